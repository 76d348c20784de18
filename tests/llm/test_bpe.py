import hashlib
import random

import pytest

from lumenframe.llm import bpe
import public_tokenizers

EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def enc():
    return bpe.encoding(bpe.default_ranks(), public_tokenizers.PATTERN)


@pytest.mark.parametrize("long", [3, 10, 50])
def test_safe_pieces_give_the_ids_of_the_whole_text(enc, long):
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("ab'sé 9 \n\t !漢🙂\r") for _ in range(rng.randrange(120)))
        assert "".join(bpe.safe_pieces(text, long)) == text
        assert bpe.encode_text(enc, text, long) == enc.encode_ordinary(text)


def test_rows_and_round_trip(spark, make_docs, enc):
    texts = [None, "", "a", "<|endoftext|> x", "Zukeitpf über 漢字 🙂\n\n x", "y" * 5000, "w o r d " * 40_000, "a"]
    docs = make_docs([(i if i != 7 else 2, t) for i, t in enumerate(texts)])
    got = sorted(bpe.encode(docs).collect(), key=lambda r: (r.doc_id, r.n_tokens))
    assert len(got) == len(texts)
    want = sorted((i if i != 7 else 2, enc.encode_ordinary(t or "")) for i, t in enumerate(texts))
    assert [(r.doc_id, list(r.ids)) for r in got] == want
    assert all(r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() for r in got)
    by = {r.doc_id: r for r in got}
    for i, t in enumerate(texts[:7]):
        assert by[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert by[0].ids_sha256 == EMPTY and by[0].n_tokens == 0
    raw = {r.doc_id: bytes(r.bytes) for r in bpe.decode(bpe.encode(docs)).collect()}
    assert raw[4] == texts[4].encode()


def test_clashing_columns_change_nothing(spark, make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(1, "some text"), (None, "some text")])
    more = docs
    for name in ("ids", "n_tokens", "ids_sha256", "bytes", "decoded_sha256"):
        more = more.withColumn(name, F.lit("clash"))
    assert sorted(map(str, bpe.encode(more).collect())) == sorted(map(str, bpe.encode(docs).collect()))


def test_empty_table(make_docs):
    assert bpe.encode(make_docs([])).collect() == []
