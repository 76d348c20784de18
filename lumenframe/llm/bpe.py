"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Each task loads the ranks once.  A long text is cut at safe boundaries first: between a
character that is not white space and one that is, where every match of the pattern ends, so the
pieces give the ids of the whole text and no regular expression walks over a long text at once.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SAFE = re.compile(r"(?<=\S)(?=\s)")
LONG = 200_000


def default_ranks() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, long: int = LONG) -> Iterator[str]:
    """Cut ``text`` in pieces of at least ``long`` code points, each ending at a safe boundary."""
    start = 0
    while len(text) - start > long:
        cut = _SAFE.search(text, start + long)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode_text(enc: tiktoken.Encoding, text: str, long: int = LONG) -> list[int]:
    if len(text) <= long:
        return enc.encode_ordinary(text)
    return [i for piece in safe_pieces(text, long) for i in enc.encode_ordinary(piece)]


def encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None, ids: bool = True) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (left out on request), ``ids_sha256``, ``decoded_sha256``.

    NULL and empty texts have no tokens; both digests are then those of the empty string.  Rows
    are kept one to one, repeated and NULL ids included.  Special tokens do not exist: their
    strings are ordinary text.  ``decoded_sha256`` is that of the decoded bytes.  Texts of any length are
    encoded whole; an empty table gives no row; further columns, whatever their names, are not read.
    """
    ranks, pattern = ranks or default_ranks(), pattern or public_tokenizers.PATTERN
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, {'ids array<int>, ' if ids else ''}ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            # a batch may hold many long texts: their ids leave in several small batches
            out: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = encode_text(enc, text.as_py())
                digest = hashlib.sha256(" ".join(map(str, got)).encode()).hexdigest()
                back = hashlib.sha256(enc.decode_bytes(got)).hexdigest()
                out.append((doc_id, len(got), got, digest, back))
                held += len(got) + 100
                if held > 1_000_000:
                    yield _batch(out, batch.schema.field(0).type, ids)
                    out, held = [], 0
            if out:
                yield _batch(out, batch.schema.field(0).type, ids)

    return rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], id_type: pa.DataType, ids: bool) -> pa.RecordBatch:
    a, n, i, d, b = zip(*rows)
    columns = {"doc_id": pa.array(a, id_type), "n_tokens": pa.array(n, pa.int64())}
    if ids:
        columns["ids"] = pa.array(i, pa.list_(pa.int32()))
    columns |= {"ids_sha256": pa.array(d), "decoded_sha256": pa.array(b)}
    return pa.RecordBatch.from_pydict(columns)


def decode(tokens: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id``, ``bytes``: the raw bytes of each row's ``ids`` (NULL ids: none)."""
    ranks, pattern = ranks or default_ranks(), pattern or public_tokenizers.PATTERN
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            raw = [enc.decode_bytes(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")
