"""Main text of pages: a linear-chain conditional random field over DOM leaf blocks.

The field has two labels, features of the enclosing tags, of the words in their classes and of the
text, and weights for neighbouring labels.  It is trained on the labelled pages of this package, a
fixed small set, and decoded by Viterbi; Spark only carries the weights to the pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.dom import Block, blocks
from lumenframe.llm.labelled_pages import MARK, labelled_pages

#: Words of class, id and role names, by what they usually stand for.
NAMES = {
    "main": "article content entry main post story body text prose",
    "comment": "comment comments commentlist reply replies respond responses disqus discussion reviews thread",
    "advert": "ad ads advert adverts advertisement advertising adsbygoogle banner promo promotion sponsored sponsor",
    "notice": "alert consent cookie cookies disclaimer gdpr message modal notice notification notices paywall popup privacy warning toast",
    "menu": "breadcrumb breadcrumbs menu nav navbar navigation pagination pager tabs toc toolbar",
    "header": "header masthead top topbar hero",
    "footer": "bottom copyright footer legal",
    "side": "aside complementary rail recommended related share sharing sidebar social widget widgets trending popular",
    "form": "form login newsletter search signup subscribe subscription register",
}
_GROUP = {w: f"name {g}" for g, words in NAMES.items() for w in words.split()}
_TAGS = frozenset(
    "article aside body button caption details dialog div fieldset figcaption figure footer form h1 h2 h3 h4 head header label legend li main nav "
    "noscript ol option p section select svg table td template textarea title ul blockquote pre dl".split()
)


def stands_for(name: str) -> str | None:
    """The feature that a tag or a word of a class, id or role around a block gives."""
    if name[0] == "<":
        return f"in {name}" if name[1:] in _TAGS else None
    return name if name == "*hidden" else _GROUP.get(name)


@lru_cache(maxsize=50_000)
def _around(found: frozenset[str]) -> tuple[str, ...]:
    return tuple(sorted(found))


def features(block: Block) -> list[str]:
    text = block.text
    n = text.count(" ") + 1
    share = block.linked / len(text)
    out = ["bias", *_around(block.around), f"tag {block.tag}" if block.tag in _TAGS else "tag other"]
    out.append(f"words {min(7, n.bit_length())}")
    out.append("all link" if share > 0.8 else "some link" if share > 0.25 else "no link")
    if text[-1] in ".!?":
        out.append("sentence end")
    if "©" in text:
        out.append("copyright")
    return out


class Field:
    """Weights by feature name, and those of neighbouring labels."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray) -> None:
        self.weights = weights
        self.steps = steps.tolist()

    def decode(self, page: list[Block]) -> list[bool]:
        """The best labels: True for blocks of the main text."""
        if not page:
            return []
        get, s = self.weights.get, self.steps
        off = on = 0.0
        back: list[tuple[bool, bool]] = []
        for i, b in enumerate(page):
            gain = sum(get(f, 0.0) for f in features(b))
            if i:
                a, c = (off + s[0][0], on + s[1][0]), (off + s[0][1], on + s[1][1])
                back.append((a[1] > a[0], c[1] > c[0]))
                off, on = max(a), max(c) + gain
            else:
                on = gain
        label = on > off
        labels = [label]
        for came in reversed(back):
            label = came[label]
            labels.append(label)
        return labels[::-1]


def marked(page: str) -> tuple[list[Block], list[int]]:
    """The blocks of a labelled page without its marks, and their labels."""
    got, labels = [], []
    for b in blocks(page, stands_for):
        labels.append(int(MARK in b.text))
        b.text = b.text.replace(MARK, "").strip() or "."
        got.append(b)
    return got, labels


def train(pages: list[str], rounds: int = 120, ridge: float = 0.5) -> Field:
    """Maximum conditional likelihood with a quadratic penalty, by gradient steps with momentum."""
    data, ids = [], {}
    for page in pages:
        found, labels = marked(page)
        rows = [[ids.setdefault(f, len(ids)) for f in features(b)] for b in found]
        data.append((rows, np.array(labels)))
    d = len(ids)
    longest = max(len(y) for _, y in data)
    x = np.zeros((len(data), longest, d), np.float32)
    y = np.zeros((len(data), longest), int)
    here = np.zeros((len(data), longest), bool)
    for p, (rows, labels) in enumerate(data):
        for i, row in enumerate(rows):
            x[p, i, row] = 1
        y[p, : len(labels)], here[p, : len(labels)] = labels, True
    flat, pair = x.reshape(-1, d), here[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][pair], y[:, 1:][pair]), 1)
    target = flat.T @ (y * here).ravel()
    w, t = np.zeros(d), np.zeros((2, 2))
    move_w, move_t = np.zeros(d), np.zeros((2, 2))
    total = here.sum()
    for _ in range(rounds):
        unary = np.zeros((len(data), longest, 2))
        unary[..., 1] = (flat @ w).reshape(len(data), longest)
        ahead, after = np.zeros_like(unary), np.zeros_like(unary)
        ahead[:, 0] = unary[:, 0]
        for i in range(1, longest):
            step = np.logaddexp(ahead[:, i - 1, 0, None] + t[0], ahead[:, i - 1, 1, None] + t[1]) + unary[:, i]
            ahead[:, i] = np.where(here[:, i, None], step, ahead[:, i - 1])
        for i in range(longest - 2, -1, -1):
            z = after[:, i + 1] + unary[:, i + 1]
            step = np.logaddexp(t[:, 0] + z[:, 0, None], t[:, 1] + z[:, 1, None])
            after[:, i] = np.where(here[:, i + 1, None], step, after[:, i + 1])
        norm = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        one = np.exp(ahead[..., 1] + after[..., 1] - norm[:, None]) * here
        both = ahead[:, :-1, :, None] + t + (unary + after)[:, 1:, None, :] - norm[:, None, None, None]
        expected = (np.exp(np.minimum(both, 0)) * pair[..., None, None]).sum(axis=(0, 1))
        grad_w = (target - flat.T @ one.ravel()) - ridge * w
        grad_t = seen - expected - ridge * t
        move_w = 0.9 * move_w + grad_w
        move_t = 0.9 * move_t + grad_t
        w, t = w + 2.0 / total * move_w, t + 2.0 / total * move_t
    return Field({f: float(w[k]) for f, k in ids.items()}, t)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_pages())


def main_text(field: Field, page: str) -> str:
    found = list(blocks(page, stands_for))
    return "\n".join(b.text for b, keep in zip(found, field.decode(found)) if keep)


def extract(pages: DataFrame, field: Field | None = None, html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by line feeds in page order.  NULL and empty pages, and pages without main text, give the
    empty text.  Repeated rows stay.  A page of any length or depth is read whole, at a cost in proportion
    to it; an empty table gives no row; further columns, whatever their names, are not read.
    """
    field = field or default_field()
    rows = pages.select("page_id", "url", F.coalesce(html, F.lit("")).alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(field, x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
