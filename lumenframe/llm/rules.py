"""Quality rules with cross-document line frequency, in DataFrame operations only.

Each different text of a host is measured once: its statistics, and the hash and words of its
normalised lines.  A line that stands in too many different texts of its host is boilerplate there and
is taken out; a document that mostly consists of such lines is depleted and rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import WORD, stash, words
from lumenframe.llm.secrets import let


def _filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def worded_lines(text: Column) -> Column:
    """The lines, cut at line feeds, that hold a word."""
    return F.filter(F.split(_filled(text), "\n", -1), lambda x: x.rlike(WORD))


def repeated_words(tokens: Column) -> Column:
    """How many words stand in windows of three words that occur twice or more, the first included.

    Windows are compared by 64-bit hashes of their words.  Few repeated hashes are looked up window by
    window; where there are many, the windows are sorted.
    """

    def windows(w: Column) -> Column:
        return F.transform(
            F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a == b, F.lit(False))

    def sorted_places(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            twice = F.filter(s, lambda e, j: same(F.get(s, j - 1)["h"], e["h"]) | same(F.get(s, j + 1)["h"], e["h"]))
            return F.sort_array(F.transform(twice, lambda e: e["i"]))

        return let(placed, marked)

    def looked_up(h: Column, twice: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(twice, F.get(h, i)))

    def spread(at: Column) -> Column:
        """Words under windows that begin at the ascending places ``at``."""
        steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda n, x: n + x)

    def covered(h: Column) -> Column:
        twice = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (F.get(s, i - 1) == x))))
        places = let(twice, lambda d: F.when(F.size(d) <= 64, looked_up(h, d)).otherwise(sorted_places(h)))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(places, spread))

    return let(tokens, lambda w: F.coalesce(let(windows(w), covered), F.lit(0))).cast("long")


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(text: Column) -> Column:
    """A struct of ``stats`` (a struct of STATS) and ``lines``: ``k`` (key) and ``n`` (words) of each line with a word.

    The words are taken once, line by line; a word never crosses a line feed.
    """
    symbols = F.length(F.regexp_replace(_filled(text), "[^#*$%&|<>]+", "")).cast("long")

    def of(lines: Column, split: Column) -> Column:
        stats = let(
            F.flatten(split),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                symbols.alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                repeated_words(w).alias("n_repeat_words"),
            ),
        )
        keyed = F.transform(split, lambda w: F.struct(F.xxhash64(F.lower(F.array_join(w, " "))).alias("k"), F.size(w).alias("n")))
        return F.struct(stats.alias("stats"), keyed.alias("lines"))

    return let(worded_lines(text), lambda lines: let(F.transform(lines, words), lambda split: of(lines, split)))


def base_stats(text: Column) -> Column:
    """A struct of STATS."""
    return measured(text)["stats"]


def base_failed(stats: Column) -> Column:
    """Under 50 words, or over half of the words repeated."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def line_key(line: Column) -> Column:
    """Hash of a line without regard to case and white space."""
    return F.xxhash64(F.lower(F.array_join(words(line), " ")))


def host_key(host: Column) -> Column:
    """The host, or one of its own for NULL."""
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def copy_key(text: Column) -> Column:
    return F.unhex(F.md5(_filled(text)))


#: A frequent line is repeated so often before it meets its documents; at ``most`` >= SALTS the repeated
#: list has fewer rows than the lines themselves.
SALTS = 16


def texts(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``host``, ``copy`` (digest of the text), ``stats``, ``lines`` of each different text of a host, written."""
    rows = docs.select(
        host_key(F.col(host)).alias("host"), copy_key(F.col(text)).alias("copy"), measured(F.col(text)).alias("m")
    )
    once = rows.groupBy("host", "copy").agg(F.first("m").alias("m"))
    return stash(once.select("host", "copy", "m.stats", "m.lines"), "texts")


def frequent(known: DataFrame, most: int) -> DataFrame:
    """``host``, ``line`` of the lines that stand in more than ``most`` different texts of the host.

    ``known`` has one row per text and host, so a line counts once in each of its rows and the counts
    are combined before the shuffle.
    """
    lines = known.select("host", F.explode(F.array_distinct("lines.k")).alias("line"))
    return lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("found")).where(F.col("found") > most).select("host", "line")


def removals(known: DataFrame, most: int = 20) -> DataFrame:
    """``host``, ``copy``, ``removed_words``, ``removed_lines``: what each of the ``texts`` loses on its host."""
    often = stash(frequent(known, most), "frequent-lines")
    often = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lines = known.select("host", "copy", F.inline("lines")).withColumnRenamed("k", "line")
    lines = lines.withColumn("salt", F.pmod(F.xxhash64("copy"), F.lit(SALTS)).cast("int"))
    hit = lines.join(often, ["host", "line", "salt"])
    return hit.groupBy("host", "copy").agg(F.sum("n").alias("removed_words"), F.collect_set("line").alias("removed_lines"))


def verdicts(docs: DataFrame, host: str = "source", text: str = "text", most: int = 20, depleted: float = 0.8) -> DataFrame:
    """``host``, ``copy``, ``stats``, ``base_failed``, ``removed_words``, ``removed_lines``, ``kept`` of each text."""
    known = texts(docs, host, text)
    rows = known.drop("lines").join(removals(known, most), ["host", "copy"], "left")
    rows = rows.withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    failed = base_failed(F.col("stats"))
    fine = F.col("removed_words") <= depleted * F.col("stats.n_words")
    return rows.select("host", "copy", "stats", failed.alias("base_failed"), "removed_words", "removed_lines", (~failed & fine).alias("kept"))


def without_lines(text: Column, removed: Column) -> Column:
    """The text without its lines whose key is in ``removed``."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~(x.rlike(WORD) & F.array_contains(removed, line_key(x)))), "\n")


def judge(
    docs: DataFrame,
    columns: Sequence[str],
    host: str = "source",
    text: str = "text",
    most: int = 20,
    depleted: float = 0.8,
) -> DataFrame:
    """One row per document: ``doc`` (a struct of ``columns``), ``stats``, ``base_failed``,
    ``removed_words``, ``removed_lines`` (keys, NULL if none), ``kept``.

    A line is boilerplate on its host if it stands in more than ``most`` different texts there.  A
    document is kept if it passes the base rules and no more than ``depleted`` of its words stand in
    boilerplate lines.  NULL and empty texts have no words and fail; a NULL host is a host of its
    own; repeated rows and copies get equal verdicts and count as one document; a text of any length
    is read whole; an empty table gives no row.  Further columns of ``docs``, whatever their names,
    change nothing and come back only inside ``doc``.
    """
    found = verdicts(docs, host, text, most, depleted).withColumnsRenamed({"host": "__host", "copy": "__copy"})
    rows = docs.select(
        F.struct(*columns).alias("doc"), host_key(F.col(host)).alias("__host"), copy_key(F.col(text)).alias("__copy")
    )
    return rows.join(found, ["__host", "__copy"]).select("doc", "stats", "base_failed", "removed_words", "removed_lines", "kept")
