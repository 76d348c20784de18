"""Secret scans over an incremental ledger of text blobs, in DataFrame operations only.

Every version of every path is addressed by the SHA-256 of its text.  Only pairs of blob and rule
version that the ledger does not hold are scanned, each blob once, and what a blob holds is joined
back to all paths and versions with that text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import stash


@dataclass(frozen=True)
class Rule:
    """``pattern`` in Java's syntax, never empty; a match counts if ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The first three kinds. A run of 24 hex digits is the run of any length that passes,
#: as runs are maximal; so for access keys. An assignment that fails still takes up its text.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
#: A private key: from its BEGIN mark to the END mark of the same label if that is the next mark, else
#: over the base64 lines that follow (after up to eight header lines), else the mark alone. Possessive and
#: bounded, so a text costs its length; line ends may be written as ``\\n``.
_BREAK = r"(?:[\x20\t\r]*+(?:\n|\\[rn]))++[\x20\t]*+"
_LINE_ENDS = r"(?=[\x20\t\r]*+(?:\n|\\[rn]|\z))"
_KEY = (
    r"-----BEGIN ((?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY)-----(?:(?:[^-]|-(?!----))*+-----END \1-----"
    rf"|(?:{_BREAK}[A-Za-z0-9-]{{1,40}}:[^\n\\]{{0,200}}+){{0,8}}+"
    rf"(?:{_BREAK}[A-Za-z0-9+/=]{{16,}}+{_LINE_ENDS})++(?:{_BREAK}[A-Za-z0-9+/=]{{1,15}}+{_LINE_ENDS})?+)?+"
)
#: Kinds beside the base ones.
MORE = (
    Rule("private_key", 2, _KEY),
    Rule("forge_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE + MORE

#: A span: code points and bytes, ends exclusive, ``rank`` the place of the rule.
SPAN = "start:bigint,rank:int,end:bigint,kind:string,from_byte:bigint,to_byte:bigint"
LEDGER = f"blob binary, rule string, spans array<struct<{SPAN}>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def address(text: Column) -> Column:
    """SHA-256 of the text; that of the empty text for NULL."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches as gaps before them and lengths, which add up to positions."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))

    def measured(all_: Column) -> Column:
        gaps = F.split(text, rule.pattern, -1)
        pairs = F.arrays_zip(all_.alias("m"), F.slice(gaps, F.lit(1), F.size(all_)).alias("g"))

        def one(p: Column, i: Column) -> Column:
            held = p["m"] if rule.group == 0 else F.regexp_extract(p["m"], rule.pattern, rule.group)
            return F.struct(
                F.lit(rank).alias("rank"),
                i.alias("i"),
                F.length(p["g"]).cast("long").alias("gap"),
                F.length(p["m"]).cast("long").alias("size"),
                F.octet_length(p["g"]).cast("long").alias("gap_bytes"),
                F.octet_length(p["m"]).cast("long").alias("bytes"),
                (F.length(held) >= rule.least).alias("ok"),
            )

        return F.when(F.size(all_) > 0, F.transform(pairs, one))

    return let(found, measured)


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob``, ``seen``, ``spans`` (of all rules not in ``seen``, by start and rank).

    ``blobs`` has ``blob`` (unique), ``text``, ``seen`` (names of rules already applied).  Positions
    come from running sums of the pieces between matches, so the work is linear in the text.
    """
    todo = [
        F.coalesce(
            F.when(~F.array_contains("seen", r.name), _matches(F.col("text"), r, k)),
            F.expr("CAST(array() AS array<struct<rank:int,i:int,gap:bigint,size:bigint,gap_bytes:bigint,bytes:bigint,ok:boolean>>)"),
        )
        for k, r in enumerate(rules)
    ]
    # rows of (blob, match); a blob without any keeps one empty row
    rows = blobs.select("blob", "seen", F.explode_outer(F.concat(*todo)).alias("f")).select("blob", "seen", "f.*")
    w = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end, to_byte = F.sum(F.col("gap") + F.col("size")).over(w), F.sum(F.col("gap_bytes") + F.col("bytes")).over(w)
    rows = rows.withColumn("end", end).withColumn("to_byte", to_byte)
    kinds = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rank") + 1)
    span = F.struct(
        (F.col("end") - F.col("size")).alias("start"), "rank", "end", kinds.alias("kind"),
        (F.col("to_byte") - F.col("bytes")).alias("from_byte"), "to_byte",
    )
    got = rows.groupBy("blob").agg(F.first("seen").alias("seen"), F.sort_array(F.collect_list(F.when(F.col("ok"), span))).alias("spans"))
    return got.withColumn("spans", F.col("spans").cast(f"array<struct<{SPAN}>>"))


def blobs_of(versions: DataFrame, text: str = "text") -> DataFrame:
    """``blob``, ``text`` of every different text of ``versions``, written: what scans of several rule sets read."""
    rows = versions.select(address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return stash(rows.groupBy("blob").agg(F.first("text").alias("text")), "blobs")


def scan_versions(
    blobs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES
) -> tuple[DataFrame, DataFrame]:
    """``(found, added)``: per blob of ``blobs_of`` its ``blob`` and ``spans`` under ``rules``, and the
    rows that the scan adds to the ledger (``blob``, ``rule``, ``spans``).

    NULL text is the empty blob, which holds nothing.  Equal texts are one blob, however many paths
    and versions have it.  An empty table gives empty results.  ``ledger`` is a table written from
    earlier ``added`` rows; rows of other rules or versions stay in it unused.
    """
    names = [r.name for r in rules]
    if ledger is None:
        fresh = scan(blobs.withColumn("seen", F.expr("CAST(array() AS array<string>)")), rules)
        known = None
    else:
        known = ledger.where(F.col("rule").isin(names)).groupBy("blob").agg(
            F.collect_set("rule").alias("seen"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("old")
        )
        seen = F.coalesce(F.array_sort("seen"), F.expr("CAST(array() AS array<string>)")).alias("seen")
        held = blobs.select("blob").join(known.select("blob", "seen"), "blob", "left").select("blob", seen)
        sets = held.select("seen").distinct().limit(2).collect()
        if len(sets) == 1:
            # the ledger holds the same rules of every blob: no text has to meet it
            blobs = blobs.withColumn("seen", F.array(*[F.lit(n) for n in sets[0].seen]).cast("array<string>"))
        else:
            blobs = blobs.join(held, "blob")
        fresh = scan(blobs.where(F.size("seen") < len(names)), rules)
    wanted = F.explode(F.array_except(F.array(*[F.lit(n) for n in names]), "seen")).alias("rule")
    ranks = F.create_map(*[x for k, n in enumerate(names) for x in (F.lit(n), F.lit(k))])
    added = fresh.select("blob", wanted, "spans").select(
        "blob", "rule", F.filter("spans", lambda s: s["rank"] == ranks[F.col("rule")]).alias("spans")
    )
    if known is None:
        return fresh.select("blob", "spans"), added
    old = blobs.select("blob").join(known.select("blob", "old"), "blob", "left")
    none = F.expr(f"CAST(array() AS array<struct<{SPAN}>>)")
    all_spans = old.join(fresh.select("blob", "spans"), "blob", "left").select(
        "blob", F.array_sort(F.concat(F.coalesce("old", none), F.coalesce("spans", none))).alias("spans")
    )
    # the place of a rule may have changed since the ledger was written
    at = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(k))])
    again = F.transform("spans", lambda s: s.withField("rank", at[s["kind"]]))
    return all_spans.withColumn("spans", F.sort_array(again)), added


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def record(blobs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """What a scan of ``blobs`` under ``rules`` adds to ``ledger``, written as a table below the shared folder."""
    _, added = scan_versions(blobs, ledger, rules)
    return stash(added, "ledger")


def find(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES, ledger: DataFrame | None = None, blobs: DataFrame | None = None
) -> DataFrame:
    """``key`` and ``spans`` of every row; what ``ledger`` holds is not scanned again, the rest once per
    blob, and is joined back to all paths.

    NULL and empty texts have no span; a text of any length is read whole; spans that begin together are
    listed by the place of their rule; repeated rows and keys come back as often as they are there; an
    empty table gives no row; further columns, whatever their names, are not read.
    """
    found, _ = scan_versions(blobs_of(docs, text) if blobs is None else blobs, ledger, rules)
    return docs.select(key, address(F.col(text)).alias("__blob")).join(found.withColumnRenamed("blob", "__blob"), "__blob").select(key, "spans")


def redact(
    docs: DataFrame,
    columns: Sequence[str],
    text: str = "text",
    mask: str = "[SECRET]",
    rules: Sequence[Rule] = RULES,
    ledger: DataFrame | None = None,
    blobs: DataFrame | None = None,
) -> DataFrame:
    """``columns`` of every row, each maximal stretch of overlapping spans in ``text`` replaced by ``mask``.

    NULL text stays NULL.  What ``ledger`` holds is not scanned again.  The parts between are cut by byte positions, so a long text with many
    spans costs its length.
    """
    found, _ = scan_versions(blobs_of(docs, text) if blobs is None else blobs, ledger, rules)
    found = found.where(F.size("spans") > 0)

    def kept(spans: Column) -> Column:
        """Stretches between the merged spans: a stretch starts where all spans so far have ended."""
        ends = F.aggregate(
            spans,
            F.struct(F.lit(0).cast("long").alias("reach"), F.expr("CAST(array() AS array<struct<a:bigint,b:bigint>>)").alias("gaps")),
            lambda acc, s: F.struct(
                F.greatest(acc["reach"], s["to_byte"]).alias("reach"),
                F.when(
                    (s["from_byte"] >= acc["reach"]) & ((s["from_byte"] > acc["reach"]) | (F.size(acc["gaps"]) == 0)),
                    F.concat(acc["gaps"], F.array(F.struct(acc["reach"].alias("a"), s["from_byte"].alias("b")))),
                )
                .otherwise(acc["gaps"])
                .alias("gaps"),
            ),
        )
        whole = F.octet_length(text).cast("long")
        return let(ends, lambda e: F.concat(e["gaps"], F.array(F.struct(e["reach"].alias("a"), whole.alias("b")))))

    cut = let(
        F.col(text).cast("binary"),
        lambda raw: F.transform(
            kept(F.col("spans")),
            lambda g: F.substr(raw, (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")).cast("string"),
        ),
    )
    rows = docs.select(F.struct(*columns).alias("doc"), text, address(F.col(text)).alias("blob"))
    rows = rows.join(found, "blob", "left")
    clean = F.when(F.col("spans").isNull(), F.col(text)).otherwise(F.array_join(cut, mask))
    return rows.select(F.col("doc").withField(text, clean).alias("doc")).select("doc.*")
