"""Conversation structure repair as lightest derivations.

Edits of a row and insertions are axioms of a weighted hypergraph; ``rest(i, state)`` says that rows
``i`` and later can be edited so that the roles so far, in ``state``, are completed to a legal
conversation.  An agenda pops items by weight (Knuth's generalisation of shortest paths), and a popped
item is final.  Weights are (cost, rows used, audit): every deduction adds up costs and rows and joins
audits, which is monotone, and never gives less than its parts, which is superior.

A long conversation is cut in blocks of rows.  A block is solved for every pair of entry and exit
state; insertions stand before a row of the block or after the last row of all, so audits of one block
are never prefixes of each other and the best ones can be chained.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Mapping, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import stash
from lumenframe.plans.ordered import ranked

#: Legal role initials are ``(s?(ua)+)?``. States: start, after s, after u, after a.
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ROLES = {"u": "user", "a": "assistant"}
#: What must be added after the last row from each state, its cost and audit.
TAILS = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Fixed value: no character but white space.
BLANK = r"^[\x20\x09-\x0D]*\z"
CUT = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"

Weight = tuple[int, int, str]


def _plus(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def edits(initial: str, fault: str) -> dict[str, Weight]:
    """The weight of turning a row into each role ("" if deleted)."""
    out: dict[str, Weight] = {"": (DELETE, 1, "D")}
    if fault in ("blank", "duplicate"):
        return out
    more = TRUNCATED if fault == "truncated" else 0
    for r in ROLES:
        out[r] = (REROLE + more, 1, "R")
    if initial in ("s", "u", "a"):
        out[initial] = (more, 1, "K")
    return out


def lightest(rows: Sequence[tuple[str, str]], ends: Mapping[int, tuple[int, str]], goals: Sequence[int]) -> dict[int, tuple[int, str]]:
    """For each goal state the (cost, audit) of the lightest derivation of ``rest(0, state)``.

    ``rows`` has (role initial, fault); ``ends`` gives the states after the last row with the weight of
    what follows.  A goal that cannot be derived is left out.
    """
    n, count = len(rows), 0
    agenda: list[tuple[Weight, int, tuple]] = []

    def push(weight: Weight, item: tuple) -> None:
        nonlocal count
        if item not in final:
            count += 1
            heapq.heappush(agenda, (weight, count, item))

    final: dict[tuple, Weight] = {}
    wanted = {("rest", 0, q) for q in goals}
    for i, row in enumerate(rows):
        for role, weight in edits(*row).items():
            push(weight, ("row", i, role))
    for role in ROLES:
        push((INSERT, 0, "I"), ("new", role))
    for q, (cost, audit) in ends.items():
        push((cost, 0, audit), ("rest", n, q))
    while agenda and wanted:
        weight, _, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        wanted.discard(item)
        if item[0] == "rest":
            _, i, to = item
            for q, moves in MOVES.items():
                for role, target in moves.items():
                    if target != to:
                        continue
                    if (row := final.get(("row", i - 1, role))) is not None:
                        push(_plus(row, weight), ("rest", i - 1, q))
                    if i < n and (new := final.get(("new", role))) is not None:
                        push(_plus(new, weight), ("rest", i, q))
            if (row := final.get(("row", i - 1, ""))) is not None:
                push(_plus(row, weight), ("rest", i - 1, to))
        elif item[0] == "row":
            _, i, role = item
            for q, moves in MOVES.items():
                to = moves.get(role) if role else q
                if to is not None and (rest := final.get(("rest", i + 1, to))) is not None:
                    push(_plus(weight, rest), ("rest", i, q))
        else:
            for (kind, *at), rest in list(final.items()):
                if kind == "rest" and at[0] < n:
                    for q, moves in MOVES.items():
                        if moves.get(item[1]) == at[1]:
                            push(_plus(weight, rest), ("rest", at[0], q))
    got = {q: final.get(("rest", 0, q)) for q in goals}
    return {q: (w[0], w[2]) for q, w in got.items() if w is not None}


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``rows`` (``conv``, ``turn``, ``role``, ``text``) with the faults that a digest of their place deals out.

    NULLs are written as one space.
    """

    def text(c: Column | str) -> Column:
        return F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c, F.lit(" "))

    k = (F.crc32(F.concat(text(conv), F.lit(":"), text(turn)).cast("binary")) % 20).alias("k")
    got = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), text("role").alias("role"), text("text").alias("text"), k)
    said = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    got = got.where("k <> 0").select(
        "conv", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), F.explode(times).alias("copy")
    )
    return got.drop("copy")


def _key(conv: Column) -> Column:
    """A conversation's name; NULL is a conversation too."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def numbered(rows: DataFrame, block: int = 4096) -> DataFrame:
    """``rows`` with ``key``, ``rn`` (from 1, by turn, NULL first, then role and text) and ``block``, written.

    The order is cut in ranges of 1024 turns, so a long conversation is numbered by many tasks.
    """
    got = rows.withColumn("key", _key(F.col("conv")))
    slot = F.coalesce(F.floor(F.col("turn") / 1024).cast("long"), F.lit(-(1 << 62)))
    got = ranked(got, ["key"], slot, ["turn", "role", "text"], "rn")
    return stash(got.withColumn("block", F.floor((F.col("rn") - 1) / block).cast("long")), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """``key``, ``block``, ``rn``, ``turn``, ``initial``, ``fault`` of the ``numbered`` rows."""
    mark = F.unhex(F.sha2(F.concat("role", F.lit("\n"), "text"), 256))
    flags = rows.select(
        "key", "block", "rn", "turn", F.substring("role", 1, 1).alias("initial"),
        F.col("text").rlike(BLANK).alias("blank"), F.col("text").rlike(CUT).alias("cut"), F.struct(F.length("role").alias("n"), mark.alias("h")).alias("said"),
    )
    first = flags.groupBy("key", "said").agg(F.min("rn").alias("first"))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("rn") > F.col("first"), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    )
    return flags.join(first, ["key", "said"]).select("key", "block", "rn", "turn", "initial", fault.alias("fault"))


_BLOCK = (
    "key string, block bigint, costs array<int>, audits array<string>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first string, last string"
)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, block, final, initial, fault) in order: per block its table of entry and exit states.

    The last block of a conversation has one column, the whole way to the goal.
    """
    rows = ((r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(5)))))
    out: list[tuple] = []
    for (key, block, last), part in groupby(rows, lambda r: r[:3]):
        part = [r[3:] for r in part]
        starts = (0,) if block == 0 else tuple(MOVES)
        columns = [TAILS] if last else [{q: (0, "")} for q in MOVES]
        found = [lightest(part, ends, starts) for ends in columns]
        table = [column.get(q) for q in MOVES for column in found]
        names = [r[1] for r in part]
        pairs = [a[0] + b[0] for a, b in zip(part, part[1:])]
        out.append(
            (
                key, block, [t and t[0] for t in table], [t and t[1] for t in table],
                names.count("blank"), names.count("duplicate"), names.count("truncated"),
                sum(p not in ("su", "ua", "au") for p in pairs), part[0][0], part[-1][0],
            )
        )
        if len(out) >= 200:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    s, i = pa.string(), pa.int64()
    types = (s, i, pa.list_(pa.int32()), pa.list_(s), i, i, i, i, s, s)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [p.split(" ")[0] for p in _BLOCK.split(", ")])


def blocks(flagged: DataFrame) -> DataFrame:
    """The solved blocks of the rows of ``faults``, written."""
    ends = flagged.groupBy("key").agg(F.max("block").alias("end"))
    rows = flagged.join(ends, "key").select("key", "block", (F.col("block") == F.col("end")).alias("final"), "initial", "fault", "rn")
    # rows are small and dear to solve: a number of its own keeps adaptive execution from joining tasks
    tasks = int(flagged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "key", "block").sortWithinPartitions("key", "block", "rn").drop("rn")
    return stash(rows.mapInArrow(_solve, _BLOCK), "solved-blocks")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation from the last to the first: the audit of each, and the totals at block 0.

    Only the best entry per state is kept; equal costs are told apart by the block's audit, then by
    the order of the audits that follow, kept as a rank.
    """
    rows = (r for b in batches for r in b.to_pylist())
    for _, part in groupby(rows, lambda r: r["key"]):
        best, ways, after, sums = None, [], None, [0, 0, 0, 0]
        for r in part:
            width = len(r["costs"]) // len(MOVES)
            way = {}
            for q in MOVES:
                at = range(q * width, (q + 1) * width)
                options = []
                for to, k in enumerate(at):
                    if r["costs"][k] is not None and (best is None or to in best):
                        cost, rank = best[to] if best else (0, 0)
                        options.append((r["costs"][k] + cost, r["audits"][k], rank, to))
                if options:
                    way[q] = min(options)
            order = {x: k for k, x in enumerate(sorted({w[1:3] for w in way.values()}))}
            best = {q: (w[0], order[w[1:3]]) for q, w in way.items()}
            ways.append((r["block"], {q: (w[1], w[3]) for q, w in way.items()}))
            across = after is not None and r["last"] + after not in ("su", "ua", "au")
            sums = [a + b for a, b in zip(sums, (r["blank"], r["duplicate"], r["truncated"], r["illegal"] + across))]
            after = r["first"]
        state, out = 0, []
        for k, way in reversed(ways):
            entry, (audit, state) = state, way[state]
            out.append((r["key"], k, entry, audit, *(sums if k == 0 else [None] * 4), best[0][0] if k == 0 else None))
        s, i = pa.string(), pa.int64()
        names = ["key", "block", "entry", "audit", "blank", "duplicate", "truncated", "illegal", "cost"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (s, i, pa.int32(), s, i, i, i, i, i))], names)


def audits(solved: DataFrame) -> DataFrame:
    """``key``, ``block``, ``entry`` (state before it), ``audit`` of the cheapest edits; the totals of a conversation at its block 0; written."""
    rows = solved.repartition("key").sortWithinPartitions("key", F.col("block").desc())
    schema = "key string, block bigint, entry int, audit string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    return stash(rows.mapInArrow(_chain, schema), "audits")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, block, rn, role, text), the audit of a block (as text, rn 0) before its rows: repaired rows."""
    state: dict[str, int] = {}
    here, audit, at, role_state = None, "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, role_state
        while at < len(audit) and audit[at] == "I":
            role = next(iter(MOVES[role_state] if role_state else {"u": 2}))
            role_state = MOVES[role_state][role]
            at += 1
            yield (*here, at, ROLES[role], "")

    for batch in batches:
        out: list[tuple] = []
        for key, block, rn, entry, role, text in zip(*(batch.column(k).to_pylist() for k in range(6))):
            if rn == 0:
                if here is not None:
                    out.extend(inserted())
                here, audit, at, role_state = (key, block), text, 0, entry
                continue
            out.extend(inserted())
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            initial = role[:1] if edit == "K" else next(iter(MOVES[role_state] if role_state else {"u": 2}))
            role_state = MOVES[role_state][initial]
            out.append((*here, at, role if edit == "K" else ROLES[initial], text))
        if out:
            yield _repaired(out)
    if here is not None and (out := list(inserted())):
        yield _repaired(out)


def _repaired(out: list[tuple]) -> pa.RecordBatch:
    s, i = pa.string(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (s, i, i, s, s))], ["key", "block", "place", "role", "text"])


def repaired(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """``key``, ``block``, ``place``, ``role``, ``text``: the rows that are left and the inserted ones, in order."""
    notes = pieces.select("key", "block", F.lit(0).cast("long").alias("rn"), "entry", F.lit("").alias("role"), F.col("audit").alias("text"))
    turns = rows.select("key", "block", "rn", F.lit(0).alias("entry"), "role", "text").unionByName(notes)
    turns = turns.repartition("key", "block").sortWithinPartitions("key", "block", "rn")
    return turns.mapInArrow(_apply, "key string, block bigint, place bigint, role string, text string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, line) in order: the SHA-256 of each conversation's lines, read as a stream."""
    here, state = None, None
    for batch in batches:
        out = []
        for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != here:
                if state is not None:
                    out.append((here, state.hexdigest()))
                here, state = key, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(line.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([here]), pa.array([state.hexdigest()])], ["key", "sha"])


def _totals(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda p: p["audit"]), "").alias("audit")
    sums = [F.max(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    per = pieces.groupBy("key").agg(whole, *sums)
    turns = rows.groupBy("key", "turn").agg(F.lit(1).alias("x")).groupBy("key").agg(
        F.max("turn").cast("decimal(38,0)").alias("hi"), F.min("turn").cast("decimal(38,0)").alias("lo"), F.count("turn").alias("n")
    )
    gaps = F.coalesce(F.expr("try_cast(hi - lo + 1 - n AS bigint)"), F.when(F.col("n") == 0, F.lit(0)).cast("long"))
    return per.join(turns.select("key", gaps.alias("gaps")), "key")


def repair(rows: DataFrame, block: int = 4096) -> tuple[DataFrame, DataFrame]:
    """``(totals, turns)`` for ``rows`` with ``conv``, ``turn``, ``role`` and ``text``.

    ``totals`` has a row per conversation: ``key``, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost``, ``audit``.  ``turns`` has the rows of the repaired conversations: ``key``,
    ``block``, ``place`` (their order), ``role``, ``text``.

    Rows go by turn (NULL first), then role and text; of equal rows the later ones are duplicates.
    NULL roles and texts are empty; a NULL conversation is one of its own.  Texts and conversations may
    be of any length; a conversation is cut in blocks of ``block`` rows.  An empty table gives empty results.
    """
    clean = rows.select("conv", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = numbered(clean, block)
    pieces = audits(blocks(faults(placed)))
    return _totals(placed, pieces), repaired(placed, pieces)


def digests(turns: DataFrame) -> DataFrame:
    """``key``, ``sha``: the digest of ``role:text`` of a conversation's rows, joined by line feeds."""
    lines = turns.select("key", F.concat("role", F.lit(":"), "text").alias("line"), "block", "place")
    lines = lines.repartition("key").sortWithinPartitions("key", "block", "place").select("key", "line")
    return lines.mapInArrow(_digest, "key string, sha string")


def repair_damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", block: int = 4096) -> DataFrame:
    """``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``
    of every conversation of ``rows``, damaged by ``damage`` and repaired.

    A conversation that lost all rows has zeros, an empty audit and the digest of the empty string.
    Columns of ``rows`` beside ``conv``, ``turn``, ``role`` and ``text`` are not read.
    """
    totals, turns = repair(damage(rows, conv, turn), block)
    found = totals.join(digests(turns), "key", "left")
    all_ = rows.select(F.col(conv).alias("__conv")).distinct().withColumn("key", _key(F.col("__conv")))
    got = all_.join(found, "key", "left")
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    gaps = F.when(F.col("cost").isNull(), F.lit(0)).otherwise(F.col("gaps")).cast("long").alias("gaps")
    return got.select(
        F.col("__conv").alias(conv), gaps, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
