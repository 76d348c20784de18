"""The named queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import bpe, chat, extraction, fingerprints, language, mixing, neardup, quality, repair, rules, secrets, simhash, whitening
from lumenframe.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS turn FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s FROM d GROUP BY source),
w AS (
  SELECT source, s, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM per),
b AS (SELECT 1.5::DOUBLE * sum(s)::DOUBLE AS budget FROM per),
lv AS (
  SELECT *, (budget - coalesce(sum(2.0::DOUBLE * s) OVER before_, 0.0)) / sum(weight) OVER after_ AS level,
         2.0::DOUBLE * s / weight AS ratio
  FROM w, b
  WINDOW before_ AS (ORDER BY 2.0::DOUBLE * s / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after_ AS (ORDER BY 2.0::DOUBLE * s / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT level FROM lv WHERE ratio >= level ORDER BY ratio LIMIT 1),
t AS (SELECT source, s, least(2.0::DOUBLE * s, weight * coalesce((SELECT level FROM l), 0)) AS target FROM w),
q AS (
  SELECT d.*, t.s AS source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS queued
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
i AS (
  SELECT q.*, epoch, (queued + epoch * source_size)::DOUBLE / target AS finish FROM q, (VALUES (0), (1)) e(epoch) WHERE size > 0 AND target > 0),
r AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, turn, size, epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM i),
k AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM r, b WHERE run <= budget GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.taken, 0)::BIGINT AS taken FROM q LEFT JOIN k USING (doc_id)
"""


@query("op1_mix", MIX_SQL)
def op1_mix(spark, folder):
    got = mixing.mix(table(spark, folder, "documents"), ["doc_id"])
    return got.select("doc.doc_id", "size", "source_size", "target", "taken")


@query("op7_bpe")
def op7_bpe(spark, folder):
    return bpe.encode(table(spark, folder, "documents"), ids=False)


CHAT_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(role || text) + 4 * (length(role || text) - length(replace(role || text, '&', '')))
            + 3 * (length(role || text) - length(regexp_replace(role || text, '[<>\[\]]', '', 'g'))) AS escaped
  FROM rows_)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       (sum(escaped + length('<s>[] </s>')) + count(*) - 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op4_chat", CHAT_SQL)
def op4_chat(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    cells = [F.struct(F.lit(-1).alias("conv_id"), F.lit(k).alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for k, r in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.range(1).select(F.inline(F.array(*cells))))
    got = chat.format_paths(chat.chains(rows))
    return got.select(F.col("tree").alias("conv_id"), *[c.alias(n) for n, c in chat.read_back(F.col("formatted"), F.col("loss")).items()])


_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = (
    ("assign", _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]+", "length(m) >= 24"),
    ("private_key", "-----BEGIN (?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY-----", "true"),
    ("forge_token", "gh[pousr]_[A-Za-z0-9]{36,}", "true"),
    ("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", "true"),
)
#: What follows the BEGIN mark of a key without its END mark: up to eight header lines, then base64 lines.
_LINE = r"(?:[\x20\t\r]*(?:\n|\\[rn]))+[\x20\t]*"
_BODY = (
    r"^(" + rf"(?:{_LINE}[A-Za-z0-9-]{{1,40}}:[^\n\\]{{0,200}})?" * 8 + rf"(?:{_LINE}[A-Za-z0-9+/=]{{16,}})+(?:{_LINE}[A-Za-z0-9+/=]{{1,15}})?)"
    r"[\x20\t\r]*(?:\n|\\[rn]|\z)"
)
SECRETS_SQL = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), u AS ("
    + " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS o, '{kind}' AS kind, i, m, g, {ok} AS ok FROM (
        SELECT doc_id, unnest(m) AS m, unnest(s[1:len(m)]) AS g, generate_subscripts(m, 1) AS i FROM (
        SELECT doc_id, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS s FROM d))"""
        for k, (kind, p, ok) in enumerate(_KINDS)
    )
    + """), w AS (
  SELECT doc_id, o, kind, ok, m, length(m) AS n, sum(length(m) + length(g)) OVER (PARTITION BY doc_id, o ORDER BY i) AS stop FROM u),
k AS (
  SELECT doc_id, o, kind, stop - n AS start, stop, CASE WHEN o = 3 THEN substr(t, stop::BIGINT + 1) END AS rest, '-----END ' || substr(m, 12) AS mark
  FROM w JOIN d USING (doc_id) WHERE ok),
f AS (
  SELECT doc_id, o, kind, start::BIGINT AS start, (stop + CASE WHEN o <> 3 THEN 0
    WHEN strpos(rest, '-----') > 0 AND starts_with(substr(rest, strpos(rest, '-----')), mark) THEN strpos(rest, '-----') - 1 + length(mark)
    ELSE length(regexp_extract(rest, '""" + _BODY + """', 1)) END)::BIGINT AS stop FROM k),
a AS (
  SELECT doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans
  FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)"""
)


@query("op8_secrets", SECRETS_SQL)
def op8_secrets(spark, folder):
    docs = table(spark, folder, "documents")
    # the base rules come first; the further rules are scanned against the ledger they left
    blobs = secrets.blobs_of(docs)
    got = secrets.find(docs, ledger=secrets.record(blobs, rules=secrets.BASE), blobs=blobs)
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE))

    def count(rank):
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    return got.select(
        "doc_id",
        *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(secrets.BASE)],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


RULES_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, '=' || source AS host FROM documents),
s AS (
  SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS a, unnest(w[2:] || [NULL]) AS b, unnest(w[3:] || [NULL, NULL])  AS c FROM s WHERE len(w) >= 3),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS twice FROM g WHERE c IS NOT NULL),
v AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM h WHERE twice),
r AS (SELECT doc_id, count(*) AS n FROM v GROUP BY doc_id),
l0 AS (SELECT doc_id, host, t, unnest(lines) AS line FROM s JOIN d USING (doc_id)),
l2 AS (SELECT *, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS k, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l0),
b AS (SELECT host, k FROM l2 GROUP BY host, k HAVING count(DISTINCT t) > 20),
x AS (SELECT doc_id, sum(n)::BIGINT AS lost FROM l2 JOIN b USING (host, k) GROUP BY doc_id),
o AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(x.lost, 0)::BIGINT AS removed_words
  FROM s LEFT JOIN r USING (doc_id) LEFT JOIN x USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= 0.8::DOUBLE * n_words AS kept
FROM o
"""


@query("op9_rules", RULES_SQL)
def op9_rules(spark, folder):
    got = rules.judge(table(spark, folder, "documents"), ["doc_id"])
    return got.select("doc.doc_id", "stats.*", "removed_words", "base_failed", "kept")


NEARDUP_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
both_ AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT y, root FROM r JOIN both_ ON x = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id)::BIGINT AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


@query("op6_neardup", NEARDUP_SQL)
def op6_neardup(spark, folder):
    got = neardup.group(table(spark, folder, "documents"))
    return got.select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_fingerprints")
def op2_fingerprints(spark, folder):
    return fingerprints.compare_next(table(spark, folder, "documents"))


@query("op3_quality")
def op3_quality(spark, folder):
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_language")
def op5_language(spark, folder):
    return language.identify_held_out(table(spark, folder, "documents"))


@query("op10_extraction")
def op10_extraction(spark, folder):
    return extraction.extract(table(spark, folder, "pages"))


@query("op11_whitening")
def op11_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


@query("op12_simhash")
def op12_simhash(spark, folder):
    return simhash.group(table(spark, folder, "documents"))


@query("op13_repair")
def op13_repair(spark, folder):
    return repair.repair_damaged(table(spark, folder, "conversations"))
