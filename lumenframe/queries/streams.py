"""T-queries: streams over the event table, drained and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import brackets as B
from lumenframe.plans.lineage import scratch
from lumenframe.queries import views
from lumenframe.queries.aggregates import progress_of
from lumenframe.queries.base import query
from lumenframe.streaming import jobs as S
from lumenframe.streaming import stateful as K
from lumenframe.streaming.ledger import answer
from lumenframe.streaming.sinks import drain

c = F.col
NOW = 1_706_745_600_000_000  # 2024-02-01 00:00 UTC


def live(spark, sf):
    """The event table as a stream, in the columns of the ``ev`` view."""
    static = views.table(spark, sf, "events")
    # a glob matches the table whether it is a file or a folder of parts
    rows = spark.readStream.schema(static.schema).parquet(f"{sf}/events.parque[t]")
    return rows.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.unix_micros(c("ts").cast("timestamp")).alias("t_us"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


_RESULT = "CASE WHEN ('0x' || substr(id, 1, 8))::BIGINT % 10 = 0 THEN 'error' ELSE 'done' END AS status"


def _failed():
    from lumenframe.functions.review import hash_shard

    return hash_shard(c("id"), 10) == 0


def _answered(spark, requests, label):
    folder = scratch(spark, label)
    return answer(S.request_results(requests, _failed(), F.lit("bad request")), ["id"], folder, f"{folder}/progress")


@query("t1_request_stream", f"SELECT DISTINCT id, {_RESULT}, CASE WHEN ('0x' || substr(id, 1, 8))::BIGINT % 10 = 0 THEN 'bad request' END AS error FROM requests", "requests")
def _(spark, sf):
    req = S.with_event_time(views.requests_of(live(spark, sf)))
    return _answered(spark, req, "t1")


@query(
    "t2_sharded_stream",
    f"SELECT DISTINCT id, {_RESULT}, CASE WHEN ('0x' || substr(id, 1, 8))::BIGINT % 10 = 0 THEN 'bad request' END AS error FROM requests WHERE ('0x' || substr(id, 1, 8))::BIGINT % 4 = 1",
    "requests",
)
def _(spark, sf):
    req = S.shard(S.with_event_time(views.requests_of(live(spark, sf))), 1, 4)
    return _answered(spark, req, "t2")


_WINDOW = """SELECT worker, t_us // {w} * {w} AS start_us, count(*) AS beats, max(load) AS max_load, sum(mem_pct) / count(*) AS avg_mem, max(mem_pct) AS max_mem,
  CAST(sum(restarts) AS BIGINT) AS restarts FROM heartbeats GROUP BY ALL"""


def _beats(spark, sf):
    return S.with_event_time(views.heartbeats_of(live(spark, sf)))


@query("t3_heartbeat_minutes", _WINDOW.format(w=60_000_000), "heartbeats")
def _(spark, sf):
    return drain(S.heartbeat_windows(_beats(spark, sf), "1 minute", None), ["worker", "start_us"], "update", label="t3")


@query("t3_heartbeat_hours", _WINDOW.format(w=3_600_000_000), "heartbeats")
def _(spark, sf):
    return drain(S.heartbeat_windows(_beats(spark, sf), "1 hour", None), ["worker", "start_us"], "update", label="t3")


@query(
    "t3_service_hours",
    """, s AS (SELECT worker, t_us, unnest(['agent', service]) AS service, unnest(['active', service_state]) AS st FROM heartbeats)
       SELECT worker, service, t_us // 3600000000 * 3600000000 AS start_us, count(*) AS beats, count_if(st = 'failed') AS failures FROM s GROUP BY ALL""",
    "heartbeats",
)
def _(spark, sf):
    agent = F.struct(F.lit("agent").alias("name"), F.lit("active").alias("status"))
    own = F.struct(c("service").alias("name"), c("service_state").alias("status"))
    beats = _beats(spark, sf).withColumn("services", F.array(agent, own))
    return drain(S.service_windows(beats, "1 hour", None), ["worker", "service", "start_us"], "update", label="t3s")


@query(
    "t4_worker_latest",
    f""", l AS (SELECT worker, arg_max(seq, (t_us, seq)) AS seq, max(t_us) AS t_us, arg_max(service, (t_us, seq)) AS service FROM heartbeats GROUP BY worker)
       SELECT worker, seq, t_us, CASE WHEN service IN ('click', 'purchase') THEN 'processing' ELSE 'idle' END AS state, {NOW} - t_us > 259200000000 AS silent FROM l""",
    "heartbeats",
)
def _(spark, sf):
    latest = drain(S.worker_latest(views.heartbeats_of(live(spark, sf))), ["worker"], "update", label="t4")
    return S.worker_status(latest, NOW, 3 * 86_400)


@query(
    "t5_progress_stream",
    """SELECT user_id AS job, count(*) AS processed, count_if(event_type = 'click') AS detected, count_if(event_type = 'purchase') AS repaired, count_if(event_type = 'error') AS failed FROM ev GROUP BY user_id""",
    "ev",
)
def _(spark, sf):
    return drain(S.progress(progress_of(live(spark, sf))), ["job"], "update", label="t5")


@query(
    "t6_throughput_sliding",
    """SELECT user_id AS worker, (t_us // 600000000 - i) * 600000000 AS start_us, count(*) AS n FROM ev, range(6) r(i) WHERE event_type = 'purchase' GROUP BY ALL""",
    "ev",
)
def _(spark, sf):
    done = S.with_event_time(live(spark, sf).where("event_type = 'purchase'").select(c("user_id").alias("worker"), "t_us"))
    return drain(S.throughput_sliding(done, late=None), ["worker", "start_us"], "update", label="t6")


@query(
    "t7_bracket_stream",
    """, f AS (SELECT * FROM frames WHERE ev IS NOT NULL),
      fl AS (SELECT *, CASE WHEN lag(ev) OVER w IS NULL OR ev < lag(ev) OVER w OR t_us - lag(t_us) OVER w > 86400000000 THEN 1 ELSE 0 END AS opens FROM f WINDOW w AS (PARTITION BY shoot ORDER BY t_us, name)),
      cl AS (SELECT *, sum(opens) OVER (PARTITION BY shoot ORDER BY t_us, name) AS cn FROM fl),
      oc AS (SELECT shoot, min(t_us) AS cluster, count(*) AS n, arg_min(frame_id, (abs(ev), t_us, name)) FILTER (abs(ev) <= 1) AS mid, arg_min(frame_id, (-ev, t_us, name)) FILTER (ev <= -1) AS under,
        arg_min(frame_id, (ev, t_us, name)) FILTER (ev >= 1) AS over FROM cl GROUP BY shoot, cn)
      SELECT shoot, cluster, under, mid, over FROM oc WHERE n >= 3 AND mid <> under AND mid <> over AND under <> over""",
    "frames",
)
def _(spark, sf):
    labelled = K.bracket_stream(_arriving(spark, sf), 86_400.0, "2 days")
    rows = drain(labelled, ["shoot", "cluster", "frame_id"], "append", label="t7", settings=K.STORE)
    return B.select_triplets(rows.where("frame_id >= 0"))


def _arriving(spark, sf):
    """The frames as a stream of files in time order.

    Two closing frames per shoot, long after the last event, arrive as later files: the first moves the
    watermark, the second lets every shoot see it.
    """
    path = scratch(spark, "frames")
    f = views.frames(spark, sf).select("shoot", "frame_id", "name", "t_us", "ev")
    ranges = 4  # every shoot is opened once a batch: more rows make larger batches, not more of them
    parts = max(4, -(-f.count() // 2_000_000))
    edges = [int(x) for x in f.approxQuantile("t_us", [k / ranges for k in range(1, ranges)], 0.05)]
    for lo, hi in zip([-(2**62), *edges], [*edges, 2**62]):
        some = f.where((c("t_us") >= lo) & (c("t_us") < hi)).repartitionByRange(parts, "t_us")
        some.write.parquet(f"{path}/a{lo + 2**62:020d}")
    for i, days in enumerate((30, 90)):
        at = F.lit(NOW + days * 86_400_000_000)
        end = f.select("shoot").distinct().select(
            "shoot", F.lit(-1).cast("long").alias("frame_id"), F.lit("end").alias("name"), at.alias("t_us"), F.lit(-9.0).alias("ev")
        )
        end.repartition(parts, "shoot").write.parquet(f"{path}/b{i}")
    stream = spark.readStream.schema(f.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", parts).parquet(path)
    return S.with_event_time(stream)


@query(
    "t7_bracket_sessions",
    """, f AS (SELECT * FROM frames WHERE ev IS NOT NULL),
      fl AS (SELECT *, CASE WHEN lag(t_us) OVER w IS NULL OR t_us - lag(t_us) OVER w > 86400000000 THEN 1 ELSE 0 END AS opens FROM f WINDOW w AS (PARTITION BY shoot ORDER BY t_us, name)),
      cl AS (SELECT *, sum(opens) OVER (PARTITION BY shoot ORDER BY t_us, name) AS cn FROM fl)
      SELECT shoot, min(t_us) AS cluster, count(*) AS n, max(t_us) AS last_us, arg_min(frame_id, (-ev, t_us, name)) FILTER (ev <= -1) AS under, arg_min(frame_id, (abs(ev), t_us, name)) FILTER (abs(ev) <= 1) AS mid,
        arg_min(frame_id, (ev, t_us, name)) FILTER (ev >= 1) AS over FROM cl GROUP BY shoot, cn""",
    "frames",
)
def _(spark, sf):
    got = drain(K.bracket_sessions(_arriving(spark, sf), 86_400.0, "2 days"), ["shoot", "cluster"], "append", label="t7s")
    return got.where(c("cluster") < NOW + 30 * 86_400_000_000)


_DAY = 86_400_000_000


@query(
    "t4_worker_silence",
    f""", m AS (SELECT (max(t_us) // 1000 - 86400000) * 1000 AS mark FROM heartbeats),
      b AS (SELECT DISTINCT worker, t_us FROM heartbeats WHERE worker IS NOT NULL),
      g AS (SELECT worker, t_us, lag(t_us) OVER w AS prev, lead(t_us) OVER w AS next FROM b WINDOW w AS (PARTITION BY worker ORDER BY t_us))
      SELECT worker, 'silent' AS kind, t_us + {3 * _DAY} AS t_us FROM g, m WHERE (next IS NULL OR next - t_us > {3 * _DAY}) AND t_us + {3 * _DAY} < mark
      UNION ALL SELECT worker, 'back', t_us FROM g, m WHERE t_us - prev > {3 * _DAY} AND t_us <= mark""",
    "heartbeats",
)
def _(spark, sf):
    return drain(K.silence(_beats(spark, sf), 3 * 86_400.0, "1 day"), ["worker", "kind", "t_us"], "append", label="t4s", settings=K.STORE)


@query(
    "t8_pending_actions",
    """, l AS (SELECT user_id AS worker, t_us, event_id AS seq, CASE WHEN k % 2 = 0 THEN 'restart_worker' ELSE 'reboot_host' END AS action, CASE event_type WHEN 'signup' THEN 'request' WHEN 'error' THEN 'executed' END AS kind FROM ev WHERE event_type IN ('signup', 'error')),
      st AS (SELECT user_id AS worker, max(t_us) AS started_us FROM ev WHERE event_type = 'view' AND k < 20 GROUP BY user_id),
      rq AS (SELECT * FROM l WHERE kind = 'request' AND NOT EXISTS (SELECT 1 FROM l x WHERE x.worker = l.worker AND x.kind = 'executed' AND (x.t_us, x.seq) >= (l.t_us, l.seq))),
      nw AS (SELECT worker, max(t_us) AS t_us, arg_max(seq, (t_us, seq)) AS seq, arg_max(action, (t_us, seq)) AS action FROM rq GROUP BY worker)
      SELECT worker, action, t_us, seq FROM nw LEFT JOIN st USING (worker) WHERE started_us IS NULL OR t_us > started_us""",
    "ev",
)
def _(spark, sf):
    e = live(spark, sf).where("event_type IN ('signup', 'error')")
    log = e.select(
        c("user_id").alias("worker"),
        "t_us",
        c("event_id").alias("seq"),
        F.when(c("k") % 2 == 0, "restart_worker").otherwise("reboot_host").alias("action"),
        F.when(c("event_type") == "signup", "request").otherwise("executed").alias("kind"),
    )
    started = views.ev(spark, sf).where("event_type = 'view' AND k < 20").groupBy(c("user_id").alias("worker")).agg(F.max("t_us").alias("started_us"))
    last = drain(S.last_actions(log), ["worker"], "update", label="t8")
    return S.pending_actions(last, started)


@query(
    "t8_unanswered",
    f""", l AS (SELECT user_id AS worker, t_us, event_id AS seq, CASE WHEN k % 2 = 0 THEN 'restart_worker' ELSE 'reboot_host' END AS action, event_type FROM ev WHERE event_type IN ('signup', 'error')),
      m AS (SELECT least(max(t_us) FILTER (event_type = 'signup'), max(t_us) FILTER (event_type = 'error')) // 1000 * 1000 - {_DAY} AS mark FROM l)
      SELECT worker, action, t_us, seq FROM l r, m WHERE event_type = 'signup' AND t_us + {5 * _DAY} < mark
        AND NOT EXISTS (SELECT 1 FROM l x WHERE x.event_type = 'error' AND x.worker = r.worker AND x.action = r.action AND x.t_us BETWEEN r.t_us AND r.t_us + {5 * _DAY})""",
    "ev",
)
def _(spark, sf):
    def side(kind):
        action = F.when(c("k") % 2 == 0, "restart_worker").otherwise("reboot_host")
        rows = live(spark, sf).where(c("event_type") == kind)
        return S.with_event_time(rows.select(c("user_id").alias("worker"), action.alias("action"), "t_us", c("event_id").alias("seq")))

    got = K.unanswered(side("signup"), side("error"), "5 days", "1 day")
    return drain(got, ["worker", "action", "t_us", "seq"], "append", label="t8u")
