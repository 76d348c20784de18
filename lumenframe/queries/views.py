"""Stand-in views: the shared tables seen as frames, reviews, pixels, boxes and so on.

Each view exists twice, as a DataFrame and as SQL for the twin engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


SQL: dict[str, tuple[str, str]] = {}


def _sql(name: str, deps: str, text: str) -> None:
    SQL[name] = (deps, text)


def twin_sql(body: str, *views: str) -> str:
    """``body`` behind the CTEs it needs; a body that opens with a comma adds CTEs itself."""
    order: list[str] = []

    def need(v: str) -> None:
        for d in SQL[v][0].split():
            need(d)
        if v not in order:
            order.append(v)

    for v in views:
        need(v)
    ctes = ",\n".join(f"{v} AS ({SQL[v][1]})" for v in order)
    body = body.strip()
    if body.startswith(","):
        if not order:
            body = body[1:]
    elif not order:
        return body
    return f"WITH RECURSIVE {ctes}\n{body}"


# ---- event log ---------------------------------------------------------------------------

_sql("ev", "", """SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t_us,
  CAST(props->>'$.k' AS INT) AS k FROM events""")


def ev(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


_sql("frames", "ev", """SELECT user_id AS shoot, event_id AS frame_id,
  'DSC' || lpad(CAST(event_id AS VARCHAR), 9, '0') || '.' ||
     CASE WHEN event_type IN ('view','click') THEN 'ARW' ELSE 'JPG' END AS name,
  CASE WHEN event_type IN ('view','click') THEN 'ARW' ELSE 'JPG' END AS ext,
  t_us, CASE WHEN k % 17 = 16 THEN NULL ELSE CAST(k % 7 - 3 AS DOUBLE) END AS ev,
  CAST(floor(value * 100) AS BIGINT) AS size FROM ev""")


def frames(spark: SparkSession, folder: str) -> DataFrame:
    return frames_of(ev(spark, folder))


def frames_of(e: DataFrame) -> DataFrame:
    ext = F.when(F.col("event_type").isin("view", "click"), "ARW").otherwise("JPG")
    number = F.lpad(F.col("event_id").cast("string"), 9, "0")
    return e.select(
        F.col("user_id").alias("shoot"),
        F.col("event_id").alias("frame_id"),
        F.concat(F.lit("DSC"), number, F.lit("."), ext).alias("name"),
        ext.alias("ext"),
        "t_us",
        F.when(F.col("k") % 17 != 16, (F.col("k") % 7 - 3).cast("double")).alias("ev"),
        F.floor(F.col("value") * 100).cast("long").alias("size"),
    )


# a re-uploaded card: some frames come again under a copy name or as a camera JPG
_sql("uploads", "frames", """SELECT * FROM frames
  UNION ALL SELECT shoot, frame_id, replace(name, '.', ' (1).'), ext, t_us, ev, size
    FROM frames WHERE frame_id % 5 = 0
  UNION ALL SELECT shoot, frame_id, replace(replace(name, 'ARW', 'JPG'), 'DSC', 'CAM'), 'JPG', t_us, ev, size + 1
    FROM frames WHERE frame_id % 3 = 0""")


def uploads(spark: SparkSession, folder: str) -> DataFrame:
    f = frames(spark, folder)
    again = f.where("frame_id % 5 = 0").withColumn("name", F.expr("replace(name, '.', ' (1).')"))
    jpg = (
        f.where("frame_id % 3 = 0")
        .withColumn("name", F.expr("replace(replace(name, 'ARW', 'JPG'), 'DSC', 'CAM')"))
        .withColumn("ext", F.lit("JPG"))
        .withColumn("size", F.col("size") + 1)
    )
    return f.unionByName(again).unionByName(jpg)


_sql("journal", "ev", """SELECT user_id AS slug, event_id AS seq,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS label FROM ev""")


def journal(spark: SparkSession, folder: str) -> DataFrame:
    return ev(spark, folder).select(
        F.col("user_id").alias("slug"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("label"),
    )


_sql("sides", "ev", """SELECT DISTINCT user_id AS shoot,
  CASE WHEN event_type = 'view' THEN 'ours' ELSE 'vendor' END AS side, k AS num,
  CASE WHEN event_type = 'view' THEN 'DSC' WHEN k % 3 = 0 THEN 'dsc_' ELSE 'IMG_' END || lpad(CAST(k AS VARCHAR), 5, '0') || '.jpg' AS name
  FROM ev WHERE event_type IN ('view', 'click')""")


def sides(spark: SparkSession, folder: str) -> DataFrame:
    ours = F.col("event_type") == "view"
    return (
        ev(spark, folder)
        .where(F.col("event_type").isin("view", "click"))
        .select(
            F.col("user_id").alias("shoot"),
            F.when(ours, "ours").otherwise("vendor").alias("side"),
            F.col("k").alias("num"),
            F.concat(
                F.when(ours, "DSC").when(F.col("k") % 3 == 0, "dsc_").otherwise("IMG_"),
                F.lpad(F.col("k").cast("string"), 5, "0"),
                F.lit(".jpg"),
            ).alias("name"),
        )
        .distinct()
    )


_sql("requests", "ev", """SELECT sha256(user_id || '-' || k) AS id, user_id AS job, k, t_us,
  event_id AS seq, value FROM ev WHERE event_type = 'signup'""")
_sql("done", "ev", """SELECT sha256(user_id || '-' || k) AS id, min(t_us) AS done_us
  FROM ev WHERE event_type = 'purchase' GROUP BY ALL""")


def requests_of(e: DataFrame) -> DataFrame:
    return e.where("event_type = 'signup'").select(
        F.sha2(F.concat_ws("-", "user_id", "k"), 256).alias("id"),
        F.col("user_id").alias("job"),
        "k",
        "t_us",
        F.col("event_id").alias("seq"),
        "value",
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return requests_of(ev(spark, folder))


def done(spark: SparkSession, folder: str) -> DataFrame:
    return (
        ev(spark, folder)
        .where("event_type = 'purchase'")
        .groupBy(F.sha2(F.concat_ws("-", "user_id", "k"), 256).alias("id"))
        .agg(F.min("t_us").alias("done_us"))
    )


_sql("heartbeats", "ev", """SELECT user_id AS worker, event_id AS seq, t_us, value AS load, k AS mem_pct,
  8 AS cores, k % 3 AS restarts, event_type AS service,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'active' END AS service_state FROM ev""")


def heartbeats_of(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("user_id").alias("worker"),
        F.col("event_id").alias("seq"),
        "t_us",
        F.col("value").alias("load"),
        F.col("k").alias("mem_pct"),
        F.lit(8).alias("cores"),
        (F.col("k") % 3).alias("restarts"),
        F.col("event_type").alias("service"),
        F.when(F.col("event_type") == "error", "failed").otherwise("active").alias("service_state"),
    )


def heartbeats(spark: SparkSession, folder: str) -> DataFrame:
    return heartbeats_of(ev(spark, folder))


# ---- pixels --------------------------------------------------------------------------------

_sql("gray", "", """SELECT vec_id AS image_id, CAST((i - 1) % 8 AS INT) AS x, CAST((i - 1) // 8 AS INT) AS y,
  CAST(greatest(0, least(255, floor((CAST(embedding[i] AS DOUBLE) + 0.5) * 255))) AS INT) AS g
  FROM embeddings, range(1, 65) r(i)""")


def gray(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "embeddings")
    return v.select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("pos", "v")).select(
        "image_id",
        (F.col("pos") % 8).cast("int").alias("x"),
        F.floor(F.col("pos") / 8).cast("int").alias("y"),
        F.greatest(F.lit(0), F.least(F.lit(255), F.floor((F.col("v").cast("double") + 0.5) * 255)))
        .cast("int")
        .alias("g"),
    )


_sql("rgb", "gray", """SELECT image_id // 3 AS image, x, y,
  max(CASE WHEN image_id % 3 = 0 THEN g END) AS r,
  max(CASE WHEN image_id % 3 = 1 THEN g END) AS g,
  max(CASE WHEN image_id % 3 = 2 THEN g END) AS b
  FROM gray GROUP BY image_id // 3, x, y HAVING count(*) = 3""")


def rgb(spark: SparkSession, folder: str) -> DataFrame:
    g = gray(spark, folder)

    def plane(i: int):
        return F.max(F.when(F.col("image_id") % 3 == i, F.col("g")))

    return (
        g.groupBy(F.floor(F.col("image_id") / 3).alias("image"), "x", "y")
        .agg(plane(0).alias("r"), plane(1).alias("g"), plane(2).alias("b"), F.count(F.lit(1)).alias("n"))
        .where("n = 3")
        .drop("n")
    )


_sql("masks", "gray", "SELECT image_id, x, y FROM gray WHERE g > 140")
_sql("dims", "", "SELECT vec_id AS image_id, 8 AS w, 8 AS h FROM embeddings")


def masks(spark: SparkSession, folder: str) -> DataFrame:
    return gray(spark, folder).where("g > 140").select("image_id", "x", "y")


def dims(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "embeddings")
    return v.select(F.col("vec_id").alias("image_id"), F.lit(8).alias("w"), F.lit(8).alias("h"))


_sql("preds", "", """SELECT vec_id AS image_id, label AS truth,
  (label + CAST(vec_id % 5 = 0 AS INT)) % 10 AS pred,
  (label + CAST(vec_id % 7 = 0 AS INT) * 2) % 10 AS pred_b,
  ((vec_id * 37) % 100) / 100 AS confidence, vec_id % 3 AS version FROM embeddings""")


def preds(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "embeddings")

    def off(n: int):
        return (F.col("vec_id") % n == 0).cast("int")

    return v.select(
        F.col("vec_id").alias("image_id"),
        F.col("label").alias("truth"),
        ((F.col("label") + off(5)) % 10).alias("pred"),
        ((F.col("label") + off(7) * 2) % 10).alias("pred_b"),
        ((F.col("vec_id") * 37 % 100) / 100).alias("confidence"),
        (F.col("vec_id") % 3).alias("version"),
    )


# ---- jobs, reviews, boxes, segments -----------------------------------------------------------

_sql("jobs", "", """SELECT o_orderkey AS job_id, 'client-' || (o_custkey % 97) AS client,
  CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'processing' END AS status,
  epoch_us(o_orderdate) AS completed_us, o_custkey AS photographer,
  'Uploads/' || strftime(o_orderdate, '%Y') || '/Clerk ' || (o_custkey % 50) || '/' ||
    CASE WHEN o_orderkey % 9 = 0 THEN 'loose files'
    ELSE strftime(o_orderdate, '%m.%d.%Y') || ' ' || (o_orderkey % 20) || ' ' || (o_custkey % 900 + 1) || '-'
      || lower(replace(o_orderpriority, ' ', '-')) || '-rd'
      || CASE WHEN o_orderkey % 4 = 0 THEN '  (Agent ' || (o_custkey % 30) || ')' ELSE '' END END AS path
  FROM orders""")


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("job_id"),
        F.expr("concat('client-', o_custkey % 97)").alias("client"),
        F.expr(
            "CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'processing' END"
        ).alias("status"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("completed_us"),
        F.col("o_custkey").alias("photographer"),
        F.expr(
            """concat('Uploads/', date_format(o_orderdate, 'yyyy'), '/Clerk ', o_custkey % 50, '/',
            CASE WHEN o_orderkey % 9 = 0 THEN 'loose files' ELSE
            concat(date_format(o_orderdate, 'MM.dd.yyyy'), ' ', o_orderkey % 20, ' ', o_custkey % 900 + 1, '-',
              lower(replace(o_orderpriority, ' ', '-')), '-rd',
              CASE WHEN o_orderkey % 4 = 0 THEN concat('  (Agent ', o_custkey % 30, ')') ELSE '' END) END)"""
        ).alias("path"),
    )


# (order, line number, part, supplier) is unique in the line table and names a photo
_sql("reviews", "", """SELECT l_orderkey AS job_id,
  'DSC' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS stem,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag = 'A' END AS interior_corrected,
  l_linestatus = 'O' AS interior_worker,
  CASE l_partkey % 5 WHEN 0 THEN 'kitchen' WHEN 1 THEN 'bedroom' WHEN 2 THEN 'bathroom'
    WHEN 3 THEN 'exterior' END AS room_worker,
  CASE l_suppkey % 7 WHEN 0 THEN 'office' WHEN 1 THEN 'kitchen' END AS room_corrected,
  CASE WHEN l_tax < 0.04 THEN NULL ELSE 'editor-' || (l_suppkey % 9) END AS verified_by,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE
    '{"dust":"' || CASE WHEN l_discount > 0.06 THEN 'true' ELSE 'false' END || '"' ||
    CASE WHEN l_linenumber % 2 = 0 THEN ',"glare":"' ||
      CASE WHEN l_discount < 0.02 THEN 'true' ELSE 'false' END || '"' ELSE '' END || '}' END AS conditions,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 'out/' || l_orderkey || '/' || l_partkey || '.jpg' END AS output_path,
  CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE 'vendor/' || l_orderkey || '/' || l_suppkey || '.jpg' END AS vendor_path,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'img-' || l_partkey || '-' || l_suppkey END AS image_key,
  l_partkey AS part_no, l_suppkey AS supp_no, epoch_us(l_shipdate) AS created_us FROM lineitem""")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("job_id"),
        F.expr("concat('DSC', l_linenumber, '_', l_partkey, '_', l_suppkey)").alias("stem"),
        F.expr("CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag = 'A' END").alias("interior_corrected"),
        F.expr("l_linestatus = 'O'").alias("interior_worker"),
        F.expr(
            "CASE l_partkey % 5 WHEN 0 THEN 'kitchen' WHEN 1 THEN 'bedroom' WHEN 2 THEN 'bathroom' "
            "WHEN 3 THEN 'exterior' END"
        ).alias("room_worker"),
        F.expr("CASE l_suppkey % 7 WHEN 0 THEN 'office' WHEN 1 THEN 'kitchen' END").alias("room_corrected"),
        F.expr("CASE WHEN l_tax < 0.04D THEN NULL ELSE concat('editor-', l_suppkey % 9) END").alias("verified_by"),
        F.expr(
            """CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE concat('{"dust":"',
            CASE WHEN l_discount > 0.06D THEN 'true' ELSE 'false' END, '"',
            CASE WHEN l_linenumber % 2 = 0 THEN concat(',"glare":"',
              CASE WHEN l_discount < 0.02D THEN 'true' ELSE 'false' END, '"') ELSE '' END, '}') END"""
        ).alias("conditions"),
        F.expr(
            "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE concat('out/', l_orderkey, '/', l_partkey, '.jpg') END"
        ).alias("output_path"),
        F.expr(
            "CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE concat('vendor/', l_orderkey, '/', l_suppkey, '.jpg') END"
        ).alias("vendor_path"),
        F.expr("CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE concat('img-', l_partkey, '-', l_suppkey) END").alias(
            "image_key"
        ),
        F.col("l_partkey").alias("part_no"),
        F.col("l_suppkey").alias("supp_no"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("created_us"),
    )


_sql("boxes", "", """SELECT l_orderkey AS image, l_linenumber % 2 + 1 AS cls,
  l_linenumber || '-' || l_partkey || '-' || l_suppkey AS box_id,
  CAST(l_partkey % 48 AS INT) AS x0, CAST(l_suppkey % 48 AS INT) AS y0,
  CAST(l_partkey % 48 + 8 + CAST(l_quantity AS BIGINT) % 16 AS INT) AS x1,
  CAST(l_suppkey % 48 + 8 + CAST(l_quantity AS BIGINT) % 16 AS INT) AS y1,
  l_returnflag = 'N' AS is_truth, round(l_discount * 10, 1) AS score FROM lineitem""")


def boxes(spark: SparkSession, folder: str) -> DataFrame:
    side = "8 + CAST(l_quantity AS BIGINT) % 16"
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("image"),
        (F.col("l_linenumber") % 2 + 1).alias("cls"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("box_id"),
        F.expr("CAST(l_partkey % 48 AS INT)").alias("x0"),
        F.expr("CAST(l_suppkey % 48 AS INT)").alias("y0"),
        F.expr(f"CAST(l_partkey % 48 + {side} AS INT)").alias("x1"),
        F.expr(f"CAST(l_suppkey % 48 + {side} AS INT)").alias("y1"),
        F.expr("l_returnflag = 'N'").alias("is_truth"),
        F.expr("round(l_discount * 10, 1)").alias("score"),
    )


_sql("segments", "", """SELECT l_orderkey AS image, l_linenumber || '-' || l_partkey || '-' || l_suppkey AS seg_id,
  CAST(l_partkey % 21 - 10 AS INT) AS dx, CAST(1 + l_suppkey % 60 AS INT) AS dy,
  CAST(round(l_discount * 100) AS INT) AS tweak FROM lineitem""")


def segments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("image"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("seg_id"),
        F.expr("CAST(l_partkey % 21 - 10 AS INT)").alias("dx"),
        F.expr("CAST(1 + l_suppkey % 60 AS INT)").alias("dy"),
        F.expr("CAST(round(l_discount * 100) AS INT)").alias("tweak"),
    )


# ---- file names ----------------------------------------------------------------------------------

_sql("names", "", """SELECT p_partkey AS file_no, p_partkey // 2 % 40 AS shoot,
  CASE p_partkey % 9 WHEN 7 THEN 'photo ' || p_size WHEN 8 THEN 'IMG_' || lpad(CAST(p_partkey // 2 % 100000 AS VARCHAR), 4, '0')
    ELSE 'DSC' || lpad(CAST(p_partkey // 2 % 100000 AS VARCHAR), 5, '0') END AS stem,
  CASE p_size % 4 WHEN 1 THEN '_stage2-int' WHEN 2 THEN '_stage2-ext' ELSE '' END AS suffix,
  CASE p_size % 6 WHEN 0 THEN 'ARW' WHEN 1 THEN 'JPG' WHEN 2 THEN 'jpeg' WHEN 3 THEN 'dng' WHEN 4 THEN 'png' ELSE 'txt' END AS ext,
  p_size AS size, md5(p_name) AS sha FROM part""")


def names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("file_no"),
        F.expr("p_partkey DIV 2 % 40").alias("shoot"),
        F.expr(
            """CASE p_partkey % 9 WHEN 7 THEN concat('photo ', p_size)
            WHEN 8 THEN concat('IMG_', lpad(CAST(p_partkey DIV 2 % 100000 AS STRING), 4, '0'))
            ELSE concat('DSC', lpad(CAST(p_partkey DIV 2 % 100000 AS STRING), 5, '0')) END"""
        ).alias("stem"),
        F.expr(
            "CASE p_size % 4 WHEN 1 THEN '_stage2-int' WHEN 2 THEN '_stage2-ext' ELSE '' END"
        ).alias("suffix"),
        F.expr(
            "CASE p_size % 6 WHEN 0 THEN 'ARW' WHEN 1 THEN 'JPG' WHEN 2 THEN 'jpeg' WHEN 3 THEN 'dng' "
            "WHEN 4 THEN 'png' ELSE 'txt' END"
        ).alias("ext"),
        F.col("p_size").alias("size"),
        F.md5("p_name").alias("sha"),
    )
