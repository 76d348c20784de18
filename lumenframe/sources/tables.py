"""Table, journal, CSV, TSV and JSON scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.plans.ordered import digest, digest_slot, ranked


def read_table(spark: SparkSession, path: str, columns: Sequence[str], where: Column | None = None, fmt: str = "parquet") -> DataFrame:
    """Projection scan; the filter and the columns reach the files."""
    df = spark.read.format(fmt).load(path)
    return (df if where is None else df.where(where)).select(*columns)


def read_jdbc(spark: SparkSession, url: str, table: str, split: str, low: int, high: int, parts: int, options: Mapping[str, str]) -> DataFrame:
    """Partitioned scan of a database table over a numeric column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    return reader.options(partitionColumn=split, lowerBound=low, upperBound=high, numPartitions=parts).load()


JOURNAL = T.StructType(
    [T.StructField("slug", T.StringType()), T.StructField("label", T.StringType()), T.StructField("seq", T.LongType())]
)


def read_journal(spark: SparkSession, path: str, schema: T.StructType = JOURNAL) -> DataFrame:
    """Label journal, one JSON object per line; blank and malformed lines are skipped."""
    broken = T.StructType([*schema.fields, T.StructField("__broken", T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__broken", "allowSingleQuotes": "false"}
    rows = lines.select(F.from_json("value", broken, options).alias("r"))
    return rows.where("r IS NOT NULL AND r.__broken IS NULL AND r.slug IS NOT NULL").select("r.*").drop("__broken")


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header; every cell stays text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False, escape='"')


def write_csv(df: DataFrame, path: str, fields: Sequence[str]) -> None:
    """Write the listed fields with a header; other columns are left out."""
    df.select(*fields).write.mode("overwrite").csv(path, header=True, escape='"')


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Tab-separated lines with at least as many cells as columns; ``#`` starts a comment."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    cells = F.split("value", "\t")
    rows = lines.select(cells.alias("c")).where(F.size("c") >= len(columns))
    return rows.select(*[F.col("c")[i].alias(n) for i, n in enumerate(columns)])


ANNOTATION = "path string, boxes array<array<double>>, labels array<int>"


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Annotation documents as one row per box; images without boxes keep one empty row."""
    docs = spark.read.schema(ANNOTATION).json(path)
    both = docs.select("path", F.explode_outer(F.arrays_zip("boxes", "labels")).alias("b"))
    box = F.col("b.boxes")
    return both.select("path", F.col("b.labels").alias("label"), *[F.get(box, F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


BOXES_PER_DOC = 10_000


def write_annotations(boxes: DataFrame, path: str, box_key: str, per_doc: int = BOXES_PER_DOC) -> None:
    """JSON documents from a box table, in numbered parts of ``per_doc`` boxes for every image.

    Boxes go by a digest of ``box_key``, which tells those of an image apart; the first part is 0.
    """
    keyed = boxes.withColumn("__turn", digest("box", F.col(box_key).cast("string")))
    placed = ranked(keyed, ["path"], digest_slot("__turn", 1), ["__turn"], "__place")
    part = F.floor((F.col("__place") - 1) / per_doc).cast("int")
    box = F.array(*[F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")])
    entry = F.struct(box.alias("b"), F.col("label").cast("int").alias("l"))
    docs = placed.groupBy("path", part.alias("part")).agg(F.array_sort(F.collect_list(entry)).alias("r"))
    docs.select("path", "part", F.col("r.b").alias("boxes"), F.col("r.l").alias("labels")).write.mode("overwrite").json(path)


RUN = "shoot bigint, n_triplets int, triplets array<struct<under:string,mid:string,over:string,ms:bigint>>"


def read_run_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Run documents flattened to one row per developed triplet."""
    return spark.read.schema(RUN).json(path).select("shoot", "n_triplets", F.inline("triplets"))


REQUEST = "id string, job bigint, k int, t_us bigint"


def read_requests(spark: SparkSession, path: str, schema: str = REQUEST) -> DataFrame:
    """Queued requests; a record without an id is named by its file."""
    rows = spark.read.schema(schema).json(path, pathGlobFilter="*.json", recursiveFileLookup=True)
    return rows.withColumn("id", F.coalesce("id", file_id()))


def stream_requests(
    spark: SparkSession, path: str, schema: str = REQUEST, files_per_batch: int = 1000, archive: str | None = None
) -> DataFrame:
    """The same queue as a stream.  With ``archive`` (outside ``path``) the files of answered batches move there."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.json")
    if archive:
        rows = rows.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return rows.json(path).withColumn("id", F.coalesce("id", file_id()))


def file_id() -> Column:
    return F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")


def output_keys(df: DataFrame, job: str, order: str, stem: str) -> DataFrame:
    """Delivery key of each photo."""
    return df.withColumn("key", F.format_string("tours/%s/photos/%04d-%s.jpg", F.col(job).cast("string"), order, stem))


JOB_BUCKETS = 64


def write_by_job(df: DataFrame, path: str, job: str, buckets: int = JOB_BUCKETS) -> None:
    """Parquet in folders by a hash of the job: a reader of one job opens one folder.

    Tasks are dealt by folder and split where one is large, so the number of files follows the
    data, not tasks times jobs.
    """
    laid = df.withColumn("job_bucket", F.pmod(F.xxhash64(F.col(job)), F.lit(buckets)).cast("int"))
    laid.hint("rebalance", "job_bucket").write.mode("overwrite").partitionBy("job_bucket").parquet(path)


def read_jobs(spark: SparkSession, path: str, job: str, jobs: Sequence, buckets: int = JOB_BUCKETS) -> DataFrame:
    """The rows of some jobs; only their folders are listed and read."""
    rows = spark.read.parquet(path)
    wanted = [F.lit(j).cast(rows.schema[job].dataType) for j in jobs]
    numbers = spark.range(1).select(F.array(*[F.pmod(F.xxhash64(j), F.lit(buckets)).cast("int") for j in wanted])).first()[0]
    return rows.where(F.col("job_bucket").isin(*set(numbers)) & F.col(job).isin(*wanted)).drop("job_bucket")
