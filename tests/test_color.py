"""8-bit Lab there and back, and what is computed in it."""

from pyspark.sql import functions as F

from lumenframe.functions import color as K
from lumenframe.operators import evaluation as E
from lumenframe.operators import pixels as X

RGB = "r int, g int, b int"


def test_eight_bit_lab_of_known_colours(spark):
    known = {(255, 0, 0): (136, 208, 195), (0, 255, 0): (224, 42, 211), (0, 0, 255): (82, 207, 20), (255, 255, 255): (255, 128, 128), (0, 0, 0): (0, 128, 128)}
    rows = K.with_lab8(spark.createDataFrame(list(known), RGB), "r", "g", "b", "_").collect()
    assert {tuple(r[:3]): tuple(r[3:]) for r in rows} == known


def test_lab_and_back_stays_close(spark):
    df = spark.range(0, 256**3, 9973).select(*[(F.col("id") / F.lit(256**k) % 256).cast("int").alias(n) for k, n in enumerate("rgb")])
    back = K.with_rgb(K.with_lab8(df.select("*", *[F.col(n).alias(f"o{n}") for n in "rgb"]), "r", "g", "b", "_").drop("r", "g", "b"), "_")
    worst = back.select(*[F.avg(F.abs(F.col(n) - F.col(f"o{n}"))).alias(n) for n in "rgb"]).first()
    assert all(v < 3 for v in worst)


def test_transfer_to_itself_changes_little_and_flat_images_shift(spark):
    px = [(1, x, 0, 10 * x, 200 - 9 * x, 5 * x) for x in range(20)] + [(2, x, 0, 50, 60, 70) for x in range(5)]
    src = spark.createDataFrame(px, "image bigint, x int, y int, " + RGB)
    same = {(r.image, r.x): (r.r, r.g, r.b) for r in X.reinhard_transfer(src, src).collect()}
    assert all(max(abs(a - b) for a, b in zip(same[i, x], rgb)) <= 8 for i, x, _, *rgb in px)
    ref = src.withColumn("r", F.lit(120)).withColumn("g", F.lit(90)).withColumn("b", F.lit(30))
    flat = {(r.r, r.g, r.b) for r in X.reinhard_transfer(src.where("image = 2"), ref).collect()}
    assert len(flat) == 1 and max(abs(a - b) for a, b in zip(flat.pop(), (120, 90, 30))) <= 3


def test_sky_coverage_is_tested_before_rounding(spark):
    # 1 of 101 pixels is just below a hundredth and rounds to 0.0099
    px = [(1, i, 0, 100, 100, 250 if i == 0 else 20) for i in range(101)] + [(2, i, 0, 90, 120, 250) for i in range(10)]
    got = {r.image: r for r in E.sky_frame_scores(spark.createDataFrame(px, "image bigint, x int, y int, " + RGB), F.col("b") > F.col("r")).collect()}
    assert not got[1].has_sky and got[2].has_sky and got[2].blue_score > 0.9
    none = E.shoot_sky_decision(spark.createDataFrame(list(got.values())).where("image = 1").withColumn("shoot", F.lit(5)), "shoot").first()
    assert none.reason == "no_usable_sky_in_any_frame" and not none.swap
