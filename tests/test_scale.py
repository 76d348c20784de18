"""Skew-proof paths give the same results as the plain ones."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lumenframe.operators import evaluation as E
from lumenframe.operators import joins as J
from lumenframe.operators import pairing as P
from lumenframe.operators import sampling as S
from lumenframe.operators import similarity as Y
from lumenframe.plans.matching import greedy_match
from lumenframe.operators.brackets import bracket_clusters
from lumenframe.plans.ordered import number_slot, numbered_runs, prior, range_sums, ranked
from lumenframe.plans.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows."""
    rng = random.Random(3)
    rows = [(0 if rng.random() < 0.7 else rng.randrange(1, 20), i, rng.randrange(1000)) for i in range(3000)]
    return spark.createDataFrame(rows, "k int, i bigint, v bigint").cache()


@pytest.mark.parametrize("width", [1, 37, 100_000])
def test_prior_equals_a_plain_window(skewed, width):
    w = Window.partitionBy("k").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    plain = skewed.select(
        "i",
        F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"),
        F.max("v").over(w).alias("hi"),
        F.min("v").over(w).alias("lo"),
        F.lag("v").over(Window.partitionBy("k").orderBy("i")).alias("p"),
    )
    specs = {"s": ("sum", F.col("v")), "hi": ("max", F.col("v")), "lo": ("min", F.col("v")), "p": ("last", F.struct("v"))}
    got = prior(skewed, ["k"], number_slot("i", width), ["i"], specs).select("i", "s", "hi", "lo", F.col("p.v").alias("p"))
    assert sorted(got.collect()) == sorted(plain.collect())


def test_global_rank_without_keys(skewed):
    got = ranked(skewed, [], number_slot("i", 64), ["i"]).orderBy("i").collect()
    assert [r.rn for r in got] == list(range(1, 3001))


def test_range_sums_equal_a_pairwise_sum(spark):
    rng = random.Random(5)
    pts = [(k, p, rng.randrange(100)) for k in (1, 2) for p in rng.sample(range(-500, 500), 120)]
    df = spark.createDataFrame(pts, "k int, p bigint, w bigint")
    got = {(r.k, r.p): r.near_w for r in range_sums(df, ["k"], "p", ["w"], 20, 50).collect()}
    want = {(k, p): sum(w for k2, q, w in pts if k2 == k and abs(q - p) <= 20) for k, p, _ in pts}
    assert got == want


@pytest.mark.parametrize("small", [50_000, 20, 1])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_exact_quantiles(skewed, keys, small):
    rows = skewed.withColumn("d", F.col("v") * F.col("v") / 7.0 - 5000)
    got = exact_quantiles(rows, keys, "d", {"a": 0.0, "m": 0.5, "p": 0.95, "z": 1.0}, bins=8, small=small).collect()
    data = rows.toPandas()
    for r in got:
        part = data if not keys else data[data.k == r.k]
        want = np.percentile(part.d, [0, 50, 95, 100])
        assert np.allclose([r.a, r.m, r.p, r.z], want, rtol=0, atol=1e-9)


def test_quantile_of_one_repeated_value(spark):
    df = spark.range(500).select(F.lit(2.5).alias("d"))
    assert exact_quantiles(df, [], "d", {"m": 0.5}).first().m == 2.5


def greedy(cands):
    taken, out, served = set(), set(), set()
    for g, r, p, t in sorted(cands):
        if (g, p) not in served and (g, t) not in taken:
            served.add((g, p))
            taken.add((g, t))
            out.add((g, p, t))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_greedy_match_equals_a_walk(spark, parts):
    rng = random.Random(11)
    cands = {(g, p * 3 % 17, p, t) for g in (1, 2) for p in range(17) for t in rng.sample(range(14), 4)}
    df = spark.createDataFrame(sorted(cands), "g int, r int, p int, t int").repartition(parts)
    got = greedy_match(df, ["g"], "r", "p", "t").collect()
    assert {(x.g, x.p, x.t) for x in got} == greedy(cands)


def pair_by_hand(ours, vendor):
    votes = {}
    for o, _ in ours:
        for v, _ in vendor:
            if abs(o - v) <= 10:
                votes[o - v] = votes.get(o - v, 0) + 1
    if not votes:
        return set()
    d = min(votes, key=lambda x: (-votes[x], abs(x), x))
    used, out = set(), set()
    for o, name in sorted(ours):
        near = [(abs(v - (o - d)), v, n) for v, n in vendor if n not in used and abs(v - (o - d)) <= 1]
        if near:
            used.add(min(near)[2])
            out.add((name, min(near)[2]))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_fuzzy_pair_equals_the_file_by_file_walk(spark, seed):
    rng = random.Random(seed)
    ours = [(n, f"a{n}_{i}") for n in rng.sample(range(100), 45) for i in range(rng.choice([1, 1, 2]))]
    vendor = [(n + 4, f"b{n}_{i}") for n in rng.sample(range(100), 45) for i in range(rng.choice([1, 1, 3]))]
    schema = "shoot bigint, num bigint, name string"
    o = spark.createDataFrame([(7, n, s) for n, s in ours], schema)
    v = spark.createDataFrame([(7, n, s) for n, s in vendor], schema)
    got = {(r.ours, r.vendor) for r in P.fuzzy_pair(o, v).collect()}
    assert got == pair_by_hand(ours, vendor)


def test_tied_offsets_prefer_the_small_shift(spark):
    schema = "shoot bigint, num bigint, name string"
    o = spark.createDataFrame([(1, 20, "a"), (1, 40, "b")], schema)
    v = spark.createDataFrame([(1, 19, "x"), (1, 43, "y")], schema)
    assert P.best_offset(P.offset_votes(o, v)).first().offset == 1
    v = spark.createDataFrame([(1, 19, "x"), (1, 41, "y")], schema)
    assert P.best_offset(P.offset_votes(o, v)).first().offset == -1


def test_large_banks_are_scored_in_blocks_with_the_same_result(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(120)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    bank = df.where("id < 50")
    one = {r.id: r.score for r in Y.topk_mean(df, bank, "id", "vec", 4).collect()}
    many = {r.id: r.score for r in Y.topk_mean(df, bank, "id", "vec", 4, bank_rows=7).collect()}
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-12 for k in one)
    assert {r.score for r in Y.topk_mean(df, bank.where("false"), "id", "vec", 4).collect()} == {0.0}
    few = Y.topk_mean(df, bank.limit(2), "id", "vec", 4).count()
    assert few == 120
    # repeated keys stay rows of their own, and a bank needs no key
    twice = df.unionByName(df.select("id", F.reverse("vec").alias("vec")))
    small = sorted((r.id, round(r.score, 12)) for r in Y.topk_mean(twice, bank.select("vec"), "id", "vec", 4).collect())
    large = sorted((r.id, round(r.score, 12)) for r in Y.topk_mean(twice, bank.select("vec"), "id", "vec", 4, bank_rows=7).collect())
    assert small == large and len(small) == 240


def test_every_plate_can_be_chosen(spark):
    plates = spark.range(500).select(F.col("id").alias("plate_id"), F.concat(F.lit("p"), "id").alias("plate_path"))
    photos = spark.range(4000).select(F.col("id").alias("job_id"), F.lit("s").alias("stem"), F.lit("k").alias("object_key"))
    classes = photos.select("job_id", "stem", F.lit(False).alias("is_interior"))
    got = J.exterior_requests(photos, classes, plates, ["job_id", "stem"]).collect()
    assert len(got) == 4000 and len({r.plate_id for r in got}) > 480
    assert J.exterior_requests(photos, classes, plates.limit(0), ["job_id", "stem"]).count() == 0


def test_splits_keep_groups_whole_and_cover_all_rows(skewed):
    got = S.group_split_cumulative(skewed, "k", 0.12, 1).collect()
    sides = {}
    for r in got:
        sides.setdefault(r.k, set()).add(r.split)
    assert len(got) == 3000 and all(len(s) == 1 for s in sides.values())
    assert {"train", "val"} <= {r.split for r in got}


def test_holdout_refuses_to_use_everything(skewed):
    assert S.oldest_holdout(skewed, "i", "v", 0).where("split <> 'eval'").isEmpty()
    with pytest.raises(Exception, match="nothing to train on"):
        S.oldest_holdout(skewed, "i", "v", 3000).collect()


def test_balanced_sample_needs_enough_positives(skewed):
    with pytest.raises(Exception, match="not enough positives"):
        S.balanced_binary_sample(skewed.where("i < 5"), skewed.where("i >= 5"), "i", 50, 0).collect()


def test_tombstones(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 3, "b"), ("c", 1, "x"), ("c", 2, None)], "slug string, seq int, label string")
    assert [tuple(r) for r in S.compact_journal(log, "slug", "seq", "label").collect()] == [("a", "b")]


def test_boxes_of_any_size_meet_near_sizes_only(spark):
    rng = random.Random(8)

    def boxes(n, tag):
        out = [(1, f"{tag}{k}", x := rng.randrange(-20, 200), y := rng.randrange(200), x + rng.choice([0, 1, 5, 40, 41, 300]), y + rng.choice([1, 4, 38, 40, 250])) for k in range(n)]
        return out + [(1, f"{tag}big", 0, 0, 3000, 2000), (1, f"{tag}long", 5, 5, 2000, 6)]

    def iou(p, q):
        i = max(0, min(p[4], q[4]) - max(p[2], q[2])) * max(0, min(p[5], q[5]) - max(p[3], q[3]))
        u = sum((r[4] - r[2]) * (r[5] - r[3]) for r in (p, q)) - i
        return i / u if u else 0.0

    a, b = boxes(150, "a"), boxes(150, "b")
    schema = "image int, box_id string, x0 int, y0 int, x1 int, y1 int"
    for least in (0.5, 0.2):
        got = {(r.a_box_id, r.b_box_id) for r in J.box_pairs(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["image"], least).collect()}
        assert got == {(p[1], q[1]) for p in a for q in b if iou(p, q) >= least}
    small = spark.range(10_000).select(F.lit(1).alias("image"), F.col("id").cast("string").alias("box_id"), *[F.lit(v).alias(n) for n, v in (("x0", 7), ("y0", 7), ("x1", 9), ("y1", 9))])
    assert J.box_pairs(spark.createDataFrame(a[-2:], schema), small, ["image"], 0.5).count() == 0


@pytest.mark.parametrize("width", [1, 9, 10_000])
def test_numbered_runs_equal_a_walk(skewed, width):
    got = numbered_runs(skewed, ["k"], number_slot("i", width), ["i"], ["v"], lambda row, before: row["v"] < before["v"], "run").collect()
    want, last = {}, {}
    for r in sorted(got, key=lambda r: (r.k, r.i)):
        n, v = last.get(r.k, (0, None))
        last[r.k] = (n + (v is None or r.v < v), r.v)
        want[r.i] = last[r.k][0]
    assert {r.i: r.run for r in got} == want


def test_one_shoot_of_one_day_is_several_tasks(spark):
    frames = spark.range(5000).select(
        F.lit(1).alias("shoot"), F.col("id").alias("frame_id"), F.format_string("f%05d", "id").alias("name"),
        (F.col("id") * 17_000_000).alias("t_us"), (F.col("id") % 3 - 1).cast("double").alias("ev"),
    )
    got = bracket_clusters(frames)
    assert got.select("cluster").distinct().count() == 1667
    assert got.groupBy((F.col("t_us") / 3_600_000_000).cast("int")).count().count() == 24
    assert got._jdf.queryExecution().executedPlan().toString().count("Window") <= 8


def test_a_pile_of_boxes_is_dealt_evenly(spark):
    """20,000 boxes of one size around one spot, of which few overlap enough."""
    rng = np.random.default_rng(5)
    n = 20_000
    xy = rng.integers(0, 4000, (n, 2))
    rows = [(1, str(i), int(x), int(y), int(x) + 200, int(y) + 200) for i, (x, y) in enumerate(xy)]
    schema = "image int, box_id string, x0 int, y0 int, x1 int, y1 int"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame(rows[:3000], schema)
    got = {(r.a_box_id, r.b_box_id) for r in J.box_pairs(a, b, ["image"], 0.8).select("a_box_id", "b_box_id").collect()}
    want = set()
    for j, (x, y) in enumerate(xy[:3000]):
        w, h = 200 - np.abs(xy[:, 0] - x), 200 - np.abs(xy[:, 1] - y)
        inter = np.where((w > 0) & (h > 0), w * h, 0)
        want |= {(str(i), str(j)) for i in np.flatnonzero(inter / (80_000 - inter) >= 0.8)}
    assert got == want and len(want) > 3000
    # all on one spot: the pairs of the one cell are dealt in blocks
    same = spark.range(3000).select(F.lit(1).alias("image"), F.col("id").cast("string").alias("box_id"), *[F.lit(v).alias(c) for c, v in (("x0", 5), ("y0", 5), ("x1", 9), ("y1", 9))])
    pairs = J.box_pairs(same, same, ["image"], 0.8, block=500)
    assert pairs.count() == 9_000_000
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "__ia" in plan and "__ib" in plan


def test_a_long_chain_of_displacements_needs_no_more_jobs(spark):
    """Box i asks for targets i and i + 1: every one is displaced by the one before it."""
    def jobs(n, small):
        df = spark.createDataFrame([("g", f"{i:06d}", f"p{i:06d}", f"t{i + k:06d}") for i in range(n) for k in (0, 1)], "g string, r string, p string, t string")
        group = f"chain-{n}-{small}"
        spark.sparkContext.setJobGroup(group, group)
        got = {(x.p, x.t) for x in greedy_match(df, ["g"], "r", "p", "t", small).collect()}
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert got == {(f"p{i:06d}", f"t{i:06d}") for i in range(n)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(10, 100_000) == jobs(200, 100_000) == jobs(2000, 100_000)
    assert jobs(200, 50) < 150  # cut in components: rounds by the logarithm of the chain


def test_large_groups_are_cut_in_components(spark):
    rng = np.random.default_rng(9)
    rows = [(g, int(r), f"p{r}", f"t{t}") for g in (1, None) for r in range(150) for t in rng.choice(np.arange(r // 5 * 4, r // 5 * 4 + 6), 3, replace=False)]
    df = spark.createDataFrame(rows, "g int, r int, p string, t string")
    whole = sorted(map(str, greedy_match(df.where("g IS NOT NULL"), ["g"], "r", "p", "t").collect()))
    assert whole == sorted(map(str, greedy_match(df.where("g IS NOT NULL"), ["g"], "r", "p", "t", small=20).collect()))


def test_large_banks_are_searched_by_cells(spark):
    """Clusters of directions: exact top values, and only a part of all pairs is compared."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 12))
    vec = lambda n: (centres[rng.integers(0, 40, n)] + 0.15 * rng.standard_normal((n, 12))).tolist()
    bank_rows = vec(4000) + [[0.0] * 12] * 3 + [centres[0].tolist()] * 200
    rows = vec(300) + [[0.0] * 12, (-centres[1]).tolist()]
    bank = spark.createDataFrame([(v,) for v in bank_rows], "vec array<double>")
    queries = spark.createDataFrame(list(enumerate(rows)), "id int, vec array<double>")
    got = {r.id: (r.best, r.seen) for r in Y.pruned_topk(queries, bank, "id", "vec", 5, 300, pivots=64).collect()}

    def units(m):
        m = np.array(m)
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1, n)

    want = -np.sort(-(units(rows) @ units(bank_rows).T), axis=1)[:, :5]
    assert len(got) == len(rows)
    assert all(np.allclose(got[i][0], want[i], atol=1e-12) for i in range(len(rows)))
    share = sum(s for _, s in got.values()) / (len(rows) * len(bank_rows))
    print(f"share of pairs compared: {share:.3f}")
    assert share < 0.3


def test_cosines_are_held_a_tile_at_a_time():
    """Memory of a search in one task does not follow the size of the bank."""
    rng = np.random.default_rng(2)
    queries, bank = rng.standard_normal((3000, 8)), rng.standard_normal((9000, 8))
    tracemalloc.start()
    got = Y._best(queries, bank, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, np.sort(queries @ bank.T, axis=1)[:, -5:], atol=1e-12)
    assert peak < 40 << 20  # all pairs: 216 MB
    assert Y._best(queries[:2], bank[:3], 5).shape == (2, 3)


def test_a_query_travels_once_to_a_shelf_of_cells():
    """Where angles exclude nothing, copies of a query follow the shelves and not the cells."""
    shelves = Y._Shelves(np.array([40, 50, 0, 350, 30, 20, 90]), 100)
    assert shelves.cells[0].tolist() == [0, 1] and shelves.first.tolist()[3:] == [1, 5, 5, 6] and shelves.parts[3] == 4
    units, wanted = np.eye(3), np.ones((3, 7), bool)
    wanted[2] = [False] * 6 + [True]
    got = [r for part in shelves.asks(np.arange(3), units, wanted) for r in part.itertuples(index=False)]
    assert len(got) == 2 * shelves.count + 1 and shelves.count == 7
    assert sorted((r.shelf, *r.cells) for r in got if r.shelf in (0, 6)) == [(0, 0, 1), (0, 0, 1), (6, 6), (6, 6), (6, 6)]


def test_roll_estimators_read_the_angles_once(spark, tmp_path):
    """The angles are merged in one pass; everything after reads the small written table.  Odd groups as before."""
    rng = random.Random(8)
    rows = [(i % 9, rng.choice([None, -25_000_000, 3, 9_999_999, 10_000_000, rng.randrange(-25_000_000, 25_000_000)]), rng.randrange(0, 50)) for i in range(600)]
    rows += [(20, None, 5), (21, 7, 0), (21, -4, 0), (22, 12_000_000, 1), (22, 12_000_000, 1), (None, 4, 2)]
    spark.createDataFrame(rows, "image int, angle bigint, weight bigint").write.parquet(str(tmp_path / "angles"))
    angles = spark.read.parquet(str(tmp_path / "angles"))
    both = E.roll_mean_and_median(angles)
    for made in (both, E.roll_weighted_median(angles), E.rotation_estimate(angles), E.paired_improvement(both, "mean_deg", "median_deg")):
        assert not [f for f in made.inputFiles() if str(tmp_path) in f]
    got = {r.image: r for r in both.where("image IS NOT NULL").collect()}
    std = {r.image: r for r in E.rotation_estimate(angles).where("image IS NOT NULL").collect()}
    assert got.keys() == std.keys() == {i for i, _, _ in rows if i is not None}
    for image, r in got.items():
        mine = sorted((a, w) for i, a, w in rows if i == image and a is not None)
        total, run, median = sum(w for _, w in mine), 0, 0
        for a in sorted({a for a, _ in mine}):
            run += sum(w for b, w in mine if b == a)
            if run * 2 >= total:
                median = a
                break
        assert r.n == len(mine) and r.median_deg == pytest.approx(-median / 1e6) and std[image].roll_deg == pytest.approx(median / 1e6)
        if total:
            assert r.mean_deg == pytest.approx(-sum(a * w for a, w in mine) / total / 1e6)
        spread = np.std([a for a, _ in mine]) / 1e6 if mine else 0.0
        assert std[image].residual_std == pytest.approx(spread, rel=1e-6, abs=1e-9)
