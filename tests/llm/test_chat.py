import hashlib
import random

from lumenframe.llm import chat
from pyspark.sql import functions as F

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
TREE = "tree bigint, node bigint, parent bigint, score double, role string, text string"


def read(df):
    return df.select("*", *[c.alias(n) for n, c in chat.read_back(F.col("formatted"), F.col("loss")).items()]).collect()


def test_conversations_round_trip(spark):
    rng = random.Random(6)
    bits = ["</s>", "[INST]", "&lt;", "&amp;amp;", "<s>[assistant] ", "é🙂", "\n", "", "&", "x" * 3000, "&lb;"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a]b", None]), rng.choice([None, "".join(rng.choices(bits, k=4))])) for c in range(30) for t in range(rng.randrange(1, 12))]
    rows += [(None, None, "user", "x"), (None, 1, "assistant", "y"), (3, 0, "user", "same"), (3, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("tree", F.lit("clash"))
    got = {r.tree: r for r in read(chat.format_paths(chat.chains(df)))}
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, (r[3] or "").encode()))
        r = got[c]
        assert r.n_turns == len(mine)
        assert r.turns_sha256 == sha("".join(f"{a or ''}\n{b or ''}\n" for _, _, a, b in mine))
        learned = "".join(b or "" for _, _, a, b in mine if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(learned), sha(learned))
        assert r.formatted_chars == len(r.formatted)
        assert r.formatted.count("<s>") == len(mine)


def test_best_branch_of_each_tree(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for tree in range(12):
        n = rng.choice([1, 5, 40])
        parent = {0: None} | {i: rng.randrange(max(0, i - rng.choice([1, 3, 40])), i) for i in range(1, n)}
        score = {i: float(rng.randrange(-3, 6)) for i in range(n)}
        rows += [(tree, i, parent[i], score[i], "user" if i % 2 else "assistant", f"t{tree}n{i}") for i in range(n)]
        leaves = set(range(n)) - set(parent.values())

        def path(x):
            return [x] if parent[x] is None else path(parent[x]) + [x]

        best = sorted(leaves, key=lambda x: (-sum(score[i] for i in path(x)), -len(path(x)), x))[:2]
        want |= {(tree, x): path(x) for x in best}
    rows += [(50, 1, 2, 1.0, "user", "a"), (50, 2, 1, 1.0, "user", "b")]  # a cycle has no root
    rows += [(51, 7, 99, None, None, None)]  # its parent is not there
    want |= {(51, 7): [7]}
    df = spark.createDataFrame(rows, TREE)
    got = {}
    for r in chat.branches(df, top=2).collect():
        got.setdefault((r.tree, r.leaf), []).append((r.depth, r.node))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == want
    one = chat.format_paths(df.where("tree = 51")).collect()
    assert [r.formatted for r in one] == ["<s>[] </s>"]


def test_a_long_chain(spark):
    df = spark.range(900).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    (r,) = read(chat.format_paths(chat.chains(df)))
    assert r.n_turns == 900 and r.loss_sha256 == sha("".join(map(str, range(900))))


def test_empty_table(spark):
    assert chat.format_paths(spark.createDataFrame([], TREE)).collect() == []
