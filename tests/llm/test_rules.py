import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lumenframe.llm import rules

W = re.compile(r"[^\x20\x09-\x0D]+")


def stats(t):
    t = t or ""
    w = W.findall(t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if W.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def corpus():
    rng = random.Random(8)
    word = lambda: rng.choice(["a", "bb", "ccc", "é", "🙂x", "#*", "dd|", "e&"]) + str(rng.randrange(400))
    lines = [" ".join(word() for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    rows = []
    for i in range(300):
        own = rng.sample(lines, rng.randrange(1, 15))
        if i % 3 == 0:
            own.insert(rng.randrange(len(own) + 1), "Share this  PAGE with a friend " + ("now " * (i % 2)))
        if i % 50 == 0:
            own = ["Share this page with a friend"] * 40
        rows.append((i, rng.choice(["\n", "\n\n", " \n"]).join(own), rng.choice(["h1", "h2", None])))
    rows += [(1000 + k, "near\ncopy of a page " + " ".join(f"v{j}" for j in range(60)) + f"\nline {k}", "h1") for k in range(80)]
    return rows + [(2000, None, "h1"), (2001, "", None), (2002, "\n\n", "h2"), rows[5], (2003, "ab ab ab " * 5000, "h1")]


def brute(rows, most=20, depleted=0.8):
    norm = lambda x: " ".join(W.findall(x)).lower()
    holders = {}
    split = {i: [norm(x) for x in (r[1] or "").split("\n") if W.search(x)] for i, r in enumerate(rows)}
    for i, r in enumerate(rows):
        for x in split[i]:
            holders.setdefault((r[2], x), set()).add(r[1])
    bad = {k for k, v in holders.items() if len(v) > most}
    out = []
    for i, r in enumerate(rows):
        s = stats(r[1])
        lost = sum(len(x.split(" ")) for x in split[i] if (r[2], x) in bad)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        out.append((r[0], *s, lost, failed, not failed and lost <= depleted * s[0]))
    return sorted(out), bad


def test_verdicts_equal_brute_force(make_docs):
    rows = corpus()
    docs = make_docs(rows)
    for name in ("host", "copy", "stats", "line", "salt", "kept", "__host", "removed_words"):
        docs = docs.withColumn(name, F.lit(2))
    got = rules.judge(docs, ["doc_id", "stats", "__host"])
    got = got.select("doc.doc_id", "stats.*", "removed_words", "base_failed", "kept").collect()
    want, bad = brute(rows)
    assert bad and any(w[6] for w in want)
    assert sorted(map(tuple, got)) == want
    assert not any(r.kept for r in got if 1000 <= r.doc_id < 1080)


def test_depleted_documents_go(make_docs):
    rng = random.Random(9)
    own = lambda n: "\n".join(f"w{rng.randrange(10**6)} x{rng.randrange(10**6)}" for _ in range(n))
    foot = " ".join(f"f{k}" for k in range(70))
    rows = [(i, own(i % 12 + 30) + "\n" + foot, "h") for i in range(40)] + [(99, "a b\n" + foot + "\nc d", "h")]
    got = {r.doc.doc_id: r for r in rules.judge(make_docs(rows), ["doc_id", "text"]).collect()}
    assert not got[99].kept and all(got[i].kept for i in range(40))
    clean = rules.judge(make_docs(rows), ["text"]).select(rules.without_lines(F.col("doc.text"), F.col("removed_lines")).alias("t")).collect()
    assert not any(foot in r.t for r in clean)


def footed(n, own, foot, seed=10):
    """``n`` differing documents of one host: a title, ``own(i)`` lines, the lines of ``foot``."""
    rng = random.Random(seed)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))
    return [(i, "\n".join([line() for _ in range(1 + own(i))] + foot), "h") for i in range(n)]


def test_every_line_of_a_footer_goes(make_docs):
    foot = [" ".join(f"f{k}x{j}" for j in range(30)) for k in range(4)]
    rows = footed(100, lambda i: i % 12 + 4, foot) + [(999, "a b c\n" + "\n".join(foot), "h")]
    got = {r.doc.doc_id: r for r in rules.judge(make_docs(rows), ["doc_id"]).collect()}
    assert {r.removed_words for r in got.values()} == {120}
    assert not got[999].kept
    texts = rules.judge(make_docs(rows), ["text"]).select(rules.without_lines(F.col("doc.text"), F.col("removed_lines")).alias("t")).collect()
    assert not any(x in r.t for r in texts for x in foot)
    # copies of one document still count once
    assert all(r.removed_words == 0 for r in rules.judge(make_docs(rows[:1] * 100), ["doc_id"]).collect())


def test_footers_go_whatever_the_lengths_in_lines(make_docs):
    foot = [" ".join(f"f{j}" for j in range(70))]
    long_ = [(i, "\n".join([f"own{i} {j}" for j in range(1000 + i)] + foot), "long") for i in range(25)]
    # always three lines; lengths of 1000 lines and more
    rows = footed(60, lambda i: 1, foot) + [(999, "a b c\n" + foot[0], "h")]
    got = {r.doc.doc_id: r for r in rules.judge(make_docs(rows), ["doc_id"]).collect()}
    assert {got[i].removed_words for i in (*range(60), 999)} == {70} and not got[999].kept
    assert {r.removed_words for r in rules.judge(make_docs(long_), ["doc_id"]).collect()} == {70}


def test_pages_that_are_mostly_template_go(make_docs):
    """200 differing documents a host, the same six template lines in all, ever fewer words of their own."""
    foot = [" ".join(f"t{k}x{j}" for j in range(20)) for k in range(6)]
    rng = random.Random(11)
    rows = []
    for own in (6, 10, 15, 25, 60):
        for i in range(200):
            rows.append((own * 1000 + i, "\n".join([" ".join(f"o{rng.randrange(10**6)}" for _ in range(own)), *foot]), f"host{own}"))
    got = rules.judge(make_docs(rows), ["doc_id"]).collect()
    assert {r.removed_words for r in got} == {120}
    assert {(r.doc.doc_id // 1000, r.kept) for r in got} == {(6, False), (10, False), (15, False), (25, False), (60, True)}


def test_many_and_few_repeated_windows(spark):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(k)}" for _ in range(n)) for k in (2, 9, 20, 60) for n in (0, 1, 2, 3, 4, 50, 3000)]
    texts += ["a a a", "a a a a", "a b a b a b", "x y z q x y z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.n for r in df.select("i", rules.repeated_words(rules.words(F.col("text"))).alias("n")).collect()}
    assert got == {i: stats(t)[4] for i, t in enumerate(texts)}


def test_hot_line_is_split(make_docs):
    """A line that all documents share meets them in SALTS parts."""
    rows = [(i, f"own {i}\nshared line of the host", "h") for i in range(500)]
    known = rules.texts(make_docs(rows))
    plan = rules.removals(known)._jdf.queryExecution().executedPlan().toString()
    assert "salt" in plan
    assert {r.removed_words for r in rules.removals(known).collect()} == {5}


def test_twin_states_the_method(make_docs, against_twin):
    """Layouts on which counts of neighbours, of lengths or of near copies would say something else."""
    foot = [" ".join(f"f{k}x{j}" for j in range(20)) for k in range(6)]
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    # one layout of eight lines in 59 documents; near copies; 20 and 21 documents; copies of one
    rows = [(i, "\n".join([word() + " " + word(), *foot, word()]), "layout") for i in range(59)]
    rows += [(1000 + i, "\n".join([*(f"n{k} " * 12 for k in range(9)), word()]), "near") for i in range(30)]
    for host, n in (("at", 20), ("above", 21)):
        rows += [(2000 + 100 * n + i, "\n".join([" ".join(word() for _ in range(50)), "The  Same LINE" if i % 2 else "the same line"]), host) for i in range(n)]
    rows += [(9000 + i, "copy " * 60 + "\nagain and again", "copies") for i in range(40)] + [(9100, None, None), (9101, "", "near")]
    got = {r.doc_id: r for r in against_twin("op9_rules", make_docs(rows))}
    assert {got[i].removed_words for i in range(59)} == {120} and not any(got[i].kept for i in range(59))
    assert {got[r[0]].removed_words for r in rows if r[2] == "at"} == {0} and {got[r[0]].removed_words for r in rows if r[2] == "above"} == {3}
    assert {got[9000 + i].removed_words for i in range(40)} == {0} and {got[1000 + i].removed_words for i in range(30)} == {108}


def test_empty_table(make_docs):
    assert rules.judge(make_docs([]), ["doc_id"]).collect() == []
