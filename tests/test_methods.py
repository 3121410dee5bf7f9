"""Cosine join, numbered files, histogram trees and gradient steps against plain computations."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import cosine_join as cj
from quarry.operators import gradient as gd
from quarry.operators import metrics as mt
from quarry.operators import pairs as pr
from quarry.operators import trees as tr
from quarry.sources import files as fs


# cosine join

def plain_cosines(rows, t):
    """{(bag a, bag b): cosine} of different bags, and the rows of each bag."""
    bags = defaultdict(list)
    for i, ws in rows:
        if ws:
            bags[tuple(sorted(Counter(ws).items()))].append(i)
    m = sum(map(len, bags.values()))
    df = Counter()
    for bag, ids in bags.items():
        for w, _ in bag:
            df[w] += len(ids)
    vecs = {}
    for bag in bags:
        v = {w: n * math.log((m + 1) / (df[w] + 1)) for w, n in bag if df[w] < m}
        norm = math.sqrt(sum(x * x for x in v.values()))
        if norm:
            vecs[bag] = {w: x / norm for w, x in v.items()}
    out = {}
    for a in vecs:
        for b in vecs:
            if a < b:
                c = round(sum(x * vecs[b].get(w, 0.0) for w, x in vecs[a].items()), 9)
                if c >= t:
                    out[(a, b)] = c
    return out, {b: sorted(ids) for b, ids in bags.items() if b in vecs}


@pytest.mark.parametrize("t,block", [(0.8, 256), (0.5, 3), (0.3, 1), (1.0, 4)])
def test_cosine_join_equals_all_pairs(spark, t, block):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40)]
    rows = [(i, ["the"] * rng.randint(0, 2) + rng.choices(vocab, [1 / (k + 1) for k in range(40)], k=rng.randint(1, 7))) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [(300, []), (301, None), (302, rows[5][1] + rows[5][1]), (303, rows[5][1])]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    found = cj.cosine_join(df, ["id"], "words", t, block)
    want, bags = plain_cosines(rows, t)
    members = defaultdict(list)
    for r in found.members.collect():
        members[r["node"]].append(r["id"])
    assert sorted(map(sorted, members.values())) == sorted(bags.values())
    name = {tuple(v): k for k, v in bags.items()}
    got = {tuple(sorted((name[tuple(sorted(members[r["a"]]))], name[tuple(sorted(members[r["b"]]))]))): r["cosine"] for r in found.pairs.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-8 for k in want)


def test_cosine_join_lists_little_of_frequent_terms(spark):
    rows = [(i, ["common", "usual", f"a{i}", f"b{i}"]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    bags = df.select(cj.term_bag("words").alias("bag")).withColumn("node", F.monotonically_increasing_id()).withColumn("copies", F.lit(1).cast("long"))
    lists = cj.listed(cj.weighted(bags), 0.8)
    assert {r["term"][0] for r in lists.collect()} <= {"a", "b"}
    assert cj.cosine_join(df, ["id"], "words", 0.8).pairs.count() == 0
    assert cj.cosine_join(df.where("id < 0"), ["id"], "words", 0.8).members.count() == 0
    with pytest.raises(ValueError):
        cj.cosine_join(df, ["id"], "words", 0.0)


# files in splits

def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    rng = random.Random(3)
    lines = {"a.txt": [], "b.txt": [], "c.txt": []}
    for name, n in (("a.txt", 900), ("b.txt", 40), ("c.txt", 0)):
        for i in range(n):
            lines[name].append(rng.choice(["", "one", f"line {i} of it", "två ord " + "x" * rng.randint(0, 90), "tail\twith tab only"]))
        (tmp_path / name).write_text("\n".join(lines[name]), encoding="utf-8")
    kept = {(n, k, v) for n, ls in lines.items() for k, v in enumerate((x for x in ls if x and " " in x), 1)}
    every = {(n, k, v) for n, ls in lines.items() for k, v in enumerate(ls, 1) if ls}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("128m", "4k", "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "4m" if size == "128m" else "0")
            got = fs.read_numbered_lines(spark, str(tmp_path / "*.txt")).collect()
            assert {(r["id"].rsplit("/", 1)[1], r["line_no"], r["value"]) for r in got} == kept and len(got) == len(kept)
            blocks = len({r["block"] for r in got if r["id"].endswith("a.txt")})
            assert blocks > 3 if size != "128m" else blocks == 1
        raw = fs.read_numbered_lines(spark, {"x": str(tmp_path / "*.txt")}, reader_filter=False).collect()
        assert {(r["id"].rsplit("/", 1)[1], r["line_no"], r["value"]) for r in raw} == every and {r["label"] for r in raw} == {"x"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


# trees

def gini(rows):
    return sum(n * n for n in Counter(y for _, y in rows).values()) / len(rows) if rows else 0.0


def plain_tree(rows, cuts, depth, k=0):
    """{node: (feature, bin)} by trying every cut on the rows' bins."""
    out = {}
    if depth == 0 or not rows:
        return out
    best = None
    for f in range(len(cuts)):
        for b in sorted({x[f] for x, _ in rows}):
            left, right = [r for r in rows if r[0][f] < b], [r for r in rows if r[0][f] >= b]
            if left and right:
                g = round(gini(left) + gini(right) - gini(rows), 6)
                if g > 0 and (best is None or g > best[0]):
                    best = (g, f, b, left, right)
    if best:
        out[k] = best[1:3]
        out |= plain_tree(best[3], cuts, depth - 1, 2 * k + 1) | plain_tree(best[4], cuts, depth - 1, 2 * k + 2)
    return out


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(12)
    rows = []
    for i in range(240):
        x = [round(rng.uniform(-3, 3), 2), float(rng.randint(0, 4)), rng.gauss(0, 1), 1.0]
        rows.append((i, x, "c" if x[1] >= 3 else "b" if x[0] + rng.gauss(0, 0.3) > 0.5 else "a"))
    return rows, spark.createDataFrame(rows + [(900, [1.0, 1.0, 1.0, 1.0], None), (901, None, "a")], "id long, x array<double>, y string")


def test_one_tree_equals_trying_every_cut(labelled):
    rows, df = labelled
    tree = tr.grow(df, "x", "y", "id", depth=3, bins=8)
    bins = [([sum(c <= v for c in cuts) for v, cuts in zip(x, tree.cuts)], y) for _, x, y in rows]
    assert all(len(c) <= 7 for c in tree.cuts) and tree.cuts[3] == []
    assert {k: s for (_, k), s in tree.splits.items()} == plain_tree(bins, tree.cuts, 3)
    got = {r["id"]: r["prediction"] for r in tree.predict(df, "x").collect()}
    right = sum(got[i] == y for i, _, y in rows)
    assert right > 0.9 * len(rows) and len(got) == 242
    for (_, k), held in tree.leaves.items():
        if k == 0:
            assert held == [float(sum(y == c for _, _, y in rows)) for c in tree.classes]


def test_a_forest_beats_the_majority_and_does_not_depend_on_partitions(labelled):
    rows, df = labelled
    grown = [tr.grow(d, "x", "y", "id", trees=6, depth=4, per_node=2, bagging=True) for d in (df, df.repartition(7))]
    assert grown[0].splits == grown[1].splits and len({s for s in grown[0].splits.values()}) > 6
    held = {r["id"]: r["prediction"] for r in grown[0].predict(df, "x").collect()}
    assert sum(held[i] == y for i, _, y in rows) > 1.4 * Counter(y for _, _, y in rows).most_common(1)[0][1]


def test_only_the_features_of_a_node_leave_its_rows(labelled):
    _, df = labelled
    nodes = [(t, 0) for t in range(3)]
    at = df.where("y is not null and x is not null").select(
        F.explode(F.array(*[F.lit(t) for t, _ in nodes])).alias("t"), F.lit(0).alias("k"), F.length("y").alias("y"),
        F.transform("x", lambda v: F.floor(v).cast("int")).alias("bins"), F.lit(1).alias("w"))
    plan = tr._best_cuts(at, nodes, 4, 2, 1, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "BROADCAST" in plan.upper()   # no row per feature of the whole vector, no shuffled join


def test_a_prediction_bins_a_row_once(labelled):
    _, df = labelled
    forest = tr.Forest(["a", "b"], [[0.0], [1.0]], 2, 1, {(0, 0): (0, 1), (1, 0): (1, 1)}, {(t, k): [float(k == 1), float(k == 2)] for t in (0, 1) for k in (1, 2)})
    made = forest.predict(df, "x")
    assert made._jdf.queryExecution().optimizedPlan().toString().count("[[0.0],[1.0]]") == 1
    got = {r["id"]: (r["prediction"], r["votes"]) for r in made.where("x is not null").collect()}
    assert all(v == ("b" if x[0] >= 0 and x[1] >= 1 else "a", [((x[0] < 0) + (x[1] < 1)) / 2, ((x[0] >= 0) + (x[1] >= 1)) / 2]) for i, x, _ in labelled[0] for v in [got[i]])


def test_constants_are_literals_of_the_plan(spark):
    made = spark.range(2).select(F.transform(F.array(F.col("id")), lambda i: F.get(tr.constant([[1.5, -2e-7], [], [float("inf")]], "array<array<double>>"), i)).alias("x"))
    assert [r["x"] for r in made.collect()] == [[[1.5, -2e-7]], [[]]]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "json" not in plan and "array(1.5" not in plan   # nothing is parsed or built for a row
    assert spark.range(1).select(tr.constant([[], []], "array<array<double>>").alias("x"), tr.constant([(-1, 0)], "array<struct<f:int,b:int>>").alias("y")).first() == (
        [[], []], [(-1, 0)])


def test_trees_of_little_data(spark):
    one = spark.createDataFrame([(1, [1.0], "a"), (2, [2.0], "a")], "id long, x array<double>, y string")
    assert tr.grow(one, "x", "y", "id").splits == {}
    assert {r["prediction"] for r in tr.grow(one, "x", "y", "id").predict(one, "x").collect()} == {"a"}
    assert tr.grow(one.where("id = 9"), "x", "y", "id").classes == []


# gradient steps

def test_softmax_steps_equal_numpy_and_the_loss_falls(spark):
    rng = np.random.default_rng(2)
    n, d, names = 60, 12, ["p", "q", "r"]
    x = np.round(rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.4), 3)
    y = rng.integers(0, 3, n)
    examples = spark.createDataFrame([(i, names[y[i]]) for i in range(n)] + [(99, None)], "id long, label string")
    entries = spark.createDataFrame([(i, f"t{j}", float(x[i, j])) for i in range(n) for j in range(d) if x[i, j]] + [(99, "t0", 1.0)], "id long, term string, x double")
    w, b, losses = np.zeros((d, 3)), np.zeros(3), []
    states = list(gd.softmax_steps(examples, entries, 4, rate=0.8, ridge=0.05))
    for state in states:
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        losses.append(-np.log(p[np.arange(n), y]).mean() + 0.025 * (w ** 2).sum())
        e = p - np.eye(3)[y]
        w, b = w - 0.8 * (x.T @ e / n + 0.05 * w), b - 0.8 * e.mean(axis=0)
        got = {(r["term"], r["label"]): r["w"] for r in state.weights.collect()}
        assert abs(state.loss - losses[-1]) < 1e-9
        for c, name in enumerate(names):
            assert abs(got[(gd.BIAS, name)] - b[c]) < 1e-9
            assert all(abs(got.get((f"t{j}", name), 0.0) - w[j, c]) < 1e-9 for j in range(d))
    assert losses == sorted(losses, reverse=True) and len(states) == 4
    assert list(gd.softmax_steps(examples.where("id = 99"), entries, 2)) == []


def test_hinge_steps_equal_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 5))
    y = (x @ np.array([2.0, -1.0, 0.5, 0.0, 0.0]) + rng.normal(size=80) * 0.2 > 0).astype(float)
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(80)] + [(90, None, 1.0), (91, [1.0] * 5, None)],
                               "id long, x array<double>, y double")
    model = gd.hinge_sgd(df, "id", "x", "y", steps=12, share=0.6, reg=0.05, intercept=True)
    ones, s = np.hstack([x, np.ones((80, 1))]), 2 * y - 1
    w = np.zeros(6)
    for k in range(1, 13):
        at = sorted(r["id"] for r in df.where(gd.in_batch("id", k, 0.6, 42)).where("x is not null and y is not null").collect())
        assert model.counts[k - 1] == len(at) and 20 < len(at) < 70
        bad = [i for i in at if 1 - s[i] * (ones[i] @ w) > 0]
        w = w * (1 - 0.05 / k ** 0.5) + (1 / k ** 0.5) * (s[bad, None] * ones[bad]).sum(axis=0) / len(at)
    assert np.allclose(model.weights, w[:-1]) and abs(model.intercept - w[-1]) < 1e-12
    scored = df.select(model.margin("x").alias("m"), "y")
    assert mt.auc_roc(scored, "m", "y").first()["auc"] > 0.95
    assert len(gd.hinge_sgd(df.where("id = 90"), "id", "x", "y").weights) == 0


# stages and vectors

def test_example_stages_save_and_load(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from quarry.operators import encoders as en
    from quarry.plans import stages as sg
    df = spark.createDataFrame([(1, 10.0, 2.0, "good", "java"), (2, 20.0, None, "bad", "zig"), (3, 5.0, 1.0, None, " ")], "id long, pay double, years double, lvl string, tongue string")
    levels, tongues = {"bad": 1.0, "good": 2.0}, ["java", "scala"]
    made = {
        "r": (sg.RegressionExamples("pay", "years", "lvl", list(levels), list(levels.values()), "tongue", tongues, outputCol="f"),
              en.regression_examples(df, "pay", "years", "lvl", levels, "tongue", tongues, "f")),
        "c": (sg.ClusteringExamples("pay", "years", "lvl", list(levels), list(levels.values()), "f"), en.clustering_examples(df, "pay", "years", "lvl", levels, "f")),
        "w": (sg.WideExamples(["pay", "years"], "id", "f"), en.wide_examples(df, ["pay", "years"], "id", "f")),
        "l": (sg.Labeler("y", -1.0, "who", "nobody"), df.withColumn("y", F.lit(-1.0)).withColumn("who", F.lit("nobody")))}
    for name, (stage, want) in made.items():
        PipelineModel(stages=[stage]).write().overwrite().save(str(tmp_path / name))
        got = PipelineModel.load(str(tmp_path / name)).transform(df)
        assert got.columns == want.columns and list(map(str, got.collect())) == list(map(str, want.collect()))


def test_uneven_and_null_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [1.0]), (4, [1.0, None]), (5, []), (6, [0.0, 0.0, 2.0]), (7, None)], "id int, v array<double>")
    q = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0, 1.0]), ("c", [1.0, None])], "qid string, qv array<double>")
    got = {(r["qid"], r["id"]): r["cosine"] for r in pr.cosine_pairs(df, q, "id", "v", "qid", "qv").collect()}
    assert got[("a", 1)] == got[("a", 2)] == got[("a", 3)] == 1.0 and got[("b", 6)] == 1.0 and got[("a", 6)] == 0.0
    assert got[("a", 4)] is None and got[("a", 5)] is None and got[("c", 1)] is None
    near = pr.nearest_neighbors(df, q, 2, "id", "v", "qid", "qv").collect()
    assert [(r["id"], r["cosine"]) for r in near if r["qid"] == "a"] == [(1, 1.0), (2, 1.0)]
    assert [(r["id"], r["cosine"]) for r in near if r["qid"] == "b"][0] == (6, 1.0) and not [r for r in near if r["qid"] == "c"]
    both = df.where("v is not null").withColumn("g", F.lit("x")).withColumn("id", F.col("id").cast("long"))
    best = {r["id"]: r["best_id"] for r in pr.best_match_within(both, "g", "id", "v").collect()}
    assert best[1] == 2 and best[3] == 1 and best[4] is None and best[5] is None
