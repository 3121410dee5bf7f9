"""Grid searches from one aggregation against models fitted fold by fold."""

import random
import re

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.operators import bayes_search as bs
from quarry.operators import metrics as mt
from quarry.operators import moments as mo
from quarry.operators import sampling as sp
from quarry.plans import jobs as jb


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = []
    for i in range(90):
        y = "abc"[i % 3]
        ws = [rng.choice({"a": "xyzq", "b": "xwvq", "c": "uvtz"}[y]) + rng.choice(["", "1", "2"]) for _ in range(rng.randint(0, 9))]
        data.append((0, i, 0, i % 4, y, ws + ([f"only{i}"] if i % 7 == 0 else [])))
    return spark.createDataFrame(data, "variant int, id long, part int, fold int, label string, words array<string>")


def fitted(train, test, stages, smoothing):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import StringIndexer
    idx = StringIndexer(inputCol="label", outputCol="li", stringOrderType="alphabetAsc")
    model = Pipeline(stages=[idx, *stages, NaiveBayes(labelCol="li", smoothing=smoothing)]).fit(train)
    return {r["id"]: r["rawPrediction"].toArray() for r in model.transform(test).collect()}


def test_counts_equal_a_fit_per_fold(rows):
    from pyspark.ml.feature import CountVectorizer
    scored = bs.nb_fold_scores(rows, (0.5, 1.0))
    got = {(r["point"], r["id"]): r["scores"] for r in scored.collect()}
    assert len(got) == 2 * 90
    for k in range(4):
        for p, s in enumerate((0.5, 1.0)):
            want = fitted(rows.filter(F.col("fold") != k), rows.filter(F.col("fold") == k), [CountVectorizer(inputCol="words", outputCol="features")], s)
            for i, raw in want.items():
                assert np.allclose(got[(p, i)], raw, atol=1e-8)


def test_hashed_tf_idf_equals_a_fit_per_fold(rows):
    from pyspark.ml.feature import IDF
    hashed = bs.bucket_variants(rows, [8, 32])
    got = {(r["variant"], r["point"], r["id"]): r["scores"] for r in bs.nb_fold_scores(hashed, (1.0,), [8, 32], (0, 3)).collect()}
    for v, size in enumerate((8, 32)):
        for p, d in enumerate((0, 3)):
            for k in (0, 3):
                stages = [*jb._bucket_counts("words", size), IDF(inputCol="tf", outputCol="features", minDocFreq=d)]
                want = fitted(rows.filter(F.col("fold") != k), rows.filter(F.col("fold") == k), stages, 1.0)
                assert want and all(np.allclose(got[(v, p, i)], raw, atol=1e-8) for i, raw in want.items())


def test_a_class_of_one_fold_is_not_scored_there(spark):
    data = [(0, i, 0, i % 2, "ab"[i % 2 == 0 and i > 1] if i % 2 == 0 else "a", ["x", f"w{i}"]) for i in range(8)]
    df = spark.createDataFrame(data, "variant int, id long, part int, fold int, label string, words array<string>")
    got = {r["id"]: r["classes"] for r in bs.nb_fold_scores(df).collect()}
    assert got[0] == ["a"] and got[1] == ["a", "b"]
    assert bs.fold_accuracy(bs.nb_fold_scores(df)).count() == 2


def test_empty_rows_and_search(spark):
    none = spark.createDataFrame([], "variant int, id long, part int, fold int, label string, words array<string>")
    assert bs.nb_fold_scores(none).count() == 0 and bs.fold_auc(bs.nb_fold_scores(none)).count() == 0
    assert bs.grid_means(bs.fold_accuracy(bs.nb_fold_scores(none)), "accuracy") == []


def test_grouped_auc_spans_partitions(spark):
    rng = random.Random(7)
    data = [(g, rng.choice([0.1, 0.2, 0.5, 0.9]) + rng.random() * (g == 1), rng.random() < 0.4) for g in (1, 2) for _ in range(400)]
    df = spark.createDataFrame(data + [(3, 0.5, True)], "g int, s double, hit boolean")
    got = {r["g"]: r["auc"] for r in bs.auc_by(df.repartition(7), ["g"], "s", "hit").collect()}
    for g in (1, 2):
        one = df.filter(F.col("g") == g).select("s", F.col("hit").cast("double").alias("y"))
        assert abs(got[g] - mt.auc_roc(one, "s", "y").first()["auc"]) < 1e-12
    assert got[3] is None


def test_verse_variants_equal_the_splitter(spark):
    from quarry.plans.stages import VerseSplitter
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", F.col("lang").alias("label"))
    rows = bs.verse_variants(docs, [4, 8], "doc_id", "text", "label", 5)
    for i, n in enumerate((4, 8)):
        want = {(r["doc_id"], r["verse_id"]): r["verse"] for r in VerseSplitter(sentencesInVerse=n, stem="s").transform(docs).collect()}
        assert {(r["id"], r["part"]): r["words"] for r in rows.filter(F.col("variant") == i).collect()} == want


# linear models from moments

@pytest.fixture(scope="module")
def examples(spark):
    rng = np.random.default_rng(3)
    data = []
    for i in range(300):
        one_hot = [0.0] * 4
        one_hot[int(rng.integers(4))] = 1.0
        x = [float(rng.normal(5, 2)), float(rng.integers(0, 5)), *one_hot, 7.0]
        data.append((x, 30 + 4 * x[0] - 3 * x[1] + 10 * one_hot[1] + float(rng.normal(0, 3)), i % 5))
    return spark.createDataFrame(data, "x array<double>, label double, fold int").select(
        array_to_vector("x").alias("features"), "label", "fold")


def test_grid_equals_linear_regression_fold_by_fold(examples):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    points = jb.grid_points({"regParam": [0.3, 0.8], "fitIntercept": [False, True], "elasticNetParam": [0.0, 0.3, 0.8], "maxIter": [400]})
    folds = mo.fold_moments(examples)
    assert sorted(folds) == list(range(5)) and sum(m.n for m in folds.values()) == 300
    found = mo.grid_search(folds, points)
    ev = RegressionEvaluator(metricName="rmse")
    for p in found:
        own = {k: p[k] for k in ("regParam", "fitIntercept", "elasticNetParam", "maxIter")}
        lr = LinearRegression(tol=1e-12, **own)
        for k in (0, 4):
            train, test = examples.filter(F.col("fold") != k), examples.filter(F.col("fold") == k)
            model = lr.fit(train)
            assert abs(ev.evaluate(model.transform(test)) - p["fold_rmse"][k]) < 1e-5, own
            rest = [m for f, m in folds.items() if f != k]
            ours = mo.elastic_net(sum(rest[1:], rest[0]), p["regParam"], p["elasticNetParam"], p["fitIntercept"])
            assert np.allclose(ours.coefficients, model.coefficients.toArray(), atol=1e-4), own
            assert abs(ours.intercept - model.intercept) < 1e-3


def test_moments_leave_out_rows_without_a_label(spark):
    df = spark.createDataFrame([([1.0], 2.0, 0), ([2.0], 4.0, 1), ([3.0], None, 0), (None, 1.0, 0), ([9.0], 1.0, None)],
                               "features array<double>, label double, fold int")
    folds = mo.fold_moments(df)
    assert {k: m.n for k, m in folds.items()} == {0: 1.0, 1: 1.0}
    assert mo.fold_moments(df.filter("fold = 9")) == {}
    line = mo.elastic_net(folds[0] + folds[1])
    assert abs(line.coefficients[0] - 2.0) < 1e-9 and abs(line.intercept) < 1e-9


def test_salary_job_uses_the_best_point(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    from quarry.plans.catalog import BRAND_SLOTS, TYPE_LEVELS
    got = {r["name"]: r["coefficient"] for r in jb.salary_regression_job(part, "p_retailprice", "p_size", "p_type", TYPE_LEVELS, "p_brand", BRAND_SLOTS,
                                                                         folds=4).collect()}
    assert got["param:regParam"] in (0.3, 0.8) and got["param:cv_rmse"] > 0 and "p_brand=Other" in got


def test_bucket_stage_equals_long_form(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from quarry.operators import terms as tm
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, ["ñ", "b"])], "doc_id int, words array<string>")
    PipelineModel(stages=jb._bucket_counts("words", 16)).write().overwrite().save(str(tmp_path / "m"))
    made = PipelineModel.load(str(tmp_path / "m")).transform(df)
    got = {(r["doc_id"], int(i)): v for r in made.collect() for i, v in zip(r["tf"].indices, r["tf"].values)}
    assert got == {(r["doc_id"], r["bucket"]): float(r["tf"]) for r in tm.hashing_tf(df, num_features=16).collect()}
    assert sp.FOLD_SEED == 1


# table-backed naive Bayes and the answering stream

def test_model_tables_hold_more_terms_than_a_default_vocabulary(spark, tmp_path):
    from quarry.operators import bayes as nb
    n = (1 << 18) + 5000
    docs = spark.range(n).select(F.concat(F.lit("c"), F.col("id") % 3).alias("label"),
                                 F.array(F.concat(F.lit("w"), F.col("id")), F.lit("shared")).alias("words"))
    model = nb.nb_model(docs, "label", "words")
    assert model.vocab_size == n + 1 and model.term_weights.count() == n + 1
    again, own = nb.NBModel.load(spark, model.save(str(tmp_path / "m"), {"note": "x"}))
    assert own["note"] == "x" and again.vocab_size == n + 1 and again.classes == ["c0", "c1", "c2"]
    ask = spark.createDataFrame([(i, [f"w{i}"]) for i in (0, 1, 2, n - 1)], "doc_id long, words array<string>")
    assert {r["doc_id"]: r["prediction"] for r in nb.nb_score(again, ask).collect()} == {i: f"c{i % 3}" for i in (0, 1, 2, n - 1)}


def verse_model(spark, words):
    from quarry.operators import bayes as nb
    rows = [(y, ws * 3) for y, ws in words.items()]
    return nb.nb_model(spark.createDataFrame(rows, "label string, words array<string>"), "label", "words")


def test_stream_takes_a_new_model_between_batches_and_replays_a_batch(spark, tmp_path):
    from quarry.streaming import answer_stream, publish
    from quarry.streaming import answers as an
    root, src, sink, mark = (str(tmp_path / x) for x in ("models", "in", "out", "mark"))
    one = {"rock": ["guitar", "loud"], "pop": ["dance", "love"]}
    own = {"sentencesInVerse": "1", "stem": "none"}
    publish(verse_model(spark, one), root, 1, own)
    schema = "doc_id long, text string"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        answer_stream(spark, root, src, schema, sink, mark)

    arrive([(1, "guitar so loud\nloud guitar here"), (2, "dance with love"), (3, ""), (4, None)])
    publish(verse_model(spark, {"folk": ["guitar", "loud"], "disco": ["dance", "love"]}), root, 2, own)
    arrive([(5, "guitar so loud"), (6, "dance with love")])

    def read():
        return {r["doc_id"]: (r["predicted_label"], r["n_verses"], r["model_version"], r["batch"]) for r in spark.read.parquet(sink).collect()}

    first = read()
    assert first == {1: ("rock", 2, 1, 0), 2: ("pop", 1, 1, 0), 3: (None, 0, 1, 0), 4: (None, 0, 1, 0),
                     5: ("folk", 1, 2, 1), 6: ("disco", 1, 2, 1)}
    # batch 0 runs again, as after a failure before its commit: same folder, same version, nothing twice
    again = spark.createDataFrame([(1, "guitar so loud\nloud guitar here"), (2, "dance with love"), (3, ""), (4, None)], schema)
    an.batch_writer(spark, root, sink, an.verse_answers)(again, 0)
    assert read() == first and spark.read.parquet(sink).count() == 6
    with pytest.raises(ValueError):
        publish(verse_model(spark, one), root, 2, own)
    with pytest.raises(ValueError):
        an.newest(spark, str(tmp_path / "nothing"))


def test_mean_answers_equal_the_pipeline_form(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer, StringIndexer
    from quarry.operators import bayes as nb
    from quarry.operators import text as tx
    from quarry.plans.scoring import score_documents
    from quarry.streaming.answers import verse_answers
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", F.col("lang").alias("label"))
    verses = tx.text_verses(docs, n=2, label="label", out="words")
    ours = {r["doc_id"]: r for r in verse_answers(nb.nb_model(verses), {"sentencesInVerse": "2", "stem": "none"}, docs).collect()}
    pipe = Pipeline(stages=[StringIndexer(inputCol="label", outputCol="li", stringOrderType="alphabetAsc"),
                            CountVectorizer(inputCol="words", outputCol="features"), NaiveBayes(labelCol="li")]).fit(verses)
    theirs = score_documents(pipe.transform(verses), "doc_id", pipe.stages[0].labels).collect()
    assert len(ours) == docs.count() and theirs
    for r in theirs:
        assert ours[r["doc_id"]]["predicted_label"] == r["predicted_label"] and ours[r["doc_id"]]["n_verses"] == r["n_verses"]
        assert np.allclose([ours[r["doc_id"]]["class_probabilities"][c] for c in pipe.stages[0].labels], r["mean_probability"], atol=1e-9)


def test_bucket_weights_are_broadcast_or_joined_alike(rows, monkeypatch):
    hashed = bs.bucket_variants(rows, [8, 32]).unionByName(bs.bucket_variants(rows.filter("id < 3"), [8, 32]))  # keys twice

    def scored():
        out = bs.nb_fold_scores(hashed, (1.0,), [8, 32], (0, 3))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        return "strategy=broadcast" in plan, {(r["variant"], r["point"], r["id"]): r["scores"] for r in out.collect()}
    small, whole = scored()
    monkeypatch.setattr(bs, "BROADCAST_CELLS", 0)
    large, again = scored()
    assert small and not large and whole.keys() == again.keys()
    assert all(np.allclose(whole[k], again[k], atol=1e-8) for k in whole)


def test_a_terms_folds_are_written_once_and_joined_as_one_row(rows):
    out = bs.nb_fold_scores(rows)
    assert any("/per-term/" in f for f in out.inputFiles())
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x and "term#" in x]
    assert len(joins) == 1 and not re.search(r"fold#\d+ = fold#", joins[0])


def test_words_are_hashed_once_for_all_verses_and_sizes(spark):
    docs = spark.createDataFrame([(1, "apple pear plum\nfig lime nut\n", "a"), (2, "", "a"), (3, None, "b"), (4, "kiwi fig", "b")],
                                 "doc_id long, text string, label string")
    plain = bs.bucket_variants(bs.verse_variants(docs, [1, 2], "doc_id", "text", "label", 3), [8, 32])
    once = bs.bucket_variants(bs.verse_variants(docs, [1, 2], "doc_id", "text", "label", 3, hashed=True), [8, 32], hashed=True)
    assert sorted(map(str, once.collect())) == sorted(map(str, plain.collect())) and plain.count() == 10
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5") == 2   # of the id for its fold, and of a word: the text chain is run in one place
