import math

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.operators import bayes as nb
from quarry.operators import metrics as mt
from quarry.operators import pairs as pr
from quarry.plans import models as md


def test_cosine_zero_vector_is_null(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "id int, v array<double>")
    q = spark.createDataFrame([("q", [1.0, 1.0])], "qid string, qv array<double>")
    got = {r["id"]: r["cosine"] for r in pr.cosine_pairs(df, q, "id", "v", "qid", "qv").collect()}
    assert got[1] is None and abs(got[2] - 1 / math.sqrt(2)) < 1e-12


def test_nearest_neighbors_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    vecs = rng.normal(size=(60, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "id int, v array<double>")
    qs = spark.createDataFrame([(j, vecs[j].tolist()) for j in (0, 7)], "qid int, qv array<double>")
    got = pr.nearest_neighbors(df, qs, 3, "id", "v", "qid", "qv").orderBy("qid", "rank").collect()
    for j in (0, 7):
        cos = vecs @ vecs[j] / (np.linalg.norm(vecs, axis=1) * np.linalg.norm(vecs[j]))
        want = sorted(range(60), key=lambda i: (-cos[i], i))[:3]
        assert [r["id"] for r in got if r["qid"] == j] == want


def test_auc_ties_average_ranks_and_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rows = [(0.1, 0.0), (0.4, 1.0), (0.4, 0.0), (0.35, 1.0), (0.8, 1.0), (0.1, 1.0), (0.2, 0.0)]
    df = spark.createDataFrame(rows, "s double, y double")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for b in (1, 2, 5):
        assert abs(mt.auc_roc(df.repartition(b), "s", "y").first()["auc"] - want) < 1e-12
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y")
    assert abs(ev.evaluate(df) - want) < 1e-9


def test_multiclass_metrics_equal_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 0.0), (2.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = mt.multiclass_metrics(df).first()
    for name, col in [("accuracy", "accuracy"), ("f1", "f1"), ("weightedPrecision", "weighted_precision"),
                      ("weightedRecall", "weighted_recall")]:
        ev = MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert abs(ev - m[col]) < 1e-12, name


def test_relational_nb_equals_ml_nb(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer, StringIndexer
    docs = spark.createDataFrame([
        (1, "a", ["x", "y", "x"]), (2, "a", ["x"]), (3, "b", ["y", "z"]), (4, "b", ["z", "z", "w"]),
        (5, "c", []), (6, "c", ["w", "q"])], "doc_id int, label string, words array<string>")
    model = nb.nb_model(docs, "label", "words")
    test = spark.createDataFrame([(10, ["x", "z", "unseen"]), (11, []), (12, ["q", "q", "y"])],
                                 "doc_id int, words array<string>")
    rel = {r["doc_id"]: r for r in nb.nb_score(model, test).collect()}
    idx = StringIndexer(inputCol="label", outputCol="li", stringOrderType="alphabetAsc").fit(docs)
    cv = CountVectorizer(inputCol="words", outputCol="features").fit(docs)
    mlm = NaiveBayes(labelCol="li", smoothing=1.0).fit(cv.transform(idx.transform(docs)))
    for r in mlm.transform(cv.transform(test)).collect():
        assert idx.labels[int(r["prediction"])] == rel[r["doc_id"]]["prediction"]
        assert np.allclose(r["probability"].toArray(), rel[r["doc_id"]]["probability"], atol=1e-12)
    cp = nb.class_probabilities(nb.nb_score(model, test), model.classes).first()["class_probabilities"]
    assert set(cp) == {"a", "b", "c"}


def test_ols_normal_equals_closed_form(spark):
    rows = [(float(x), 3.0 + 2.0 * x + (x % 3) * 0.1) for x in range(50)]
    df = spark.createDataFrame(rows, "x double, y double")
    m = md.train_linear(df.select(array_to_vector(F.array("x")).alias("features"), F.col("y").alias("label")),
                        reg=0.0, elastic_net=0.0, solver="normal")
    c = df.agg(F.regr_slope("y", "x"), F.regr_intercept("y", "x")).first()
    assert abs(m.coefficients[0] - c[0]) < 1e-9 and abs(m.intercept - c[1]) < 1e-9


def test_models_beat_majority_and_reload(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegressionModel
    emb = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    d = emb.select(F.col("label").cast("double").alias("label"),
                   array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    m = md.train_logistic(d, family="multinomial", max_iter=50)
    acc = mt.multiclass_metrics(m.transform(d)).first()["accuracy"]
    majority = d.groupBy("label").count().agg(F.max("count")).first()[0] / d.count()
    assert acc > majority
    p = str(tmp_path / "lr")
    from quarry.sources.models import save_model
    save_model(m, p)
    again = LogisticRegressionModel.load(p)
    a = [r["prediction"] for r in m.transform(d).orderBy("label").collect()]
    b = [r["prediction"] for r in again.transform(d).orderBy("label").collect()]
    assert a == b


def test_verse_splitter_pipeline_saves_and_loads(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import CountVectorizer
    from quarry.plans.stages import VerseSplitter
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text", F.col("lang").alias("label"))
    pipe = Pipeline(stages=[VerseSplitter(sentencesInVerse=2), CountVectorizer(inputCol="verse", outputCol="f")])
    model = pipe.fit(docs)
    model.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    assert again.stages[0].getOrDefault("sentencesInVerse") == 2
    assert again.transform(docs).count() == model.transform(docs).count() > 0


def test_stream_scoring_equals_batch(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer, StringIndexer
    from quarry.plans.stages import DocumentWords
    from quarry.streaming import score_stream
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = Pipeline(stages=[StringIndexer(inputCol="lang", outputCol="label"), DocumentWords(),
                             CountVectorizer(inputCol="words", outputCol="features"), NaiveBayes()]).fit(docs)
    src = str(tmp_path / "in")
    docs.repartition(3).write.parquet(src)
    score_stream(spark, model, src, docs.schema, str(tmp_path / "out"), str(tmp_path / "ck"),
                 select=["doc_id", "prediction"])
    streamed = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    batch = sorted(map(tuple, model.transform(docs).select("doc_id", "prediction").collect()))
    assert streamed == batch


def test_synonyms_unknown_word_gives_no_rows(spark):
    from quarry.plans.stages import VerseSplitter
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    verses = VerseSplitter(carryCols=[], sentencesInVerse=2).transform(docs)
    m = md.train_word2vec(verses, vector_size=8)
    req = spark.createDataFrame([("zzzunknownzzz",)], "word string")
    assert md.synonyms(m, req).count() == 0
    known = m.getVectors().first()["word"]
    got = md.synonyms(m, spark.createDataFrame([(known,)], "word string"), k=3).collect()
    assert len(got) == 3 and all(r["synonym"] != known for r in got)


def test_best_match_within_group(spark):
    rows = [("r1", 1, [1.0, 0.0]), ("r1", 2, [0.9, 0.1]), ("r1", 3, [0.0, 1.0]), ("r2", 1, [1.0, 1.0]),
            ("r3", 1, [0.0, 0.0]), ("r3", 2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "g string, id long, v array<double>")
    got = {(r["g"], r["id"]): (r["best_id"], r["cosine"]) for r in pr.best_match_within(df, "g", "id", "v").collect()}
    assert got[("r1", 1)][0] == 2 and got[("r1", 3)][0] == 2
    assert got[("r2", 1)] == (None, None)
    assert got[("r3", 1)] == (None, None) and got[("r3", 2)] == (None, None)


def test_probability_map_drops_keep_bucket_and_document_vote(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from quarry.plans.scoring import probability_map, score_documents
    train = spark.createDataFrame([(1, "a", 0.0), (2, "a", 0.2), (3, "b", 1.0), (4, "b", 0.9)], "d int, y string, x double")
    pipe = Pipeline(stages=[StringIndexer(inputCol="y", outputCol="label", handleInvalid="keep"),
                            VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression(maxIter=20)])
    model = pipe.fit(train)
    labels = model.stages[0].labels
    test = spark.createDataFrame([(9, "zz", 0.1), (9, "zz", 0.05), (8, "zz", 0.95)], "d int, y string, x double")
    pred = model.transform(test)
    assert len(pred.first()["probability"]) == 3          # two labels + the keep bucket
    m = probability_map(pred, labels).first()["class_probabilities"]
    assert set(m) == {"a", "b"}
    got = {r["d"]: r["predicted_label"] for r in score_documents(pred, "d", labels).collect()}
    assert got == {9: "a", 8: "b"}


def test_load_or_train_trains_once(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegressionModel
    from quarry.sources import models as ms
    d = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.0, 0.1), (1.0, 0.9)], "label double, x double").select(
        "label", array_to_vector(F.array("x")).alias("features"))
    calls = []

    def train():
        calls.append(1)
        return md.train_logistic(d, max_iter=10)

    p = str(tmp_path / "m")
    a = ms.load_or_train(spark, p, train, kind=LogisticRegressionModel)
    b = ms.load_or_train(spark, p, train, kind=LogisticRegressionModel)
    assert len(calls) == 1 and isinstance(b, LogisticRegressionModel)
    assert a.coefficients == b.coefficients


def test_metrics_degenerate_inputs_give_null(spark):
    one_class = spark.createDataFrame([(0.1, 1.0), (0.4, 1.0)], "s double, y double")
    assert mt.auc_roc(one_class, "s", "y").first()["auc"] is None
    const = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "prediction double, label double")
    r = mt.regression_metrics(const).first()
    assert r["r2"] is None and abs(r["rmse"] - 1.0) < 1e-12


def test_synonyms_match_spark_find_synonyms(spark):
    from quarry.plans.stages import VerseSplitter
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    verses = VerseSplitter(carryCols=[], sentencesInVerse=2).transform(docs)
    m = md.train_word2vec(verses, vector_size=16, seed=3)
    words = [r["word"] for r in m.getVectors().orderBy("word").limit(3).collect()]
    req = spark.createDataFrame([(w,) for w in words], "word string")
    ours = md.synonyms(m, req, k=5).collect()
    for w in words:
        spark_syn = [r["word"] for r in m.findSynonyms(w, 5).collect()]
        mine = [r["synonym"] for r in sorted((r for r in ours if r["word"] == w), key=lambda r: r["rank"])]
        assert mine == spark_syn


def test_ranked_probabilities_shares(spark):
    docs = spark.createDataFrame([(1, "a", ["x", "x"]), (2, "b", ["y"]), (3, "c", ["z"])],
                                 "doc_id int, label string, words array<string>")
    model = nb.nb_model(docs, "label", "words")
    scored = nb.nb_score(model, spark.createDataFrame([(9, ["x", "y"])], "doc_id int, words array<string>"))
    r = nb.ranked_probabilities(scored, model.classes).orderBy("rank").collect()
    assert [x["rank"] for x in r] == [1, 2, 3]
    assert abs(sum(x["share"] for x in r) - 100.0) < 1e-9
    assert sum(x["is_predicted"] for x in r) == 1 and r[0]["is_predicted"]


def test_auc_leaves_out_rows_without_a_label(spark):
    df = spark.createDataFrame([(0.9, 1.0), (0.1, 0.0), (0.5, None), (None, 0.0)], "s double, y double")
    r = mt.auc_roc(df, "s", "y").first()
    assert (r["auc"], r["n_pos"], r["n_neg"]) == (1.0, 1, 1)


def test_nb_ignores_documents_without_a_label(spark):
    docs = spark.createDataFrame([(1, "a", ["x"]), (2, "b", ["y"]), (3, None, ["z", "z"])], "doc_id int, label string, words array<string>")
    model = nb.nb_model(docs, "label", "words")
    assert model.classes == ["a", "b"] and model.vocab_size == 2


def test_nb_plan_does_not_grow_with_the_classes(spark):
    docs = spark.createDataFrame([(i, f"c{i:03d}", [f"w{i}", "shared"]) for i in range(300)],
                                 "doc_id int, label string, words array<string>")
    model = nb.nb_model(docs, "label", "words")
    got = nb.nb_score(model, docs, carry=("label",)).select("label", "prediction").collect()
    assert len(got) == 300 and all(r["label"] == r["prediction"] for r in got)


def test_least_squares_uses_whole_rows_only(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 2.0), (2.0, 3.0), (50.0, None), (None, -9.0)], "x double, y double")
    b, a = mt.least_squares(df, "x", "y")
    assert abs(b - 1.0) < 1e-12 and abs(a - 1.0) < 1e-12


def test_number_lines_keeps_null_rows_and_explode_drops_null_elements(spark):
    from quarry.operators import text as tx
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), ("b", None)], "k string, o int")
    got = sorted((r["k"] or "", r["o"] or 0, r["line_no"]) for r in tx.number_lines(df, "k", "o").collect())
    assert got == [("", 1, 1), ("a", 1, 1), ("a", 2, 2), ("b", 0, 1)]
    arr = spark.createDataFrame([(1, ["x", None, "y"])], "k int, a array<string>")
    assert [r["e"] for r in tx.explode_rows(arr, ["k"], F.col("a"), "e").collect()] == ["x", "y"]
    assert [(r["e"], r["p"]) for r in tx.explode_rows(arr, ["k"], F.col("a"), "e", "p").collect()] == [("x", 1), ("y", 3)]


def test_an_unreadable_model_is_not_overwritten(spark, tmp_path):
    import pytest
    from quarry.sources import models as ms
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "junk").write_text("x")
    with pytest.raises(Exception):
        ms.load_or_train(spark, str(tmp_path / "m"), lambda: pytest.fail("trained anew"))
    assert (tmp_path / "m" / "junk").read_text() == "x"


def test_statistics_open_a_cross_validated_model(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import ParamGridBuilder
    d = spark.createDataFrame([(float(i), 2.0 * i, i % 2) for i in range(20)], "x double, label double, fold int").select(
        array_to_vector(F.array("x")).alias("features"), "label", "fold")
    lr = LinearRegression()
    cv = md.tune(lr, ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.5]).build(), RegressionEvaluator(), d)
    rows = md.model_statistics(cv).collect()
    assert {"avg_metric_0", "avg_metric_1", "regParam"} <= {r["param"] for r in rows}


def test_shared_folder_is_needed_beyond_local_sessions():
    import pytest
    from quarry import session as ss

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ss.shared_root(Session())
    assert ss.is_local("local[4]") and not ss.is_local("local-cluster[2,1,512]")
