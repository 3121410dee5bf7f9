"""End-to-end jobs (JB1..JB13): compositions of the operators and model plans.

Each job takes DataFrames, returns DataFrames (metrics, statistics, predictions) and
writes models only under a caller-given shared path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (IDF, CountVectorizer, CountVectorizerModel, IndexToString, MaxAbsScaler, MinMaxScaler,
                                StringIndexer, VectorIndexer)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_fraction
from quarry.operators import bayes as nb
from quarry.operators import bayes_search as bs
from quarry.operators import clusters as cl
from quarry.operators import encoders as en
from quarry.operators import metrics as mt
from quarry.operators import moments as mo
from quarry.operators import sampling as sp
from quarry.operators import text as tx
from quarry.plans import models as md
from quarry.plans.stages import BucketWords, PlainWords, VerseSplitter
from quarry.sources import models as ms


# The original jobs' grids, fold counts and estimator settings.
FOLDS = 10
SALARY_GRID = {"regParam": [0.3, 0.8], "fitIntercept": [False, True], "elasticNetParam": [0.3, 0.8], "maxIter": [50, 100]}
VERSE_GRIDS = {
    "logistic": {"sentencesInVerse": [4, 8, 16], "vectorSize": [100, 200, 300], "regParam": [0.01], "maxIter": [100, 200]},
    "forest": {"sentencesInVerse": [16], "vectorSize": [300], "numTrees": [10, 20, 30], "maxDepth": [20, 30], "maxBins": [32, 64, 128]},
    "mlp": {"sentencesInVerse": [16], "vectorSize": [300], "maxIter": [100]},
    "nb_counts": {"sentencesInVerse": [4, 8, 16]},
    "nb_tfidf": {"sentencesInVerse": [4, 8, 16, 32], "numFeatures": [4096, 8192], "minDocFreq": [0, 1, 2]},
}
TEXT_VOCABULARY, TEXT_MIN_DOCS, TEXT_MAX_ITER = 15_000, 3, 30
TEXT_BUCKETS, TEXT_RIDGE = [4096, 8192], [0.01, 0.1, 1.0]
TEXT_FOLDS = {"nb": 5, "lr": 3}
PRODUCT_TREES, PRODUCT_DEPTH = 20, 30
FITS_AT_ONCE = 4   # settings of a verse classifier that are fitted side by side: each holds its forest on the driver


def _spark() -> SparkSession:
    return SparkSession.getActiveSession()


def _metric_rows(rows) -> DataFrame:
    return _spark().createDataFrame([(str(k), float(v)) for k, v in rows], "metric string, value double")


# --- JB1: salary-like regression --------------------------------------------------

def salary_regression_job(table: DataFrame, label: str, numeric: str, level: str, level_map, category: str,
                          names: Sequence[str], folds: int = FOLDS, grid: dict | None = None,
                          model_path: str | None = None, other: int | None = None, key: str | None = None) -> DataFrame:
    """Examples (F3) -> elastic-net regression tuned by k-fold CV (E1, E2, E5) -> coefficients.

    The grid is searched on the folds' moments (``operators.moments``): one scan for all
    points and folds. The best point is fitted once more by ``LinearRegression``, saved
    under ``model_path``.
    """
    ex = en.regression_examples(table, label, numeric, level, level_map, category, names, other=other)
    best, model = _best_linear(sp.assign_folds(ex, key or table.columns[0], folds), grid or SALARY_GRID)
    if model_path:
        ms.save_model(model, model_path)
    slots = list(names) + (["Other"] if (other is None or other >= len(names)) else [])
    slot_names = [numeric, level] + [f"{category}={n}" for n in slots]
    params = {k: v for k, v in best.items() if k not in ("fold_rmse", "rmse")} | {"cv_rmse": best["rmse"]}
    return md.explain_linear(model, slot_names, params)


def _best_linear(examples: DataFrame, grid: dict):
    """(best grid point with its RMSE, the model of that point fitted on all rows)."""
    from pyspark.ml.regression import LinearRegression
    best = min(mo.grid_search(mo.fold_moments(examples), grid_points(grid)), key=lambda p: p["rmse"])
    own = {k: v for k, v in best.items() if k not in ("fold_rmse", "rmse")}
    return best, LinearRegression(featuresCol="features", labelCol="label").setParams(**own).fit(examples)


def grid_points(grid: dict) -> list[dict]:
    """All combinations of a grid's values, in its order."""
    out: list[dict] = [{}]
    for name, values in grid.items():
        out = [{**p, name: v} for p in out for v in values]
    return out


# --- JB2: level clustering -------------------------------------------------------

def level_clustering_job(table: DataFrame, value: str, numeric: str, level: str, level_map, k: int = 3,
                         names=("junior", "middle", "senior"), seed: int = 1,
                         model_path: str | None = None) -> DataFrame:
    """Examples (F4) -> max-abs scaling (F9) -> k-means (M2) -> profile in original units (E10) -> names (C4)."""
    from pyspark.ml.clustering import KMeans
    ex = en.clustering_examples(table, value, numeric, level, level_map)
    pipe = Pipeline(stages=[MaxAbsScaler(inputCol="features", outputCol="scaled"),
                            KMeans(k=k, featuresCol="scaled", seed=seed, maxIter=20, predictionCol="cluster")])
    model = pipe.fit(ex)
    if model_path:
        ms.save_model(model, model_path)
    a = vector_to_array("features")
    assigned = model.transform(ex).select("cluster", a[0].alias(value), a[1].alias(numeric), a[2].alias("level"))
    prof = cl.cluster_profile(assigned, [value, numeric, "level"])
    return cl.level_from_cluster(prof, f"avg_{value}", list(names))


# --- JB3..JB7: verse classifiers ---------------------------------------------------

def _points(stage, grid: dict) -> list[dict]:
    """All combinations of a stage's parameters, in the grid's order."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(stage.getParam(name), list(values))
    return b.build() or [{}]


def _verse_classifier(kind: str, seed: int):
    from pyspark.ml.classification import (LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes,
                                           RandomForestClassifier)
    if kind == "logistic":
        return LogisticRegression()
    if kind == "forest":
        return RandomForestClassifier(seed=seed, maxMemoryInMB=512)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(blockSize=300, seed=1234)
    if kind in ("nb_counts", "nb_tfidf"):
        return NaiveBayes()
    raise ValueError(kind)


def _feature_points(kind: str, grid: dict) -> list[dict]:
    """The feature settings of a grid; the classifier's own settings are searched inside each."""
    if kind in ("logistic", "forest", "mlp"):
        return [{"vectorSize": s} for s in grid["vectorSize"]]
    if kind == "nb_tfidf":
        return [{"numFeatures": f, "minDocFreq": d} for f in grid["numFeatures"] for d in grid["minDocFreq"]]
    return [{}]


def _fit_features(kind: str, point: dict, train: DataFrame, seed: int) -> list:
    """Fitted feature stages (verse -> features) on the training rows."""
    if kind in ("logistic", "forest", "mlp"):
        return [md.train_word2vec(train, "verse", "features", vector_size=point["vectorSize"], seed=seed)]
    buckets = _bucket_counts("verse", point["numFeatures"])
    counted = buckets[1].transform(buckets[0].transform(train))
    return [*buckets, IDF(inputCol="tf", outputCol="features", minDocFreq=point["minDocFreq"]).fit(counted)]


def _bucket_counts(words: str, size: int) -> list:
    """Stages from words to the vector ``tf`` of their counts in ``size`` portable hash buckets."""
    return [BucketWords(inputCol=words, outputCol="buckets", numFeatures=size),
            CountVectorizerModel.from_vocabulary([str(i) for i in range(size)], inputCol="buckets", outputCol="tf")]


def _setting_metrics(estimator, settings: list[dict], train: DataFrame, test: DataFrame, evaluator) -> list[float]:
    """The metric of every setting of ``estimator`` on ``test``, in order. A few settings are fitted at a time, as
    a fit of a forest is a row of short jobs, one a level."""
    from multiprocessing.pool import ThreadPool
    from pyspark import inheritable_thread_target
    if len(settings) > 1:  # the features are made once, before they are asked for from several sides
        train.count()
        test.count()

    def metric(setting: dict) -> float:
        return evaluator.evaluate(estimator.fit(train, setting).transform(test))

    with ThreadPool(min(FITS_AT_ONCE, len(settings))) as pool:
        return pool.map(inheritable_thread_target(_spark())(metric), settings, chunksize=1)


def _nb_verse_search(known: DataFrame, kind: str, grid: dict, folds: int, id: str, text: str, label: str, stem: str):
    """(setting, mean AUC) of every point of a naive Bayes grid, best first: all folds and points from one term table."""
    lengths, smooth = grid["sentencesInVerse"], grid.get("smoothing", [1.0])
    rows = bs.verse_variants(known, lengths, id, text, label, folds, stem, hashed=kind == "nb_tfidf")
    if kind == "nb_counts":
        scored = bs.nb_fold_scores(rows, smooth)
    else:
        sizes = grid["numFeatures"]
        scored = bs.nb_fold_scores(bs.bucket_variants(rows, sizes, hashed=True), smooth, sizes * len(lengths), grid["minDocFreq"])
    out = []
    for variant, point, auc in bs.grid_means(bs.fold_auc(scored), "auc"):
        own = {} if kind == "nb_counts" else {"numFeatures": sizes[variant % len(sizes)], "minDocFreq": grid["minDocFreq"][point // len(smooth)]}
        own |= {"smoothing": smooth[point % len(smooth)]} if "smoothing" in grid else {}
        out.append(({"sentencesInVerse": lengths[variant // (1 if kind == "nb_counts" else len(sizes))], **own}, auc))
    return out


def verse_classifier_job(docs: DataFrame, kind: str = "logistic", grid: dict | None = None, folds: int = FOLDS,
                         seed: int = 1, id: str = "doc_id", text: str = "text", label: str = "label", stem: str = "s",
                         model_path: str | None = None) -> DataFrame:
    """Two-class verse classifier: mean AUC of the folds for each grid point, the best one refitted (JB3..JB7).

    The chain is cleanse, tokenize, stop words, stem, verses. Folds are drawn per document
    (no document in train and test). Naive Bayes searches its whole grid by subtraction
    from one term table (``bayes_search``). For the others the verses of each length are
    made once; features are fitted once per fold and feature setting and serve every
    classifier setting. The best point over all lengths is fitted on all rows and saved
    under ``model_path`` with its ``VerseSplitter`` and label index in front, ready for
    requests (counts + naive Bayes as Parquet tables of terms and classes).
    """
    from pyspark.ml import PipelineModel
    grid = grid or VERSE_GRIDS[kind]
    ev = BinaryClassificationEvaluator(metricName="areaUnderROC")
    index = StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc").fit(
        docs.filter(F.col(label).isNotNull()))
    if len(index.labels) != 2:
        raise ValueError(f"{label}: {len(index.labels)} classes; the verse classifiers tell two apart")
    known = index.transform(docs.filter(F.col(label).isNotNull()))
    own = {k: v for k, v in grid.items() if k not in ("sentencesInVerse", "vectorSize", "numFeatures", "minDocFreq")}
    rows, best, lengths = [], None, grid["sentencesInVerse"]
    if kind in ("nb_counts", "nb_tfidf"):
        found = _nb_verse_search(known, kind, grid, folds, id, text, label, stem)
        rows = [("|".join(f"{a}={v}" for a, v in named.items()), auc) for named, auc in found]
        named, auc = found[0]
        point = {k: named[k] for k in ("numFeatures", "minDocFreq") if k in named}
        best, lengths = (auc, named["sentencesInVerse"], point, {k: named[k] for k in ("smoothing",) if k in named}), []

    def classifier(point):
        c = _verse_classifier(kind, seed).setLabelCol("label_index")
        return c.setLayers([point["vectorSize"], 50, 2]) if kind == "mlp" else c

    def splitter(n):
        return VerseSplitter(idCol=id, textCol=text, carryCols=["label_index"], sentencesInVerse=n, stem=stem)

    for n in lengths:
        verses = sp.assign_folds(splitter(n).transform(known), id, folds).persist()
        try:
            for point in _feature_points(kind, grid):
                totals: dict[str, float] = {}
                estimator = classifier(point)   # one for all: a setting is known by its estimator's id, another's passes it by
                settings = _points(estimator, own)
                for k in range(folds):
                    train, test = verses.filter(F.col("fold") != k), verses.filter(F.col("fold") == k)
                    made = PipelineModel(stages=_fit_features(kind, point, train, seed))
                    train, test = (made.transform(d).select("label_index", "features").persist() for d in (train, test))
                    try:
                        for i, auc in enumerate(_setting_metrics(estimator, settings, train, test, ev.setLabelCol("label_index"))):
                            totals[i] = totals.get(i, 0.0) + auc / folds
                    finally:
                        train.unpersist()
                        test.unpersist()
                for i, setting in enumerate(settings):
                    named = {"sentencesInVerse": n, **point, **{p.name: v for p, v in setting.items()}}
                    rows.append(("|".join(f"{a}={v}" for a, v in named.items()), totals[i]))
                    if best is None or totals[i] > best[0]:
                        best = (totals[i], n, point, {p.name: v for p, v in setting.items()})
        finally:
            verses.unpersist()
    if model_path and kind == "nb_counts":  # as tables: no vocabulary on the driver
        _, n, _, setting = best
        verses = tx.text_verses(known, n=n, id=id, text=text, label=label, stem=stem, out="words")
        nb.nb_model(verses, label, "words", **setting).save(model_path, {"sentencesInVerse": str(n), "stem": stem, "text": text})
    elif model_path:
        auc, n, point, setting = best
        verses = splitter(n).transform(known).persist()
        try:
            features = _fit_features(kind, point, verses, seed)
            model = classifier(point).copy().setParams(**setting).fit(PipelineModel(stages=features).transform(verses))
            ms.save_model(PipelineModel(stages=[splitter(n), *features, model]), model_path)
            ms.save_model(index, f"{model_path}-labels")
        finally:
            verses.unpersist()
    return _metric_rows(rows + [("best_auc", best[0])])


def verse_predictions_job(spark: SparkSession, requests: DataFrame, model_path: str, id: str = "doc_id") -> DataFrame:
    """Score requests with a saved verse classifier: one answer and a class map per text.

    Counts + naive Bayes are tables that the verses' words are joined with; the others are pipelines.
    """
    if ms.path_exists(spark, f"{model_path}/settings/_SUCCESS"):
        from quarry.streaming.answers import verse_answers
        model, settings = nb.NBModel.load(spark, model_path)
        return verse_answers(model, settings, requests, id, settings["text"])
    from pyspark.ml.feature import StringIndexerModel
    from quarry.plans.scoring import score_documents
    model, labels = ms.load_model(model_path), StringIndexerModel.load(f"{model_path}-labels").labels
    scored = score_documents(model.transform(requests), id, labels)
    names = F.array(*[F.lit(x) for x in labels])
    return scored.select(id, "n_verses", "predicted_label", F.map_from_arrays(names, "mean_probability").alias("class_probabilities"))


# --- JB8, JB9: multi-class text ------------------------------------------------------

def _multiclass_train(docs: DataFrame, kind: str, id: str, text: str, label: str, folds: int | None, parallelism: int):
    """(fitted pipeline with the word stage in front, best mean accuracy of the folds, test rows)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression, NaiveBayes
    folds = folds or TEXT_FOLDS[kind]
    words = PlainWords(textCol=text, outputCol="words")
    d = sp.hash_split(docs.select(id, text, label).na.drop(subset=[text, label]), id)
    train = sp.assign_folds(words.transform(d.filter(F.col("split") == "train")), id, folds)
    test = d.filter(F.col("split") == "test")
    idx = StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="keep")
    if kind == "nb":
        variants = train.select(F.lit(0).alias("variant"), F.col(id).alias("id"), F.lit(0).alias("part"), "fold",
                                F.col(label).cast("string").alias("label"), "words")
        scored = bs.nb_fold_scores(bs.bucket_variants(variants, TEXT_BUCKETS), (1.0,), TEXT_BUCKETS)
        best, _, accuracy = bs.grid_means(bs.fold_accuracy(scored), "accuracy")[0]
        pipe = Pipeline(stages=[idx, *_bucket_counts("words", TEXT_BUCKETS[best]), IDF(inputCol="tf", outputCol="features"),
                                NaiveBayes(labelCol="label_index", smoothing=1.0)])
        return PipelineModel(stages=[words, *pipe.fit(train).stages]), accuracy, test
    tfs = CountVectorizer(inputCol="words", outputCol="tf", vocabSize=TEXT_VOCABULARY, minDF=TEXT_MIN_DOCS)
    clf = LogisticRegression(labelCol="label_index", maxIter=TEXT_MAX_ITER)
    pipe = Pipeline(stages=[idx, tfs, IDF(inputCol="tf", outputCol="features"), clf])
    ev = MulticlassClassificationEvaluator(labelCol="label_index", metricName="accuracy")
    cvm = md.tune(pipe, _points(clf, {"regParam": TEXT_RIDGE}), ev, train, "fold", parallelism)
    return PipelineModel(stages=[words, *cvm.bestModel.stages]), md.best_of_grid(cvm, ev)[1], test


def multiclass_text_job(docs: DataFrame, kind: str = "nb", id: str = "doc_id", text: str = "text",
                        label: str = "lang", folds: int | None = None, parallelism: int = 4,
                        model_path: str | None = None) -> DataFrame:
    """80/20 document split, label index (F6), tokens of the whole text without stop words (no line
    filter, no ASCII cleanse), TF-IDF, NB or LR tuned by CV; test metrics (E3).

    Naive Bayes searches both bucket numbers in all folds from one term table; for LR the
    words are made once before the search and cached by ``tune``. ``folds`` is 5 for NB and
    3 for LR unless given. The saved model has the word stage in front of the tuned ones.
    """
    full, best, test = _multiclass_train(docs, kind, id, text, label, folds, parallelism)
    if model_path:
        ms.save_model(full, model_path)
    m = mt.multiclass_metrics(full.transform(test), "label_index", "prediction").first()
    return _metric_rows(list(m.asDict().items()) + [("cv_accuracy", best)])


def multiclass_text_reports(docs: DataFrame, kind: str = "nb", id: str = "doc_id", text: str = "text", label: str = "lang",
                            folds: int | None = None, parallelism: int = 4) -> dict[str, DataFrame]:
    """The job's other outputs: overview (A1), rows per class (A2), confusion (A3) and first predictions (O2)."""
    full, _, test = _multiclass_train(docs, kind, id, text, label, folds, parallelism)
    names = full.stages[1].labels
    pred = en.index_to_string(full.transform(test).select(id, label, "prediction"), "prediction", names, "predicted")
    return {"overview": mt.dataset_overview(docs, text), "classes": mt.class_distribution(docs, label),
            "confusion": mt.confusion_counts(pred, label, "predicted"),
            "sample": mt.sample_predictions(pred.select(id, label, "predicted"), 20, (id,))}


def multiclass_text_predictions(spark: SparkSession, docs: DataFrame, requests: DataFrame, model_path: str, kind: str = "lr",
                                id: str = "doc_id", text: str = "text", label: str = "lang", folds: int | None = None) -> DataFrame:
    """Load the text classifier (or train and save it where there is none) and answer requests: class and class map."""
    from quarry.plans.scoring import probability_map
    model = ms.load_or_train(spark, model_path, lambda: _multiclass_train(docs, kind, id, text, label, folds, 4)[0])
    names = model.stages[1].labels
    pred = probability_map(model.transform(requests.select(id, text)), names)
    return en.index_to_string(pred, "prediction", names, "predicted").select(id, "predicted", "class_probabilities")


# --- JB10: embeddings, synonyms, similarity ---------------------------------------------

def verse_embeddings(docs: DataFrame, sentences_in_verse: int = 4, vector_size: int = 50, seed: int = 1,
                     id: str = "doc_id", text: str = "text", stem: str = "s", model_path: str | None = None):
    """Word2Vec over the verses of a corpus (F13). Returns (model, verses)."""
    verses = VerseSplitter(idCol=id, textCol=text, carryCols=[], sentencesInVerse=sentences_in_verse, stem=stem
                           ).transform(docs)
    model = md.train_word2vec(verses, "verse", "vec", vector_size=vector_size, seed=seed)
    if model_path:  # what answers requests is the saved model
        from pyspark.ml.feature import Word2VecModel
        model = Word2VecModel.load(ms.save_model(model, model_path))
    return model, verses


def synonyms_job(docs: DataFrame, k: int = 5, n_query_words: int = 3, **w2v) -> DataFrame:
    """Synonyms (J2) of the ``n_query_words`` most frequent corpus words (a top-k report)."""
    from quarry.operators.text import explode_rows
    model, verses = verse_embeddings(docs, **w2v)
    top_words = (explode_rows(verses, [], F.col("verse"), "word").groupBy("word").count()
                 .orderBy(F.col("count").desc(), F.col("word")).limit(n_query_words))
    return md.synonyms(model, top_words, "word", k)


def request_similarity_job(docs: DataFrame, requests: DataFrame, request_id: str = "request_id",
                           request_text: str = "text", **w2v) -> DataFrame:
    """For every line of every request, the most similar other line of the same request.

    Embeddings are trained on the corpus; each request's line vectors are gathered per
    request (a group is one request text) and compared inside that group.
    """
    from quarry.operators.pairs import best_match_within
    model, _ = verse_embeddings(docs, **w2v)
    lines = VerseSplitter(idCol=request_id, textCol=request_text, carryCols=[], sentencesInVerse=1,
                          outputCol="verse", stem="s", multiwordLines=False).transform(requests)
    vec = model.transform(lines).select(request_id, "verse_id", F.col("vec"))
    return best_match_within(vec, request_id, "verse_id", "vec")


# --- JB11: wide-feature classifier -----------------------------------------------

def product_classifier_job(table: DataFrame, feature_cols: Sequence[str], label: str, key: str,
                           folds: int = FOLDS, num_trees: int = PRODUCT_TREES, max_depth: int = PRODUCT_DEPTH,
                           parallelism: int = 4, model_path: str | None = None) -> DataFrame:
    """Wide features (F5) -> label index (F6, fitted inside CV) -> vector index (F8) -> forest (M5)
    -> index to string (F7); CV f1 on 80% of the rows, metrics (E3) on the others; model saved (S7)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    split = sp.hash_split(table.withColumn(label, F.col(label).cast("string")), key)
    data, held = sp.assign_folds(split.filter(F.col("split") == "train"), key, folds), split.filter(F.col("split") == "test")
    idx = StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="keep")
    asm = VectorAssembler(inputCols=list(feature_cols), outputCol="raw")
    vix = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=10, handleInvalid="keep")
    rf = RandomForestClassifier(labelCol="label_index", numTrees=num_trees, maxDepth=max_depth, seed=1, maxMemoryInMB=512)
    pipe = Pipeline(stages=[idx, asm, vix, rf])
    grid = ParamGridBuilder().addGrid(rf.maxDepth, [max_depth]).build()
    ev = MulticlassClassificationEvaluator(labelCol="label_index", metricName="f1")
    cvm = md.tune(pipe, grid, ev, data, "fold", parallelism)
    labels = cvm.bestModel.stages[0].labels
    pred = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels).transform(
        cvm.bestModel.transform(held))
    if model_path:
        ms.save_model(cvm.bestModel, model_path)
    m = mt.multiclass_metrics(pred.withColumn("label_s", F.col(label)), "label_s", "predicted_label").first()
    return _metric_rows([("cv_f1", cvm.avgMetrics[0])] + list(m.asDict().items()))


# --- JB12: labelled vectors classifier ---------------------------------------------

def vector_classifier_job(spark: SparkSession, table: DataFrame, label: str, arr: str, key: str, path: str,
                          max_iter: int = 50) -> DataFrame:
    """Write labelled vectors (S5) -> read (S4) -> multinomial LR (M8) -> pairs (E6) -> metrics
    -> save (S7) -> load-or-train (S8) -> score (C1)."""
    from pyspark.ml.classification import LogisticRegressionModel
    from quarry.sources.files import write_labeled_vectors
    src = sp.hash_split(table, key, (0.7, 0.3), ("train", "test"))
    write_labeled_vectors(src.filter(F.col("split") == "train"), f"{path}/train", label, arr)
    write_labeled_vectors(src.filter(F.col("split") == "test"), f"{path}/test", label, arr)
    train = spark.read.parquet(f"{path}/train")
    test = spark.read.parquet(f"{path}/test")
    model_path = f"{path}/model"

    def fit():
        cached = train.persist()
        try:
            return md.train_logistic(cached, family="multinomial", max_iter=max_iter)
        finally:
            cached.unpersist()

    model = ms.load_or_train(spark, model_path, fit, kind=LogisticRegressionModel)
    pairs = mt.prediction_pairs(model.transform(test))
    m = mt.multiclass_metrics(pairs).first()
    return _metric_rows(list(m.asDict().items()))


# --- JB13: baseline trainers ---------------------------------------------------------

def baseline_trainers_job(table: DataFrame, label: str, arr: str, key: str, seed: int = 42) -> DataFrame:
    """70/30 hash split (R1), 70% hash sample (R2) and its complement (U2), then NB, SVM, LR,
    linear regression and k-means on one labelled-vector table."""
    src = table.select(key, F.col(label).cast("double").alias("label"),
                       array_to_vector(F.col(arr).cast("array<double>")).alias("features"))
    # the sample and its complement are one condition on the key's hash: no join
    inside = hash_fraction(key, sp.SAMPLE_SEED, 0.7)
    train, test = src.filter(inside).persist(), src.filter(~inside).persist()
    rows = []
    try:
        # NB needs non-negative features: scaled to 0..1 by the training rows' ranges
        scaler = MinMaxScaler(inputCol="features", outputCol="scaled").fit(train)

        def scaled(df):
            return scaler.transform(df).withColumn("scaled", array_to_vector(
                F.transform(vector_to_array("scaled"), lambda x: F.greatest(x, F.lit(0.0)))))

        nbm = md.train_nb(scaled(train), features="scaled")
        rows.append(("nb_accuracy", mt.multiclass_metrics(nbm.transform(scaled(test))).first()["accuracy"]))
        svm = md.train_svm(train.withColumn("label", (F.col("label") > 4).cast("double")), max_iter=50)
        rows.append(("svm_auc", BinaryClassificationEvaluator(rawPredictionCol="rawPrediction").evaluate(
            svm.transform(test.withColumn("label", (F.col("label") > 4).cast("double"))))))
        lrm = md.train_logistic(train, family="multinomial", max_iter=50)
        rows.append(("lr_accuracy", mt.multiclass_metrics(lrm.transform(test)).first()["accuracy"]))
        lin = md.train_linear(train, reg=0.3, elastic_net=0.8, max_iter=50)
        rows.append(("linear_rmse", mt.regression_metrics(lin.transform(test)).first()["rmse"]))
        km = md.train_kmeans(train, k=10, seed=1)
        rows.append(("kmeans_cost", km.summary.trainingCost))
    finally:
        train.unpersist()
        test.unpersist()
    return _metric_rows(rows)


# --- predict side of JB1 / JB2 -------------------------------------------------------

def salary_predictions_job(spark: SparkSession, table: DataFrame, model_path: str, label: str, numeric: str,
                           level: str, level_map, category: str, names: Sequence[str], key: str, folds: int = FOLDS) -> DataFrame:
    """Load the tuned regression (or train and save it once) and score a whole table."""
    from pyspark.ml.regression import LinearRegressionModel
    ex = en.regression_examples(table, label, numeric, level, level_map, category, names)
    model = ms.load_or_train(spark, model_path, lambda: _best_linear(sp.assign_folds(ex, key, folds), SALARY_GRID)[1],
                             kind=LinearRegressionModel)
    return model.transform(ex).select(key, "label", "prediction")


def level_predictions_job(spark: SparkSession, table: DataFrame, model_path: str, value: str, numeric: str,
                          level: str, level_map, key: str, k: int = 3,
                          names=("junior", "middle", "senior")) -> DataFrame:
    """Load the clustering pipeline (or train and save it once); every row gets its cluster and the
    cluster's named level (C4), ranked by mean ``value`` in original units."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.clustering import KMeans
    ex = en.clustering_examples(table, value, numeric, level, level_map)

    def train():
        return Pipeline(stages=[MaxAbsScaler(inputCol="features", outputCol="scaled"),
                                KMeans(k=k, featuresCol="scaled", seed=1, maxIter=20,
                                       predictionCol="cluster")]).fit(ex)

    model = ms.load_or_train(spark, model_path, train, kind=PipelineModel)
    assigned = model.transform(ex).withColumn(value, F.col(value).cast("double"))
    levels = cl.level_from_cluster(cl.cluster_profile(assigned, [value]), f"avg_{value}", list(names))
    # one row per cluster (k rows): a broadcast of a table bounded by k
    return assigned.join(F.broadcast(levels.select("cluster", "level")), "cluster").select(key, "cluster", "level")


# --- the jobs on their original input formats ------------------------------------------

def survey_salary_job(spark: SparkSession, csv_path: str, folds: int = FOLDS, model_path: str | None = None):
    """JB1 on a survey CSV: role filter before projection (P4), [experience, English level,
    19 language slots] (F3), elastic-net regression tuned by CV, coefficients (E9)."""
    from quarry.operators.filters import role_filter
    from quarry.sources import formats as fm
    from quarry.sources.files import read_typed_csv
    raw = read_typed_csv(spark, csv_path, fm.SURVEY_SCHEMA)
    kept = role_filter(raw, "position", fm.ROLE_CONTAINS, fm.ROLE_EQUALS).filter(F.col("salary").isNotNull())
    table = kept.select("id", "salary", "experience", "english_level", "programming_language")
    return salary_regression_job(table, "salary", "experience", "english_level", fm.ENGLISH_LEVELS,
                                 "programming_language", fm.LANGUAGE_SLOTS, folds=folds, model_path=model_path,
                                 other=fm.OTHER_LANGUAGE_SLOT, key="id")


def survey_levels_job(spark: SparkSession, csv_path: str, k: int = 3, model_path: str | None = None):
    """JB2 on a survey CSV: [salary, experience, English level], max-abs scaling, k-means, named levels."""
    from quarry.operators.filters import role_filter
    from quarry.sources import formats as fm
    from quarry.sources.files import read_typed_csv
    raw = read_typed_csv(spark, csv_path, fm.SURVEY_SCHEMA)
    kept = role_filter(raw, "position", fm.ROLE_CONTAINS, fm.ROLE_EQUALS).na.drop(subset=["salary", "experience"])
    return level_clustering_job(kept, "salary", "experience", "english_level", fm.ENGLISH_LEVELS, k=k,
                                model_path=model_path)


def product_csv_job(spark: SparkSession, csv_path: str, folds: int = 10, n_features: int = 93):
    """JB11 on a product CSV (id, feat_1..feat_n, target)."""
    from quarry.sources import formats as fm
    from quarry.sources.files import read_typed_csv
    table = read_typed_csv(spark, csv_path, fm.product_schema(n_features))
    return product_classifier_job(table, fm.product_features(n_features), "target", "id", folds=folds)


def text_csv_job(spark: SparkSession, csv_path: str, text: str = "lyrics", label: str = "genre",
                 kind: str = "nb", folds: int | None = None):
    """JB8 / JB9 on a CSV with a text and a class column (inferred schema, rows with nulls dropped).

    Rows carry no id, so the split and folds hash the text itself.
    """
    from quarry.sources.files import read_inferred_csv
    raw = read_inferred_csv(spark, csv_path).select(text, label).na.drop()
    docs = raw.withColumn("row_key", F.md5(F.col(text)))
    return multiclass_text_job(docs, kind, id="row_key", text=text, label=label, folds=folds)


def text_dirs_verse_job(spark: SparkSession, dirs, kind: str = "nb_counts",
                        folds: int = FOLDS, grid: dict | None = None, model_path: str | None = None) -> DataFrame:
    """JB3..JB7 on a class-per-folder text tree ({label: glob}): each file is one document,
    its folder the class; folds are drawn per file."""
    from quarry.sources.files import read_labeled_text
    docs = read_labeled_text(spark, dirs, whole=True).select(F.col("id").alias("doc_id"),
                                                             F.col("value").alias("text"), "label")
    return verse_classifier_job(docs, kind, grid=grid, folds=folds, model_path=model_path)
