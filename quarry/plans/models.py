"""Model training, tuning and reports on ``pyspark.ml`` (M1..M8, F13, E1, E2, E8, E9, E11).

Solvers and random initialisation have no SQL twin; these are checked by rows and by
tests (beat the majority class, save -> load gives the same predictions).
Data is cached once before iterative fits and released after.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def train_linear(df: DataFrame, features="features", label="label", reg=0.3, elastic_net=0.8,
                 max_iter=50, solver="auto", fit_intercept=True):
    """Linear regression with elastic net (M1)."""
    from pyspark.ml.regression import LinearRegression
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=elastic_net,
                            maxIter=max_iter, solver=solver, fitIntercept=fit_intercept).fit(df)


def train_kmeans(df: DataFrame, k: int, features="features", seed=1, max_iter=20):
    """K-means (M2)."""
    from pyspark.ml.clustering import KMeans
    return KMeans(k=k, featuresCol=features, seed=seed, maxIter=max_iter).fit(df)


def train_logistic(df: DataFrame, features="features", label="label", reg=0.0, elastic_net=0.0,
                   max_iter=100, family="auto"):
    """Logistic regression, binary or multinomial (M3, M8)."""
    from pyspark.ml.classification import LogisticRegression
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=elastic_net,
                              maxIter=max_iter, family=family).fit(df)


def train_nb(df: DataFrame, features="features", label="label", smoothing=1.0, model_type="multinomial"):
    """Naive Bayes on non-negative features (M4)."""
    from pyspark.ml.classification import NaiveBayes
    return NaiveBayes(featuresCol=features, labelCol=label, smoothing=smoothing, modelType=model_type).fit(df)


def train_forest(df: DataFrame, features="features", label="label", num_trees=30, max_depth=5,
                 max_bins=32, seed=1, max_memory_mb=512):
    """Random forest classifier (M5)."""
    from pyspark.ml.classification import RandomForestClassifier
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                  maxBins=max_bins, seed=seed, maxMemoryInMB=max_memory_mb).fit(df)


def mlp_layers(n_features: int, n_classes: int, hidden: Sequence[int] = (50,)) -> list[int]:
    """Layer sizes derived from the data: [inputs, *hidden, classes]."""
    return [int(n_features), *map(int, hidden), int(n_classes)]


def train_mlp(df: DataFrame, features="features", label="label", hidden=(50,), max_iter=100,
              block_size=128, seed=1234):
    """Multilayer perceptron; input and output sizes come from the data (M6)."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import vector_to_array
    from quarry.operators.encoders import vector_width
    n_features = vector_width(df.select(vector_to_array(features).alias("a")), "a")
    n_classes = int(df.agg(F.max(label)).first()[0]) + 1
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label,
                                          layers=mlp_layers(n_features, n_classes, hidden), maxIter=max_iter,
                                          blockSize=block_size, seed=seed).fit(df)


def train_svm(df: DataFrame, features="features", label="label", max_iter=100, reg=0.0):
    """Linear SVM, binary (M7)."""
    from pyspark.ml.classification import LinearSVC
    return LinearSVC(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg).fit(df)


def train_word2vec(df: DataFrame, input_col="verse", output_col="embedding", vector_size=100, min_count=0,
                   seed=1, num_partitions=8, max_iter=3, window_size=5):
    """Word2Vec; a row's vector is the mean of its word vectors.

    Each partition sees its share of the sentences an iteration and the vectors are
    averaged, so more partitions want more iterations. Both are the caller's to set and
    do not follow the cluster's cores; ``model_statistics`` reports them.
    """
    from pyspark.ml.feature import Word2Vec
    return Word2Vec(inputCol=input_col, outputCol=output_col, vectorSize=vector_size, minCount=min_count,
                    seed=seed, numPartitions=num_partitions, maxIter=max_iter, windowSize=window_size).fit(df)


def synonyms(model, words: DataFrame, word_col: str = "word", k: int = 5) -> DataFrame:
    """Top-k most similar vocabulary words per requested word.

    Requested text is split into words; unknown words give no rows. The requested
    words' vectors are shipped in blocks; the model vocabulary is scanned as a DataFrame.
    """
    from quarry.operators.pairs import nearest_neighbors
    vocab = model.getVectors()                             # (word, vector)
    req = (words.select(F.explode(F.split(F.lower(F.trim(F.col(word_col))), r"\s+")).alias("word"))
           .filter(F.col("word") != "").distinct())
    q = req.join(vocab, "word").select(F.col("word").alias("query"), F.col("vector").alias("qv"))
    nn = nearest_neighbors(vocab.withColumnRenamed("word", "synonym"), q, k, "synonym", "vector",
                           "query", "qv", exclude_self=True)
    return nn.select(F.col("query").alias("word"), "rank", "synonym", F.col("cosine").alias("similarity"))


def training_summary(model) -> DataFrame:
    """(metric, value): coefficients count, iterations, RMSE, r2 of a fitted linear model."""
    spark = SparkSession.getActiveSession()
    s = model.summary
    rows = [("iterations", float(s.totalIterations)), ("rmse", float(s.rootMeanSquaredError)),
            ("r2", float(s.r2)), ("n_coefficients", float(len(model.coefficients))),
            ("intercept", float(model.intercept))]
    return spark.createDataFrame(rows, "metric string, value double")


def explain_linear(model, names: Sequence[str], params: dict | None = None) -> DataFrame:
    """(name, coefficient) per feature slot plus the intercept and chosen params."""
    spark = SparkSession.getActiveSession()
    coef = model.coefficients.toArray().tolist()
    rows = [("intercept", float(model.intercept))] + [(n, float(c)) for n, c in zip(names, coef, strict=True)]
    rows += [(f"param:{k}", float(v)) for k, v in (params or {}).items()]
    return spark.createDataFrame(rows, "name string, coefficient double")


def model_statistics(model, best_metric: float | None = None) -> DataFrame:
    """(stage, param, value) for every set param of every stage, plus the best metric."""
    spark = SparkSession.getActiveSession()
    rows = []
    if hasattr(model, "bestModel"):  # a cross-validated model: its best model, and the folds' mean metrics
        rows += [("cv", f"avg_metric_{i}", str(m)) for i, m in enumerate(model.avgMetrics)]
        model = model.bestModel
    stages = getattr(model, "stages", [model])
    for i, st in enumerate(stages):
        for p, v in st.extractParamMap().items():
            if isinstance(v, (int, float, str, bool)):
                rows.append((f"{i}:{type(st).__name__}", p.name, str(v)))
        if hasattr(st, "getVectors"):
            rows.append((f"{i}:{type(st).__name__}", "vocabulary", str(st.getVectors().count())))
        if hasattr(st, "getNumTrees"):
            rows.append((f"{i}:{type(st).__name__}", "trees", str(st.getNumTrees)))
        if hasattr(st, "vocabulary"):
            rows.append((f"{i}:{type(st).__name__}", "vocabulary", str(len(st.vocabulary))))
    if best_metric is not None:
        rows.append(("model", "best_metric", str(best_metric)))
    return spark.createDataFrame(rows, "stage string, param string, value string")


def best_of_grid(cv_model, evaluator) -> tuple[int, float]:
    """Index and value of the best grid point, by the evaluator's direction (O3)."""
    ms = list(cv_model.avgMetrics)
    pick = max if evaluator.isLargerBetter() else min
    best = pick(range(len(ms)), key=lambda i: ms[i])
    return best, ms[best]


def tune(estimator, grid, evaluator, data: DataFrame, fold_col: str = "fold", parallelism: int = 4,
         seed: int = 42):
    """k-fold cross-validation with folds given by ``fold_col`` (hash folds by document).

    The data is cached once for all grid points and folds, then released.
    """
    from pyspark.ml.tuning import CrossValidator
    data = data.persist()
    try:
        # fold values must lie in [0, numFolds): take the largest present, not the count of distinct ones
        n_folds = int(data.agg(F.max(fold_col)).first()[0]) + 1
        cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                            numFolds=max(2, n_folds), foldCol=fold_col, parallelism=parallelism, seed=seed)
        return cv.fit(data)
    finally:
        data.unpersist()
