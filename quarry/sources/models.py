"""Model sinks and sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession


def save_model(model, path: str) -> str:
    """Overwrite-save any ML writable (pipeline, CV model, single model)."""
    model.write().overwrite().save(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (any shared store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def load_model(path: str, kind="pipeline"):
    """Load a saved ``PipelineModel`` / ``CrossValidatorModel`` (S8), or any model class with ``load``."""
    if not isinstance(kind, str):
        return kind.load(path)
    if kind == "cv":
        from pyspark.ml.tuning import CrossValidatorModel
        return CrossValidatorModel.load(path)
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def load_or_train(spark: SparkSession, path: str, train_fn: Callable[[], object], kind="pipeline"):
    """Load the model at ``path``; train, save and return it only where there is none.

    A model that is there but can't be read is an error, not a reason to overwrite it.
    """
    if path_exists(spark, path):
        return load_model(path, kind)
    model = train_fn()
    save_model(model, path)
    return model
