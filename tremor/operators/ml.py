"""Magnitude models: assemble, fit, score, compare, choose.

Tree models are trained by ``operators.trees``: the same rows give the same
model however they are partitioned, and scoring is a column expression.  The
linear model, and tree models on request (``learner="spark-ml"``), are Spark ML
pipelines; Spark ML draws samples and split candidates per partition, so its
tree models also depend on the layout of the training rows.  Only the fitted
model and a handful of scalar metrics reach the driver.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor import schema
from tremor.operators import trees

# Model seed, acceptance threshold on RMSE, default prediction year.
SEED = 42
RMSE_TARGET = 0.5
PREDICTION_YEAR = 2017
# The compared models, in comparison order.
MODEL_NAMES = ("RandomForest", "LinearRegression", "DecisionTree", "GBT")


def assembler(features=schema.FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def regressor(name: str, label: str = schema.LABEL, seed: int = SEED):
    common = {"featuresCol": "features", "labelCol": label}
    if name == "RandomForest":
        return RandomForestRegressor(seed=seed, **common)
    if name == "LinearRegression":
        return LinearRegression(**common)
    if name == "DecisionTree":
        return DecisionTreeRegressor(seed=seed, **common)
    if name == "GBT":
        return GBTRegressor(seed=seed, **common)
    raise ValueError(f"unknown model {name!r}; known: {MODEL_NAMES}")


def model_frame(df: DataFrame, features=schema.FEATURES, label: str = schema.LABEL) -> DataFrame:
    """Feature and label columns with incomplete rows dropped (the assembler rejects nulls)."""
    return df.select(*features, label).na.drop(how="any")


def fit(
    train: DataFrame, name: str = "RandomForest", features=schema.FEATURES, seed: int = SEED, label: str = schema.LABEL, learner: str = "exact"
) -> PipelineModel | trees.TreeModel:
    """A model with ``transform``, which adds the column ``prediction``.

    ``learner`` (trees only; the linear model is Spark ML's): "exact" trains with
    ``operators.trees``, "spark-ml" with Spark ML's estimator.
    """
    if learner not in ("exact", "spark-ml"):
        raise ValueError(f"unknown learner {learner!r}")
    estimator = regressor(name, label, seed)
    exact = {"RandomForest": trees.fit_forest, "DecisionTree": trees.fit_tree, "GBT": trees.fit_boosted}
    # Many passes (split finding, tree levels, iterations), unless the caller already cached the rows.
    cached = train.storageLevel.useMemory or train.storageLevel.useDisk
    if not cached:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if learner == "exact" and name in exact:
            return exact[name](train, features, label, seed)
        return Pipeline(stages=[assembler(features), estimator]).fit(train)
    finally:
        if not cached:
            train.unpersist()


def rmse(model, test: DataFrame, label: str = schema.LABEL) -> float:
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    return ev.evaluate(model.transform(test))


def predict(model, test: DataFrame) -> DataFrame:
    return model.transform(test).drop("features")


def compare(
    train: DataFrame, test: DataFrame, names=MODEL_NAMES, seed: int = SEED, parallelism: int = 4
) -> DataFrame:
    """Fit each model on ``train``, score ``test``: ``pos, model, rmse, accepted``.

    Training and test rows are cached for the fits and scores (each model reads
    both) and released afterwards.  Up to ``parallelism`` models are fitted at once from a thread pool, as Spark ML's
    own tuning estimators do, so their jobs share the cluster instead of
    queueing; seeds make the result independent of the interleaving.
    """
    from multiprocessing.pool import ThreadPool

    from pyspark.util import inheritable_thread_target

    spark = train.sparkSession
    train, test = train.persist(StorageLevel.MEMORY_AND_DISK), test.persist(StorageLevel.MEMORY_AND_DISK)

    @inheritable_thread_target(spark)
    def one(item):
        i, n = item
        return i, n, float(rmse(fit(train, n, seed=seed), test))

    try:
        with ThreadPool(processes=max(1, min(parallelism, len(names)))) as pool:
            rows = sorted(pool.map(one, list(enumerate(names))))
    finally:
        train.unpersist()
        test.unpersist()
    df = spark.createDataFrame(rows, "pos int, model string, rmse double")
    return df.withColumn("accepted", F.col("rmse") < F.lit(RMSE_TARGET))


def select_best(compared: DataFrame) -> DataFrame:
    """Lowest RMSE; the earlier model wins a tie."""
    return compared.orderBy("rmse", "pos").limit(1)


def prediction_table(
    model, test: DataFrame, year: int = PREDICTION_YEAR, err: float | None = None
) -> DataFrame:
    """``Latitude, Longitude, Pred_Magnitude, Year, RMSE`` for the holdout rows
    (``err``: the model's RMSE on ``test`` when already known)."""
    if err is None:
        err = rmse(model, test)
    return model.transform(test).select(
        "Latitude",
        "Longitude",
        F.col("prediction").alias("Pred_Magnitude"),
        F.lit(year).alias("Year"),
        F.lit(err).alias("RMSE"),
    )


def score_points(model, points: DataFrame) -> DataFrame:
    """Predicted magnitude for a table of points (batch form of one-point scoring)."""
    feats = points.select(
        "point_id",
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        F.col("depth").alias("Depth"),
    ).na.drop(how="any")
    return model.transform(feats).select(
        "point_id", "Latitude", "Longitude", "Depth", F.col("prediction").alias("Pred_Magnitude")
    )
