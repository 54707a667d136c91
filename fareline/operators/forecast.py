"""Demand forecasting: training, scoring, metrics."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import constants as K


def train_gbt(train: DataFrame, leaky: bool = False, iterations: int = 50, depth: int = 5, bins: int = 64) -> PipelineModel:
    """Gradient-boosted trees on the feature matrix. The supply/demand ratio has the target in its
    denominator and is left out unless ``leaky`` is set. ``bins`` grows to hold
    every zone and the unknown one."""
    bins = max(bins, train.select("origin_zone").distinct().count() + 2)
    cols = [*K.MODEL_FEATURES, *([K.LEAKY_FEATURE] if leaky else [])]
    stages = [
        StringIndexer(inputCol="origin_zone", outputCol="zone_idx", handleInvalid="keep"),
        VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip"),
        GBTRegressor(featuresCol="features", labelCol="demand", maxDepth=depth, maxIter=iterations, stepSize=0.1, seed=42, maxBins=bins),
    ]
    return Pipeline(stages=stages).fit(train)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importances(model: PipelineModel) -> DataFrame:
    names = model.stages[-2].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double").orderBy(F.desc("importance"))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).drop("features", "zone_idx")


def naive(rows: DataFrame) -> DataFrame:
    """Prediction = same zone and slot seven rows back."""
    return rows.withColumn("prediction", F.col("demand_lag_7d").cast("double")).where("prediction IS NOT NULL")


def metrics(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """RMSE, MAE and R2 of ``prediction`` against ``demand``, overall or per key, in one pass."""
    err = F.col("demand") - F.col("prediction")
    g = rows.groupBy(*(by or []))
    base = g.agg(
        F.count("*").alias("n_rows"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_res"), (F.var_pop("demand") * F.count("*")).alias("_tot"))
    return base.withColumn("r2", F.when(F.col("_tot") > 0, 1 - F.col("_res") / F.col("_tot")).otherwise(0.0)).drop("_res", "_tot")


def improvement(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """Metric table of both predictors with the percent gain of the model."""
    both = model.withColumn("model", F.lit("gbt")).unionByName(baseline.withColumn("model", F.lit("baseline_7d_lag")))
    base = baseline.select("rmse").scalar()
    return both.withColumn("rmse_gain_pct", (base - F.col("rmse")) / base * 100)


def versus_baseline(scored: DataFrame, rows: DataFrame, by: str = "origin_zone") -> DataFrame:
    m = metrics(scored, [by]).select(by, F.col("rmse").alias("model_rmse"), F.col("mae").alias("model_mae"))
    b = metrics(naive(rows), [by]).select(by, F.col("rmse").alias("baseline_rmse"), F.col("mae").alias("baseline_mae"), "n_rows")
    return m.join(b, by).withColumn("gain_pct", (F.col("baseline_rmse") - F.col("model_rmse")) / F.col("baseline_rmse") * 100)
