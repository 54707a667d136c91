"""Features, baseline and model queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.operators import common, features, forecast
from fareline.plans import views
from fareline.plans.ctes import sql
from fareline.plans.registry import query, rounded
from fareline.session import cut_lineage, scratch

SPLIT = "2024-02-18"
FEAT_SQL = """origin_zone, trip_date, slot_of_day, hour_of_day, day_of_week, is_weekend, is_peak, demand, supply,
    round(supply_demand_ratio, 6) AS supply_demand_ratio, demand_lag_1d, demand_lag_7d, round(rolling_7d_mean, 6) AS rolling_7d_mean"""
CAL = {
    "cal": """SELECT s.*, a.demand AS demand_lag_1d, b.demand AS demand_lag_7d, (SELECT avg(c.demand) FROM slots c WHERE c.origin_zone = s.origin_zone AND c.slot_of_day = s.slot_of_day AND c.trip_date BETWEEN s.trip_date - 7 AND s.trip_date - 1) AS rolling_7d_mean
        FROM slots s JOIN slots a ON a.origin_zone = s.origin_zone AND a.slot_of_day = s.slot_of_day AND a.trip_date = s.trip_date - 1
        JOIN slots b ON b.origin_zone = s.origin_zone AND b.slot_of_day = s.slot_of_day AND b.trip_date = s.trip_date - 7""",
}
TEST = f"FROM feats WHERE trip_date >= DATE '{SPLIT}'"
MET = """count(*) AS n_rows, round(sqrt(avg(pow(demand - demand_lag_7d, 2))), 6) AS rmse, round(avg(abs(demand - demand_lag_7d)), 6) AS mae,
    round(CASE WHEN var_pop(demand) * count(*) > 0 THEN 1 - sum(pow(demand - demand_lag_7d, 2)) / (var_pop(demand) * count(*)) ELSE 0 END, 6) AS r2"""


def matrix(spark, sf):
    return features.build_features(features.slot_demand(views.curated(spark, sf)))


@query("slot_demand", sql("SELECT origin_zone, trip_date, slot_of_day, demand, supply, day_of_week, is_weekend, hour_of_day FROM slots", "slots"))
def slot_demand(spark, sf):
    return features.slot_demand(views.curated(spark, sf))


@query("features", sql(f"SELECT {FEAT_SQL} FROM feats", "feats"))
def feature_matrix(spark, sf):
    return rounded(matrix(spark, sf))


@query("features_calendar", sql("""SELECT origin_zone, trip_date, slot_of_day, hour_of_day, day_of_week, is_weekend, CASE WHEN hour_of_day IN (8, 9, 13, 14, 17, 18) THEN 1 ELSE 0 END AS is_peak, demand, supply,
    round(supply::DOUBLE / demand, 6) AS supply_demand_ratio, demand_lag_1d, demand_lag_7d, round(rolling_7d_mean, 6) AS rolling_7d_mean FROM cal""", "slots", extra=CAL))
def features_calendar(spark, sf):
    return rounded(features.build_features(features.slot_demand(views.curated(spark, sf)), calendar_lag=True))


@query("daily_mean_demand", sql("SELECT trip_date, round(avg(demand), 6) AS mean_demand FROM feats GROUP BY 1", "feats"))
def daily_mean_demand(spark, sf):
    return rounded(matrix(spark, sf).groupBy("trip_date").agg(F.avg("demand").alias("mean_demand")))


@query("train_test_split", sql(f"""SELECT CASE WHEN trip_date < DATE '{SPLIT}' THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows, min(trip_date) AS first_date, max(trip_date) AS last_date FROM feats GROUP BY 1""", "feats"))
def train_test_split(spark, sf):
    parts = features.split_at(matrix(spark, sf), SPLIT)
    both = common.union_all([p.withColumn("part", F.lit(n)) for n, p in zip(("train", "test"), parts)])
    return both.groupBy("part").agg(F.count("*").alias("n_rows"), F.min("trip_date").alias("first_date"), F.max("trip_date").alias("last_date"))


@query("naive_baseline", sql(f"SELECT {MET} {TEST}", "feats"))
def naive_baseline(spark, sf):
    return rounded(forecast.metrics(forecast.naive(features.split_at(matrix(spark, sf), SPLIT)[1])))


@query("model_metrics_by_zone", sql(f"SELECT origin_zone, {MET} {TEST} GROUP BY 1", "feats"))
def model_metrics_by_zone(spark, sf):
    return rounded(forecast.metrics(forecast.naive(features.split_at(matrix(spark, sf), SPLIT)[1]), ["origin_zone"]))


@query("residual_stats", sql(f"""SELECT round(avg(e), 6) AS mean, round(stddev_samp(e), 6) AS std, round(median(e), 6) AS median, round(quantile_cont(e, 0.05), 6) AS p05, round(quantile_cont(e, 0.95), 6) AS p95
    FROM (SELECT (demand - demand_lag_7d)::DOUBLE AS e {TEST})""", "feats"))
def residual_stats(spark, sf):
    e = forecast.naive(features.split_at(matrix(spark, sf), SPLIT)[1]).select((F.col("demand") - F.col("prediction")).alias("e"))
    q = common.percentiles(e, "e", [0.05, 0.5, 0.95])
    at = lambda p: q.agg(F.max(F.when(F.col("p") == p, F.col("value")))).scalar()
    return rounded(e.agg(F.avg("e").alias("mean"), F.stddev_samp("e").alias("std")).select(
        "mean", "std", at(0.5).alias("median"), at(0.05).alias("p05"), at(0.95).alias("p95")))


CORR = ["demand", "hour_of_day", "day_of_week", "is_weekend", "is_peak", "slot_of_day", "demand_lag_1d", "demand_lag_7d", "rolling_7d_mean"]


@query("feature_corr", sql(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM feats" for i, a in enumerate(CORR) for b in CORR[i + 1:]), "feats"))
def feature_corr(spark, sf):
    return rounded(features.correlations(matrix(spark, sf), CORR))


# --- trained model: one fit per session and input, kept as a saved model in the shared folder ---

_saved: dict[tuple[str, str], str] = {}
_kept: dict[tuple[str, str], DataFrame] = {}


def kept_matrix(spark, sf):
    """The feature matrix, written once per session and input: a fit and its scores read it many times,
    and it has at most a row per zone, date and slot, whatever the number of trips."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _kept:
        _kept[key] = cut_lineage(matrix(spark, sf), "features")
    return _kept[key]


def model_for(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _saved:
        train, _ = features.split_at(kept_matrix(spark, sf), SPLIT)
        path = scratch(spark, "model")
        forecast.save_model(forecast.train_gbt(train), path)
        _saved[key] = path
    return forecast.load_model(_saved[key])


def test_rows(spark, sf):
    return features.split_at(kept_matrix(spark, sf), SPLIT)[1]


@query("gbt_train")
def gbt_train(spark, sf):
    model = model_for(spark, sf)
    rows = [(i, type(s).__name__) for i, s in enumerate(model.stages)]
    return spark.createDataFrame(rows, "stage int, kind string")


@query("gbt_metrics")
def gbt_metrics(spark, sf):
    test = test_rows(spark, sf)
    return rounded(forecast.improvement(forecast.metrics(forecast.score(model_for(spark, sf), test)), forecast.metrics(forecast.naive(test))))


@query("gbt_importance")
def gbt_importance(spark, sf):
    return rounded(forecast.feature_importances(model_for(spark, sf)))


@query("batch_score")
def batch_score(spark, sf):
    return rounded(forecast.score(model_for(spark, sf), test_rows(spark, sf)).select("origin_zone", "trip_date", "slot_of_day", "demand", "prediction"))


@query("model_vs_baseline_by_zone")
def model_vs_baseline_by_zone(spark, sf):
    test = test_rows(spark, sf)
    return rounded(forecast.versus_baseline(forecast.score(model_for(spark, sf), test), test))


@query("model_save")
def model_save(spark, sf):
    """Save a metrics table beside the model and read it back."""
    test = test_rows(spark, sf)
    path = scratch(spark, "metrics")
    m = forecast.improvement(forecast.metrics(forecast.score(model_for(spark, sf), test)), forecast.metrics(forecast.naive(test)))
    m.write.parquet(path)
    return rounded(spark.read.parquet(path))


@query("model_reload")
def model_reload(spark, sf):
    """Scores from a model written again and loaded from its copy, next to the first model's."""
    first = model_for(spark, sf)
    path = scratch(spark, "model-copy")
    forecast.save_model(first, path)
    test = test_rows(spark, sf)
    key = ["origin_zone", "trip_date", "slot_of_day"]
    a = forecast.score(first, test).select(*key, F.col("prediction").alias("p1"))
    b = forecast.score(forecast.load_model(path), test).select(*key, F.col("prediction").alias("p2"))
    return a.join(b, key).agg(F.count("*").alias("n_rows"), F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_difference"))
