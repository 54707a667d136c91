"""The path-based jobs end to end on files written from the derived tables."""

from pyspark.sql import functions as F

from fareline import jobs
from fareline.operators import trips
from fareline.plans import views
from fareline.plans.source_queries import CSV_COLS, _drifting
from fareline.sources import sinks


def test_trip_jobs_chain(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    raw, zones, curated, kpis, feats = (str(tmp_path / n) for n in ("raw", "zones", "curated", "kpis", "features"))
    sinks.write_csv(views.table(spark, sf, "raw_trips").select(*CSV_COLS), raw)
    sinks.write_csv(views.zones(spark, sf), zones)
    seen = jobs.etl_trips(spark, raw, zones, curated, salt=4)
    want = trips.curate_trips(views.table(spark, sf, "raw_trips"), views.zones(spark, sf))
    assert seen["trips"] == want.count() == spark.read.parquet(curated).count() > 0

    jobs.kpis(spark, curated, kpis)
    per_zone = spark.read.parquet(f"{kpis}/trips_per_zone")
    assert per_zone.agg(F.sum("trip_count")).first()[0] == seen["trips"]
    assert spark.read.parquet(f"{kpis}/peak_hours").count() == 5

    jobs.build_matrix(spark, curated, feats)
    table = jobs.train(spark, feats, "2024-02-18", str(tmp_path / "model"), str(tmp_path / "metrics"), iterations=3)
    assert {r.model for r in table.collect()} == {"gbt", "baseline_7d_lag"}
    jobs.score(spark, str(tmp_path / "model"), feats, str(tmp_path / "scored"))
    assert spark.read.parquet(str(tmp_path / "scored")).where("prediction IS NULL").count() == 0


def test_meter_job(spark, sf, tmp_path):
    seen = jobs.etl_meter(spark, _drifting(spark, sf), str(tmp_path / "demand"))
    assert spark.read.parquet(str(tmp_path / "demand")).agg(F.sum("trip_count")).first()[0] == seen["trips"] == views.clean_meter(spark, sf).count()
