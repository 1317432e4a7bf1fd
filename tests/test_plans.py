"""Physical-plan shape: broadcast only under the size check, interval as a
residual join condition, filters and partitions pruned at the scan."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from terrace import catalog
from terrace.catalog import RUN_TS
from terrace.operators import incremental, joins
from terrace.plans import gold, marts
from terrace.plans.star import build_star
from terrace.sinks.tables import VersionedTable
from terrace.sources import fixtures


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _star(spark):
    return build_star(spark, fixtures.bronze(spark, SF_SMALL), RUN_TS)


def test_mart_broadcasts_small_dimensions(spark):
    p = plan(_star(spark).mart())
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "valid_from" in p and "valid_to" in p


def test_mart_shuffles_geography_over_the_limit(spark):
    spark.conf.set("terrace.broadcast.maxBytes", "0")
    try:
        s = _star(spark)
        p = plan(marts.mart_rural_urban(s.fact_sales, s.dim_date, s.dim_geography, s.dim_property))
    finally:
        spark.conf.unset("terrace.broadcast.maxBytes")
    import re
    # equality on the postcode (salted where blank) is the sort key; the interval is the residual
    assert re.search(r"SortMergeJoin \[_key#\d+\], \[g_postcode#\d+\], LeftOuter, "
                     r"\(\(full_date#\d+ >= valid_from#\d+\) AND \(full_date#\d+ <= valid_to#\d+\)\)", p), p


def test_year_filter_reaches_fact_scan(spark, tmpdir_run):
    s = _star(spark)
    s.fact_sales.write.parquet(f"{tmpdir_run}/fact")
    fact = spark.read.parquet(f"{tmpdir_run}/fact")
    p = plan(marts.top_deprived_areas(fact, s.dim_geography, s.dim_date, 1998))
    assert "GreaterThanOrEqual(date_key,19980101)" in p and "LessThanOrEqual(date_key,19981231)" in p


def test_versioned_table_partition_pruning(spark, tmpdir_run):
    t = VersionedTable(spark, f"{tmpdir_run}/t", lambda: F.year("d"), ["k"])
    rows = [(f"k{i}", dt.date(1995 + i % 5, 1, 1)) for i in range(50)]
    t.overwrite(spark.createDataFrame(rows, "k string, d date"))
    df = t.read(with_part=True).where(F.col("_part") == "1997")
    assert "PartitionFilters: [isnotnull(_part" in plan(df)
    assert df.count() == 10
    assert len(t.read().inputFiles()) == 5  # range-clustered: one file per year here


def test_hot_postcode_is_split_at_run_time(spark):
    """One postcode holding a third of the facts: with the versions side over
    the broadcast limit, adaptive execution splits its join partition."""
    from terrace.operators import joins
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "terrace.broadcast.maxBytes": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(30000).select(
            F.col("id").cast("string").alias("tid"),
            F.when(F.col("id") % 3 == 0, F.lit("HOT"))
             .otherwise(F.concat(F.lit("K"), (F.col("id") % 500).cast("string"))).alias("pc"),
            F.lit(dt.date(1998, 5, 1)).alias("d"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload")).repartition(16)
        versions = spark.range(501).select(
            F.when(F.col("id") == 500, F.lit("HOT")).otherwise(
                F.concat(F.lit("K"), F.col("id").cast("string"))).alias("gpc"),
            F.lit(dt.date(1990, 1, 1)).alias("valid_from"), F.lit(dt.date(2099, 1, 1)).alias("valid_to"))
        out = joins.validity_join(facts, versions, "pc", "gpc", "d", how="left").groupBy("gpc").agg(
            F.count(F.lit(1)).alias("n"), F.max("payload").alias("p"))
        rows = {r.gpc: r.n for r in out.collect()}
        assert rows["HOT"] == 10000 and sum(rows.values()) == 30000
        assert "SortMergeJoin(skew=true)" in plan(out)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_refcount_delta_is_an_equi_join(spark):
    """Null-safe matching of attribute combinations stays a hash/sort join."""
    from terrace.operators import refcount as R
    schema = "k string, a string, b string"
    cur = R.counts(spark.createDataFrame([("1", "x", None)], schema), ["a", "b"])
    inc = spark.createDataFrame([("2", "y", None), ("3", "x", None)], schema)
    out = R.apply_delta(cur, inc, spark.createDataFrame([], schema), ["a", "b"])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([("x", None, 2), ("y", None, 1)], key=repr)
    p = plan(out)
    assert "NestedLoop" not in p and "CartesianProduct" not in p
    assert "SortMergeJoin" in p or "HashJoin" in p


def _executed(df) -> str:
    """The plan as it ran (adaptive execution included)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_filtered_calendar_prunes_year_folders(spark, tmpdir_run):
    s = _star(spark)
    fact = gold.write_by_year(s.fact_sales, f"{tmpdir_run}/fact")
    p = plan(marts.top_deprived_areas(fact, s.dim_geography, s.dim_date, 1998))
    assert "dynamicpruning" in p and "date_key,19980101" not in p
    p = plan(marts.detached_new_builds(fact, s.dim_date, s.dim_property, 1997))
    assert "dynamicpruning" in p


def test_the_mark_is_a_subquery_that_reads_footers(spark, tmpdir_run):
    s = _star(spark)
    s.silver_ppd.where("transfer_date < '1998-01-01'").write.parquet(f"{tmpdir_run}/silver")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    new = incremental.past_mark(s.raw["ppd"], f"{tmpdir_run}/silver", "transfer_date", incremental.DEFAULT_DATE_MARK)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    p = new._jdf.queryExecution().toString()
    assert "ubquery" in p and "PushedAggregation: [MAX(transfer_date)]" in p
    assert new.count() == s.raw["ppd"].where("transfer_date >= '1998-01-01'").count()


def test_bucketed_tables_join_without_exchange(spark, tmpdir_run):
    facts = spark.range(1000).selectExpr("concat('P', id % 40) AS k", "date'2000-01-01' + cast(id % 900 AS int) AS d", "id")
    versions = spark.range(80).selectExpr("concat('P', id % 40) AS k", "date'2000-01-01' + cast(id * 5 AS int) AS valid_from",
                                          "date'2001-12-31' AS valid_to", "id AS version")
    f = joins.bucketed(facts, "k", f"{tmpdir_run}/f", 4)
    v = joins.bucketed(versions, "k", f"{tmpdir_run}/v", 4)
    got = joins.bucketed_validity_join(f, v, "k", "d")
    p = _executed(got)
    assert "SortMergeJoin" in p and "Exchange" not in p
    want = joins.validity_join(facts, versions.withColumnRenamed("k", "vk"), "k", "vk", "d").drop("vk")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_no_job_before_silver_and_check_plans(spark):
    sc = spark.sparkContext
    catalog._STARS.clear()
    sc.setJobGroup("planning", "plans only")
    try:
        for name in ("silver_transactions", "silver_postcodes", "silver_rural_urban", "silver_deprivation", "fact_sales",
                     "check_price", "check_min_rows", "check_freshness", "metric_m1"):
            catalog.queries()[name](spark, SF_SMALL)
        tracker = sc.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("planning") for s in tracker.getJobInfo(j).stageIds]
        # Only the footers that give a table's schema are read.
        assert stages and all(s.name.startswith("parquet at") and s.numTasks == 1 for s in stages), stages
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
