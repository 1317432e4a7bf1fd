"""Write the physical plans of the headline queries to PLANS.md.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from terrace import catalog  # noqa: E402
from terrace.operators import merge  # noqa: E402
from terrace.plans import marts  # noqa: E402
from terrace.session import build_session, scratch_path  # noqa: E402


def tree(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", shuffle_partitions=8)
    s = catalog.star(spark, sf_dir)
    out = ["# Physical plans", "", f"Generated by `tools/plans.py` on `{sf_dir}` (local[8], AQE on).", ""]

    def section(title, note, df):
        out.extend([f"## {title}", "", note, "", "```", tree(df).rstrip(), "```", ""])

    section("Mart, dimensions under the broadcast limit",
            "Calendar, postcode versions and property broadcast; one partial+final aggregate.",
            s.mart())
    spark.conf.set("terrace.broadcast.maxBytes", "0")
    section("Mart, postcode versions over the broadcast limit",
            "Postcode equality is the sort-merge key, the validity interval is the residual "
            "condition; AQE may still switch to broadcast at run time once it sees the sizes.",
            marts.mart_rural_urban(s.fact_sales, s.dim_date, s.dim_geography, s.dim_property))
    spark.conf.unset("terrace.broadcast.maxBytes")
    d = scratch_path(spark, f"plans-{uuid.uuid4().hex[:8]}")
    s.fact_sales.write.parquet(f"{d}/fact")
    fact = spark.read.parquet(f"{d}/fact")
    section("Top deprived areas over a stored fact",
            "The year filter is also a `date_key` range, pushed into the Parquet scan.",
            marts.top_deprived_areas(fact, s.dim_geography, s.dim_date, catalog.E2_YEAR))
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", F.col("event_id").alias("first_event_id"), "event_id", "ts", "event_type", "value", "props")
    cut = ev.agg(F.max("event_id")).first()[0] // 2
    cur = ev.where(F.col("event_id") <= cut)
    section("Keyed upsert",
            "Table and batch in one aggregation by key: partial max_by/min_by before the exchange, "
            "each input read once.",
            merge.keyed_upsert(cur, ev.where(F.col("event_id") > cut), "user_id", "event_id",
                               catalog.EVENT_UPDATE_COLUMNS))
    from terrace.operators import refcount
    from terrace import schemas
    s0 = s.silver_ppd.where(F.col("transfer_date") < "2000-01-01")
    inc = s.silver_ppd.where(F.col("transfer_date") >= "2000-01-01")
    section("Reference counts of a distinct dimension, one increment",
            "Counts partially aggregated per address; the null-safe match of combinations is an "
            "equi-join on (coalesce, isnull) keys, never a nested loop; silver is not rescanned.",
            refcount.apply_delta(refcount.counts(s0, schemas.ADDRESS_COLUMNS), inc, inc.where(F.lit(False)),
                                 schemas.ADDRESS_COLUMNS))
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
