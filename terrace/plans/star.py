"""Wire the bronze tables through silver into the gold star schema (lazily)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from terrace.plans import gold, marts, silver


class Tables(Mapping):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class Star:
    """Every model over the bronze tables ``raw``, built when first asked for:
    a query plans, and measures broadcast sides for, its own models only."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame], run_ts: _dt.datetime | None = None):
        self.spark = spark
        self.raw = raw
        self.run_ts = run_ts
        # Broadcast-size measurements of dimension sides over these tables.
        self.memo: dict = {}

    @cached_property
    def silver_ppd(self) -> DataFrame:
        return silver.silver_ppd(self.raw["ppd"], self.run_ts)

    @cached_property
    def silver_onspd(self) -> DataFrame:
        return silver.silver_onspd(self.raw["onspd"])

    @cached_property
    def silver_ruc(self) -> DataFrame:
        return silver.silver_ruc(self.raw["ruc_lsoa_2021"])

    @cached_property
    def silver_imd(self) -> DataFrame:
        return silver.silver_imd(self.raw["imd"])

    @cached_property
    def dim_geography(self) -> DataFrame:
        return gold.dim_geography(self.silver_onspd, self.silver_ruc, self.silver_imd)

    @cached_property
    def dim_property(self) -> DataFrame:
        return gold.dim_property(self.silver_ppd)

    @cached_property
    def dim_location(self) -> DataFrame:
        return gold.dim_location(self.silver_ppd)

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.spark)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_sales(self.silver_ppd, self.run_ts)

    @cached_property
    def _mart(self) -> DataFrame:
        return marts.mart_rural_urban(self.fact_sales, self.dim_date, self.dim_geography, self.dim_property, self.memo)

    def mart(self) -> DataFrame:
        return self._mart


def build_star(spark: SparkSession, raw: Mapping[str, DataFrame], run_ts: _dt.datetime | None = None) -> Star:
    """Lazy DataFrames for every model."""
    return Star(spark, raw, run_ts)
