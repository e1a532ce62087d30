"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from crashlake.operators import adu, graphs, hangs, topcrash, users
from crashlake.operators.clean import Cleaned, Dims, build_reports_clean
from crashlake.plans.event_views import Tables, sql
from crashlake.session import configure

#: Newest day of the event table's period, and the first one with a full past.
TODAY = "2024-02-01"


class Context:
    """Input frames of one folder, and the marts built from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.tables = Tables(configure(spark), folder)

    def t(self, name: str) -> DataFrame:
        return self.tables.view(name)

    @cached_property
    def dims(self) -> Dims:
        return Dims(self.t("product_versions"), self.t("product_version_builds"),
                    self.tables.small("channel_matches"), self.tables.small("os_matches"),
                    self.tables.small("windows_versions"))

    @cached_property
    def cleaned(self) -> Cleaned:
        return build_reports_clean(self.t("reports"), self.dims)

    @property
    def clean(self) -> DataFrame:
        return self.cleaned.clean

    @cached_property
    def pv(self) -> DataFrame:
        return self.t("product_versions")

    @cached_property
    def product_adu(self) -> DataFrame:
        return adu.product_adu(self.t("raw_adu"), self.pv, self.t("product_version_builds"),
                               self.t("guid_map"), self.tables.small("os_matches"))

    @cached_property
    def build_adu(self) -> DataFrame:
        return adu.build_adu(self.t("raw_adu"), self.pv, self.t("product_version_builds"),
                             self.t("guid_map"), self.tables.small("os_matches"))

    @cached_property
    def tcbs(self) -> DataFrame:
        return topcrash.tcbs(self.clean, self.pv)

    @cached_property
    def cbu(self) -> DataFrame:
        return users.crashes_by_user(self.clean, self.pv, self.t("crash_types"),
                                     self.t("os_names"), self.product_adu)

    @cached_property
    def cbub(self) -> DataFrame:
        return users.crashes_by_user_build(
            self.clean, self.pv, self.t("crash_types"), self.t("os_names"),
            self.t("product_version_builds"), self.build_adu)

    @cached_property
    def graph(self) -> DataFrame:
        return graphs.home_page_graph(self.clean, self.pv, self.t("crash_types"),
                                      self.t("channels"), self.product_adu)

    @cached_property
    def graph_build(self) -> DataFrame:
        return graphs.home_page_graph_build(self.clean, self.pv, self.t("crash_types"),
                                            self.t("channels"), self.build_adu)

    @cached_property
    def nightly(self) -> DataFrame:
        return graphs.nightly_builds(self.clean, self.pv, self.t("product_version_builds"))

    @cached_property
    def hang_rows(self) -> DataFrame:
        return hangs.daily_hangs(self.clean, self.cleaned.user_info)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, text: tuple[str, ...] = ()):
    """Register a query. Columns named in ``text`` are compared as text (dates, times)."""
    def register(fn: Callable[[Context], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(Context(spark, folder))
            return df.withColumns({c: F.col(c).cast("string") for c in text}) if text else df
        QUERIES[name] = run
        if oracle is not None:
            body = oracle
            if text:
                casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text)
                body = f"SELECT * REPLACE ({casts}) FROM (\n{oracle.strip()}\n) AS q"
            ORACLES[name] = sql(body)
        return fn
    return register


def load() -> None:
    """Import the modules that register queries."""
    from crashlake.plans import (checks_fields, checks_jobs, checks_marts, checks_reads,  # noqa: F401
                                 checks_sources, checks_sql, checks_streams, checks_text)
