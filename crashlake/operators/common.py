"""Shared pieces: ranks and shares without one-task windows, beta parents, live versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from crashlake.session import rule_rows


def _levels(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Distinct counts of each group, with the number of rows that have them."""
    return df.groupBy(*keys, measure).agg(F.count(F.lit(1)).alias("_n"))


def dense_rank_by(df: DataFrame, keys: list[str], measure: str, rank: str,
                  total: str) -> DataFrame:
    """Dense rank by a falling count within ``keys``, and the sum of the counts.

    The windows run over the distinct counts, of which a group of N reports has at most
    about sqrt(2 N); the rows get rank and sum by an equality join, so that a group holding
    most of the rows is never sorted in one task.
    """
    group = Window.partitionBy(*keys)
    levels = _levels(df, keys, measure).withColumns({
        rank: F.dense_rank().over(group.orderBy(F.desc(measure))),
        total: F.sum(F.col(measure) * F.col("_n")).over(group)}).drop("_n")
    return df.join(levels, [*keys, measure])


def rank_by(df: DataFrame, keys: list[str], measure: str, rank: str, total: str) -> DataFrame:
    """Zero-based rank by a falling count within ``keys``, ties sharing the best place, and
    the sum of the counts (same method)."""
    group = Window.partitionBy(*keys)
    above = group.orderBy(F.desc(measure)).rowsBetween(Window.unboundedPreceding, -1)
    levels = _levels(df, keys, measure).withColumns({
        rank: F.coalesce(F.sum("_n").over(above), F.lit(0)),
        total: F.sum(F.col(measure) * F.col("_n")).over(group)}).drop("_n")
    return df.join(levels, [*keys, measure])


def with_total(df: DataFrame, keys: list[str], measure: str, name: str) -> DataFrame:
    """Sum of a measure over ``keys`` beside every row; pre-aggregated, then joined."""
    return df.join(df.groupBy(*keys).agg(F.sum(measure).alias(name)), keys)


def grand_total(df: DataFrame, measure: str) -> Column:
    """Sum over the whole frame as a scalar subquery."""
    return df.agg(F.sum(measure)).scalar()


def report_day(df: DataFrame, ts: str = "date_processed") -> DataFrame:
    return df.withColumn("report_date", F.to_date(ts))


def live_on(day: Column) -> Column:
    """Is the version between its build date and its sunset on that day?"""
    return day.between(F.col("build_date"), F.col("sunset_date"))


def to_parents(df: DataFrame, include_self: bool, cond: Column | None = None) -> DataFrame:
    """Give rows of rapid betas to their parent version, with or without keeping their own.

    One pass instead of a second scan: every row is exploded to one or two version ids.
    ``df`` carries ``product_version_id`` and ``rapid_beta_id``.
    """
    own, parent = F.col("product_version_id"), F.col("rapid_beta_id")
    has = parent.isNotNull() if cond is None else parent.isNotNull() & cond
    ids = F.array_compact(F.array(own if include_self else F.lit(None), F.when(has, parent)))
    return df.withColumn("product_version_id", F.explode(ids)).drop("rapid_beta_id")


def crash_kind(df: DataFrame, crash_types: DataFrame) -> DataFrame:
    """Crash type of every report, from its process type and whether it has a hang id."""
    kinds = crash_types.withColumn("_pt", F.lower("process_type")).drop("process_type")
    return (df.withColumns({"_pt": F.lower("process_type"),
                            "has_hang_id": F.col("hang_id").isNotNull()})
            .join(kinds, ["_pt", "has_hang_id"]).drop("_pt"))


def with_crash_types(df: DataFrame, crash_types: DataFrame, *cols: str) -> DataFrame:
    """Every row once per crash type, by exploding the short type list as a literal."""
    rows = rule_rows(crash_types.select(*cols))
    kinds = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in cols]) for r in rows])
    return df.withColumn("_kind", F.explode(kinds)).select(*df.columns, "_kind.*")


def page(df: DataFrame, order: list, size: int, number: int = 1) -> DataFrame:
    """One page of a totally ordered result (numbers start at 1)."""
    if size < 1 or number < 1:
        raise ValueError("page size and number start at 1")
    return df.orderBy(*order).offset(size * (number - 1)).limit(size)


def page_count(df: DataFrame, size: int) -> DataFrame:
    """Total rows and whole pages of them."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("total_count"), F.floor(n / F.lit(size)).alias("total_pages"))


def carry_down(df: DataFrame, group: str, order: str, values: dict[str, Column],
               chunk: int = 100_000) -> DataFrame:
    """Last non-NULL value so far, for each of ``values``, in the order of a line number.

    Long groups are cut into chunks by line number: a window inside each chunk, one over the
    last values of the chunks, and a join of the two. No task sees more than one chunk.
    """
    df = df.withColumns({f"_v_{n}": c for n, c in values.items()}) \
        .withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))
    inside = Window.partitionBy(group, "_chunk").orderBy(order)
    before = Window.partitionBy(group).orderBy("_chunk") \
        .rowsBetween(Window.unboundedPreceding, -1)
    ends = df.groupBy(group, "_chunk").agg(*[
        F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(order))).alias(f"_e_{n}")
        for n in values])
    ends = ends.select(group, "_chunk", *[
        F.last(f"_e_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in values])
    df = df.withColumns({n: F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in values})
    df = df.join(ends, [group, "_chunk"])
    df = df.withColumns({n: F.coalesce(n, f"_c_{n}") for n in values})
    return df.drop("_chunk", *[f"_v_{n}" for n in values], *[f"_c_{n}" for n in values])
