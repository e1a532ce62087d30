"""Joins of points to the intervals that hold them, by bins instead of a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bounds are cut to this before bins are formed, so that no difference overflows.
_FAR = 1 << 60


def _whole(df: DataFrame, name: str) -> Column:
    """The greatest whole number that is not above a number, day or time (in microseconds)."""
    kind, c = dict(df.dtypes)[name], F.col(name)
    if kind == "date":
        return F.unix_date(c).cast("bigint")
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp"))
    if kind in ("float", "double"):
        far = F.lit(float(_FAR))
        return F.when(F.isnan(c), F.lit(_FAR)).otherwise(F.floor(F.greatest(F.least(c, far), -far)))
    if kind.startswith("decimal"):
        return F.greatest(F.least(F.floor(c), F.lit(_FAR)), F.lit(-_FAR)).cast("bigint")
    return F.greatest(F.least(c.cast("bigint"), F.lit(_FAR)), F.lit(-_FAR))


def interval_join(points: DataFrame, intervals: DataFrame, at: str, low: str, high: str,
                  keys: tuple[str, ...] = (), closed: bool = False, how: str = "inner") -> DataFrame:
    """Rows of ``points`` beside every interval ``[low, high)`` that holds their ``at``.

    ``closed`` takes the upper bound in as well. With ``keys`` both sides agree on these, too.
    ``how`` is ``inner`` or ``left``; names other than the keys must differ. A NULL bound or
    point holds nothing, and an interval that ends before it starts neither.

    An interval is listed under the one or two bins, of a width of the power of two just above
    its length, that it touches; a point looks once for every width in use, of which there are
    at most 62. Bins and keys are joined on equality and the bounds are compared in that join, so
    the rows are those of a plain range join at any size, each once. Only points and intervals
    are moved: the pairs, of which there may be as many as points times intervals, come out of
    the last join. Neither side is broadcast, since points grow with the widths. Points without
    an interval are found by their distinct values.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    right = intervals.where(F.col(low).isNotNull() & F.col(high).isNotNull() & (
        F.col(low) <= F.col(high) if closed else F.col(low) < F.col(high)))
    a, b = _whole(right, low), _whole(right, high)
    right = right.withColumns({"_a": a, "_b": b}) \
        .withColumn("_level", F.when(F.col("_b") == F.col("_a"), F.lit(0))
                    .otherwise(F.length(F.bin(F.col("_b") - F.col("_a"))))) \
        .withColumn("_bin", F.explode(F.sequence(F.expr("shiftright(_a, _level)"), F.expr("shiftright(_b, _level)")))) \
        .drop("_a", "_b")
    levels = sorted(r[0] for r in right.select("_level").distinct().collect())
    widths = F.array(*[F.lit(n) for n in levels]) if levels else F.array().cast("array<int>")

    def looked(side: DataFrame) -> DataFrame:
        return side.where(F.col(at).isNotNull()).withColumn("_w", _whole(side, at)).withColumn("_level", F.explode(widths)) \
            .withColumn("_bin", F.expr("shiftright(_w, _level)")).drop("_w")
    names = [c for c in intervals.columns if c not in keys]
    found = [*keys, "_level", "_bin"]
    inside = (F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high) if closed else F.col(at) < F.col(high))
    hits = looked(points).join(right.hint("merge"), found).where(inside).select(*points.columns, *names)
    if how == "inner":
        return hits
    seen = looked(points.select(*keys, at).distinct()).alias("p")
    spans = right.select(*found, low, high).alias("i")
    same = [F.col(f"p.{c}") == F.col(f"i.{c}") for c in found]
    held = seen.join(spans, [*same, inside], "left_semi").select(*keys, at).distinct()
    lone = points.join(held, [*keys, at], "left_anti")
    empty = [F.lit(None).cast(intervals.schema[c].dataType).alias(c) for c in names]
    return hits.unionByName(lone.select(*points.columns, *empty))
