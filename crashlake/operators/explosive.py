"""Explosiveness: how far a signature's crash rate is above its recent past."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from crashlake.functions.times import days_between

SPAN = 10
#: Least rate (crashes per million users) of a listed signature.
MIN_RATE = 10
#: Crashes that the divisor stands for at least.
MIN_DIVISOR = 30


def crash_rates(tcbs: DataFrame, product_adu: DataFrame) -> DataFrame:
    """Crashes per million users by version, signature and day, and the least divisor."""
    adu = (product_adu.where("adu_count > 0").groupBy("product_version_id", "adu_date")
           .agg(F.sum("adu_count").cast("double").alias("_adu")))
    n = tcbs.groupBy("product_version_id", "signature", "report_date") \
        .agg(F.sum("report_count").alias("_n"))
    return (n.join(adu.withColumnRenamed("adu_date", "report_date"),
                   ["product_version_id", "report_date"])
            .select("product_version_id", "signature", "report_date",
                    (F.col("_n") * 1e6 / F.col("_adu")).alias("rate"),
                    (F.lit(MIN_DIVISOR) * 1e6 / F.col("_adu")).alias("divisor")))


def explosiveness(tcbs: DataFrame, product_adu: DataFrame, first_end, last_end=None) -> DataFrame:
    """Scores for every end day of a range, usually one.

    A row counts towards the end days up to nine days after it, so that all end days are one
    aggregate; days without reports are the zeros of the ten day columns.
    """
    last_end = first_end if last_end is None else last_end
    first, last = F.lit(first_end).cast("date"), F.lit(last_end).cast("date")
    days = days_between(F.col("report_date"), F.date_sub(first, SPAN - 1), last)
    rates = crash_rates(tcbs.where(days),
                        product_adu.where(days_between(F.col("adu_date"),
                                                       F.date_sub(first, SPAN - 1), last)))
    ends = F.sequence(F.greatest("report_date", first),
                      F.least(F.date_add("report_date", SPAN - 1), last))
    rows = rates.withColumn("last_date", F.explode(ends)) \
        .withColumn("_ago", F.datediff("last_date", "report_date"))

    def at(i: int, c: str):
        return F.sum(F.when(F.col("_ago") == i, F.col(c)).otherwise(F.lit(0.0)))
    wide = rows.groupBy("last_date", "product_version_id", "signature").agg(
        *[at(i, "rate").alias(f"r{i}") for i in range(SPAN)],
        *[at(i, "divisor").alias(f"m{i}") for i in range(3)])
    r = [F.col(f"r{i}") for i in range(SPAN)]

    def total(cols):
        return reduce(lambda a, b: a + b, cols)
    avg9, max9 = total(r[1:]) / 9, F.greatest(*r[1:])
    avg3, div3 = total(r[:3]) / 3, (F.col("m0") + F.col("m1") + F.col("m2")) / 3
    avg7 = total(r[3:]) / 7
    sdv7 = F.sqrt(total([(x - avg7) * (x - avg7) for x in r[3:]]) / 6)
    oneday = F.when(r[0] > MIN_RATE,
                    F.round((r[0] - avg9) / F.greatest(max9 - avg9, F.col("m0")), 2))
    threeday = F.when(avg3 > MIN_RATE, F.round((avg3 - avg7) / F.greatest(sdv7, div3), 2))
    return wide.select("last_date", "product_version_id", "signature",
                       oneday.alias("oneday"), threeday.alias("threeday"),
                       *[F.round(r[i], 2).alias(f"day{i}") for i in range(SPAN)]) \
        .where(F.col("oneday").isNotNull() | F.col("threeday").isNotNull())
