"""Session settings, and the two places where the size of a side is checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Rule and level tables up to this many rows become plain expressions.
MAX_RULE_ROWS = 500


def configure(spark: SparkSession) -> SparkSession:
    """Settings every job relies on: UTC days, runtime re-planning, skew splitting."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a part of the warehouse, which is shared too, where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize a frame that feeds several outputs, surviving executor loss."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def bounded_rows(df: DataFrame, limit: int = MAX_RULE_ROWS) -> list | None:
    """The rows of a rule table, or None when there are more than ``limit``.

    Never fetches more than ``limit + 1`` rows, so the check itself is bounded.
    """
    rows = df.take(limit + 1)
    return None if len(rows) > limit else rows


def rule_rows(df: DataFrame, limit: int = MAX_RULE_ROWS) -> list:
    """The rows of a table that must be short; an error when it is not."""
    rows = bounded_rows(df, limit)
    if rows is None:
        raise ValueError(f"a rule table has more than {limit} rows")
    return rows
