"""Bug feed: bugs and their signature associations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crashlake.functions.text import signatures_in_bug


def bug_signatures(feed: DataFrame) -> DataFrame:
    """(bug_id, signature) pairs named in the feed."""
    return feed.select("bug_id", F.explode(signatures_in_bug(F.col("cf_crash_signature")))
                       .alias("signature")).distinct()


def association_changes(feed: DataFrame, associations: DataFrame, reports: DataFrame) -> DataFrame:
    """Pairs to ``add`` (only with a report of that signature) and to ``remove``.

    Only bugs in the feed lose pairs.
    """
    named = bug_signatures(feed)
    keys = ["bug_id", "signature"]
    in_feed = associations.select(*keys).join(feed.select("bug_id").distinct(), "bug_id", "left_semi")
    gone = in_feed.join(named, keys, "left_anti").withColumn("change", F.lit("remove"))
    new = named.join(associations.select(*keys), keys, "left_anti") \
        .join(reports.select("signature").distinct(), "signature", "left_semi") \
        .withColumn("change", F.lit("add")).select(*keys, "change")
    return gone.unionByName(new)


def update_bug_associations(feed: DataFrame, bugs: DataFrame, associations: DataFrame,
                            reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bugs and associations after the feed.

    A bug without signatures is dropped with its associations. A new bug is kept only when
    it brings an association.
    """
    named = bug_signatures(feed)
    useful = named.select("bug_id").distinct()
    keys = ["bug_id", "signature"]
    changes = association_changes(feed, associations, reports)
    kept = associations.select(*keys).join(
        changes.where("change = 'remove'").select(*keys), keys, "left_anti")
    after = kept.unionByName(changes.where("change = 'add'").select(*keys))
    cols = ["bug_id", "status", "resolution", "short_desc"]
    fresh = feed.join(useful, "bug_id", "left_semi").select(
        "bug_id", F.col("bug_status").alias("status"), "resolution", "short_desc")
    known = fresh.join(bugs.select("bug_id"), "bug_id", "left_semi")
    brought = fresh.join(bugs.select("bug_id"), "bug_id", "left_anti") \
        .join(changes.where("change = 'add'").select("bug_id").distinct(), "bug_id", "left_semi")
    others = bugs.join(feed.select("bug_id"), "bug_id", "left_anti").select(*cols)
    return others.unionByName(known).unionByName(brought), after


def bugs_for_signatures(associations: DataFrame, signatures: list[str]) -> DataFrame:
    return associations.where(F.col("signature").isin(signatures)).select(
        F.col("bug_id").alias("id"), "signature")
