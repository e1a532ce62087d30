"""Signature list, first appearance per version, and versions per product."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crashlake.functions import versions as V


def signature_versions(reports: DataFrame, product_versions: DataFrame, builds: DataFrame,
                       start=None, end=None) -> DataFrame:
    """(signature, build, product_version_id, first_report) of the reports of the days.

    The version is matched by build id first; releases, nightlies and auroras that have any
    build are matched without it. The end is the midnight after the last day, included.
    """
    r = reports
    if start is not None:
        r = r.where((F.col("date_processed") >= F.lit(start).cast("date").cast("timestamp"))
                    & (F.col("date_processed") <= F.date_add(F.lit(end).cast("date"), 1)
                       .cast("timestamp")))
    new = (r.groupBy(F.coalesce("signature", F.lit("")).alias("signature"),
                     F.lower("product").alias("_product"), F.lower("version").alias("_version"),
                     "build")
           .agg(F.min("date_processed").alias("first_report")))
    pv = product_versions.select(
        "product_version_id", F.lower("product_name").alias("_product"),
        F.lower("release_version").alias("_version"), F.lower("build_type").alias("_type"))
    b = builds.select("product_version_id", F.col("build_id").cast("string").alias("build")).distinct()
    with_build = pv.join(b, "product_version_id")
    keys = ["_product", "_version"]
    exact = with_build.groupBy(*keys, "build").agg(F.min("product_version_id").alias("_exact"))
    loose = (with_build.where(F.col("_type").isin("release", "nightly", "aurora"))
             .groupBy(*keys).agg(F.min("product_version_id").alias("_loose")))
    return (new.join(exact, [*keys, "build"], "left").join(loose, keys, "left")
            .select("signature", "build", "first_report",
                    F.coalesce("_exact", "_loose").alias("product_version_id")))


def update_signatures(reports: DataFrame, product_versions: DataFrame, builds: DataFrame,
                      signatures: DataFrame | None = None,
                      signature_products: DataFrame | None = None, start=None, end=None
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New signatures, new (signature, version) pairs, and the roll-up of all pairs."""
    found = signature_versions(reports, product_versions, builds, start, end) \
        .where(F.col("product_version_id").isNotNull())
    pairs = found.groupBy("signature", "product_version_id").agg(
        F.min("first_report").alias("first_report"),
        F.min(V.build_numeric(F.col("build"))).alias("first_build"))
    new_sigs = pairs.groupBy("signature").agg(F.min("first_report").alias("first_report"),
                                              F.min("first_build").alias("first_build"))
    if signatures is not None:
        new_sigs = new_sigs.join(signatures.select("signature"), "signature", "left_anti")
    new_pairs = pairs.drop("first_build")
    keys = ["signature", "product_version_id"]
    if signature_products is not None:
        new_pairs = new_pairs.join(signature_products.select(*keys), keys, "left_anti")
    stored = new_pairs if signature_products is None else \
        new_pairs.unionByName(signature_products.select(*keys, "first_report"))
    return new_sigs, new_pairs, signature_rollup(stored, product_versions)


def signature_rollup(signature_products: DataFrame, product_versions: DataFrame) -> DataFrame:
    """Versions per signature and product, in version order (a product has few versions)."""
    pv = product_versions.select("product_version_id", "product_name", "version_string",
                                 "version_sort")
    ordered = F.array_sort(F.collect_list(F.struct("version_sort", "version_string")))
    return (signature_products.join(pv, "product_version_id")
            .groupBy("signature", "product_name")
            .agg(F.count(F.lit(1)).alias("ver_count"),
                 F.transform(ordered, lambda s: s["version_string"]).alias("version_list")))


def signature_bugs(signatures: DataFrame, associations: DataFrame) -> DataFrame:
    """Bugs per signature."""
    bugs = associations.groupBy("signature").agg(
        F.count(F.lit(1)).alias("bug_count"),
        F.array_sort(F.collect_list("bug_id")).alias("bug_list"))
    return signatures.select("signature").distinct().join(bugs, "signature")
