"""Dimensions: lookup growth, OS versions, product versions and their builds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from crashlake.functions import versions as V
from crashlake.functions.platforms import ilike_map, os_version_parts, os_version_string
from crashlake.functions.text import nonzero_string
from crashlake.session import cut_lineage, rule_rows


def lookup_id(c: Column, exact: bool = False) -> Column:
    """Surrogate id of a dimension text: a function of the text, so facts need no join."""
    return F.xxhash64(c if exact else F.lower(c))


def version_id(product: Column, version: Column, beta: Column) -> Column:
    return F.xxhash64(F.lower(product), F.lower(version), F.coalesce(beta.cast("int"), F.lit(-1)))


def grow_lookup(new: DataFrame, lookup: DataFrame | None, col: str, ts: str = "date_processed",
                exact: bool = False, seen: str = "first_seen") -> DataFrame:
    """Values not yet in the lookup, with the first time they were seen.

    Values that differ in case only are one value; the smallest spelling is kept.
    """
    key = F.col(col) if exact else F.lower(F.col(col))
    found = (new.where(F.col(col).isNotNull()).groupBy(key.alias("_key"))
             .agg(F.min(col).alias(col), F.min(ts).alias(seen)))
    if lookup is not None:
        known = lookup.select((F.col(col) if exact else F.lower(F.col(col))).alias("_key"))
        found = found.join(known, "_key", "left_anti")
    return found.select(lookup_id(F.col(col), exact).alias(f"{col}_id"), col, seen)


def windows_rows(windows_versions: DataFrame) -> list[tuple[str, int, int]]:
    rows = windows_versions.select("windows_version_name", "major_version", "minor_version")
    return [(r[0], r[1], r[2]) for r in rule_rows(rows)]


def grow_os_versions(new: DataFrame, matches: DataFrame, windows_versions: DataFrame,
                     os_versions: DataFrame | None = None) -> DataFrame:
    """OS versions not yet known. Rows whose OS name fits no pattern give none."""
    pairs = new.select("os_name", "os_version").distinct() \
        .withColumnRenamed("os_name", "_raw")
    parts = os_version_parts(F.col("os_version"))
    found = (ilike_map(pairs, matches, "_raw", "os_name", "os_name")
             .where(F.col("os_name").isNotNull())
             .select("os_name", parts.alias("_p"))
             .select("os_name", F.col("_p.major").alias("major_version"),
                     F.col("_p.minor").alias("minor_version")).distinct())
    keys = ["os_name", "major_version", "minor_version"]
    if os_versions is not None:
        found = found.join(os_versions.select(*keys), keys, "left_anti")
    text = os_version_string(F.col("os_name"), F.col("major_version"), F.col("minor_version"),
                             windows_rows(windows_versions))
    return found.select(F.xxhash64(*keys).alias("os_version_id"), *keys,
                        text.alias("os_version_string"))


VERSION_COLUMNS = (
    "product_version_id", "product_name", "major_version", "release_version", "version_string",
    "beta_number", "version_sort", "build_date", "sunset_date", "build_type", "is_rapid_beta",
    "rapid_beta_id", "has_builds")


def recent_releases(releases: DataFrame, products: DataFrame, repos: DataFrame,
                    specials: DataFrame, today, window: int = 30,
                    copies: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Releases of the last days that fit their channel, under their product names.

    ``specials`` renames products on given platforms; ``copies`` lists (from, to) products:
    the second gets a copy of the first one's releases from its own first version on.
    """
    p = products.select(
        "product_name", F.lower("release_name").alias("_release"), "rapid_release_version",
        "rapid_beta_version")
    s = specials.select(
        F.col("product_name").alias("_special"), F.lower("release_name").alias("_release"),
        F.lower("platform").alias("_platform"), F.lower("repository").alias("_repo"),
        F.lower("release_channel").alias("_channel"), F.col("min_version").alias("_min"))
    r = releases.where(
        (V.build_date(F.col("build_id")) > F.date_sub(F.lit(today).cast("date"), window))
        & V.version_matches_channel(F.col("version"), F.col("build_type")))
    r = (r.withColumn("_release", F.lower("product_name")).drop("product_name")
         .withColumns({"_platform": F.lower("platform"), "_repo": F.lower("repository"),
                       "_channel": F.lower("build_type")}))
    r = r.join(repos.select(F.lower("repository").alias("_repo")).distinct(), "_repo", "left_semi")
    mvs = V.major_version_sort
    r = r.join(p, "_release").join(s, ["_release", "_platform", "_repo", "_channel"], "left")
    special = F.when(mvs(F.col("version")) >= mvs(F.col("_min")), F.col("_special"))
    r = r.select(
        F.coalesce(special, F.col("product_name")).alias("product_name"), "version",
        "beta_number", "build_id",
        F.when((F.col("_channel") == "release") & F.lower("version").endswith("esr"), F.lit("ESR"))
        .otherwise(F.col("build_type")).alias("build_type"), "platform",
        (mvs(F.col("version")) >= mvs(F.col("rapid_release_version"))).alias("is_rapid"),
        V.is_rapid_beta(F.col("build_type"), F.col("version"), F.col("rapid_beta_version"))
        .alias("is_rapid_beta"), "repository").distinct()
    for source, target in copies:
        first = products.where(F.lower("product_name") == target.lower()) \
            .select(F.lit(source.lower()).alias("_from"),
                    F.col("product_name").alias("_to"), F.col("rapid_release_version").alias("_min"))
        twin = (r.withColumn("_from", F.lower("product_name")).join(first, "_from")
                .where(mvs(F.col("version")) >= mvs(F.col("_min")))
                .withColumn("product_name", F.col("_to")).drop("_from", "_to", "_min"))
        r = r.unionByName(twin)
    return r


def update_product_versions(releases: DataFrame, products: DataFrame, repos: DataFrame,
                            specials: DataFrame, existing: DataFrame | None,
                            existing_builds: DataFrame | None, today, window: int = 30,
                            copies: tuple[tuple[str, str], ...] = ()) -> tuple[DataFrame, DataFrame]:
    """New versions and new builds: plain versions, rapid-beta parents, and their children.

    A parent has beta number 0, no builds, and the sunset of its first beta; children carry
    its id. Running twice on the same releases adds nothing.
    """
    # a few weeks of releases feed both outputs and three kinds of versions: kept once
    recent = cut_lineage(
        recent_releases(releases, products, repos, specials, today, window, copies))
    rapid = recent.where(F.col("is_rapid"))
    first = F.min("build_id").alias("_first")
    product, version, beta = F.col("product_name"), F.col("version"), F.col("beta_number")

    def rows(df: DataFrame, *, text: Column, kind: Column, sunset: Column, is_parent: bool,
             parent: Column, has_builds: Column) -> DataFrame:
        return df.select(
            version_id(product, version, beta).alias("product_version_id"), "product_name",
            V.to_major_version(version).alias("major_version"),
            version.alias("release_version"), text.alias("version_string"), "beta_number",
            V.version_sort(version, F.coalesce(beta, F.lit(0))).alias("version_sort"),
            V.build_date(F.col("_first")).alias("build_date"), sunset.alias("sunset_date"),
            kind.alias("build_type"), F.lit(is_parent).alias("is_rapid_beta"),
            parent.cast("bigint").alias("rapid_beta_id"), has_builds.alias("has_builds"))

    plain = (rapid.where(~F.col("is_rapid_beta"))
             .groupBy("product_name", "version", "beta_number", "build_type").agg(first))
    plain = rows(
        plain, text=F.when(F.coalesce(beta, F.lit(0)) != 0, V.version_string(version, beta))
        .otherwise(version), kind=F.col("build_type"),
        sunset=V.sunset_date(F.col("_first"), F.col("build_type")), is_parent=False,
        parent=F.lit(None), has_builds=F.lower("build_type").isin("aurora", "nightly"))
    # betas are kept under the product's own name, found by its release name
    names = products.select(F.lower("release_name").alias("_release"),
                            F.col("product_name").alias("_name"))
    betas = (rapid.where(F.col("is_rapid_beta")).withColumn("_release", F.lower("product_name"))
             .join(names, "_release").withColumn("product_name", F.col("_name")))
    parents = (betas.groupBy("product_name", "version").agg(first)
               .withColumn("beta_number", F.lit(0)))
    parents = rows(parents, text=F.concat(version, F.lit("b")), kind=F.lit("beta"),
                   sunset=V.sunset_date(F.col("_first"), F.lit("beta")), is_parent=True,
                   parent=F.lit(None), has_builds=F.lit(True))
    known = existing.select(*VERSION_COLUMNS) if existing is not None else None
    if known is not None:
        parents = parents.join(known.select("product_version_id"), "product_version_id", "left_anti")
    all_parents = parents if known is None else \
        parents.unionByName(known.where(F.col("is_rapid_beta")))
    heads = all_parents.select(
        F.lower("product_name").alias("_p"), F.lower("release_version").alias("_v"),
        F.col("product_version_id").alias("_parent"), F.col("sunset_date").alias("_sunset"))
    children = (betas.groupBy("product_name", "version", "beta_number").agg(first)
                .withColumns({"_p": F.lower("product_name"), "_v": F.lower("version")})
                .join(heads, ["_p", "_v"]))
    children = rows(children, text=V.version_string(version, beta), kind=F.lit("beta"),
                    sunset=F.col("_sunset"), is_parent=False, parent=F.col("_parent"),
                    has_builds=F.lit(False))
    fresh = plain.unionByName(children)
    if known is not None:
        fresh = fresh.join(known.select("product_version_id"), "product_version_id", "left_anti")
    fresh = fresh.unionByName(parents)
    everything = fresh if known is None else fresh.unionByName(known)
    target = everything.select(
        "product_version_id", F.lower("product_name").alias("_p"),
        F.lower("release_version").alias("_v"), F.lower("build_type").alias("_t"),
        F.col("beta_number").alias("_b"))
    src = recent.withColumns({"_p": F.lower("product_name"), "_v": F.lower("version"),
                              "_t": F.lower("build_type")})
    builds = (src.join(target, (src["_p"] == target["_p"]) & (src["_v"] == target["_v"])
                       & (src["_t"] == target["_t"])
                       & src["beta_number"].eqNullSafe(target["_b"]))
              .select("product_version_id", "build_id", "platform", "repository").distinct())
    if existing_builds is not None:
        keys = ["product_version_id", "build_id", "platform"]
        builds = builds.join(existing_builds.select(*keys), keys, "left_anti")
    return fresh, builds


def valid_releases(new: DataFrame, products: DataFrame, channels: DataFrame, today) -> DataFrame:
    """Releases that may be appended, under their release names.

    All of product, version, channel, platform and build id are needed; the product (by
    name or release name) and the channel must be known; the build day lies between 2005
    and a month from now.
    """
    names = products.select(F.lower("release_name").alias("_key"), F.col("release_name").alias("_rel"),
                            F.lit(0).alias("_rank")) \
        .unionByName(products.select(F.lower("product_name").alias("_key"),
                                     F.col("release_name").alias("_rel"), F.lit(1).alias("_rank")))
    names = names.groupBy("_key").agg(F.min_by("_rel", F.struct("_rank", "_rel")).alias("_rel"))
    ok = (nonzero_string(F.col("product_name")) & nonzero_string(F.col("version"))
          & nonzero_string(F.col("build_type")) & nonzero_string(F.col("platform"))
          & V.build_date(F.col("build_id")).between(
              F.lit("2005-01-01").cast("date"), F.add_months(F.lit(today).cast("date"), 1)))
    known = channels.select(F.lower("release_channel").alias("_channel")).distinct()
    return (new.where(ok).withColumns({"_key": F.lower("product_name"),
                                       "_channel": F.lower("build_type")})
            .join(known, "_channel", "left_semi").join(names, "_key")
            .withColumn("product_name", F.col("_rel")).select(*new.columns))


def append_releases(new: DataFrame, existing: DataFrame, products: DataFrame,
                    channels: DataFrame, today) -> DataFrame:
    """Valid releases not yet stored; the same release is never added twice."""
    keys = ["product_name", "version", "build_type", "build_id", "platform", "beta_number"]
    good = valid_releases(new, products, channels, today).dropDuplicates(keys)
    cond = None
    stored = existing.select(*[F.col(k).alias(f"_{k}") for k in keys])
    for k in keys:
        a, b = F.col(k), F.col(f"_{k}")
        same = F.lower(a.cast("string")).eqNullSafe(F.lower(b.cast("string")))
        cond = same if cond is None else cond & same
    return good.join(stored, cond, "left_anti")


def old_release(product: Column, version: Column, kind: Column, start: Column) -> Column:
    """Row of the old-style version list: 18 weeks of life for majors, 9 for the rest."""
    weeks = F.when(kind == "major", 18).otherwise(9)
    return F.struct(product.alias("product"), version.alias("version"), kind.alias("release"),
                    V.old_version_sort(version).alias("version_sort"), start.alias("start_date"),
                    F.date_add(start, weeks * 7).alias("end_date"),
                    F.lit(100).alias("throttle"))


def version_order(product_versions: DataFrame) -> DataFrame:
    """Order number of every version within its product (a short list per product)."""
    w = Window.partitionBy("product_name").orderBy(F.asc_nulls_first("version_sort"),
                                                   "version_string", "product_version_id")
    return product_versions.withColumn("sort_key", F.row_number().over(w))
