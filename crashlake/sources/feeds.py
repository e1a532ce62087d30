"""Feeds from outside: users, releases, bugs, modules, lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crashlake import schemas as S


def load_raw_adu(spark: SparkSession, path: str) -> DataFrame:
    """Daily users per product, OS, version, build and channel."""
    df = spark.read.schema(S.RAW_ADU).csv(path, header=True)
    return df.withColumn("adu_date", F.to_date("date")).drop("date")


def load_bugs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.BUGS).csv(path, header=True, multiLine=True, escape='"')


def load_modules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.MODULES).csv(path, header=True)


def interval_seconds(c: Column) -> Column:
    """``HH:MM:SS`` or ``N year`` as seconds."""
    p = F.split(c, ":")
    clock = p[0].try_cast("int") * 3600 + F.get(p, 1).try_cast("int") * 60 + F.get(p, 2).try_cast("int")
    years = F.regexp_extract(c, r"^([0-9]+) years?$", 1).try_cast("int") * 31557600
    return F.when(c.contains(":"), clock).otherwise(years)


def load_lookup(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One table of the bulk load, with its fixed schema."""
    if name not in S.LOOKUPS:
        raise ValueError(f"no lookup table {name!r}")
    df = spark.read.schema(S.LOOKUPS[name]).csv(path, header=True, multiLine=True, escape='"')
    if name == "uptime_levels":
        df = df.withColumns({c: interval_seconds(F.col(c)) for c in ("min_uptime", "max_uptime")})
    if name == "raw_adu":
        df = df.withColumn("adu_date", F.to_date("date")).drop("date")
    return df


def parse_info_files(files: DataFrame, repositories: tuple[str, str] = ("release", "beta"),
                     path: str = "path", text: str = "value") -> DataFrame:
    """Build info files -> release rows.

    Release builds lie under ``<product>/<folder>/<version>-candidates/<build>/`` as
    ``<platform>_info.txt`` with ``key=value`` lines; the last build folder in text order
    counts. A version ``NbM`` is beta M of N. Nightlies lie under
    ``<product>/nightly/yyyy/mm/<stamp>-<branch>/`` as ``<name>-<version>.<locale>.<platform>.txt``
    with the build id in the first line; versions ending in ``a2`` are auroras.
    """
    p = F.col(path)
    release = r"([^/]+)/[^/]+/([^/]+)-candidates/(build[^/]*)/([^/]+)_info\.txt$"
    nightly = r"([^/]+)/nightly/[0-9]{4}/[0-9]{2}/([^/]+)/([^/]+)\.(?:en-US|multi)\.([^/]+)\.txt$"

    def part(regex: str, i: int) -> Column:
        return F.regexp_extract(p, regex, i)
    build_id = F.regexp_extract(F.col(text), r"(?m)^buildID=([0-9]+)\s*$", 1)
    rel = files.where(p.rlike(release)).select(
        part(release, 1).alias("product_name"), part(release, 2).alias("_v"),
        part(release, 3).alias("_build"), part(release, 4).alias("platform"),
        build_id.try_cast("bigint").alias("build_id"))
    newest = rel.groupBy("product_name", "_v").agg(F.max("_build").alias("_build"))
    rel = rel.join(newest, ["product_name", "_v", "_build"], "left_semi")
    beta = F.col("_v").contains("b")
    rel = rel.select(
        "product_name", F.split("_v", "b")[0].alias("version"), "platform", "build_id",
        F.when(beta, F.lit("Beta")).otherwise(F.lit("Release")).alias("build_type"),
        F.when(beta, F.split("_v", "b")[1].try_cast("int")).alias("beta_number"),
        F.when(beta, F.lit(repositories[1])).otherwise(F.lit(repositories[0])).alias("repository"))
    fields = F.split(part(nightly, 2), "-")
    branch = F.array_join(F.filter(fields, lambda f: ~f.rlike("^[0-9]+$")), "-")
    version = F.element_at(F.split(part(nightly, 3), "-"), -1)
    ngt = files.where(p.rlike(nightly)).select(
        part(nightly, 1).alias("product_name"), version.alias("_v"),
        part(nightly, 4).alias("platform"),
        F.trim(F.split(F.col(text), r"\r?\n")[0]).try_cast("bigint").alias("build_id"),
        branch.alias("repository"))
    ngt = ngt.select(
        "product_name", F.split("_v", "b")[0].alias("version"), "platform", "build_id",
        F.when(F.col("_v").endswith("a2"), F.lit("Aurora")).otherwise(F.lit("Nightly"))
        .alias("build_type"), F.lit(None).cast("int").alias("beta_number"), "repository")
    return rel.unionByName(ngt)


def load_releases(spark: SparkSession, path: str,
                  repositories: tuple[str, str] = ("release", "beta")) -> DataFrame:
    """All build info files below a folder; one row per file, whole files per row."""
    files = (spark.read.text(path, wholetext=True, pathGlobFilter="*.txt",
                             recursiveFileLookup=True)
             .select("value", F.col("_metadata.file_path").alias("path")))
    return parse_info_files(files, repositories)
