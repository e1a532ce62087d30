"""Operating system names and versions, and text-to-canonical pattern maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.functions.text import UNKNOWN, extract
from crashlake.operators.patterns import ilike_join
from crashlake.session import bounded_rows


def strip_linux_version(os_name: Column, os_version: Column) -> Column:
    """Drop a leading ``0.0.0 Linux`` from Linux version texts."""
    odd = os_version.contains("0.0.0") & os_name.ilike("linux%")
    return F.when(odd, F.regexp_replace(os_version, r"^([^\n]*?)[0.]+\s+Linux\s+", "$1")) \
        .otherwise(os_version)


def fix_channel(product: Column, version: Column, channel: Column, old_product: str,
                version_head: str = "2.1", pre_mark: str = "pre") -> Column:
    """Channel of a product that did not send one: ``pre`` versions are beta, others release."""
    hit = product.ilike(old_product) & version.startswith(version_head)
    return (F.when(hit & version.contains(pre_mark), F.lit("beta"))
            .when(hit, F.lit("release")).otherwise(channel))


def ilike_case(c: Column, rules: list[tuple[str, str]]) -> Column:
    """First pattern that fits gives the value; ``rules`` is (value, pattern) pairs."""
    out = None
    for value, pattern in rules:
        hit = c.ilike(pattern)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return F.lit(None).cast("string") if out is None else out


def ilike_map(df: DataFrame, rules: DataFrame, col: str, value: str, out: str,
              pattern: str = "match_string") -> DataFrame:
    """Map a text column to a canonical value by ILIKE patterns.

    A short rule table becomes one CASE expression: no join, no shuffle. A long one is looked
    up through an index of its literals, with the same result.
    Where several patterns fit, the smallest (value, pattern) is taken.
    """
    rows = bounded_rows(rules.select(value, pattern))
    if rows is not None:
        ordered = sorted((r[0], r[1]) for r in rows if None not in (r[0], r[1]))
        return df.withColumn(out, ilike_case(F.col(col), ordered))
    texts = df.select(F.col(col).alias("_fitted")).where("_fitted IS NOT NULL").distinct()
    rule = rules.select(F.col(value).alias("_value"), F.col(pattern).alias("_pattern"))
    mapped = ilike_join(texts, rule, "_fitted", "_pattern").groupBy("_fitted").agg(F.min("_value").alias(out))
    return df.join(mapped, df[col] == mapped["_fitted"], "left").drop("_fitted")


def os_version_parts(c: Column) -> Column:
    """Struct(major, minor); numbers of 1000 and above, or none at all, count as 0.

    A version whose minor part is unusable keeps its major part.
    """
    major = extract(c, r"^([0-9]+)").try_cast("bigint")
    minor = extract(c, r"^[0-9]+\.([0-9]+)").try_cast("bigint")
    ok = F.coalesce(major < 1000, F.lit(False))
    zero = F.lit(0)
    return F.struct(
        F.when(ok, major).otherwise(zero).cast("int").alias("major"),
        F.when(ok & F.coalesce(minor < 1000, F.lit(False)), minor).otherwise(zero)
        .cast("int").alias("minor"))


def os_version_string(os_name: Column, major: Column, minor: Column,
                      windows_versions: list[tuple[str, int, int]]) -> Column:
    """Readable version; Windows by table, Mac within 10–11 / 0–20, others by name."""
    windows = None
    for name, wmajor, wminor in windows_versions:
        hit = (major == wmajor) & (minor == wminor)
        windows = F.when(hit, F.lit(name)) if windows is None else windows.when(hit, F.lit(name))
    windows = F.lit("Windows Unknown") if windows is None \
        else windows.otherwise(F.lit("Windows Unknown"))
    mac = F.when(major.between(10, 11) & minor.between(0, 20),
                 F.concat(F.lit("OS X "), major.cast("string"), F.lit("."), minor.cast("string"))) \
        .otherwise(F.lit("OS X Unknown"))
    label = (F.when(F.lower(os_name) == "windows", windows)
             .when(F.lower(os_name) == "mac os x", mac).otherwise(os_name))
    return F.when(os_name.isNotNull() & major.isNotNull() & minor.isNotNull(), label)


# Legal Linux version lines, with and without an architecture.
_LINUX_LINE = r"^(?:0\.0\.0 [lL]inux.+[lL]inux$|[0-9.]+.+(i586|i686|sun4u|i86pc|x86_64)?)"
_LINUX_FULL = r"(0\.0\.0 [lL]inux.)([0-9.]+[0-9]).*(i586|i686|sun4u|i86pc|x86_64).*"
_LINUX_SHORT = r"(0\.0\.0 [lL]inux.)([0-9.]+[0-9]).*"


def linux_version(os_name: Column, version: Column) -> Column:
    """Linux version number and architecture; ``?arch?`` if there is none, '' if illegible."""
    full = F.regexp_replace(version, _LINUX_FULL, "$2 $3")
    short = F.regexp_replace(version, _LINUX_SHORT, "$2")
    tidy = (F.when(~version.rlike(_LINUX_LINE), F.lit(""))
            .when(full != version, full)
            .when(short != version, F.concat(short, F.lit(" ?arch?")))
            .otherwise(F.lit("")))
    return F.when(os_name == "Linux", tidy).otherwise(version)


def default_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN))
