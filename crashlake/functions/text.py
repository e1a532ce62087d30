"""Text rules: null defaults, domains, page keys, CPU cores, bug markers, cell rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = "Unknown"


#: Characters that count as blank at the ends of a text.
BLANKS = " \t\n\r\f\x0b"


def strip(c: Column) -> Column:
    """Text without blanks at its ends."""
    return F.btrim(c, F.lit(BLANKS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def ci(c: Column) -> Column:
    """Key for case-insensitive equality, ordering and grouping."""
    return F.lower(c)


def ci_equals(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def ci_like(c: Column, pattern: str) -> Column:
    return c.ilike(pattern)


def ci_matches(c: Column, regex: str) -> Column:
    return c.rlike("(?i)" + regex)


def ci_replace(c: Column, regex: str, to: str) -> Column:
    return F.regexp_replace(c, "(?i)" + regex, to)


def ci_split(c: Column, regex: str) -> Column:
    return F.split(c, "(?i)" + regex)


def ci_position(needle: str, c: Column) -> Column:
    """1-based position of ``needle`` in ``c`` ignoring case; 0 when absent."""
    return F.instr(F.lower(c), needle.lower())


def extract(c: Column, regex: str, group: int = 1) -> Column:
    """First match of a group, NULL when the pattern does not match."""
    return F.when(c.rlike(regex), F.regexp_extract(c, regex, group))


def nonzero_string(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def initcap1(c: Column) -> Column:
    """Upper-case the first letter only and leave the tail as it is."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 2147483647))


def get_cores(c: Column) -> Column:
    """Core count from a CPU description that ends in ``| N``."""
    return extract(c, r"[|] ([0-9]+)$").try_cast("int")


#: Fixed value: shape of "protocol, slashes, dotted host" at the start of a URL.
DOMAIN_PATTERN = r"^([\w:]+:/+(?:\w+\.)*\w+).*"


def url2domain(c: Column) -> Column:
    return extract(c, DOMAIN_PATTERN)


def url_parts(c: Column) -> Column:
    """Struct(protocol, host, page); NULL unless the URL has ``protocol://host``.

    ``page`` is the URL up to the first of ``? & = ;``.
    """
    page = F.regexp_extract(c, r"^([^?&=;]*)", 1)
    shape = r"^(\w+)://([^/?&=;]+)"
    return F.when(
        page.rlike(shape),
        F.struct(
            F.regexp_extract(page, shape, 1).alias("protocol"),
            F.regexp_extract(page, shape, 2).alias("host"),
            page.alias("page"),
        ),
    )


def signatures_in_bug(c: Column) -> Column:
    """Distinct trimmed texts between ``[@`` and ``]``."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?s)\[@([^\]]*)\]"), F.lit(1))
    return F.array_distinct(F.transform(found, strip))


def one_line(c: Column) -> Column:
    """Cell text: trimmed, carriage returns dropped, newlines shown as `` | ``."""
    return F.replace(F.replace(strip(c), F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(" | "))


def cell(c: Column) -> Column:
    """NULL prints as ``\\N``; everything else as one line."""
    return one_line(F.coalesce(c.cast("string"), F.lit("\\N")))


def useful_email(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")).contains("@"), F.lit("yes")).otherwise(F.lit(""))


def clean_nulls(df: DataFrame) -> DataFrame:
    """Defaults of the cleaning job; columns that are absent are left absent."""
    defaults = {
        "signature": "", "product": "", "version": "", "process_type": "Browser",
        "reason": UNKNOWN, "address": UNKNOWN, "flash_version": UNKNOWN, "os_name": UNKNOWN,
    }
    present = {name: F.coalesce(F.col(name), F.lit(value))
               for name, value in defaults.items() if name in df.columns}
    if "url" in df.columns:
        present["domain"] = F.coalesce(url2domain(F.col("url")), F.lit(""))
    return df.withColumns(present)


#: Columns that identify a person.
PII_COLUMNS = ("url", "email", "user_id")


def scrub(df: DataFrame) -> DataFrame:
    return df.drop(*PII_COLUMNS)


def bowdlerize(df: DataFrame) -> DataFrame:
    """Public form of an extract: same columns, person data masked."""
    return df.withColumns({"url": F.lit("URL (removed)"), "email": F.lit("")})
