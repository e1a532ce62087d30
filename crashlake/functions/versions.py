"""Build ids and version texts: dates, sort keys, channel checks, ordered keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crashlake.functions.text import extract


def build_numeric(c: Column) -> Column:
    """14-digit build id as a number; NULL when the text is not all digits."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def build_date(c: Column) -> Column:
    """Day of a build id (text or number); NULL when its head is no date."""
    return F.try_to_date(F.substring(c.cast("string"), 1, 8), "yyyyMMdd")


def sunset_date(build: Column, build_type: Column) -> Column:
    """18 weeks of visibility for releases and ESR, 9 weeks for the rest."""
    weeks = F.when(F.lower(build_type).isin("release", "esr"), 18).otherwise(9)
    return F.date_add(build_date(build), weeks * 7)


def major_version(c: Column) -> Column:
    """``6.0`` of ``6.0a2``; any character may stand between the numbers.

    The result must look like ``N.N``, as the column type of the mart demands.
    """
    head = extract(c, r"^([0-9]+.[0-9]+)")
    return F.when(head.rlike(r"^[0-9]+\.[0-9]+"), head)


def to_major_version(c: Column) -> Column:
    return extract(c, r"^([0-9]+\.[0-9]+)")


def version_sort_digit(c: Column) -> Column:
    """Three-digit text of a number; ``000`` when blank, ``###`` above 999."""
    n = F.when(c != "", c.try_cast("int"))
    padded = F.when(n > 999, F.lit("###")).otherwise(F.lpad(n.cast("string"), 3, "0"))
    return F.coalesce(padded, F.lit("000"))


def major_version_sort(c: Column) -> Column:
    return F.concat(version_sort_digit(extract(c, r"^([0-9]+)")),
                    version_sort_digit(extract(c, r"^[0-9]+\.([0-9]+)")))


# number . number letters digits [. number] [letters digits] rest
_VERSION_SHAPE = (r"^([0-9]+)\.([0-9]+)([a-zA-Z]*)([0-9]*)(?:\.([0-9]+))?"
                  r"(?:([a-zA-Z]+)([0-9]*))?.*$")


def version_sort(version: Column, beta: Column | None = None,
                 channel: Column | None = None) -> Column:
    """Sortable text ``MMMmmmpppXnnn``; X is a, b, r or x for alpha, beta, release, ESR.

    NULL when the version has no ``N.N`` head.
    """
    beta = F.lit(0) if beta is None else beta
    channel = F.lit("") if channel is None else F.lower(F.coalesce(channel, F.lit("")))

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(version, _VERSION_SHAPE, i), F.lit(""))

    letter, digit = F.coalesce(part(3), part(6)), F.coalesce(part(4), part(7))
    has_beta = F.coalesce(beta > 0, F.lit(False))
    final_beta = version.contains("(beta)")
    letter = F.when(has_beta | final_beta, F.lit("b")).otherwise(letter)
    digit = F.when(final_beta, F.lit("99")).when(has_beta, beta.cast("string")).otherwise(digit)
    by_channel = {"nightly": ("a", "1"), "aurora": ("a", "2"), "release": ("r", "0"),
                  "esr": ("x", "0")}
    kind, number = F.when(channel == "beta", F.lit("b")), \
        F.when(channel == "beta", F.coalesce(digit, F.lit("99")))
    for name, (k, n) in by_channel.items():
        kind, number = kind.when(channel == name, F.lit(k)), number.when(channel == name, F.lit(n))
    kind, number = kind.otherwise(letter), number.otherwise(digit)
    kind = F.when(kind == "esr", F.lit("x")).otherwise(F.coalesce(kind, F.lit("r")))
    key = F.concat(version_sort_digit(part(1)), version_sort_digit(part(2)),
                   version_sort_digit(part(5)), kind, version_sort_digit(number))
    return F.when(version.rlike(_VERSION_SHAPE), key)


_OLD_SHAPE = r"^([0-9]+)[^0-9]*\.([0-9]+)([a-z]?)[^.]*(?:\.([0-9]+))?([a-z]?).*$"


def old_version_sort(c: Column) -> Column:
    """Sort key of the pre-rapid-release versions: betas ``b``, finals ``z``."""
    def part(i: int) -> Column:
        return F.regexp_extract(c, _OLD_SHAPE, i)

    kind = F.when((part(3) != "") | (part(5) != ""), F.lit("b")).otherwise(F.lit("z"))
    key = F.concat(version_sort_digit(part(1)), version_sort_digit(part(2)),
                   version_sort_digit(part(4)), kind, F.lit("000"))
    return F.when(c.rlike(_OLD_SHAPE), key)


def version_string(version: Column, beta: Column, channel: Column | None = None) -> Column:
    """``7.0`` + beta 3 -> ``7.0b3``; with a channel also the a1 / a2 suffixes."""
    out = F.when(beta != 0, F.concat(version, F.lit("b"), beta.cast("string")))
    if channel is not None:
        out = out.when(F.lower(channel) == "nightly", F.concat(version, F.lit("a1")))
        out = out.when(F.lower(channel) == "aurora", F.concat(version, F.lit("a2")))
    return out.otherwise(version)


def version_matches_channel(version: Column, channel: Column) -> Column:
    v, ch = F.lower(version), F.lower(channel)
    verdict = (
        (v.endswith("a1") & ch.startswith("nightly"))
        | (v.endswith("a2") & (ch == "aurora"))
        | (v.endswith("esr") & ch.isin("release", "esr"))
        | (~v.contains("a") & ~v.endswith("esr") & ch.isin("beta", "release"))
    )
    return F.when(version.isNotNull() & channel.isNotNull(), verdict)


def aurora_or_nightly(version: Column) -> Column:
    label = (F.when(version.endswith("a1"), F.lit("nightly"))
             .when(version.endswith("a2"), F.lit("aurora")).otherwise(F.lit("ERROR")))
    return F.when(version.isNotNull(), label)


def is_rapid_beta(channel: Column, version: Column, first_rapid: Column) -> Column:
    return (F.lower(channel) == "beta") & (major_version_sort(version) >= major_version_sort(first_rapid))


# A missing text sorts high, so that 3.6 is above 3.6b1; a missing number sorts low.
MISSING_TEXT = "zzzzzz"
_PART_SHAPE = r"^([0-9]*)([a-zA-Z]*)([0-9]*)([a-zA-Z]*)$"
_KEY_TYPE = "array<struct<n1:int,s1:string,n2:int,s2:string>>"


def version_key(c: Column, parts: int = 4) -> Column:
    """Array of (number, text, number, text) per dotted part; Spark orders it natively.

    Shorter versions are padded to ``parts``; NULL for a text that is no version.
    """
    def number(x: Column, i: int) -> Column:
        return F.coalesce(F.regexp_extract(x, _PART_SHAPE, i).try_cast("int"), F.lit(0))

    def text(x: Column, i: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(x, _PART_SHAPE, i), F.lit("")),
                          F.lit(MISSING_TEXT))

    split = F.split(c, r"\.")
    key = F.transform(split, lambda x: F.struct(
        number(x, 1).alias("n1"), text(x, 2).alias("s1"),
        number(x, 3).alias("n2"), text(x, 4).alias("s2")))
    pad = F.struct(F.lit(0).alias("n1"), F.lit(MISSING_TEXT).alias("s1"),
                   F.lit(0).alias("n2"), F.lit(MISSING_TEXT).alias("s2"))
    padded = F.concat(key, F.array_repeat(pad, F.greatest(F.lit(parts) - F.size(split), F.lit(0))))
    return F.when(F.forall(split, lambda x: x.rlike(_PART_SHAPE)), padded.cast(_KEY_TYPE))


def version_compare(a: Column, b: Column) -> Column:
    ka, kb = version_key(a), version_key(b)
    return F.when(ka < kb, -1).when(ka > kb, 1).when(ka == kb, 0)


def version_denormalize(key: Column) -> Column:
    """Shortest text of a key: zero numbers, missing texts and empty parts are left out."""
    def show(x: Column) -> Column:
        def number(n: str) -> Column:
            return F.when(x[n] == 0, F.lit("")).otherwise(x[n].cast("string"))

        def text(s: str) -> Column:
            return F.when(x[s] == MISSING_TEXT, F.lit("")).otherwise(x[s])
        return F.concat(number("n1"), text("s1"), number("n2"), text("s2"))
    return F.array_join(F.filter(F.transform(key, show), lambda p: p != ""), ".")


def release_class(c: Column) -> Column:
    """Milestone (``…pre``), development (alpha or beta) or major; NULL otherwise."""
    numbers = r"^([0-9]+\.)+[0-9]+"
    return (F.when(c.rlike(numbers + r"([ab][0-9]*)?pre$"), F.lit("milestone"))
            .when(c.rlike(numbers + r"[ab][0-9]*$"), F.lit("development"))
            .when(c.rlike(numbers + r"$"), F.lit("major")))
