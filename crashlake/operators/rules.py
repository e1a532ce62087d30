"""Ordered rewrite rules over crash maps, and the throttle at ingest."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.functions.versions import version_key

# A predicate takes (source map, destination map) and gives a boolean Column.
# An action takes the same and gives (new value or None to leave as is, key, verdict).
Predicate = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Action:
    """Put ``value`` under ``key`` of the destination map.

    ``verdict`` is the action's own success flag; the stock actions have none (NULL).
    """

    key: str
    value: Callable[[Column, Column], Column]
    verdict: Callable[[Column, Column], Column] | None = None


@dataclass(frozen=True)
class Rule:
    predicate: Predicate
    action: Action


MODES = ("all", "until_action_succeeds", "until_action_fails",
         "until_predicate_succeeds", "until_predicate_fails")


def always(source: Column, dest: Column) -> Column:
    return F.lit(True)


def key_equals(key: str, value: str) -> Predicate:
    return lambda source, dest: F.coalesce(source[key] == value, F.lit(False))


def keys_equal(left: str, right: str) -> Predicate:
    """Same value under a key of the source and a key of the destination."""
    return lambda source, dest: F.coalesce(source[left] == dest[right], F.lit(False))


def copy_key(source_key: str, dest_key: str) -> Action:
    return Action(dest_key, lambda source, dest: source[source_key])


def format_value(dest_key: str, template: str) -> Action:
    """Fill ``%(Name)s`` marks from the source; nothing is written if a name is missing."""
    pieces = re.split(r"%\((\w[\w-]*)\)s", template)

    def value(source: Column, dest: Column) -> Column:
        return F.concat(*[source[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)])
    return Action(dest_key, value)


def put(m: Column, key: str, value: Column) -> Column:
    """Map with ``key`` set to ``value``; a NULL value leaves the map as it was."""
    rest = F.map_filter(m, lambda k, v: k != key)
    return F.when(value.isNotNull(), F.map_concat(rest, F.create_map(F.lit(key), value))) \
        .otherwise(m)


def apply_rules(df: DataFrame, rules: list[Rule], source: str = "raw", dest: str | None = None,
                mode: str = "all", outcome: str | None = None) -> DataFrame:
    """Run rules in order over a map column, row by row and without any shuffle.

    Source and destination may be the same column (each rule then sees the work of those
    before it). ``outcome`` names a column for the result of the chosen mode.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    dest = dest or source
    null = F.lit(None).cast("boolean")
    initial = F.lit(True) if mode == "all" else \
        F.lit(False) if mode in ("until_action_succeeds", "until_action_fails") else null
    out = df.withColumns({"_done": F.lit(False), "_outcome": initial})
    for rule in rules:
        src, dst = F.col(source), F.col(dest)
        hit = ~F.col("_done") & rule.predicate(src, dst)
        verdict = null if rule.action.verdict is None else rule.action.verdict(src, dst)
        result = F.when(hit, verdict)
        succeeded = F.coalesce(result, F.lit(False))
        stop = {"all": F.lit(False), "until_action_succeeds": succeeded,
                "until_action_fails": ~succeeded, "until_predicate_succeeds": hit,
                "until_predicate_fails": ~hit}[mode]
        final = F.lit(True) if mode.startswith("until_action") else result
        out = out.withColumns({
            dest: F.when(hit, put(dst, rule.action.key, rule.action.value(src, dst))).otherwise(dst),
            "_outcome": F.when(~F.col("_done") & stop, final).otherwise(F.col("_outcome")),
            "_done": F.col("_done") | stop,
        })
    if outcome:
        out = out.withColumn(outcome, F.col("_outcome"))
    return out.drop("_done", "_outcome")


def rename_products(df: DataFrame, id_map: DataFrame, raw: str = "raw") -> DataFrame:
    """Set ``ProductName`` from the product id where the id is in the map.

    ``id_map`` has ``productid`` and ``product_name``; ids are unique in it.
    """
    names = id_map.select(F.col("productid").alias("_pid"), F.col("product_name").alias("_pname"))
    joined = df.join(names, F.col(raw)["ProductID"] == F.col("_pid"), "left")
    return joined.withColumn(raw, put(F.col(raw), "ProductName", F.col("_pname"))) \
        .drop("_pid", "_pname")


#: The rule that marks extended-support versions.
ESR_RULE = Rule(key_equals("ReleaseChannel", "esr"), format_value("Version", "%(Version)sesr"))

ACCEPT, DEFER, DISCARD = 0, 1, 2


def understands_refusal(product: Column, version: Column, minimal: dict[str, str]) -> Column:
    """Is the version at or above the least one that copes with a refusal?"""
    out = F.lit(False)
    for name, least in minimal.items():
        out = F.when(product == name,
                     F.coalesce(version_key(version) >= version_key(F.lit(least)), F.lit(False))) \
            .otherwise(out)
    return out


def throttle_percent(rules: list[tuple], raw: Column) -> Column:
    """Percentage of the first rule that fits; 0 when none does.

    A rule is (key, test, percent). The test is a compiled pattern (searched), True/False,
    a function of the value, or a text to equal. Key None always applies; a rule whose key
    the crash lacks is passed over.
    """
    out = None
    for key, test, percent in rules:
        value = F.lit(None).cast("string") if key is None else raw[key]
        if isinstance(test, bool):
            fits = F.lit(test)
        elif isinstance(test, re.Pattern):
            fits = value.rlike(test.pattern)
        elif callable(test):
            fits = test(value)
        else:
            fits = value == test
        if key is not None:
            fits = F.map_contains_key(raw, key) & fits
        fits = F.coalesce(fits, F.lit(False))
        pct = F.lit(float(percent))
        out = F.when(fits, pct) if out is None else out.when(fits, pct)
    return F.lit(0.0) if out is None else out.otherwise(F.lit(0.0))


def throttle(df: DataFrame, rules: list[tuple], raw: str = "raw", uuid: str = "uuid",
             minimal: dict[str, str] | None = None, never_discard: bool = True,
             bucket: Column | None = None, out: str = "legacy_processing") -> DataFrame:
    """Verdict per crash: 0 accept, 1 defer, 2 discard.

    The draw is a bucket 0–99 hashed from the crash id, so that a re-run of lost tasks
    gives the same verdicts; ``bucket`` replaces it.
    """
    draw = F.pmod(F.xxhash64(F.col(uuid)), F.lit(100)) if bucket is None else bucket
    m = F.col(raw)
    accepted = draw < throttle_percent(rules, m)
    discard = F.lit(not never_discard) & understands_refusal(
        m["ProductName"], m["Version"], minimal or {})
    return df.withColumn(out, F.when(accepted, F.lit(ACCEPT)).when(discard, F.lit(DISCARD))
                         .otherwise(F.lit(DEFER)))
