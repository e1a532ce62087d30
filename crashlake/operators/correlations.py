"""Correlations of a signature with add-ons, CPU cores and modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.functions.text import extract
from crashlake.functions.times import ts_in_days
from crashlake.operators import common as C

GROUP = ["product_version_id", "os_name", "reason", "signature"]


def _live(clean: DataFrame, product_versions: DataFrame, start, end) -> DataFrame:
    pv = product_versions.select("product_version_id", "build_date", "sunset_date")
    r = C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end)))
    return r.join(pv, "product_version_id").where(C.live_on(F.col("report_date")))


def correlations(clean: DataFrame, product_versions: DataFrame, start=None, end=None) -> DataFrame:
    """Crashes per version, OS, reason and signature, day by day."""
    return _live(clean, product_versions, start, end).groupBy("report_date", *GROUP) \
        .agg(F.count(F.lit(1)).alias("crash_count"))


def correlation_addons(clean: DataFrame, product_versions: DataFrame, addons: DataFrame,
                       start=None, end=None) -> DataFrame:
    """The same with each add-on of the crash; ``addons`` has uuid, addon_key, addon_version."""
    return (_live(clean, product_versions, start, end).join(addons, "uuid")
            .groupBy("report_date", *GROUP, "addon_key", "addon_version")
            .agg(F.count(F.lit(1)).alias("crash_count")))


def correlation_cores(clean: DataFrame, product_versions: DataFrame, start=None, end=None) -> DataFrame:
    """The same with architecture and number of cores."""
    r = _live(clean, product_versions, start, end) \
        .where((F.col("architecture") != "") & (F.col("cores") >= 0))
    return r.groupBy("report_date", *GROUP, "architecture", "cores") \
        .agg(F.count(F.lit(1)).alias("crash_count"))


def correlate(crashes: DataFrame, items: DataFrame, item_cols: list[str],
              by: list[str], least: int = 1) -> DataFrame:
    """Share of each item in a signature's crashes against its share in all crashes.

    ``crashes`` has uuid, signature and the ``by`` columns; ``items`` has uuid and the item
    columns, and an item counts once per crash. Both counts come out of one join: overall
    counts are the sum of those per signature.
    """
    per_sig = crashes.groupBy(*by, "signature").agg(F.count(F.lit(1)).alias("signature_total"))
    overall = per_sig.groupBy(*by).agg(F.sum("signature_total").alias("overall_total"))
    each = items.select("uuid", *item_cols).distinct()
    in_sig = (crashes.select("uuid", "signature", *by).join(each, "uuid")
              .groupBy(*by, "signature", *item_cols)
              .agg(F.count(F.lit(1)).alias("signature_count")))
    in_all = in_sig.groupBy(*by, *item_cols).agg(F.sum("signature_count").alias("overall_count"))
    rows = (in_sig.join(per_sig, [*by, "signature"]).join(in_all, [*by, *item_cols])
            .join(overall, by)).where(F.col("signature_total") >= least)
    sig_share = F.col("signature_count") / F.col("signature_total")
    all_share = F.col("overall_count") / F.col("overall_total")
    return rows.withColumns({
        "signature_share": F.round(sig_share, 5), "overall_share": F.round(all_share, 5),
        "difference": F.round(sig_share - all_share, 5)})


def core_counts(clean: DataFrame, by: list[str]) -> DataFrame:
    """Shares of core counts per signature against all crashes."""
    r = clean.where((F.col("architecture") != "") & (F.col("cores") >= 0))
    items = r.select("uuid", "architecture", "cores")
    return correlate(r, items, ["architecture", "cores"], by)


def module_list(modules: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct modules; with the day they were loaded where given."""
    cols = keys or ["filename", "debug_file", "debug_id", "module_version"]
    return modules.select(*cols).distinct()


def correlation_modules(modules: DataFrame) -> DataFrame:
    """Crashes per version, OS, reason and module, from the loaded module list."""
    return modules.groupBy("product", "version", "os_name", "reason", "filename",
                           "module_version").agg(F.count(F.lit(1)).alias("crash_count"))


# ---- text reports of an earlier tool --------------------------------------------------

_PLATFORM_HEADS = ("N", "L", "M", "W")


def parse_correlation_report(lines: DataFrame, report: str = "report", number: str = "line_number",
                             text: str = "line") -> DataFrame:
    """Report lines -> rows of platform, signature, reason, count and module shares.

    A line in column one starting with N, L, M or W opens a platform section; the first
    line after a blank one is a signature line; indented lines that follow are its body.
    Headers are carried down in line order within each report file.
    """
    line = F.regexp_replace(F.col(text), r"^\s+|\s+$", "")
    df = lines.withColumns({
        "_t": line, "_platform": F.substring(text, 1, 1).isin(*_PLATFORM_HEADS)})
    # a new block starts at a platform line or a blank line
    starts = F.col("_platform") | (F.col("_t") == "")
    df = C.carry_down(df, report, number, {
        "platform": F.when(F.col("_platform"), F.col("_t")),
        "_block": F.when(starts, F.col(number))})
    body = df.where(~F.col("_platform") & (F.col("_t") != ""))
    heads = body.groupBy(F.col(report).alias("_r"), F.col("_block").alias("_b")).agg(
        F.min_by("_t", number).alias("_head"), F.min(number).alias("_first"))
    rows = body.join(heads, (body[report] == heads["_r"])
                     & body["_block"].eqNullSafe(heads["_b"])).drop("_r", "_b").where(F.col(number) > F.col("_first"))
    last = F.element_at(F.split("_head", r"\|"), -1)
    sig, reason, n = report_header(F.col("_head"), last)
    shape = r"^\s*([0-9]+)% \(([0-9]+)/([0-9]+)\) vs\.\s+([0-9]+)% \(([0-9]+)/([0-9]+)\) (.*)$"

    def num(i: int) -> Column:
        return F.regexp_extract("_t", shape, i).try_cast("bigint")
    return rows.select(
        report, number, "platform", sig.alias("signature"), reason.alias("reason"),
        n.alias("crash_count"), num(1).alias("percent"), num(2).alias("in_signature"),
        num(3).alias("signature_total"), num(4).alias("overall_percent"),
        num(5).alias("in_all"), num(6).alias("overall_total"),
        extract(F.col("_t"), shape, 7).alias("module"), F.col("_t").alias("correlation"))


def report_header(head: Column, last: Column) -> tuple[Column, Column, Column]:
    """Signature, reason and count of a signature line ``sig|REASON (N crashes)``.

    Of several bar-separated texts the one before the last is the signature. Without a bar
    the reason is UNKNOWN; an unreadable count is -1.
    """
    parts = F.split(head, r"\|")
    bare = F.size(parts) == 1
    words = F.split(last, " ")
    trim = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    sig = F.when(bare, head).otherwise(trim(F.try_element_at(parts, F.lit(-2))))
    reason = F.when(bare, F.lit("UNKNOWN")).otherwise(trim(words[0]))
    second = F.coalesce(F.get(words, 1), F.lit(""))
    count = F.when(second.startswith("("), F.coalesce(
        F.nullif(F.regexp_extract(second, r"^\(([0-9]+)", 1), F.lit("")).cast("bigint"),
        F.lit(0))).otherwise(F.lit(-1))
    return sig, reason, F.when(bare, F.lit(-1)).otherwise(count)


def crashiest_reason(report_rows: DataFrame) -> DataFrame:
    """Per signature and platform only the lines of the reason with most crashes."""
    best = report_rows.groupBy("signature", "platform").agg(
        F.max_by("reason", F.struct("crash_count", "reason")).alias("reason"))
    return report_rows.join(best, ["signature", "platform", "reason"], "left_semi")
