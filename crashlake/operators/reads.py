"""Read queries over reports and marts. Each is one plan with bounded output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.functions import metrics as M
from crashlake.functions.search import parse_parameters, search_filter
from crashlake.functions.times import days_between
from crashlake.operators import common as C
from crashlake.operators.counts import uptime_level


def _found(reports: DataFrame, params: dict, now: dt.datetime) -> tuple[DataFrame, dict]:
    p = parse_parameters(params, now)
    return reports.where(search_filter(p, reports.columns)), p


def search_signatures(reports: DataFrame, params: dict, now: dt.datetime) -> DataFrame:
    """Signatures of the matching reports with counts by OS, hangs and plugin crashes."""
    rows, p = _found(reports, params, now)
    os = F.col("os_name")
    grouped = rows.groupBy("signature").agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if(os.ilike("windows%")).alias("is_windows"),
        F.count_if(os.ilike("mac%")).alias("is_mac"),
        F.count_if(os.ilike("linux%")).alias("is_linux"),
        F.count_if(os.ilike("solaris%")).alias("is_solaris"),
        F.count("hang_id").alias("numhang"),
        F.count_if(F.lower("process_type") == "plugin").alias("numplugin"))
    return grouped.orderBy(F.desc("count"), "signature") \
        .offset(p["result_offset"]).limit(p["result_number"])


def search_crashes(reports: DataFrame, params: dict, now: dt.datetime) -> DataFrame:
    """The matching reports themselves, newest first."""
    rows, p = _found(reports, params, now)
    return rows.orderBy(F.desc("date_processed"), "uuid") \
        .offset(p["result_offset"]).limit(p["result_number"])


def search_total(reports: DataFrame, params: dict, now: dt.datetime) -> DataFrame:
    rows, _ = _found(reports, params, now)
    return rows.agg(F.count(F.lit(1)).alias("total"),
                    F.countDistinct("signature").alias("signatures"))


def report_list(reports: DataFrame, params: dict, now: dt.datetime) -> DataFrame:
    """Reports of one signature, which must be given."""
    if not params.get("signature"):
        raise ValueError("a signature is needed")
    return search_crashes(reports, params, now)


def comments(reports: DataFrame, params: dict, now: dt.datetime) -> DataFrame:
    """Comments on the matching reports; none without a signature."""
    rows, _ = _found(reports, params, now)
    if not params.get("signature"):
        rows = rows.where(F.lit(False))
    return rows.where(F.col("user_comments").isNotNull()).select(
        "date_processed", "uuid", "user_comments",
        F.when(F.coalesce("email", F.lit("")) != "", F.col("email")).alias("email"))


def frequency(reports: DataFrame, signature: str, params: dict, now: dt.datetime) -> DataFrame:
    """Per build: crashes of the signature, and their share of all crashes of the build.

    The OS shares are of the crashes on that OS. Builds without the signature are left out.
    """
    rows, _ = _found(reports, {**params, "signature": None}, now)
    mine = F.col("signature") == signature
    on = {"windows": "windows%", "mac": "mac%", "linux": "linux%"}
    aggs = [F.count_if(mine).alias("count"), F.count(F.lit(1)).alias("total")]
    for name, pattern in on.items():
        hit = F.col("os_name").ilike(pattern)
        aggs += [F.count_if(mine & hit).alias(f"count_{name}"),
                 F.count_if(hit).alias(f"_total_{name}")]
    out = rows.groupBy(F.col("build").alias("build_date")).agg(*aggs).where("count > 0")

    def share(n: str, total: str) -> Column:
        return F.when(F.col(total) > 0, F.round(F.col(n) / F.col(total), 5)).otherwise(F.lit(0.0))
    return out.select(
        "build_date", "count", "total", *[f"count_{n}" for n in on],
        share("count", "total").alias("frequency"),
        *[share(f"count_{n}", f"_total_{n}").alias(f"frequency_{n}") for n in on])


def _span(rows: DataFrame, start, end, day: str) -> DataFrame:
    return rows.where((F.col(day) > F.lit(start).cast("date"))
                      & (F.col(day) <= F.lit(end).cast("date")))


def top_crashers(tcbs: DataFrame, product_versions: DataFrame, signatures: DataFrame,
                 rollup: DataFrame, product: str | None, version: str | None, end,
                 hours: int = 168, crash_type: str = "all", os: str | None = None,
                 limit: int = 100, date_range: str = "report") -> DataFrame:
    """Top signatures of a span of days with their change against the span before.

    Ranks start at 0 and signatures with equal counts share a rank. A signature that the
    span before lacks has NULL previous values and NULL changes (it is new). ``date_range``
    ``build`` takes rows of the build mart by build date. Without a product all versions
    are ranked together.
    """
    days = max(1, hours // 24)
    last = end if isinstance(end, dt.date) else dt.date.fromisoformat(str(end))
    mid, first = last - dt.timedelta(days=days), last - dt.timedelta(days=2 * days)
    day = "report_date" if date_range == "report" else "build_date"
    rows = tcbs.where((F.col(day) > F.lit(first)) & (F.col(day) <= F.lit(last)))
    if crash_type != "all":
        rows = rows.where(F.lower("process_type") == crash_type)
    if product is not None:
        pv = product_versions.where(F.lower("product_name") == product.lower())
        if version is not None:
            pv = pv.where(F.lower("version_string") == version.lower())
        rows = rows.join(pv.select("product_version_id"), "product_version_id", "left_semi")
    measure = {"windows": "win_count", "mac": "mac_count", "linux": "lin_count"}
    picked = "report_count" if os is None else \
        next(c for n, c in measure.items() if os.lower().startswith(n[:3]))
    now = F.col(day) > F.lit(mid)
    sums = [F.sum(F.when(now, F.col(c)).otherwise(0)).alias(c)
            for c in ("win_count", "mac_count", "lin_count", "hang_count", "startup_count")]
    kinds = [F.sum(F.when(now & (F.lower("process_type") == k), F.col("report_count")).otherwise(0))
             .alias(f"{k}_count") for k in ("content", "plugin")]
    both = rows.groupBy("signature").agg(
        F.sum(F.when(now, F.col(picked)).otherwise(0)).alias("report_count"),
        F.sum(F.when(now, F.lit(0)).otherwise(F.col(picked))).alias("_before"), *sums, *kinds)
    current = C.rank_by(both.where("report_count > 0").withColumn("_all", F.lit(1)),
                        ["_all"], "report_count", "current_rank", "_total")
    top = current.orderBy("current_rank", "signature").limit(limit)
    previous = C.rank_by(both.where("_before > 0").select("signature", "_before")
                         .withColumn("_all", F.lit(1)), ["_all"], "_before", "previous_rank",
                         "_total_before")
    previous = previous.select("signature", "previous_rank",
                               (F.col("_before") / F.col("_total_before")).alias("_share"))
    out = top.drop("_all", "_before").join(previous, "signature", "left")
    firsts = signatures.select("signature", "first_report")
    lists = rollup if product is None else rollup.where(F.lower("product_name") == product.lower())
    lists = lists.groupBy("signature").agg(
        F.sum("ver_count").alias("versions_count"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("version_list")))), ", ")
        .alias("versions")) if product is None else lists.select(
        "signature", F.col("ver_count").alias("versions_count"),
        F.array_join("version_list", ", ").alias("versions"))
    out = out.join(firsts, "signature", "left").join(lists, "signature", "left")
    share = F.col("report_count") / F.col("_total")
    return out.select(
        "signature", "report_count", "win_count", "mac_count", "lin_count", "hang_count",
        "content_count", "plugin_count", "current_rank", "previous_rank",
        (F.col("previous_rank") - F.col("current_rank")).alias("change_in_rank"),
        F.round(share, 9).alias("percent_of_total"),
        F.round("_share", 9).alias("previous_percent_of_total"),
        F.round(share - F.col("_share"), 9).alias("change_in_percent_of_total"),
        F.round(F.col("startup_count") / F.col("report_count"), 5).alias("startup_percent"),
        "first_report", F.coalesce("versions_count", F.lit(0)).alias("versions_count"),
        F.coalesce("versions", F.lit("")).alias("versions"))


def crashes_daily(cbu_view: DataFrame, product: str | None, versions: list[str] | None = None,
                  start=None, end=None, os: list[str] | None = None,
                  report_type: list[str] | None = None, separated_by: str | None = None,
                  date_range: str = "report") -> DataFrame:
    """Crashes and users per version and day, also by OS or report type.

    ``cbu_view`` is the crashes-per-user view (by report day, or by build date). Users are
    taken once per version, day and OS, however many crash types there are.
    """
    day = "report_date" if date_range == "report" else "build_date"
    rows = cbu_view.where(days_between(F.col(day), start, end))
    if product is not None:
        rows = rows.where(F.lower("product_name") == product.lower())
    if versions:
        rows = rows.where(F.lower("version_string").isin([v.lower() for v in versions]))
    if os:
        rows = rows.where(F.lower("os_name").isin([o.lower() for o in os]))
    if report_type:
        rows = rows.where(F.lower("crash_type_short").isin([t.lower() for t in report_type]))
    keys = ["product_name", "version_string", day, "throttle"]
    if separated_by == "os" or os:
        keys.append("os_name")
    if separated_by == "report_type" or report_type:
        keys.append("crash_type_short")
    per_os = rows.groupBy(*dict.fromkeys([*keys, "os_name"])).agg(
        F.sum("report_count").alias("_n"), F.max("adu").alias("_u"))
    out = per_os.groupBy(*keys).agg(F.sum("_n").alias("report_count"), F.sum("_u").alias("adu"))
    return out.withColumn("crash_hadu", M.crash_hadu(
        F.col("report_count"), F.col("adu"), F.col("throttle")))


def daily_totals(daily: DataFrame, by: str) -> DataFrame:
    """Totals over the days by version or OS: sums, and the sum of the daily ratios."""
    return daily.groupBy("product_name", by).agg(
        F.sum("report_count").alias("crashes"), F.sum("adu").alias("users"),
        F.round(F.sum("crash_hadu"), 3).alias("ratio"))


def signature_history(tcbs: DataFrame, product_versions: DataFrame, product: str, version: str,
                      signature: str, start, end) -> DataFrame:
    """Count per day and its share of all days.

    As in the query this follows, rows of a day with the same count are one row.
    """
    pv = product_versions.where((F.lower("product_name") == product.lower())
                                & (F.lower("version_string") == version.lower()))
    wanted = {"##null##": F.col("signature").isNull(), "##empty##": F.col("signature") == ""} \
        .get(signature, F.col("signature") == signature)
    hist = (tcbs.where(days_between(F.col("report_date"), start, end) & wanted)
            .join(pv.select("product_version_id"), "product_version_id", "left_semi")
            .select("report_date", "report_count").distinct())
    total = C.grand_total(hist, "report_count")
    return hist.withColumn("percent_of_total", F.round(F.col("report_count") / total, 9))


def signature_histories(tcbs: DataFrame) -> DataFrame:
    """The same for every signature and version at once."""
    keys = ["product_version_id", "signature"]
    hist = tcbs.select(*keys, "report_date", "report_count").distinct()
    rows = C.with_total(hist, keys, "report_count", "total_crashes")
    return rows.withColumn("percent_of_total",
                           F.round(F.col("report_count") / F.col("total_crashes"), 9))


def plot_points(history: DataFrame) -> DataFrame:
    """(milliseconds, count) points of a signature history."""
    return history.select((F.unix_seconds(F.col("report_date").cast("timestamp")) * 1000)
                          .alias("x"), F.col("report_count").alias("y"))


SUMMARY_TYPES = ("uptime", "products", "os", "process_type", "flash_version", "architecture")


def signature_summary(clean: DataFrame, product_versions: DataFrame, report_type: str,
                      signature: str | None = None, start=None, end=None,
                      product: str | None = None, version_ids: list | None = None,
                      levels: DataFrame | None = None) -> DataFrame:
    """Share of a signature's reports by one property.

    ``products`` takes all products; the others one product and, if given, its versions.
    Without a signature the summary is made for each of them.
    """
    if report_type not in SUMMARY_TYPES:
        raise ValueError(f"report type {report_type!r} is not defined")
    r = clean
    if signature is not None:
        r = r.where(F.col("signature") == signature)
    if start is not None:
        r = r.where(F.col("date_processed") >= F.lit(start).cast("timestamp"))
    if end is not None:
        r = r.where(F.col("date_processed") < F.lit(end).cast("timestamp"))
    pv = product_versions.select("product_version_id", "product_name", "version_string")
    if report_type == "products":
        counts = r.groupBy("signature", "product_version_id").agg(F.count(F.lit(1)).alias("_n")) \
            .join(pv, "product_version_id")
        category = F.concat_ws(" ", "product_name", "version_string")
        scale, places = 100, 3
    else:
        if version_ids:
            r = r.where(F.col("product_version_id").isin(version_ids))
        if product is not None:
            r = r.join(pv.where(F.lower("product_name") == product.lower())
                       .select("product_version_id"), "product_version_id", "left_semi")
        if report_type == "uptime":
            r = uptime_level(r, levels, value="uptime_string")
        column = {"uptime": "uptime_string", "os": "os_version_string"}.get(report_type, report_type)
        counts = r.groupBy("signature", column).agg(F.count(F.lit(1)).alias("_n"))
        category = F.col(column)
        if report_type == "flash_version":
            category = F.when(category == "", F.lit("Unknown/No Flash")).otherwise(category)
        scale, places = 1, 5
    rows = counts.select("signature", category.alias("category"), F.col("_n").alias("report_count"))
    rows = C.with_total(rows, ["signature"], "report_count", "_total")
    share = F.round(F.col("report_count") * scale / F.col("_total"), places)
    return rows.withColumn("percent", share).drop("_total")


def signature_urls(reports: DataFrame, signature: str | None, start, end,
                   products: list[str], versions: list[str]) -> DataFrame:
    """URLs of a signature with counts; ``ALL`` stands for every product or version."""
    r = reports.where((F.col("date_processed") >= F.lit(start).cast("timestamp"))
                      & (F.col("date_processed") < F.lit(end).cast("timestamp"))
                      & (F.coalesce("url", F.lit("")) != ""))
    if signature is not None:
        r = r.where(F.col("signature") == signature)
    if products != ["ALL"]:
        r = r.where(F.col("product").isin(products))
    if versions != ["ALL"]:
        r = r.where(F.col("version").isin(versions))
    return r.groupBy("signature", "url").agg(F.count(F.lit(1)).alias("crash_count"))


def extensions(addons: DataFrame, uuid: str | None = None,
               latest: DataFrame | None = None) -> DataFrame:
    """Add-ons of a crash (or of all), with the current version and an out-of-date flag."""
    rows = addons if uuid is None else addons.where(F.col("uuid") == uuid)
    if latest is None:
        return rows
    v = latest.select("addon_key", "name", "latest_version")
    out = rows.join(v, "addon_key", "left")
    return out.withColumn("out_of_date", F.col("latest_version").isNotNull()
                          & (F.col("addon_version") != F.col("latest_version")))


def crashiest_version(reports: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Product and version with most of the reports, overall or per key."""
    keys = keys or []
    counts = reports.groupBy(*keys, "product", "version").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(F.struct("product", "version", "n"),
                    F.struct("n", "product", "version")).alias("b")
    return counts.groupBy(*keys).agg(best).select(*keys, "b.*")


def crashes_by_os(frequencies: DataFrame) -> DataFrame:
    """Totals by OS over builds, and the OS that has most."""
    w, m, x = (F.sum(c).alias(c) for c in ("count_windows", "count_mac", "count_linux"))
    return frequencies.agg(w, m, x).withColumn("dominant_os", M.dominant_os(
        F.col("count_windows"), F.col("count_mac"), F.col("count_linux")))


