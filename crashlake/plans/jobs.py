"""The daily views: what each needs, how it is built, backfill and catch-up."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from crashlake.functions.times import in_range
from crashlake.operators import adu, correlations, explosive, graphs, hangs, topcrash, users
from crashlake.operators.clean import Dims, build_reports_clean, day_is_complete
from crashlake.operators.counts import signature_counts
from crashlake.operators.signatures import signature_rollup, update_signatures
from crashlake.plans.warehouse import Warehouse
from crashlake.session import cut_lineage


class AlreadyRun(RuntimeError):
    """The day is there already."""


class NotReady(RuntimeError):
    """An input of the day is not complete."""


Build = Callable[[Warehouse, dt.date, dt.date], DataFrame]


@dataclass(frozen=True)
class Job:
    """A daily view. ``last_only`` views hold their newest day and nothing else."""

    name: str
    needs: tuple[str, ...]
    build: Build
    day: str = "report_date"
    last_only: bool = False
    feeds: tuple[str, ...] = ("reports_clean",)


def _t(w: Warehouse, name: str) -> DataFrame:
    return w.table(name)


def _guids(w: Warehouse) -> DataFrame | None:
    return w.read("product_productid_map")


JOBS: dict[str, Job] = {j.name: j for j in (
    Job("product_adu", (), lambda w, a, b: adu.product_adu(
        _t(w, "raw_adu"), _t(w, "product_versions"), _t(w, "product_version_builds"), _guids(w),
        _t(w, "os_name_matches"), a, b), day="adu_date", feeds=("raw_adu",)),
    Job("build_adu", (), lambda w, a, b: adu.build_adu(
        _t(w, "raw_adu"), _t(w, "product_versions"), _t(w, "product_version_builds"), _guids(w),
        _t(w, "os_name_matches"), a, b), day="adu_date", feeds=("raw_adu",)),
    Job("tcbs", (), lambda w, a, b: topcrash.tcbs(
        _t(w, "reports_clean"), _t(w, "product_versions"), a, b)),
    Job("tcbs_build", (), lambda w, a, b: topcrash.tcbs_build(
        _t(w, "reports_clean"), _t(w, "product_versions"), a, b)),
    Job("crashes_by_user", ("product_adu",), lambda w, a, b: users.crashes_by_user(
        _t(w, "reports_clean"), _t(w, "product_versions"), _t(w, "crash_types"), _t(w, "os_names"),
        _t(w, "product_adu"), a, b, today=b)),
    Job("crashes_by_user_build", ("build_adu",), lambda w, a, b: users.crashes_by_user_build(
        _t(w, "reports_clean"), _t(w, "product_versions"), _t(w, "crash_types"), _t(w, "os_names"),
        _t(w, "product_version_builds"), _t(w, "build_adu"), a, b)),
    Job("home_page_graph", ("product_adu",), lambda w, a, b: graphs.home_page_graph(
        _t(w, "reports_clean"), _t(w, "product_versions"), _t(w, "crash_types"),
        _t(w, "product_release_channels"), _t(w, "product_adu"), a, b, today=b)),
    Job("home_page_graph_build", ("build_adu",), lambda w, a, b: graphs.home_page_graph_build(
        _t(w, "reports_clean"), _t(w, "product_versions"), _t(w, "crash_types"),
        _t(w, "product_release_channels"), _t(w, "build_adu"), a, b)),
    Job("daily_crashes", (), lambda w, a, b: graphs.daily_crashes(
        _t(w, "reports_clean"), _t(w, "product_versions"), _t(w, "os_names"), a, b), day="adu_day"),
    Job("daily_hangs", (), lambda w, a, b: hangs.daily_hangs(
        _t(w, "reports_clean"), _t(w, "reports_user_info"), a, b)),
    Job("nightly_builds", (), lambda w, a, b: graphs.nightly_builds(
        _t(w, "reports_clean"), _t(w, "product_versions"), _t(w, "product_version_builds"), a, b)),
    Job("rank_compare", (), lambda w, a, b: topcrash.rank_compare(_t(w, "reports_clean"), b, b),
        last_only=True),
    Job("explosiveness", ("tcbs", "product_adu"), lambda w, a, b: explosive.explosiveness(
        _t(w, "tcbs"), _t(w, "product_adu"), b), day="last_date", last_only=True,
        feeds=("tcbs", "product_adu")),
    Job("correlations", (), lambda w, a, b: correlations.correlations(
        _t(w, "reports_clean"), _t(w, "product_versions"), b, b), last_only=True),
    Job("correlation_cores", (), lambda w, a, b: correlations.correlation_cores(
        _t(w, "reports_clean"), _t(w, "product_versions"), b, b), last_only=True),
)}


def order(names: list[str] | None = None) -> list[str]:
    """Names in dependency order, with everything they need."""
    out: list[str] = []

    def visit(name: str) -> None:
        for need in JOBS[name].needs:
            visit(need)
        if name not in out:
            out.append(name)
    for name in names or JOBS:
        visit(name)
    return out


# Day columns of the inputs that must have the day.
_FEED_DAY = {"raw_adu": "adu_date", "product_adu": "adu_date", "tcbs": "report_date"}


def inputs_ready(w: Warehouse, job: Job, day: dt.date) -> bool:
    """Facts must reach the last hour of the day; marts and feeds must have the day."""
    for feed in job.feeds:
        if feed == "reports_clean":
            clean = w.read(feed)
            if clean is None or not day_is_complete(clean, day):
                return False
        elif not w.has_day(feed, day, _FEED_DAY[feed]):
            return False
    return all(w.has_day(n, day, JOBS[n].day) for n in job.needs if not JOBS[n].last_only)


def _write(w: Warehouse, job: Job, start: dt.date, end: dt.date) -> None:
    df = job.build(w, start, end)
    if job.last_only:
        w.write(job.name, df)
    else:
        w.write_days(job.name, df, job.day, start, end)


def run_day(w: Warehouse, name: str, day: dt.date, check: bool = True) -> bool:
    """Build one day of a view once.

    With ``check`` a day that is there, or whose inputs are not, is an error; without it the
    call does nothing and gives False.
    """
    job = JOBS[name]
    if not job.last_only and w.has_day(name, day, job.day):
        if check:
            raise AlreadyRun(f"{name} has been run for {day}")
        return False
    if not inputs_ready(w, job, day):
        if check:
            raise NotReady(f"inputs of {name} are not complete for {day}")
        return False
    _write(w, job, day, day)
    return True


def backfill_day(w: Warehouse, name: str, day: dt.date) -> None:
    """Rebuild one day from scratch."""
    _write(w, JOBS[name], day, day)


def backfill(w: Warehouse, start: dt.date, end: dt.date, today: dt.date,
             names: list[str] | None = None) -> list[str]:
    """Rebuild a closed range of days of all views, in dependency order.

    Each view is one job over the whole range. The end is cut at the last day of user counts;
    days to come are refused. Views that hold one day only are built for the last day.
    """
    if start > today or end > today:
        raise ValueError("cannot backfill into the future")
    last = w.last_day("raw_adu", "adu_date")
    end = min(end, last) if last is not None else end
    if end < start:
        return []
    done = []
    for name in order(names):
        _write(w, JOBS[name], start, end)
        done.append(name)
    update_signature_tables(w, start, end)
    return done


def run_all(w: Warehouse, day: dt.date) -> dict[str, str]:
    """One day of every view; what depends on a failed view is skipped, the rest goes on."""
    state: dict[str, str] = {}
    for name in order():
        if any(state.get(n) not in ("done", "present") for n in JOBS[name].needs):
            state[name] = "skipped"
            continue
        try:
            run_day(w, name, day)
            state[name] = "done"
        except AlreadyRun:
            state[name] = "present"
        except Exception as error:  # a failed view must not stop the others
            state[name] = f"failed: {error}"
    return state


def missed_days(w: Warehouse, name: str, yesterday: dt.date,
                first: dt.date | None = None) -> list[dt.date]:
    """Days after the last one built, up to yesterday."""
    last = w.last_day(name, JOBS[name].day)
    day = first if last is None else last + dt.timedelta(days=1)
    out = []
    while day is not None and day <= yesterday:
        out.append(day)
        day += dt.timedelta(days=1)
    return out


def catch_up(w: Warehouse, name: str, yesterday: dt.date, first: dt.date | None = None) -> int:
    days = missed_days(w, name, yesterday, first)
    for day in days:
        run_day(w, name, day)
    return len(days)


def hour_steps(start: dt.datetime, end: dt.datetime, hours: int = 1):
    """Steps of a time range, never across a Monday midnight and never above one day."""
    if not 1 <= hours <= 24:
        raise ValueError("a step has 1 to 24 hours")
    at = start
    while at < end:
        stop = min(at + dt.timedelta(hours=hours), end)
        monday = (at - dt.timedelta(days=at.weekday())).replace(
            hour=0, minute=0, second=0, microsecond=0) + dt.timedelta(days=7)
        stop = min(stop, monday)
        yield at, stop
        at = stop


def load_dims(w: Warehouse) -> Dims:
    return Dims(_t(w, "product_versions"), _t(w, "product_version_builds"),
                _t(w, "release_channel_matches"), _t(w, "os_name_matches"),
                _t(w, "windows_versions"))


def _write_hours(w: Warehouse, name: str, df: DataFrame, start: dt.datetime,
                 end: dt.datetime) -> None:
    """Replace the hours of a step (at most 24), also those that have no rows any more."""
    hour = F.date_format("date_processed", "yyyyMMddHH").cast("int")
    week = F.to_date(F.date_trunc("week", F.col("date_processed")))
    first, last = f"{start:%Y%m%d%H}", f"{end - dt.timedelta(seconds=1):%Y%m%d%H}"
    w.replace(name, df.withColumns({"week": week, "hour": hour}), ["week", "hour"],
              lambda at: first <= at["hour"] <= last)


def clean_hours(w: Warehouse, start: dt.datetime, end: dt.datetime, hours: int = 1) -> int:
    """Clean whole hours of stored reports step by step; gives the number of steps.

    Facts lie under week and hour and a step replaces its hours, so that cleaning again,
    after late reports came or after a failure, leaves each report once. Ids that other
    hours have are skipped.
    """
    if start != start.replace(minute=0, second=0, microsecond=0):
        raise ValueError("steps start at full hours")
    dims, n = load_dims(w), 0
    for a, b in hour_steps(start, end, hours):
        done = w.read("reports_clean")
        if done is not None:
            done = done.where(~in_range(F.col("date_processed"), a, b))
        out = build_reports_clean(_t(w, "reports"), dims, done, w.read("reports_duplicates"), a, b)
        out.staged = cut_lineage(out.staged)
        _write_hours(w, "reports_clean", out.clean, a, b)
        _write_hours(w, "reports_user_info", out.user_info, a, b)
        _write_hours(w, "reports_bad", out.bad, a, b)
        n += 1
    return n


def update_signature_tables(w: Warehouse, start: dt.date, end: dt.date) -> None:
    """Add new signatures and pairs of the days; rebuild the roll-up. Repeating adds nothing."""
    reports = w.read("reports")
    if reports is None:
        return
    sigs, pairs = w.read("signatures"), w.read("signature_products")
    new, new_pairs, _ = update_signatures(
        reports, _t(w, "product_versions"), _t(w, "product_version_builds"), sigs, pairs, start, end)
    w.append("signatures", new)
    w.append("signature_products", new_pairs)
    w.write("signature_products_rollup",
            signature_rollup(_t(w, "signature_products"), _t(w, "product_versions")))


def backfill_signature_counts(w: Warehouse, start: dt.date, end: dt.date,
                              dims: tuple[str, ...] = ("uptime", "os", "product")) -> None:
    for dim in dims:
        levels = _t(w, "uptime_levels") if dim == "uptime" else None
        df = signature_counts(_t(w, "reports_clean"), _t(w, "product_versions"), dim, start, end,
                              levels)
        w.write_days(f"{dim}_signature_counts", df, "report_date", start, end)


def reprocess(w: Warehouse, pick: Callable[[DataFrame], DataFrame],
              again: Callable[[DataFrame], DataFrame], name: str = "raw_crashes",
              out: str = "reprocessed") -> int:
    """Run picked raw crashes through a transform again, from the last mark on.

    The mark is the newest submit time handled so far, read back from the output; rows with
    that very time are told apart by id.
    """
    rows = pick(_t(w, name))
    old = w.read(out)
    if old is not None:
        mark = old.agg(F.max("date_processed").alias("m")).first()["m"]
        if mark is not None:
            rows = rows.where(F.col("submitted_timestamp") >= F.lit(mark)) \
                .join(old.where(F.col("date_processed") == F.lit(mark)).select("uuid"), "uuid",
                      "left_anti")
    fixed = cut_lineage(again(rows))
    n = fixed.count()
    if n:
        w.append(out, fixed)
    return n


