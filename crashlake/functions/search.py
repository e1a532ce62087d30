"""Search parameters -> one row filter over report columns."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, functions as F

MODES = ("default", "starts_with", "contains", "is_exactly")

# name -> (default, kind); kinds ending in [] are lists
PARAMETERS = {
    "data_type": ("signatures", "str"), "terms": (None, "str[]"), "signature": (None, "str"),
    "fields": ("signature", "str[]"), "search_mode": ("default", "str"),
    "from_date": (None, "datetime"), "to_date": (None, "datetime"),
    "products": (None, "str[]"), "versions": (None, "str[]"), "os": (None, "str[]"),
    "branches": (None, "str[]"), "reasons": (None, "str[]"), "build_ids": (None, "str[]"),
    "build_from": (None, "datetime"), "build_to": (None, "datetime"),
    "report_process": ("any", "str"), "report_type": ("any", "str"),
    "plugin_terms": (None, "str[]"), "plugin_in": ("name", "str[]"),
    "plugin_search_mode": ("default", "str"),
    "result_number": (100, "int"), "result_offset": (0, "int"),
}

#: Fields that terms may be searched in, and their report columns.
SEARCH_FIELDS = {"signature": "signature", "dump": "topmost_filenames",
                 "comments": "user_comments", "reason": "reason", "url": "url"}

PLUGIN_FIELDS = {"name": "plugin_name", "filename": "plugin_filename"}


def _typed(value, kind: str):
    if value is None or value == "":
        return None
    if kind.endswith("[]"):
        items = [value] if isinstance(value, str) else list(value)
        return [str(v) for v in items if v not in (None, "")] or None
    if kind == "int":
        return int(value)
    if kind == "datetime" and isinstance(value, str):
        value = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    if kind == "datetime":
        if not isinstance(value, dt.datetime):
            value = dt.datetime(value.year, value.month, value.day)
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return value
    return str(value)


def parse_parameters(params: dict, now: dt.datetime) -> dict:
    """Typed parameters with defaults; dates clamped to ``now``, unknown modes made default."""
    out = {}
    for name, (default, kind) in PARAMETERS.items():
        given = params.get(name)
        out[name] = _typed(default if given is None else given, kind)
    for mode in ("search_mode", "plugin_search_mode"):
        if out[mode] not in MODES:
            out[mode] = "default"
    last_week = now - dt.timedelta(days=7)
    for start, end in (("from_date", "to_date"), ("build_from", "build_to")):
        build = start == "build_from"
        if not build or params.get(start) is not None or params.get(end) is not None:
            out[end] = now if out[end] is None or out[end] > now else out[end]
            out[start] = last_week if out[start] is None else out[start]
    out["fields"] = [f for f in out["fields"] or [] if f in SEARCH_FIELDS] or ["signature"]
    out["plugin_in"] = [f for f in out["plugin_in"] or [] if f in PLUGIN_FIELDS] or ["name"]
    return out


def _like_escape(term: str) -> str:
    return term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def term_filter(c: Column, terms: list[str], mode: str) -> Column:
    """Any of the terms; ``default`` finds them as words, the rest by position.

    Comparison is exact for ``is_exactly`` and ignores case for the other modes.
    """
    def one(term: str) -> Column:
        if mode == "is_exactly":
            return c == term
        if mode == "starts_with":
            return c.ilike(_like_escape(term) + "%")
        if mode == "contains":
            return c.ilike("%" + _like_escape(term) + "%")
        words = F.split(F.lower(c), r"[^a-z0-9_]+")
        return F.array_contains(words, term.lower()) | (F.lower(c) == term.lower())
    return reduce(lambda a, b: a | b, (one(t) for t in terms))


def _version_filter(versions: list[str], product: str, version: str) -> Column:
    def one(text: str) -> Column:
        name, _, number = text.rpartition(":")
        cond = F.col(version) == number
        return cond & (F.col(product) == name) if name else cond
    return reduce(lambda a, b: a | b, (one(v) for v in versions))


def search_filter(params: dict, columns: list[str] | None = None) -> Column:
    """Row filter of parsed parameters.

    The time range is a plain range on ``date_processed``, so that it prunes partitions
    and reaches the scan. A signature of ``##null##`` or ``##empty##`` stands for a missing
    or blank one.
    """
    conds = [(F.col("date_processed") >= F.lit(params["from_date"])),
             (F.col("date_processed") <= F.lit(params["to_date"]))]
    if params["products"]:
        conds.append(F.col("product").isin(params["products"]))
    if params["versions"]:
        conds.append(_version_filter(params["versions"], "product", "version"))
    if params["os"]:
        conds.append(reduce(lambda a, b: a | b,
                            (F.col("os_name").ilike(_like_escape(o) + "%") for o in params["os"])))
    if params["branches"] and (columns is None or "branch" in columns):
        conds.append(F.col("branch").isin(params["branches"]))
    if params["reasons"]:
        conds.append(F.col("reason").isin(params["reasons"]))
    if params["build_ids"]:
        conds.append(F.col("build").isin(params["build_ids"]))
    if params["build_from"] is not None:
        conds.append(F.col("build") >= params["build_from"].strftime("%Y%m%d%H%M%S"))
        conds.append(F.col("build") <= params["build_to"].strftime("%Y%m%d%H%M%S"))
    if params["report_process"] == "browser":
        conds.append(F.coalesce(F.lower(F.col("process_type")), F.lit("browser")) == "browser")
    elif params["report_process"] != "any":
        conds.append(F.lower(F.col("process_type")) == params["report_process"])
    if params["report_type"] == "crash":
        conds.append(F.col("hang_id").isNull())
    elif params["report_type"] == "hang":
        conds.append(F.col("hang_id").isNotNull())
    if params["report_process"] == "plugin" and params["plugin_terms"]:
        conds.append(reduce(lambda a, b: a | b, (
            term_filter(F.col(PLUGIN_FIELDS[f]), params["plugin_terms"],
                        params["plugin_search_mode"]) for f in params["plugin_in"])))
    if params["signature"] == "##null##":
        conds.append(F.col("signature").isNull())
    elif params["signature"] == "##empty##":
        conds.append(F.col("signature") == "")
    elif params["signature"]:
        conds.append(F.col("signature") == params["signature"])
    if params["terms"]:
        conds.append(reduce(lambda a, b: a | b, (
            term_filter(F.col(SEARCH_FIELDS[f]), params["terms"], params["search_mode"])
            for f in params["fields"])))
    return reduce(lambda a, b: a & b, conds)
