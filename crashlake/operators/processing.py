"""Raw crash map + dump text -> processed report row. No shuffle anywhere in here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.functions.signature import DEFAULT_RULES, SignatureRules, normalize_frame, signature
from crashlake.functions.text import let, strip
from crashlake.functions.times import in_range, ooid_date

# (raw key, column, greatest length, note when missing)
TEXT_FIELDS = (
    ("ProductName", "product", 30, True),
    ("Version", "version", 16, True),
    ("BuildID", "build", 16, True),
    ("URL", "url", 255, False),
    ("Comments", "user_comments", 500, False),
    ("Notes", "app_notes", 1000, False),
    ("Distributor", "distributor", 20, False),
    ("Distributor_version", "distributor_version", 20, False),
    ("Email", "email", 100, False),
    ("ProcessType", "process_type", 10, False),
)


def finished_reports(df: DataFrame, start, end) -> DataFrame:
    """Finished reports of a half-open time range."""
    return df.where(in_range(F.col("date_processed"), start, end)
                    & F.col("completed_datetime").isNotNull())


def _add_notes(df: DataFrame, *notes: Column) -> DataFrame:
    old = F.col("notes") if "notes" in df.columns else F.array().cast("array<string>")
    return df.withColumn("notes", F.concat(old, F.array_compact(F.array(*notes))))


def truncate_fields(df: DataFrame, spec=TEXT_FIELDS, raw: str = "raw") -> DataFrame:
    """Copy map entries to columns with their length limits; note the missing ones."""
    m = F.col(raw)
    out = df.withColumns({col: F.substring(m[key], 1, size) for key, col, size, _ in spec})
    return _add_notes(out, *[F.when(m[key].isNull(), F.lit(f"WARNING: raw crash misses {key}"))
                             for key, _, _, warn in spec if warn])


def derive_times(df: DataFrame, raw: str = "raw", submitted: str = "submitted_timestamp",
                 uuid: str = "uuid") -> DataFrame:
    """Crash, startup and install times, each falling back on the one before.

    Uptime is never negative; the install age may be. Without a submit time the day in the
    crash id stands in.
    """
    m = F.col(raw)
    when = F.coalesce(F.col(submitted), ooid_date(F.col(uuid)).cast("timestamp"))
    submitted_s = F.unix_seconds(when)
    crash = F.coalesce(F.substring(m["CrashTime"], 1, 10).try_cast("bigint"),
                       m["timestamp"].try_cast("bigint"), submitted_s)
    startup = F.coalesce(m["StartupTime"].try_cast("bigint"), crash)
    install = F.coalesce(m["InstallTime"].try_cast("bigint"), startup)
    out = df.withColumns({
        "date_processed": when,
        "crash_time": crash,
        "client_crash_date": F.timestamp_seconds(crash),
        "install_age": crash - install,
        "uptime": F.greatest(F.lit(0), crash - startup),
        "last_crash": m["SecondsSinceLastCrash"].try_cast("bigint"),
    })
    return _add_notes(
        out, F.when(m["CrashTime"].isNull(), F.lit("WARNING: raw crash misses CrashTime")),
        F.when(F.col("crash_time") == submitted_s,
               F.lit("WARNING: no client crash date in the raw crash")))


def hang_type(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Hang id, hang type (given, else -1 with a hang id, else 0), add-ons-checked flag."""
    m = F.col(raw)
    return df.withColumns({
        "hang_id": m["HangID"],
        "hang_type": F.when(m["Hang"].isNotNull(), m["Hang"].try_cast("int"))
        .when(F.coalesce(m["HangID"], F.lit("")) != "", F.lit(-1)).otherwise(F.lit(0)),
        "addons_checked": F.lower(m["EMCheckCompatibility"]) == "true",
        "release_channel": F.coalesce(m["ReleaseChannel"], F.lit("unknown")),
    })


def plugin_fields(df: DataFrame, raw: str = "raw") -> DataFrame:
    m = F.col(raw)
    is_plugin = F.substring(m["ProcessType"], 1, 10) == "plugin"
    return df.withColumns({
        name: F.when(is_plugin, F.coalesce(m[key], F.lit("")))
        for key, name in (("PluginFilename", "plugin_filename"), ("PluginName", "plugin_name"),
                          ("PluginVersion", "plugin_version"))})


def parse_addons(c: Column) -> Column:
    """``id:version,…`` -> array of struct(id, version), both URL-decoded.

    A missing version is ``''``; a bad escape is kept as it stands.
    """
    def decode(x: Column) -> Column:
        return F.coalesce(F.try_url_decode(x), F.replace(x, F.lit("+"), F.lit(" ")))

    def one(x: Column) -> Column:
        pair = F.split(x, ":", 2)
        return F.struct(decode(pair[0]).alias("id"),
                        decode(F.coalesce(F.get(pair, 1), F.lit(""))).alias("version"))
    parsed = F.transform(F.split(c, ","), one)
    return F.when(F.coalesce(c, F.lit("")) != "", parsed) \
        .otherwise(F.array().cast("array<struct<id:string,version:string>>"))


def addon_notes(c: Column) -> Column:
    bad = F.filter(F.split(c, ","), lambda x: ~x.contains(":"))
    return F.when(F.coalesce(c, F.lit("")) != "", F.transform(
        bad, lambda x: F.concat(F.lit('"'), x, F.lit('" lacks a name or a version of an addon'))))


def _with_lines(df: DataFrame, dump: str) -> DataFrame:
    """Dump lines without blanks at their ends, and the place of the first blank line.

    Every later step reads these columns, so that a dump is cut once.
    """
    if "_lines" in df.columns:
        return df
    df = df.withColumn("_lines", F.transform(F.split(dump, "\n"), strip))
    return df.withColumn("_blank", F.array_position("_lines", F.lit("")).cast("int"))


def _fields(line: Column) -> Column:
    return F.transform(F.split(line, r"\|"), lambda s: F.nullif(strip(s), F.lit("")))


# Module file names of the Flash plugin, with their version parts.
FLASH_PATTERN = (r"^(?:NPSWF32_?(.*)\.dll|FlashPlayerPlugin_?(.*)\.exe|"
                 r"libflashplayer(.*)\.(.*)|Flash ?Player-?(.*))")


def flash_version(filename: Column, version: Column) -> Column:
    """Version of a Flash module, from its own field or its file name; NULL for others."""
    def group(i: int) -> Column:
        return F.nullif(F.regexp_extract(filename, FLASH_PATTERN, i), F.lit(""))
    from_name = F.coalesce(F.replace(group(1), F.lit("_"), F.lit(".")),
                           F.replace(group(2), F.lit("_"), F.lit(".")), group(3), group(5))
    return F.when(filename.rlike(FLASH_PATTERN), F.coalesce(version, from_name))


def parse_dump_header(df: DataFrame, dump: str = "dump") -> DataFrame:
    """Columns from the header lines, which end at the first blank line.

    OS, CPU, reason, address, crashed thread and Flash version; of repeated lines the last
    one counts, of Flash modules the first with a version.
    """
    df = _with_lines(df, dump)
    head = F.when(F.col("_blank") > 0, F.slice("_lines", 1, F.greatest(F.col("_blank") - 1, F.lit(0)))) \
        .otherwise(F.col("_lines"))
    df = df.withColumn("_head", F.transform(head, _fields))
    df = df.withColumn("_good", F.filter("_head", lambda f: F.size(f) >= 3))

    def last(kind: str) -> Column:
        return F.try_element_at(F.filter("_good", lambda f: f[0] == kind), F.lit(-1))

    df = df.withColumns({"_os": last("OS"), "_cpu": last("CPU"), "_crash": last("Crash")})
    os, cpu, crash = F.col("_os"), F.col("_cpu"), F.col("_crash")
    flash = F.array_compact(F.transform(
        F.filter("_good", lambda f: (f[0] == "Module") & (F.size(f) >= 5)),
        lambda f: flash_version(f[1], f[2])))
    info = F.substring(F.get(cpu, 2), 1, 100)
    out = df.withColumns({
        "os_name": F.substring(F.get(os, 1), 1, 100),
        "os_version": F.substring(F.get(os, 2), 1, 100),
        "cpu_name": F.substring(F.get(cpu, 1), 1, 100),
        "cpu_info": F.when(F.get(cpu, 3).isNotNull(),
                           F.concat(info, F.lit(" | "), F.substring(F.get(cpu, 3), 1, 100)))
        .otherwise(info),
        "reason": F.substring(F.get(crash, 1), 1, 255),
        "address": F.substring(F.get(crash, 2), 1, 20),
        "crashed_thread": F.get(crash, 3).try_cast("int"),
        "flash_version": F.coalesce(F.get(flash, 0), F.lit("[blank]")),
    })
    return _add_notes(
        out, F.when(F.size("_head") == 0, F.lit("no header lines in the dump")),
        F.when(F.exists("_head", lambda f: F.size(f) < 3), F.lit("cannot parse a header line")),
        F.when(F.col("crashed_thread").isNull(),
               F.lit("No thread was identified as the cause of the crash"))
    ).drop("_head", "_good", "_os", "_cpu", "_crash")


MAX_SIGNATURE_FRAMES = 30

_FRAME = ("thread", "frame", "module", "function", "source", "line", "address")


def parse_frames(df: DataFrame, dump: str = "dump", long_stack: int = 100,
                 rules: SignatureRules = DEFAULT_RULES) -> DataFrame:
    """Frames of the crashed thread (thread 0 for a browser-side hang), at most 30.

    Adds ``frames`` (structs), ``frame_texts`` (normal forms), ``topmost_filenames`` and
    ``truncated``. Only the first unbroken run of the thread counts.
    """
    df = _with_lines(df, dump)
    body = F.when(F.col("_blank") > 0, F.filter(
        F.slice("_lines", F.col("_blank") + 1, F.size("_lines")), lambda s: s != "")) \
        .otherwise(F.array().cast("array<string>"))

    def frame(line: Column) -> Column:
        return let(_fields(line), lambda p: F.struct(
            *[F.get(p, i).alias(n) for i, n in enumerate(_FRAME)]))

    df = df.withColumns({
        "_all": F.transform(body, frame),
        "_thread": F.when(F.col("hang_type") == 1, F.lit(0)).otherwise(F.col("crashed_thread")),
    })
    df = df.withColumn("_mine", F.transform("_all", lambda f: F.coalesce(
        f["thread"].try_cast("int") == F.col("_thread"), F.lit(False))))
    df = df.withColumn("_first", F.array_position("_mine", F.lit(True)).cast("int"))
    df = df.withColumn("_after", F.slice("_mine", F.greatest("_first", F.lit(1)),
                                         F.greatest(F.size("_mine"), F.lit(1))))
    df = df.withColumn("_stop", F.array_position("_after", F.lit(False)).cast("int"))
    df = df.withColumn("_length", F.when(F.col("_first") == 0, 0)
                       .when(F.col("_stop") == 0, F.size("_after")).otherwise(F.col("_stop") - 1))
    # source files are taken from everything read up to the line that ends the run
    read = F.when(F.col("_first") == 0, F.col("_all")).otherwise(
        F.slice("_all", 1, F.col("_first") + F.col("_length")))
    sources = F.filter(F.transform(read, lambda f: f["source"]), lambda s: s.isNotNull())
    df = df.withColumns({
        "frames": F.slice("_all", F.greatest("_first", F.lit(1)),
                          F.least("_length", F.lit(MAX_SIGNATURE_FRAMES))),
        "topmost_filenames": F.coalesce(F.get(sources, 0), F.lit("")),
        "truncated": F.col("_length") > long_stack,
    })
    texts = F.transform("frames", lambda f: normalize_frame(
        f["module"], f["function"], f["source"], f["line"], f["address"], rules))
    return df.withColumn("frame_texts", texts).drop(
        "_all", "_thread", "_mine", "_first", "_after", "_stop", "_length", "_lines", "_blank")


def explode_frames(df: DataFrame, key: str = "uuid") -> DataFrame:
    """One row per frame kept by :func:`parse_frames`."""
    rows = df.select(key, F.posexplode(F.arrays_zip("frames", "frame_texts")).alias("pos", "f"))
    return rows.select(key, "pos", "f.frames.*", F.col("f.frame_texts").alias("frame_text"))


def add_signature(df: DataFrame, rules: SignatureRules = DEFAULT_RULES,
                  trace: str = "java_stack_trace") -> DataFrame:
    made = signature(F.col(trace), F.col("frame_texts"), F.col("hang_type"),
                     F.col("crashed_thread"), rules)
    df = df.withColumn("_sig", made)
    return df.withColumns({"signature": F.col("_sig.signature"),
                           "notes": F.concat("notes", "_sig.notes")}).drop("_sig")


def process_raw(df: DataFrame, rules: SignatureRules = DEFAULT_RULES) -> DataFrame:
    """The whole narrow transform; works on batch and stream alike.

    Input: ``uuid``, ``raw`` (map), ``submitted_timestamp``, ``dump`` (text, may be NULL).
    """
    out = hang_type(derive_times(truncate_fields(df)))
    out = plugin_fields(out).withColumns({
        "java_stack_trace": F.col("raw")["JavaStackTrace"],
        "addons": parse_addons(F.col("raw")["Add-ons"]),
        "notes": F.concat("notes", F.coalesce(addon_notes(F.col("raw")["Add-ons"]),
                                              F.array().cast("array<string>"))),
        "productid": F.col("raw")["ProductID"],
        "dump": F.coalesce("dump", F.lit("")),
    })
    out = add_signature(parse_frames(parse_dump_header(out), rules=rules), rules)
    return out.withColumns({
        "success": F.col("dump") != "",
        "processor_notes": F.array_join("notes", "; "),
    }).drop("raw", "dump", "notes", "frames", "frame_texts", "java_stack_trace")
