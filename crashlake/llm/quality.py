"""Quality rules: text statistics and robust multivariate outliers of each language and source."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.llm.common import maybe_asked, store, text_of, unused

#: Words of a window for repeats; rules that reject at once.
WINDOW, LEAST_WORDS, MOST_REPEAT = 8, 20, 30
#: Share of a group that the estimate rests on, concentration steps, squared distance from
#: which a document is an outlier (a chi-square of 4 exceeds it once in 3e9).
CORE, STEPS, CUT = 0.75, 5, 50.0
#: Transformed statistics, and the least standard deviation each is taken to have: where most
#: documents of a group have the same value, smaller differences than these mean nothing.
FLOORS = {"v_length": 0.1, "v_symbols": 0.08, "v_lines": 0.15, "v_repeats": 0.15}
KEYS = ("lang", "source")


def with_statistics(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed.

    Windows of eight words are hashed by position; sorting (hash bits, position) longs puts
    equal windows side by side, so a text costs n log n however often it repeats itself. The
    bits that a position leaves to the hash are few in a long text, so the windows found are
    sorted once more by all 64 bits.
    """
    text = text_of()
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = (docs.withColumn("_words", F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
            .withColumn("_lines", lines)
            .withColumn("n_symbols", (F.size(F.split(text, r"[#*$%&|<>]", -1)) - 1).cast("long")))
    step = (step.withColumn("n_words", F.size("_words").cast("long"))
            .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
            .withColumn("n_lines", F.size("_lines").cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
            .drop("_words", "_lines"))
    bits = F.ceil(F.log2(F.greatest(F.col("n_words"), F.lit(2)).cast("double"))).cast("int") + 1
    step = step.withColumn("_bits", bits)
    windows = F.when(F.col("n_words") >= WINDOW, F.sort_array(F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
        lambda i: F.call_function("shiftleft", F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]), F.col("_bits"))
        .bitwiseOR(i.cast("long"))))).otherwise(F.array().cast("array<bigint>"))
    step = step.withColumn("_windows", windows)
    part = lambda x: F.call_function("shiftright", x, F.col("_bits"))
    twice = F.filter("_windows", lambda x, i: (part(F.get("_windows", i - 1)) == part(x))
                     | (part(F.get("_windows", i + 1)) == part(x)))
    place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1)
    near = F.sort_array(F.transform(twice, lambda x: F.struct(
        F.xxhash64(*[F.get("_hashes", place(x).cast("int") + k) for k in range(WINDOW)]).alias("h"), place(x).alias("p"))))
    step = step.withColumn("_near", near).drop("_windows", "_hashes")
    same = F.filter("_near", lambda x, i: (F.get("_near", i - 1)["h"] == x["h"]) | (F.get("_near", i + 1)["h"] == x["h"]))
    step = step.withColumn("_starts", F.sort_array(F.transform(same, lambda x: x["p"]))).drop("_near")
    reach = F.aggregate("_starts", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("end")),
                        lambda a, p: F.struct((a["sum"] + p + WINDOW - F.greatest(a["end"], p)).alias("sum"),
                                              (p + WINDOW).alias("end")), lambda a: a["sum"])
    return (step.withColumn("n_repeat_words", reach).drop("_starts", "_bits")
            .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                        | (100 * F.col("n_repeat_words") > MOST_REPEAT * F.col("n_words"))))


def with_vectors(stats: DataFrame) -> DataFrame:
    """Rates by word or line, transformed to be near normal; 0 for texts without words."""
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return stats.withColumns({
        "v_length": F.log(F.greatest(per("word_chars", "n_words"), F.lit(0.01))),
        "v_symbols": F.sqrt(per("n_symbols", "n_words")),
        "v_lines": F.sqrt(per("n_dup_lines", "n_lines")),
        "v_repeats": F.sqrt(per("n_repeat_words", "n_words"))})


def consistency(core: float) -> float:
    """Factor that makes a covariance of the ``core`` nearest of a normal sample of 4 unbiased."""
    cdf4 = lambda x: 1 - math.exp(-x / 2) * (1 + x / 2)
    cdf6 = lambda x: 1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)
    low, high = 0.0, 200.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf4(mid) < core else (low, mid)
    return core / cdf6(low)


def _center(i: int) -> str:
    return f"m{i}"


def _whiten(moments: DataFrame, p: int) -> DataFrame:
    """From means m_i and covariances c_i_j, add w_i_j, the inverse Cholesky factor, and log_det."""
    out = moments
    for j in range(p):
        done = lambda i: sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))  # noqa: E731,B023
        out = out.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(F.col(f"c{j}_{j}") - done(j), F.lit(1e-12))))
        for i in range(j + 1, p):
            out = out.withColumn(f"l{i}_{j}", (F.col(f"c{i}_{j}") - done(i)) / F.col(f"l{j}_{j}"))
    for j in range(p):
        for i in range(j, p):
            rest = sum((F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)), F.lit(0.0))
            out = out.withColumn(f"w{i}_{j}", (F.lit(1.0 if i == j else 0.0) - rest) / F.col(f"l{i}_{i}"))
    det = sum((F.log(f"l{i}_{i}") for i in range(p)), F.lit(0.0))
    return out.withColumn("log_det", det).select(
        *KEYS, "start", "log_det", *[_center(i) for i in range(p)], *[f"w{i}_{j}" for i in range(p) for j in range(i + 1)])


def squared_distance(names: list[str]) -> Column:
    gaps = [F.col(n) - F.col(_center(i)) for i, n in enumerate(names)]
    rows = [sum((F.col(f"w{i}_{j}") * gaps[j] for j in range(i + 1)), F.lit(0.0)) for i in range(len(names))]
    return sum((r * r for r in rows), F.lit(0.0))


def _join(rows: DataFrame, params: DataFrame) -> DataFrame:
    right = params.withColumnsRenamed({k: f"_{k}" for k in KEYS})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    return rows.join(right, on[0] & on[1]).drop(*[f"_{k}" for k in KEYS])


def _moments(rows: DataFrame, names: list[str], scale: float) -> DataFrame:
    """Means and covariances by group and start, with the floors added to the variances."""
    p, floors = len(names), list(FLOORS.values())
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    sums = rows.groupBy(*KEYS, "start").agg(
        *[F.avg(n).alias(_center(i)) for i, n in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs])
    return _whiten(sums.withColumns({
        f"c{i}_{j}": F.col(f"c{i}_{j}") * scale + (floors[i] ** 2 if i == j else 0.0) for i, j in pairs}), p)


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Minimum covariance determinant of every (lang, source): centre and whitening matrix.

    Two starts are taken, both from medians and median deviations: the ``CORE`` nearest by
    sum of squares, and by the largest coordinate. Each concentration step takes the means and
    covariances of the ``CORE`` of a group that is nearest by the last estimate, which never
    raises the determinant; of the two ends the one with the smaller determinant is kept.
    A step is two aggregations over the narrow statistics, with bounded sketches for quantiles.
    """
    names, p = list(FLOORS), len(FLOORS)
    middle = rows.groupBy(*KEYS).agg(*[F.percentile_approx(n, 0.5, 1000).alias(_center(i)) for i, n in enumerate(names)])
    spread = (_join(rows, middle).groupBy(*KEYS, *[_center(i) for i in range(p)])
              .agg(*[F.percentile_approx(F.abs(F.col(n) - F.col(_center(i))), 0.5, 1000).alias(f"s{i}")
                     for i, n in enumerate(names)]))
    score = [F.pow((F.col(n) - F.col(_center(i))) / F.sqrt(F.pow(F.col(f"s{i}") * 1.4826, 2) + f * f), 2)
             for i, (n, f) in enumerate(FLOORS.items())]
    starts = F.explode(F.array(F.struct(F.lit(0).alias("start"), sum(score[1:], score[0]).alias("d")),
                               F.struct(F.lit(1).alias("start"), F.greatest(*score).alias("d"))))
    near = _join(rows, store(spread, "mcd-start")).select(*KEYS, *names, starts.alias("s")).select(*KEYS, *names, "s.*")
    for step in range(STEPS + 1):
        edge = near.groupBy(*KEYS, "start").agg(F.percentile_approx("d", CORE, 1000).alias("edge"))
        edge = edge.withColumnRenamed("start", "_start")
        core = _join(near, edge).where("start = _start AND d <= edge")
        params = store(_moments(core, names, consistency(CORE)), f"mcd-{step}")
        near = _join(rows, params).select(*KEYS, *names, "start", squared_distance(names).alias("d"))
    columns = [c for c in params.columns if c not in (*KEYS, "start", "log_det")]
    best = params.groupBy(*KEYS).agg(F.min_by(F.struct(*columns), F.struct("log_det", "start")).alias("b"))
    return best.select(*KEYS, "b.*")


def _verdict(stats: DataFrame, estimates: DataFrame, names: list[str]) -> DataFrame:
    right = estimates.withColumnsRenamed({k: f"_{k}" for k in KEYS})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    far = F.coalesce(squared_distance(names), F.lit(0.0))
    return (stats.join(right, on[0] & on[1], "left").withColumn("distance", far)
            .withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= CUT))
            .drop(*right.columns, *names))


def quality_report(docs: DataFrame) -> DataFrame:
    """Return doc_id, lang, source, text_key, the statistics, base_failed, distance and kept of every row.

    A document is kept when the base rules pass and its squared Mahalanobis distance from the
    robust centre of its language and source is at most ``CUT``. Documents that fail the base
    rules take no part in the estimates. Null language and source are groups like others; a
    group of one is its own centre. Null texts count as empty and fail by their word count;
    null doc_ids are kept as they are; an empty table gives no rows. ``text_key`` is the hash
    of the text. Texts are read once, and only their statistics are written.
    """
    names = list(FLOORS)
    wanted = ["doc_id", *KEYS, "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    stats = store(with_vectors(with_statistics(
        docs.select("doc_id", *KEYS, "text", F.xxhash64(text_of()).alias("text_key")))).select(*wanted, *names), "quality")
    estimates = robust_estimates(stats.where("NOT base_failed").select(*KEYS, *names))
    return _verdict(stats, estimates, names)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` that ``quality_report`` keeps.

    Verdicts come back by doc_id, language, source and text hash, on which alone they depend. Only texts
    that may be rejected are moved to meet them.
    """
    keys = ["doc_id", *KEYS, "text_key"]
    bad = store(quality_report(docs).where("NOT kept").select(*keys).distinct(), "rejected")
    own = dict(zip(keys, unused(docs, *[f"_{k}" for k in keys])))
    key, = unused(docs, "_text_hash")
    keyed = docs.withColumn(key, F.xxhash64(text_of(docs.text)))
    maybe, sure = maybe_asked(keyed, bad, ["doc_id", *KEYS, key])
    bad = bad.withColumnsRenamed(own)
    same = F.col(key) == F.col(own["text_key"])
    for k in keys[:-1]:
        same &= F.col(k).eqNullSafe(F.col(own[k]))
    return sure.unionByName(maybe.join(bad, same, "left_anti")).drop(key)
