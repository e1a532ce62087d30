"""Joins of texts to ILIKE patterns through an index of the patterns' literals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.operators.intervals import interval_join
from crashlake.session import cut_lineage

#: Longest n-gram of a literal that is looked up. Shorter ones are in many more texts: with 3, pairs
#: to be tested grew with texts times patterns.
GRAM = 5
#: Words of 64 bits in the table that tells which grams of a text no pattern is looked up by.
WORDS = 1 << 18


def _grams(text: Column, n: Column) -> Column:
    """Distinct n-grams of a text; none when it is shorter."""
    last = F.length(text) - n + 1
    return F.when(last > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), last), lambda i: F.substring(text, i, n)))).otherwise(F.array().cast("array<string>"))


def _literals(pattern: Column) -> Column:
    """Lower-case runs of a pattern between its wildcards, escapes resolved."""
    runs = F.regexp_extract_all(F.lower(pattern), F.lit(r"(?s)((?:\\.|[^%_\\])+)"), F.lit(1))
    return F.transform(runs, lambda r: F.regexp_replace(r, r"(?s)\\(.)", "$1"))


def _looked_up(held: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose gram may be among the keys', and all whose is.

    A bit is set for the hash of each key. The table has at most ``WORDS`` rows however many keys there
    are, so it is sent to the rows, and of a text only the grams that a pattern is looked up by are moved.
    """
    place = F.xxhash64("_gram")
    named = {"_word": F.pmod(F.shiftrightunsigned(place, 6), F.lit(WORDS)), "_bit": place.bitwiseAND(F.lit(63)).cast("int")}
    table = keys.withColumns(named).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    marked = held.withColumns(named).join(F.broadcast(table), "_word")
    return marked.where("shiftright(_bits, _bit) & 1 = 1").select(*held.columns)


def ilike_join(texts: DataFrame, rules: DataFrame, col: str, pattern: str) -> DataFrame:
    """Rows of ``texts`` beside every rule whose pattern their text fits, whatever the case.

    Each pattern is looked up by one n-gram of its literals: the one that is in the fewest
    texts, so common beginnings never decide. N-grams are counted without their texts. Distinct
    texts, moved for the n-grams that a pattern is looked up by, meet the patterns that share
    such an n-gram by an equality join, and ILIKE is tested on these pairs alone. Patterns of
    wildcards only are a condition on the length and join by it. Pairs are of distinct texts and
    patterns until the last join, whose rows are not moved again. The rows are those of a
    nested loop over all pairs. NULL texts and patterns fit nothing; names must differ.
    """
    names = list(rules.columns)
    rule = rules.where(F.col(pattern).isNotNull()).select(F.struct(*names).alias("_rule"), F.col(pattern).alias("_like"))
    patterns = rule.select("_like").distinct().withColumn("_runs", _literals(F.col("_like")))
    longest = F.array_max(F.transform("_runs", lambda r: F.length(r)))
    size = F.least(F.coalesce(longest, F.lit(0)), F.lit(GRAM))
    patterns = patterns.withColumn("_size", size)
    grams = F.array_distinct(F.flatten(F.transform("_runs", lambda r: _grams(r, F.col("_size")))))
    asked = patterns.where("_size > 0").select("_like", "_size", F.explode(grams).alias("_gram"))
    seen = texts.where(F.col(col).isNotNull()).select(F.col(col).alias("_text")).distinct()
    sizes = [r[0] for r in asked.select("_size").distinct().collect()]
    every = F.array(*[_grams(F.lower("_text"), F.lit(n)) for n in sizes]) if sizes else F.array().cast("array<array<string>>")
    held = seen.select("_text", F.explode(F.flatten(every)).alias("_gram"))
    # counted before they meet the asked ones: a gram is moved once a task then, not once a text
    count = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    key = cut_lineage(asked.join(count, "_gram", "left")
                      .groupBy("_like").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_k"))
                      .select("_like", F.col("_k._gram").alias("_gram")))
    # a text with its grams, or with the patterns it fits, shrinks much when written: the size on disk
    # must not have it broadcast
    fits = _looked_up(held, key).join(key.hint("merge"), "_gram").where("_text ILIKE _like").select("_text", "_like")
    fits = fits.unionByName(_by_length(seen, patterns.where("_size = 0")))
    # the rules come last: what they make of the pairs is as large as the result and is not moved
    near = texts.join(fits.hint("merge"), texts[col] == fits["_text"]).drop("_text")
    return near.join(rule.hint("merge"), "_like").select(*texts.columns, "_rule.*")


def _by_length(seen: DataFrame, patterns: DataFrame) -> DataFrame:
    """Texts and the patterns of wildcards only that they fit: so many characters, or more with a ``%``."""
    least = F.length(F.regexp_replace("_like", "%", ""))
    most = F.when(F.col("_like").contains("%"), F.lit(1 << 31)).otherwise(least + 1)
    ranges = patterns.select("_like", least.cast("bigint").alias("_low"), most.cast("bigint").alias("_high"))
    sized = seen.withColumn("_length", F.length("_text").cast("bigint"))
    return interval_join(sized, ranges, "_length", "_low", "_high").select("_text", "_like")
