"""License scans by diagonal voting over word grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from crashlake.llm.common import text_of


@dataclass(frozen=True)
class Template:
    """A license wording: ``exact`` ones count only where all words stand consecutively."""
    label: str
    words: str
    exact: bool = False


# fixed values: wordings of well-known licenses, in the words of their notices
TEMPLATES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
    Template("apache-notice", "licensed under the apache license version 2 0"),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are "
                         "permitted provided that the following conditions are met"),
    Template("cc-by-notice", "this work is licensed under a creative commons attribution license"),
    Template("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    Template("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    Template("gpl-text", "this program is free software you can redistribute it and or modify it under the terms of "
                         "the gnu general public license as published by the free software foundation"),
    Template("mit-notice", "released under the mit license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software "
                         "and associated documentation files the software to deal in the software without "
                         "restriction"),
)
#: Words of a gram; neighbouring diagonals so far apart are one place (words put in or left
#: out); share of a wording's grams that a place must hold. A gram's place is a bit of a mask,
#: so wordings have 64 words at most.
GRAM, BAND, SHARE, LONGEST = 2, 2, 0.7, 64
#: The gram table of the wordings is broadcast up to this many rows, and joined by key beyond.
BROADCAST_ROWS = 10_000
#: Hash of the row that every document has besides its grams, so that none is lost in the join.
OWN = -1


def words_of(text: Column) -> Column:
    """Lower-case words of letters, digits and any character beyond ASCII.

    ``lower`` also changes letters beyond ASCII; none of them becomes an ASCII letter once the
    Kelvin sign is out of the way, and they stay parts of words, so ASCII wordings see no
    difference from lowering A-Z alone.
    """
    lower = F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def grams_of_templates(spark, templates) -> DataFrame:
    rows = [("", False, 0, -1, None, None)]
    for t in templates:
        w = t.words.split()
        if not GRAM <= len(w) <= LONGEST:
            raise ValueError(f"{t.label}: a wording has {GRAM} to {LONGEST} words")
        rows += [(t.label, t.exact, len(w) - 1, i, w[i], w[i + 1]) for i in range(len(w) - 1)]
    frame = (spark.createDataFrame(rows, "label string, exact boolean, grams int, place int, a string, b string")
             .withColumn("hash", F.when(F.col("place") < 0, F.lit(OWN).cast("long")).otherwise(F.xxhash64("a", "b"))))
    return F.broadcast(frame) if len(rows) <= BROADCAST_ROWS else frame


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Return doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    Every gram of every document is joined by its hash to the places of the wordings that hold
    it, and its two words are compared. Matches vote for (document, wording, offset of the
    document's words to the wording's). An exact wording stands where a diagonal holds all its
    grams. For the others, diagonals at most ``BAND`` apart are merged, and a place is kept
    when the grams of the wording found there, each counted once, are ``SHARE`` of it.
    ``n_base``, ``first_word`` and ``last_word`` tell of exact wordings, ``labels`` of all;
    ``score`` is the share of the document's words that kept places cover, at most 1.

    Documents are told apart by doc_id and the hash of their text; equal rows are counted and
    dealt out again. Null and empty texts have 0 words, no labels and score 0; a null doc_id
    is kept; other columns are not read; an empty table gives no rows.
    """
    key = ["doc_id", "text_hash", "n_words"]
    words = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), words_of(text_of()).alias("words"))
    grams = words.select(
        "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), "words",
        F.posexplode(F.concat(F.array(F.lit(OWN).cast("long")),
                              F.zip_with("words", F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))),
                                         lambda a, b: F.xxhash64(a, b)))).alias("at", "hash"))
    table = grams_of_templates(docs.sparkSession, templates)
    same = (F.col("place") < 0) | ((F.get("words", F.col("at") - 1) == F.col("a")) & (F.get("words", F.col("at")) == F.col("b")))
    votes = (grams.join(table, "hash").where(same)
             .withColumn("diagonal", F.when(F.col("place") < 0, F.lit(0)).otherwise(F.col("at") - 1 - F.col("place")))
             .groupBy(*key, "label", "exact", "grams", "diagonal")
             .agg(F.count("*").alias("votes"),
                  F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest("place", F.lit(0)))).alias("mask"),
                  F.min("at").alias("low"), F.max("at").alias("high")))
    line = Window.partitionBy(*key, "label").orderBy("diagonal")
    merged = (votes
              .withColumn("new", F.when(F.col("exact") | F.col("label").eqNullSafe("")
                                        | (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(line), F.lit(-10**9)) > BAND),
                                        1).otherwise(0))
              .withColumn("place", F.sum("new").over(line))
              .groupBy(*key, "label", "exact", "grams", "place")
              .agg(F.sum("votes").alias("votes"), F.bit_or("mask").alias("mask"), F.min("low").alias("low"),
                   F.max("high").alias("high"), F.min("diagonal").alias("diagonal"))
              .withColumn("held", F.bit_count("mask") / F.col("grams")))
    own = F.col("label") == ""
    kept = merged.where(own | (F.col("exact") & (F.col("held") == 1)) | (~F.col("exact") & (F.col("held") >= SHARE)))
    base, start = F.col("exact") & ~own, F.col("diagonal").cast("long")
    labels = lambda found: F.concat_ws(",", F.array_sort(F.collect_set(F.when(found, F.col("label")))))
    found = (kept.groupBy(*key).agg(
        F.sum(F.when(own, F.col("votes"))).alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, start)).alias("first_word"), F.max(F.when(base, start)).alias("last_word"),
        labels(base).alias("base_labels"), labels(~own).alias("labels"),
        F.coalesce(F.sum(F.when(~own, F.col("high") - F.col("low") + GRAM)), F.lit(0)).alias("covered")))
    return (found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                    F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("covered").cast("double"), F.col("n_words")),
                                                   F.lit(0.0))).alias("score")))
