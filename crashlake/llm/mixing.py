"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from crashlake.llm.common import n_words, store, text_of, unused

#: Weights by the rank of a source, repeating; share of all sizes; most passes over a source.
WEIGHTS, SHARE, PASSES = (5, 2, 1), 1.5, 2
#: Finish times are cut into this many stretches a unit for the running total.
STRETCHES = 4096


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(source, source_size) -> with target: the words the mix takes of each source.

    Sources weigh ``weights`` by code point, null last. No target exceeds ``passes`` times its
    source's size; what is cut off goes to the others by weight until none is above. That is
    water filling: in ascending order of limit / weight, sources are at their limit up to the
    first whose share of what is left stays below it. One row a source is all that is sorted.
    """
    every = Window.partitionBy()
    ranked = (sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
              .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                 (F.col("place") % len(weights) + 1).cast("int")))
              .withColumn("most", F.col("source_size") * float(passes))
              .withColumn("budget", F.sum("source_size").over(every) * float(share)))
    order = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    cut = ranked.withColumn("full", F.col("most") <= F.col("weight") * level)
    left = (F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(every), F.lit(0.0)))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    return cut.select("source", "source_size",
                      F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * left / open_weight)
                      .alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES,
        seed: str = "mix") -> DataFrame:
    """Return doc_id, source, size, source_size, target, taken and finish for every document.

    The documents of a source are shuffled by the md5 of the seed and their doc_id. A document
    finishes when its source has sent all words up to and with it, divided by the source's
    target; a second pass over a source starts when the first ends. All finish times of all
    sources are ordered, and the mix ends where its words reach the sum of the targets; every
    source then stands near finish time 1, its target, within about one document.

    Running totals are sums by (source, hash prefix) and by stretch of finish time, then
    windows inside those, so neither a large source nor the whole order meets in one task.
    Equal rows are counted first and each gets a turn of its own. Null texts and texts
    without words have size 0 and take 0; a null source is a source; a null doc_id is
    shuffled like an empty one, in order of size. An empty table gives no rows.
    ``finish`` is the time of the document's first turn, null with size 0.
    """
    rows = docs.select("doc_id", "source", n_words(text_of()).alias("size"))
    rows = (rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
            .withColumn("key", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
            .withColumn("part", F.substring("key", 1, 3)))
    rows = store(rows, "mix-rows")
    past = lambda *by, order: (Window.partitionBy(*by).orderBy(*order)
                               .rowsBetween(Window.unboundedPreceding, -1))
    words = F.col("n") * F.col("size")
    parts = rows.groupBy("source", "part").agg(F.sum(words).alias("words"))
    parts = parts.withColumn("head", F.coalesce(F.sum("words").over(past("source", order=["part"])), F.lit(0)))
    aims = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, passes)
    parts = (parts.alias("p").join(aims.alias("a"), F.col("p.source").eqNullSafe(F.col("a.source")))
             .select("p.source", "part", "head", "source_size", "target"))
    inside = past("source", "part", order=["key", "doc_id", "size"])
    placed = (rows.withColumn("done", F.coalesce(F.sum(words).over(inside), F.lit(0))).alias("r")
              .join(parts.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))
                    & (F.col("r.part") == F.col("p.part")))
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
              .select("doc_id", "r.source", "size", "source_size", "target", "key", "copy",
                      (F.col("head") + F.col("done") + F.col("copy") * F.col("size")).alias("sent")))
    turns = (placed.where("size > 0")
             .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
             .withColumn("finish", (F.col("turn") * F.col("source_size") + F.col("sent")) / F.col("target"))
             .withColumn("stretch", F.least(F.floor(F.col("finish") * STRETCHES), F.lit(4 * STRETCHES)))
             .select("doc_id", "source", "size", "source_size", "target", "key", "copy", "turn", "finish", "stretch"))
    turns = store(turns, "mix-turns")
    ends = turns.groupBy("stretch").agg(F.sum("size").alias("words"))
    ends = ends.withColumn("ahead", F.coalesce(F.sum("words").over(past(order=["stretch"])), F.lit(0))).drop("words")
    budget = aims.agg(F.sum("target")).first()[0] or 0.0
    upto = (Window.partitionBy("stretch").orderBy("finish", "key", "doc_id", "source", "size", "copy", "turn")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = (turns.withColumn("run", F.sum("size").over(upto)).join(ends, "stretch")
           .withColumn("sent", F.when(F.col("ahead") + F.col("run") <= F.lit(budget), F.col("size"))
                       .otherwise(F.lit(0))))
    same = ["doc_id", "source", "size", "source_size", "target"]
    took = run.groupBy(*same, "copy").agg(F.sum("sent").alias("taken"), F.min("finish").alias("finish")).drop("copy")
    empty = placed.where("size = 0").select(*same, F.lit(0).cast("long").alias("taken"),
                                            F.lit(None).cast("double").alias("finish"))
    return took.unionByName(empty)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    Rows that share doc_id, source and size share their turns evenly, rounded up. Order by
    ``mix(...)``'s finish to write the mix in its order.
    """
    turns = (mix(docs, **options).where("taken > 0").groupBy("doc_id", "source", "size")
             .agg(F.sum("taken").alias("taken"), F.count("*").alias("rows"))
             .select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
                     F.ceil(F.col("taken") / F.col("size") / F.col("rows")).cast("int").alias("_turns")))
    return (docs.alias("d").join(turns.alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t._id"))
                                 & F.col("d.source").eqNullSafe(F.col("t._source"))
                                 & (n_words(text_of("d.text")) == F.col("t._size")))
            .withColumn(*unused(docs, "_turn"), F.explode(F.sequence(F.lit(1), F.col("t._turns"))))
            .select("d.*"))
