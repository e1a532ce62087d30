"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from crashlake.llm.common import WORD, maybe_asked, ship, store, text_of, unused
from crashlake.llm.components import components
from crashlake.llm.words import grams, mix, slices, word_hashes

#: Places that the first permutation sends shingles to; bands and rows of the signature. A pair
#: of similarity 0.8 shares no band once in 300,000 times.
PLACES, BANDS, ROWS = 1 << 22, 32, 5
#: Further members of a band's largest component that the sets outside it are held against
#: before the exact join.
TURNS = 2
#: Partners that a star's centre is sent to at once.
STAR = 1000
SKETCH = "doc_id long, text_key long, n_shingles long, set_id binary, bands array<long>"


@cache
def circle() -> np.ndarray:
    """The second permutation of the places, continued over its start.

    Row s of this view holds what all shifts of the permutation give for place s, so a
    signature is the minimum of rows and no further hash is computed.
    """
    order = np.random.default_rng(20).permutation(PLACES).astype(np.uint32)
    size = BANDS * ROWS
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:size]]), size)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text; the whole sequence is one where words are few."""
    for low, high in slices(texts):
        hashes, at = word_hashes(texts[low:high])
        for i in range(high - low):
            own = hashes[at[i]:at[i + 1]]
            yield np.unique(grams(own, min(words, len(own)))) if len(own) else own


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum over the shingles of every shift of the second permutation, in blocks of rows."""
    places = (mix(shingles + np.uint64(1)) >> np.uint64(64 - 22)).astype(np.int64)
    best = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for low in range(0, len(places), 4096):
        np.minimum(best, circle()[places[low:low + 4096]].min(axis=0), out=best)
    return best


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One key for each band of each signature; the band's number is part of it."""
    parts = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x100000001B3) + parts[:, :, r])
    return keys.view(np.int64)


def sketcher(words: int):
    def sketch(batches):
        for batch in batches:
            sizes, ids, sigs = [], [], []
            for s in shingle_sets(batch["text"], words):
                sizes.append(len(s))
                ids.append(np.array([np.bitwise_xor.reduce(mix(s)), mix(s * np.uint64(3) + np.uint64(len(s))).sum()]).tobytes()
                           if len(s) else None)
                sigs.append(signature(s) if len(s) else np.zeros(BANDS * ROWS, np.uint32))
            if not sizes:
                continue
            keys = band_keys(np.stack(sigs)).ravel()
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * BANDS), pa.array(keys))
            yield pa.record_batch([batch["doc_id"], batch["text_key"], pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                                   bands], ["doc_id", "text_key", "n_shingles", "set_id", "bands"])
    return sketch


def set_writer(words: int):
    def write(batches):
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch["text"], words)]
            if sets:
                yield pa.record_batch([batch["set_id"], pa.array(sets, pa.binary())], ["set_id", "shingles"])
    return write


def verifier(percent: int):
    def verify(batches):
        """Members of stars, each star led by its centre, -> pairs that share ``percent`` hundredths of their union."""
        name, left = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep, sets, centre, stars = np.zeros(batch.num_rows, bool), batch["shingles"], batch["centre"].to_pylist(), batch["a"].to_pylist()
            for i in range(batch.num_rows):
                right = np.frombuffer(sets[i].as_buffer(), np.uint64)
                if centre[i]:
                    name, left = stars[i], right.copy()
                    continue
                assert name == stars[i]
                n, m = len(left), len(right)
                if 100 * min(n, m) >= percent * max(n, m):
                    both = np.concatenate([left, right])
                    both.sort(kind="stable")
                    same = int((both[1:] == both[:-1]).sum())
                    keep[i] = 100 * same >= percent * (n + m - same)
            yield pa.record_batch([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep))
    return verify


def near_groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Return doc_id, text_key, n_shingles and label, that of its component, for every row.

    Documents are linked when the sets of their ``words``-word shingles share ``percent``
    hundredths of their union; texts with fewer words have their whole sequence as the one
    shingle. ``text_key`` is the hash of the text; the label is null for texts without words.

    Rows of equal sets collapse to one set first, so exact copies cost one row. Sets that share
    a band go in a star around the one that shares most bands, verified on full sets; then the
    sets outside a band's largest component are held against a few more of its members. A member
    that has met all others of the band that are not of its component leaves the band. Only
    bands that still hold several components go on, to an exact prefix-filtered join:
    a set's rarest shingles, as many as any partner must meet, are joined, and each group sends
    the sets outside its largest component against the rest. So a group of near copies costs a
    row for each of its members, and no band is capped.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key"), "text")
    sketches = store(source.mapInArrow(sketcher(words), SKETCH), "sketches")
    sets = sketches.where("n_shingles > 0").groupBy("set_id").agg(F.first("bands").alias("bands"))
    members = sets.select("set_id", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("k")).where("k > 1")
    members = store(members.join(shared, "band"), "bands")
    weight = members.groupBy("set_id").agg(F.sum("k").alias("weight"))
    holders = (sketches.where("n_shingles > 0").groupBy("set_id").agg(F.min(F.struct("doc_id", "text_key")).alias("h"))
               .join(weight.select("set_id"), "set_id").select("set_id", F.col("h.doc_id").alias("_id"), F.col("h.text_key").alias("_key")))
    full = store(_texts_of(source, holders, words), "sets")

    heads = members.join(weight, "set_id").groupBy("band").agg(F.max_by("set_id", F.struct("weight", "set_id")).alias("a"))
    around = store(members.join(heads, "band").where("set_id <> a"), "around")
    links = store(_verified(around.select("a", F.col("set_id").alias("b")), full, percent), "links")
    named = _named(around.where("k > 2"), components(links))
    for turn in range(TURNS):
        apart, pairs = _turn(named, turn)
        links = links.unionByName(store(_verified(pairs, full, percent, few=True), "links"))
        named = _named(apart, components(links))
    mixed = named.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("band")
    open_sets = store(named.join(mixed, "band").select("set_id", "label").distinct(), "open-sets")
    more = store(_verified(_prefix_pairs(open_sets, full, percent), full, percent, few=True), "more-links")
    label = components(links.unionByName(more))

    return (sketches.join(label, sketches.set_id == label.node, "left")
            .select("doc_id", "text_key", "n_shingles", F.coalesce("label", "set_id").alias("label")))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Return doc_id, n_shingles, component_id and kept for every row.

    component_id is the smallest doc_id that a document reaches by links of ``near_groups``.
    Texts without words are linked with nothing and kept; null is empty. Null doc_ids take
    part; a component of null ids alone has component_id null. kept is doc_id = component_id,
    where two nulls are equal. Other columns are not read; an empty table gives no rows.
    """
    rows = near_groups(docs, words, percent)
    least = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return (rows.join(least, "label", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows and columns of ``docs`` without all but one of each group of near-duplicates.

    The row with the smallest doc_id, then text hash, stays; null ids come last. A row that is
    repeated with the same doc_id and text stays once. Texts without words all stay.
    """
    rows = store(near_groups(docs, words, percent), "groups").where("label IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = rows.groupBy("label").agg(F.min(order).alias("f")).select("label", F.col("f.doc_id").alias("_id"), F.col("f.text_key").alias("_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    marked = rows.join(first, "label").withColumn("same", same)
    i, k, own, key = unused(docs, "_id", "_key", "_own", "_own_key")
    gone = store(marked.where("NOT same").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "gone")
    keyed = docs.withColumns({own: F.col("doc_id").cast("long"), key: F.xxhash64(text_of(docs.text))})
    maybe, sure = _maybe(keyed, gone, own, key)
    gone = gone.toDF(i, k)
    left = sure.unionByName(maybe.join(gone, F.col(own).eqNullSafe(F.col(i)) & (F.col(key) == F.col(k)), "left_anti")).drop(own, key)
    if marked.where("same").groupBy("label").count().where("count > 1").isEmpty():
        return left
    named = left.withColumn(k, F.xxhash64(text_of("text")))
    bare = named.where(~F.coalesce(F.col("text"), F.lit("")).rlike(WORD))
    return named.where(F.col("text").rlike(WORD)).dropDuplicates(["doc_id", k]).unionByName(bare).drop(k)


def _named(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(set_id, band, label) of all members; a set without links is its own label."""
    return store(members.join(labels, members.set_id == labels.node, "left")
                 .select("band", "set_id", F.coalesce("label", "set_id").alias("label")), "named")


def _turn(named: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Members of bands with several components but one of the largest, and the pairs of that one and the sets outside its component.

    With these pairs the one has met all that the band may still link it to, so it is left out.
    """
    sides = named.groupBy("band", "label").agg(F.count("*").alias("k"), F.max_by("set_id", F.xxhash64("set_id", F.lit(turn))).alias("a"))
    main = (sides.groupBy("band").agg(F.max_by(F.struct("label", "a"), F.struct("k", "label")).alias("m"), F.count("*").alias("labels"))
            .where("labels > 1").select("band", "m.*").withColumnRenamed("label", "main"))
    apart = store(named.join(main, "band").where("set_id <> a"), "apart")
    return apart.select("band", "set_id"), apart.where("label <> main").select("a", F.col("set_id").alias("b"))


def _maybe(rows: DataFrame, keys: DataFrame, doc_id: str, text_key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of which the keys (_id, _key) may hold the document, and those of which they surely do not."""
    return maybe_asked(rows, keys.select("_id", "_key"), [doc_id, text_key])


def _texts_of(source: DataFrame, holders: DataFrame, words: int) -> DataFrame:
    """set_id and its shingles, computed from the text of one document that has the set."""
    holders = store(holders, "holders")
    asked, _ = _maybe(source, holders, "doc_id", "text_key")
    texts = (asked.join(holders, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
             .select("set_id", "text").dropDuplicates(["set_id"]))  # a text is less to move than its set
    return texts.mapInArrow(set_writer(words), "set_id binary, shingles binary")


def _verified(pairs: DataFrame, full: DataFrame, percent: int, few: bool = False) -> DataFrame:
    """The pairs (a, b) whose sets share enough, as stars around a.

    The names that are asked for are written first: where they are few, Spark sends them to
    the sets, and only sets that are asked for are moved; ``few`` says that many sets are not, whom a
    table of bits then keeps in place. A centre goes once to each thousand of its
    partners, which follow it, so a hot star is many tasks and its set is not repeated by pair.
    """
    pairs = store(pairs.distinct(), "pairs")
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("int").alias("parts"))
    members = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b", F.lit(False).alias("centre"))
    centres = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("b"), F.lit(True).alias("centre"))
    asked = store(members.unionByName(centres), "asked")
    full = maybe_asked(full, asked.select("b"), ["set_id"])[0] if few else full
    return (asked.join(full, F.col("b") == F.col("set_id")).select("a", "part", "b", "centre", "shingles")
            .repartition("a", "part").sortWithinPartitions("a", "part", F.desc("centre"))
            .select("a", "b", "centre", "shingles").mapInArrow(verifier(percent), "a binary, b binary"))


def _prefix_pairs(open_sets: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """All pairs of open sets of different labels that may reach ``percent``, without repeats."""
    def unpack(batches):
        for batch in batches:
            raw = [np.frombuffer(x.as_buffer(), np.int64) for x in batch["shingles"]]
            if raw:
                at = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int32)
                yield pa.record_batch([batch["set_id"], batch["label"], pa.ListArray.from_arrays(at, np.concatenate(raw))],
                                      ["set_id", "label", "shingles"])

    full, _ = maybe_asked(full, open_sets.select("set_id"), ["set_id"])
    rows = (open_sets.join(full, "set_id").select("set_id", "label", "shingles")
            .mapInArrow(unpack, "set_id binary, label binary, shingles array<long>")
            .select("set_id", "label", F.size("shingles").alias("n"), F.explode("shingles").alias("s")))
    seen = rows.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    # shingles that one set alone has come first in the order of rarity: they meet nobody
    order = Window.partitionBy("set_id").orderBy("df", "s")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    shared = (rows.join(seen, "s").withColumn("place", F.row_number().over(order))
              .withColumn("alone", F.col("n") - F.count("*").over(Window.partitionBy("set_id")))
              .withColumn("place", F.col("alone") + F.col("place"))
              .where(F.col("place") <= prefix).select("s", "set_id", "label", "n", "place"))
    shared = store(shared, "prefixes")
    most = (shared.groupBy("s", "label").agg(F.count("*").alias("k"))
            .groupBy("s").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.count("*").alias("labels"))
            .where("labels > 1").select("s", "main"))
    shared = shared.join(most, "s")
    left = shared.where("label <> main").select("s", F.col("set_id").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("place").alias("pa"))
    right = shared.select("s", F.col("set_id").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("place").alias("pb"), "main")
    # sets of these sizes must share so many shingles, and so meet in shorter prefixes
    need = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))
    fits = (F.col("pa") <= F.col("na") - need + 1) & (F.col("pb") <= F.col("nb") - need + 1)
    return (left.join(right, "s").where((F.col("la") != F.col("lb")) & ((F.col("lb") == F.col("main")) | (F.col("a") < F.col("b"))) & fits)
            .select("a", "b").distinct())
