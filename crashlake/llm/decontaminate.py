"""Benchmark decontamination by spaced seeds and substitution-tolerant verification."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crashlake.llm.common import ship, store, text_of, unused
from crashlake.llm.words import ALNUM, mix, slices, word_hashes

#: Seeds: six words in a row; six of eight, every third ignored; six of eleven, every second
#: ignored. A word replaced every two or three words still leaves one of them whole.
MASKS = ("111111", "11011011", "10101010101")
#: Matching words that make an overlap: this many, or this share of a shorter item, but never
#: fewer than LEAST; share of an overlap's words that match.
WORDS, SHARE, LEAST, IDENTITY = 13, 0.8, 8, 0.8
#: Bits of the filter that documents' seeds pass before the join, and probes in it. Its size is
#: fixed; with more seeds it lets more through, and the join decides.
FILTER_BITS, PROBES = 24, 3


def seeds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every seed of every mask."""
    out, at = [], []
    for k, mask in enumerate(MASKS):
        n = len(hashes) - len(mask) + 1
        if n > 0:
            total = np.full(n, k + 1, np.uint64)
            for i, used in enumerate(mask):
                if used == "1":
                    total = mix(total * np.uint64(31) + hashes[i:i + n])
            out.append(total)
            at.append(np.arange(n))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(at)


def _documents(batch):
    texts = batch["text"]
    for low, high in slices(texts):
        hashes, at = word_hashes(texts[low:high], ALNUM)
        for i in range(high - low):
            yield low + i, hashes[at[i]:at[i + 1]]


def _item_words(batches):
    for batch in batches:
        rows = [(i, h.tobytes(), *seeds(h)) for i, h in _documents(batch)]
        lists = pa.array([r[2].view(np.int64) for r in rows], pa.list_(pa.int64()))
        places = pa.array([r[3] for r in rows], pa.list_(pa.int64()))
        yield pa.record_batch([batch["item_id"].cast(pa.int64()), pa.array([r[1] for r in rows], pa.binary()), lists, places],
                              ["item_id", "item_words", "seeds", "places"])


def _finder(bits):
    def find(batches):
        """Documents of which a seed passes the filter, with these seeds and all word hashes."""
        held = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            rows, words, found, at = [], [], [], []
            for i, h in _documents(batch):
                s, p = seeds(h)
                hit = np.ones(len(s), bool)
                for k in range(PROBES):
                    slot = (s >> np.uint64(13 * k)) & np.uint64((1 << FILTER_BITS) - 1)
                    hit &= (held[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if hit.any():
                    rows.append(i)
                    words.append(h.tobytes())
                    found.append(s[hit].view(np.int64))
                    at.append(p[hit])
            if rows:
                few = batch.select(["doc_id", "text_key"]).take(pa.array(rows))
                yield pa.record_batch([few["doc_id"], few["text_key"], pa.array(words, pa.binary()),
                                       pa.array(found, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int64()))],
                                      ["doc_id", "text_key", "words", "seeds", "places"])
    return find


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """First document word, length and matching words of the best stretch on a diagonal.

    A match counts 1 and a mismatch -3; the stretch with the largest sum is taken.
    """
    low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if high <= low:
        return 0, 0, 0
    same = doc[low + diagonal:high + diagonal] == item[low:high]
    sums = np.concatenate([[0], np.cumsum(np.where(same, 1, -3))])
    best = sums - np.minimum.accumulate(sums)
    end = int(best.argmax())
    start = int(sums[:end + 1].argmin())
    return low + diagonal + start, end - start, int(same[start:end].sum())


def _verify(batches):
    for batch in batches:
        out = []
        for row in zip(*[batch[c].to_pylist() for c in ("doc_id", "text_key", "item_id", "diagonal", "words", "item_words")]):
            item = np.frombuffer(row[5], np.uint64)
            start, n, matched = overlap(np.frombuffer(row[4], np.uint64), item, row[3])
            if matched >= max(LEAST, min(WORDS, math.ceil(SHARE * len(item)))) and matched >= IDENTITY * n:
                out.append((*row[:3], start, n, matched))
        if out:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)],
                                  ["doc_id", "text_key", "item_id", "first_word", "n_words", "n_matched"])


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Return doc_id, text_key, item_id, first_word, n_words and n_matched of every overlap.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lowered. Seeds of all
    masks at every word of both tables are joined by hash; documents' seeds first pass a fixed
    bit filter of the benchmark's. Every (document, item, diagonal) with a common seed is then
    compared word by word, and the best stretch of a document and item is returned when enough
    of it matches. ``text_key`` is the hash of the text; equal rows give one result.

    Items of fewer than ``LEAST`` words, null and empty texts overlap nothing. Null doc_ids are
    kept as they are; items with null item_id are not looked for. Other columns are not read;
    empty tables give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    items = store(benchmark.where("item_id IS NOT NULL").select("item_id", "text").mapInArrow(
        _item_words, "item_id long, item_words binary, seeds array<long>, places array<long>"), "items")
    zipped = lambda df, *keep: df.select(*keep, F.explode(F.arrays_zip("seeds", "places")).alias("s"))
    item_seeds = zipped(items, "item_id").select("item_id", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_at"))
    slots = item_seeds.select(F.explode(F.array(*[
        F.shiftrightunsigned("seed", 13 * k).bitwiseAND((1 << FILTER_BITS) - 1) for k in range(PROBES)])).alias("slot"))
    cells = (slots.groupBy(F.shiftright("slot", 3).alias("cell"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("slot").bitwiseAND(7).cast("int"))).alias("bits")))
    held = np.zeros(1 << (FILTER_BITS - 3), np.uint8)  # at most this many rows arrive
    for cell, bits in cells.collect():
        held[cell] = bits
    find = _finder(spark.sparkContext.broadcast(held.tobytes()))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key"), "text")
    found = store(own.mapInArrow(find, "doc_id long, text_key long, words binary, seeds array<long>, places array<long>"), "seeded")
    hits = zipped(found, "doc_id", "text_key").select("doc_id", "text_key", F.col("s.seeds").alias("seed"), F.col("s.places").alias("at"))
    pairs = (hits.join(item_seeds, "seed").select("doc_id", "text_key", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal"))
             .distinct())
    texts = (found.groupBy("doc_id", "text_key").agg(F.first("words").alias("words"))
             .withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}))
    checked = (pairs.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
               .join(items.select("item_id", "item_words"), "item_id")
               .select("doc_id", "text_key", "item_id", "diagonal", "words", "item_words")
               .mapInArrow(_verify, "doc_id long, text_key long, item_id long, first_word long, n_words long, n_matched long"))
    best = F.max_by(F.struct("first_word", "n_words", "n_matched"), F.struct("n_matched", -F.col("first_word")))
    return checked.groupBy("doc_id", "text_key", "item_id").agg(best.alias("b")).select("doc_id", "text_key", "item_id", "b.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` that overlap no item of the benchmark."""
    i, k = unused(docs, "_id", "_key")
    leaks = store(find_leaks(docs, benchmark).select(F.col("doc_id").alias(i), F.col("text_key").alias(k)).distinct(), "leaks")
    return docs.join(leaks, docs.doc_id.eqNullSafe(F.col(i)) & (F.xxhash64(text_of(docs.text)) == F.col(k)), "left_anti")
