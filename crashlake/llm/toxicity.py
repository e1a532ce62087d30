"""Toxicity by a linear classifier of character n-grams, scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crashlake.llm.common import ship, store

#: Characters of an n-gram; hashed features; n-grams of a text that are hashed at once.
SIZES, BITS, BLOCK = (3, 4, 5), 20, 1 << 18
#: Most labelled rows of each class that the classifier is fitted on, by the hash of doc_id.
TOXIC_ROWS, CLEAN_ROWS = 3000, 6000
#: Texts a feature must be in, and standard deviations its count in toxic texts must lie from
#: what chance gives; smoothing, penalty, steps and step size of the fit.
LEAST_TEXTS, LEAST_Z, SMOOTHING, PENALTY, STEPS, RATE = 3, 4.0, 1.0, 1e-4, 60, 0.05


class Features:
    """Distinct hashed n-grams of texts, A-Z lowered, found with one table of last places."""

    def __init__(self):
        self.place = np.zeros(1 << BITS, np.int64)

    def of(self, text: str | None) -> np.ndarray:
        points = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
        parts = [self._distinct(points[low:low + BLOCK + max(SIZES) - 1]) for low in range(0, len(points), BLOCK)]
        if len(parts) < 2:
            return parts[0] if parts else np.zeros(0, np.uint32)
        return np.unique(np.concatenate(parts))

    def _distinct(self, points: np.ndarray) -> np.ndarray:
        found, total = [], np.zeros(len(points), np.uint32)
        for n in range(1, max(SIZES) + 1):
            if len(points) < n:
                break
            total = total[:len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1:]
            if n in SIZES:
                found.append(((total ^ (total >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n * 0x05EBCA6B)) >> np.uint32(32 - BITS))
        if not found:
            return np.zeros(0, np.uint32)
        all_ = np.concatenate(found)
        order = np.arange(len(all_))
        self.place[all_] = order
        return all_[self.place[all_] == order]


def fit(features: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of all features, and the bias, of a penalized logistic regression.

    The input of feature j is its log-count ratio: the log of the share of toxic texts that
    hold it over the share of clean ones, both smoothed so that a feature never seen has 0.
    Features whose counts chance explains are left out.
    Without both classes every weight is 0 and the bias is the prior's.
    """
    size, n = 1 << BITS, len(toxic)
    ones = int(toxic.sum())
    bias = float(np.log((ones + 0.5) / (n - ones + 1.5)))
    if not 0 < ones < n:
        return np.zeros(size, np.float32), bias
    bad, both = np.zeros(size), np.zeros(size)
    for f, y in zip(features, toxic):
        both[f] += 1
        bad[f] += y
    share = ones / n
    ratio = np.log((bad + SMOOTHING * share) / ones) - np.log((both - bad + SMOOTHING * (1 - share)) / (n - ones))
    chance = both * share
    z = (bad - chance) / np.sqrt(chance * (1 - share) + 1e-9)
    ratio[(both < LEAST_TEXTS) | (np.abs(z) < LEAST_Z)] = 0
    used = np.flatnonzero(ratio)
    place, scaled = np.full(size, -1, np.int32), ratio[used]
    place[used] = np.arange(len(used))
    kept = [p[p >= 0] for p in (place[f] for f in features)]
    rows, inverse = np.repeat(np.arange(n), [len(k) for k in kept]), np.concatenate(kept)
    weights, first, second = np.zeros(len(used)), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, STEPS + 1):
        line = np.bincount(rows, (weights * scaled)[inverse], n) + bias
        gap = (1 / (1 + np.exp(-np.clip(line, -30, 30))) - toxic) / n
        slope = np.append(np.bincount(inverse, gap[rows], len(used)) * scaled + PENALTY * weights, gap.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        step = RATE * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
        weights, bias = weights - step[:-1], bias - step[-1]
    out = np.zeros(size, np.float32)
    out[used] = weights * scaled
    return out, float(bias)


def _fitter(batches):
    """One task: the sample's features, and from them the weights."""
    own, features, toxic = Features(), [], []
    for batch in batches:
        features += [own.of(t) for t in batch["text"].to_pylist()]
        toxic += batch["toxic"].to_pylist()
    weights, bias = fit(features, np.array(toxic, np.int64))
    yield pa.record_batch([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])


def _scorer(model):
    def score(batches):
        weights, bias = model.value
        weights, own = np.frombuffer(weights, np.float32), Features()
        for batch in batches:
            lines = np.array([float(weights[own.of(t)].sum()) + bias for t in batch["text"].to_pylist()], float)
            scores = 1 / (1 + np.exp(-np.clip(lines, -700, 700)))
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(scores)], ["doc_id", "held_out", "score"])
    return score


def held_out(doc_id: str = "doc_id"):
    """Whether a document is in the fold that is never learned from; a null doc_id is."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame) -> tuple[bytes, float]:
    """Weights and bias, fitted on at most TOXIC_ROWS and CLEAN_ROWS labelled texts.

    The sample is the labelled doc_ids outside the held-out fold that come first by hash; a
    doc_id labelled twice counts as toxic if any label says so. Its list, bounded by these two
    parameters, is broadcast, so no text but the sample's is moved. The fit is one task.
    """
    known = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("order", F.xxhash64("doc_id")))
    toxic = known.where("toxic = 1").orderBy("order", "doc_id").limit(TOXIC_ROWS)
    clean = known.where("toxic <> 1").orderBy("order", "doc_id").limit(CLEAN_ROWS)
    sample = F.broadcast(toxic.unionByName(clean).select("doc_id", (F.col("toxic") == 1).cast("long").alias("toxic")))
    rows = store(docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "text", "toxic"), "labelled")
    model = (rows.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "toxic")
             .mapInArrow(_fitter, "weights binary, bias double").collect())
    return (bytes(model[0].weights), model[0].bias) if model else (bytes(4 << BITS), -1.0)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Return doc_id, held_out, score and predicted of every document.

    A text's distinct 3-, 4- and 5-grams of characters are hashed; its score is the logistic
    function of the sum of their weights. Empty and null texts score by the bias alone, which
    is the prior's; without toxic labels all do. Rows are scored one by one, so equal texts
    score alike; a null doc_id is kept and counts as held out; other columns are not read; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(train(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return (rows.mapInArrow(_scorer(model), "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
