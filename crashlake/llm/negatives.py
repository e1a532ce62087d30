"""Hard negatives by exact inner-product search: length buckets, coordinate pruning, verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from crashlake.llm.common import shared_path, ship, store

#: Components become floor(SCALE * x).
SCALE = 256
#: Bytes of a bucket's vectors, as 16-bit numbers; bytes of a block of anchors, as doubles.
BUCKET_BYTES, BLOCK_BYTES = 1 << 17, 1 << 22
#: Coordinates of an anchor that prune, its largest ones; anchors scored against a bucket at once.
FOCUS, TILE = 3, 1024
#: A candidate list longer than this share of its bucket is verified as the whole bucket.
SPARSE = 0.125
#: Stands for a null vec_id: last among ties.
NO_ID = np.iinfo(np.int64).max
BUCKETS = "part int, seq int, label long, dims int, longest double, ids binary, kind string, vectors binary"


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label (moved on by one of ten where 7 divides vec_id) and vec of rows that take part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    id_, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    return rows.where(label.isNotNull() & x.isNotNull() & fine).select(
        id_.alias("vec_id"), F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        x.cast("array<double>").alias("vec"))


def _bucketer(dims: int):
    def build(batches):
        """Rows of a part in the order of label and falling length -> buckets of one label."""
        size = max(64, BUCKET_BYTES // (2 * max(dims, 1)))
        key, held, seq = None, [], 0

        def bucket():
            ids = np.array([NO_ID if h[0] is None else h[0] for h in held], np.int64)
            vectors = np.zeros((len(held), dims))
            for row, (_, v) in zip(vectors, held):
                row[:len(v)] = np.floor(np.array(v, float) * SCALE)
            kind = "<i2" if np.abs(vectors).max(initial=0) < 1 << 15 else "<f8"
            return pa.record_batch([
                pa.array([key[0]], pa.int32()), pa.array([seq], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([dims], pa.int32()),
                pa.array([float(np.sqrt((vectors * vectors).sum(1)).max())]), pa.array([ids.tobytes()], pa.binary()), pa.array([kind]),
                pa.array([vectors.astype(kind).tobytes()], pa.binary())],
                ["part", "seq", "label", "dims", "longest", "ids", "kind", "vectors"])

        for batch in batches:
            for part, label, id_, vec in zip(*[batch[c].to_pylist() for c in ("part", "label", "vec_id", "vec")]):
                if held and ((part, label) != key or len(held) == size):
                    yield bucket()
                    held, seq = [], seq + 1
                key = (part, label)
                held.append((id_, vec))
        if held:
            yield bucket()
    return build


def bucketed(rows: DataFrame, name: str, dims: int) -> DataFrame:
    """Length buckets: rows of one label that follow each other by falling length, packed."""
    ship(rows.sparkSession)
    length = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v)
    order = [F.col("label"), F.col("length").desc(), F.col("vec_id").asc_nulls_last()]
    sorted_ = rows.withColumn("length", length).repartitionByRange(*order).sortWithinPartitions(*order)
    packed = sorted_.select(F.spark_partition_id().alias("part"), "label", "vec_id", "vec")
    return store(packed.mapInArrow(_bucketer(dims), BUCKETS), name)


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """ids and vectors of a bucket."""
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["vectors"], row["kind"]).astype(float).reshape(len(ids), row["dims"])


class Bucket:
    """Vectors of a bucket, and for a coordinate the list of its rows in the order of its unit values."""

    def __init__(self, row: dict):
        self.ids, self.vectors = unpack(row)
        self.longest, self.lists = row["longest"], {}
        lengths = np.sqrt((self.vectors * self.vectors).sum(1))
        self.unit = self.vectors / np.where(lengths > 0, lengths, 1)[:, None]

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = (order, self.unit[order, f])
        return self.lists[f]


class Anchors:
    """A block of anchors, what they look for, and the best found so far.

    Group g of anchor a looks for its first ``k`` rows with a score from low[a, g] to high[a, g],
    of its own label (``same``) or of any other; ties go to the smaller id.
    """

    def __init__(self, ids, labels, vectors, low, high, same: bool, k: int):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.low, self.high, self.same, self.k = low, high, same, k
        self.lengths = np.sqrt((vectors * vectors).sum(1))
        self.unit = vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        focus = min(FOCUS, vectors.shape[1])
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :focus]
        self.scores = np.full((*low.shape, k), -np.inf)
        self.found = np.full((*low.shape, k), NO_ID, np.int64)

    def least(self) -> np.ndarray:
        """The score below which nothing can enter a group."""
        return np.maximum(self.low, self.scores[:, :, -1])

    def ask(self, bucket: Bucket, label: int) -> None:
        """Look through one bucket."""
        wants = ((self.labels == label) == self.same) & (self.low <= self.high).any(1)
        at = np.flatnonzero(wants)
        for i in range(0, len(at), TILE):
            self._ask_tile(bucket, at[i:i + TILE])

    def _ask_tile(self, bucket: Bucket, at: np.ndarray) -> None:
        least = self.least()[at]
        floor = np.where(self.low[at] <= self.high[at], least, np.inf).min(1)
        # a row of the bucket needs at least this cosine: rows and anchors are no longer than their lengths
        reach = self.lengths[at] * bucket.longest
        cosine = np.where(floor <= 0, -1.0, floor / np.where(reach > 0, reach, 1) - 1e-9)
        near = cosine <= 1
        at, cosine = at[near], cosine[near]
        begin, end, lower, upper = self._feasible(bucket, at, cosine)
        width = end - begin
        short = np.argmin(width, axis=1) if width.size else np.zeros(len(at), int)
        n = width[np.arange(len(at)), short] if width.size else np.full(len(at), len(bucket.ids))
        sparse = n <= SPARSE * len(bucket.ids)
        for j in np.flatnonzero(sparse & (n > 0)):
            a, f = at[j], short[j]
            rows = bucket.sorted_list(int(self.focus[a, f]))[0][begin[j, f]:end[j, f]]
            values = bucket.unit[rows[:, None], self.focus[a]]
            rows = rows[((values >= lower[j]) & (values <= upper[j])).all(1)]
            if len(rows):
                self._take(np.array([a]), bucket.ids[rows], self.vectors[a:a + 1] @ bucket.vectors[rows].T)
        dense = at[~sparse]
        if len(dense):
            self._take(dense, bucket.ids, self.vectors[dense] @ bucket.vectors.T)

    def _feasible(self, bucket: Bucket, at: np.ndarray, cosine: np.ndarray):
        """Ranges of the focus coordinates' sorted lists, and their values, that may hold a row of the cosine.

        Two unit vectors of cosine t or more whose one coordinate is q and p have
        p within q t +- sqrt((1 - t^2) (1 - q^2)); p may be anything up to 1 once t <= q.
        """
        t, focus = cosine[:, None], self.focus[at]
        q = self.unit[at[:, None], focus]
        spread = np.sqrt(np.clip(1 - t * t, 0, 1) * np.clip(1 - q * q, 0, 1)) + 1e-9
        lower = np.where((t <= -1) | (t <= -q), -2.0, q * t - spread)
        upper = np.where((t <= -1) | (t <= q), 2.0, q * t + spread)
        begin, end = np.zeros(focus.shape, int), np.full(focus.shape, len(bucket.ids))
        bounded = (lower > -2) | (upper < 2)
        for f in np.unique(focus[bounded]):
            mine = (focus == f) & bounded
            values = bucket.sorted_list(int(f))[1]
            begin[mine] = np.searchsorted(values, lower[mine], "left")
            end[mine] = np.maximum(np.searchsorted(values, upper[mine], "right"), begin[mine])
        return begin, end, lower, upper

    def _take(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Merge exact scores of anchors ``at`` against rows ``ids`` into the best found."""
        for g in range(self.low.shape[1]):
            last, last_id = self.scores[at, g, -1], self.found[at, g, -1]
            floor = np.maximum(self.low[at, g], last)
            a, r = np.nonzero((scores >= floor[:, None]) & (scores <= self.high[at, g][:, None]))
            s = scores[a, r]
            keep = ((s > last[a]) | (ids[r] < last_id[a]) | np.isneginf(last[a])) & (ids[r] != self.ids[at[a]])
            a, r, s = a[keep], r[keep], s[keep]
            if not len(a):
                continue
            hit = np.unique(a)
            a = np.concatenate([a, np.repeat(hit, self.k)])
            s = np.concatenate([s, self.scores[at[hit], g].ravel()])
            i = np.concatenate([ids[r], self.found[at[hit], g].ravel()])
            order = np.lexsort((i, -s, a))
            a, s, i = a[order], s[order], i[order]
            place = np.arange(len(a)) - np.searchsorted(a, a)
            best = place < self.k
            self.scores[at[a[best]], g, place[best]] = s[best]
            self.found[at[a[best]], g, place[best]] = i[best]

    def result(self) -> pa.RecordBatch:
        a, g, k = np.nonzero(self.scores > -np.inf)
        ids = self.found[a, g, k]
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(g, pa.int32()), pa.array(self.scores[a, g, k]).cast(pa.int64(), safe=False),
                                pa.array(ids, pa.int64(), mask=ids == NO_ID)], ["anchor", "goal", "score", "id"])


def _searcher(block):
    def search(batches):
        """Buckets -> the best of this task for every anchor and group."""
        anchors = Anchors(*block.value)
        for batch in batches:
            for row in batch.to_pylist():
                anchors.ask(Bucket(row), row["label"])
        yield anchors.result()
    return search


def _first(buckets: DataFrame, block: tuple) -> DataFrame:
    """The first k rows of every group of a block: each task's best, then the best of those."""
    shipped = buckets.sparkSession.sparkContext.broadcast(block)
    found = buckets.mapInArrow(_searcher(shipped), "anchor long, goal int, score long, id long")
    order = Window.partitionBy("anchor", "goal").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= block[-1])


def _blocks(pages: DataFrame, dims: int):
    """Anchors by blocks of bounded size: (ids, labels, vectors); one block is on the driver at a time.

    Small parts are taken together, a large one is cut between its pages.
    """
    most = max(1, BLOCK_BYTES // (8 * max(dims, 1)))
    cut = max(1, most // max(64, BUCKET_BYTES // (2 * max(dims, 1))))
    wanted, parts, held = [], [], 0
    for part, n, rows in sorted(map(tuple, pages.groupBy("part").agg(F.max("seq") + 1, F.sum(F.octet_length("ids")) / 8).collect())):
        if rows > most:
            wanted += [(F.col("part") == part) & F.col("seq").between(low, low + cut - 1) for low in range(0, n, cut)]
            continue
        if held + rows > most:
            wanted.append(F.col("part").isin(parts))
            parts, held = [], 0
        parts, held = [*parts, part], held + rows
    if parts:
        wanted.append(F.col("part").isin(parts))
    for which in wanted:
        rows = pages.where(which).orderBy("part", "seq").collect()
        both = [unpack(r.asDict()) for r in rows]
        labels = np.concatenate([np.full(len(b[0]), r.label) for r, b in zip(rows, both)])
        yield np.concatenate([b[0] for b in both]), labels, np.concatenate([b[1] for b in both])


def hard_negatives(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95) -> DataFrame:
    """For each anchor and each of its positives, the first rows of other labels whose score is
    from ``low`` to ``high`` hundredths of the positive's.

    Anchors are the rows whose vec_id ``every`` divides; positives are an anchor's first other
    rows of its label. Scores are integer inner products of floor(256 x), higher ones first,
    ties by the smaller vec_id (null last). Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score; a pair with nothing in its range has no rows, and a positive
    of negative score has an empty range.

    Rows of a label are dealt to length buckets. A block of anchors is broadcast, at most
    ``BLOCK_BYTES`` of vectors, and all buckets look for it where they lie: a bucket too short
    to reach the least score still wanted is passed over; else each anchor's focus coordinates
    give a range of a sorted list each, the shortest list is cut by the other ranges, and its
    rows are scored exactly. Where ranges cut little, the whole bucket is scored, which gives the
    same rows. A task keeps its best ``positives`` or ``negatives`` a group, so nothing is
    shuffled but those.

    Rows with a null label or vector, or with a null or non-finite component, take no part. A
    shorter vector counts as filled up with zeros. Rows that share a vec_id are rows of their
    own, but never each other's positives. Scores are exact below 2**53. Other columns are not
    read; an empty table, or one without anchors, gives no rows.
    """
    spark = rows.sparkSession
    known = usable(rows)
    dims = known.agg(F.max(F.size("vec"))).first()[0] or 0
    buckets = bucketed(known, "buckets", dims)
    pages = bucketed(known.where(F.col("vec_id") % every == 0), "anchors", dims)
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    path = shared_path(spark, "negatives")
    spark.createDataFrame([], schema).write.parquet(path)
    for ids, labels, vectors in _blocks(pages, dims):
        shape = (len(ids), 1)
        mine = buckets.where(F.col("label").isin(np.unique(labels).tolist()))
        found = _first(mine, (ids, labels, vectors, np.full(shape, -np.inf), np.full(shape, np.inf), True, positives)).toArrow()
        anchor, place = found["anchor"].to_numpy(), found["rank"].to_numpy() - 1
        score = np.zeros((len(ids), positives), np.int64)
        lows, highs = np.full(score.shape, np.inf), np.full(score.shape, -np.inf)
        score[anchor, place] = found["score"].to_numpy()
        lows[anchor, place] = -(-low * score[anchor, place] // 100)
        highs[anchor, place] = high * score[anchor, place] // 100
        names = spark.createDataFrame(pa.table({"anchor": found["anchor"], "goal": pa.array(place, pa.int32()),
                                                "anchor_id": pa.array(ids[anchor]), "positive_id": found["id"],
                                                "positive_score": found["score"]}))
        (_first(buckets, (ids, labels, vectors, lows, highs, False, negatives)).join(names, ["anchor", "goal"])
         .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                 "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path))
    return spark.read.schema(schema).parquet(path)
