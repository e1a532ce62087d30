"""Token files: ids of all documents in order, Huffman coded in independent blocks."""

from __future__ import annotations

import os
import zlib
from functools import cache
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from crashlake.llm.common import shared_path, ship, store, text_of
from crashlake.llm.huffman import BLOCK, Code, code_lengths

#: Ids of a chunk, the row of a file that holds whole documents; words kept in a worker's memory.
CHUNK, CACHED = 1 << 20, 600_000
#: New words that the tokenizer is given as one line; bytes of texts whose pieces are looked up together.
LINE, TOGETHER = 32, 1 << 23


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class Encoder:
    """Ids of texts by a tokenizer that splits at white space, each distinct word encoded once while it is kept.

    The tokenizer never joins text across white space, so a text's ids are those of its pieces.
    Arrow cuts texts into pieces and puts their ids in the place of each; Python sees a piece once
    a batch. A piece of letters with trailing ASCII punctuation is two words to the tokenizer.
    New words of letters alone go to it a line at a time, and their ids are told apart by the last
    token of each, which names the word's end; a line where that count is another goes word by word.
    The memory of both tables is bounded: they start anew when full.
    """

    def __init__(self, path: str, kind):
        self.tokenizer, self.kind, self.pieces, self.words = _tokenizer(path), np.dtype(kind), {}, {}
        vocabulary, suffix = self.tokenizer.get_vocab(with_added_tokens=True), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, self.kind).tobytes() for ids in self._ids(texts)]

    def _lines(self, words: list[str]) -> list[bytes]:
        """Ids of words that are letters alone."""
        out, size = [], self.kind.itemsize
        for low in range(0, len(words), 1 << 16):
            lines = [words[i:i + LINE] for i in range(low, min(len(words), low + (1 << 16)), LINE)]
            for line, ids in zip(lines, self._ids([" ".join(line) for line in lines])):
                ids = np.array(ids, self.kind)
                cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
                if len(cuts) == len(line) and cuts[-1] == len(ids):
                    raw = ids.tobytes()
                    out += [raw[size * a:size * b] for a, b in zip([0, *cuts], cuts)]
                else:
                    out += self._raw(line)
        return out

    def _learn(self, new: list[str]) -> None:
        # two lists and no pairs: the collector would follow every pair again and again
        cores, tails = [p.rstrip(punctuation) for p in new], [""] * len(new)
        for i, (p, core) in enumerate(zip(new, cores)):
            low = core.lower()
            if not low.isalpha():  # a capital may become a letter and a mark
                cores[i] = p
                continue
            if core.isascii():
                cores[i] = low
            if len(core) < len(p):
                tails[i] = p[len(core):]
        wanted = {*cores, *tails} - {""}
        if len(self.words) + len(wanted) > CACHED:
            self.words = {}
        missing = wanted - self.words.keys()
        letters = [w for w in missing if w.isalpha() and w.lower().isalpha()]
        others = list(missing.difference(letters))
        self.words.update(zip(letters, self._lines(letters)))
        self.words.update(zip(others, self._raw(others)))
        self.words[""] = b""
        words = self.words
        self.pieces.update(zip(new, [words[a] + words[b] if b else words[a] for a, b in zip(cores, tails)]))

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offsets of each."""
        split = pc.ascii_split_whitespace(texts)
        at = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.pieces) > CACHED:
            self.pieces = {}
        new = [p for p in pieces if p not in self.pieces]
        if new:
            self._learn(new)
        values = pa.array([self.pieces[p] for p in pieces], pa.large_binary()).take(coded.indices)
        if not len(values):
            return np.zeros(0, self.kind), np.zeros(len(texts) + 1, np.int64)
        _, offsets, data = values.buffers()
        ends = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
        ids = np.frombuffer(data, self.kind, int(ends[-1]) // self.kind.itemsize) if ends[-1] else np.zeros(0, self.kind)
        return ids, ends[at - at[0]] // self.kind.itemsize

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, at = self.encode_array(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(at.tolist(), at[1:].tolist())]


@cache
def _encoder(path: str, kind: str) -> Encoder:
    """One for all tasks of a worker, so that words stay known."""
    return Encoder(path, np.dtype(kind))


def id_kind(vocabulary: int):
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def _encode(path: str, end: int, kind):
    def encode(batches):
        encoder, seq, held = _encoder(path, kind.str), 0, []

        def flush():
            rows = pa.Table.from_batches(held).combine_chunks()
            ids, at = encoder.encode_array(pa.concat_arrays(rows["text"].chunks))
            n = len(at) - 1
            ended = np.insert(ids, at[1:], end).astype(kind)
            ends = ((at + np.arange(n + 1)) * kind.itemsize).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ended.tobytes())])
            return pa.record_batch([rows["part"].combine_chunks(), pa.array(np.arange(seq, seq + n)), rows["doc_id"].combine_chunks(), packed],
                                   ["part", "seq", "doc_id", "ids"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.nbytes for b in held) >= TOGETHER:
                yield flush()
                seq, held = seq + sum(b.num_rows for b in held), []
        if held:
            yield flush()
    return encode


def _count(vocabulary: int, kind):
    def count(batches):
        sums = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 250):
                joined = b"".join(batch["ids"][low:low + 250].to_pylist())
                sums += np.bincount(np.frombuffer(joined, kind), minlength=vocabulary)
        used = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(used), pa.array(sums[used])], ["id", "n"])
    return count


def _write(code, kind):
    def write(batches):
        """Chunks of documents that follow each other in a part."""
        held, code_ = [], Code(code)

        def chunk():
            ids = np.frombuffer(b"".join(x[3] for x in held), kind)
            blocks = [code_.pack(ids[i:i + BLOCK]) for i in range(0, len(ids), BLOCK)]
            return pa.record_batch([
                pa.array([held[0][0]], pa.int32()), pa.array([held[0][1]], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([[x[2] for x in held]], pa.list_(pa.int64())),
                pa.array([[len(x[3]) // kind.itemsize for x in held]], pa.list_(pa.int64())),
                pa.array([[b for b, _ in blocks]], pa.list_(pa.binary())),
                pa.array([[m.astype("<u2").tobytes() for _, m in blocks]], pa.list_(pa.binary()))],
                ["part", "seq", "n_tokens", "doc_ids", "lengths", "blocks", "checkpoints"])

        size = 0
        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in ("part", "seq", "doc_id", "ids")]):
                if held and (size >= CHUNK * kind.itemsize or row[0] != held[-1][0] or row[1] != held[-1][1] + 1):
                    yield chunk()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield chunk()
    return write


def _read(code):
    def read(batches):
        code_ = Code(code)
        for batch in batches:
            for row in batch.to_pylist():
                ids, left = [], row["n_tokens"]
                for raw, marks in zip(row["blocks"], row["checkpoints"]):
                    n = min(left, BLOCK)
                    ids.append(code_.unpack(raw, np.frombuffer(marks, "<u2"), n))
                    left -= n
                ids = np.concatenate(ids).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                k = len(starts)
                yield pa.record_batch([
                    pa.array([row["part"]] * k, pa.int32()), pa.array([row["seq"]] * k, pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts, pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64())],
                    ["part", "seq", "doc_id", "start", "n_tokens", "ids_crc32"])
    return read


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = 1) -> None:
    """Write the ids of all documents, each ended by ``end``, below ``path`` in ascending doc_id order.

    ``path/code`` holds the code's lengths by id; ``path/chunks`` has a row for about a million
    ids: part and seq (its place in the order), n_tokens, the documents' ids and lengths, the
    blocks, each packed from a byte of its own, and every block's checkpoints: the bits of each
    stretch of 64 ids, so that a reader starts anywhere, and reads all stretches at once.

    Ids are kept in the shared folder between counting and packing, so texts are encoded once.
    Only the counts by id, as many as the vocabulary has, reach the driver. Null texts are
    empty (the end id alone), null doc_ids come first; ties of doc_id are ordered by the hash
    of their text. Files are written by Spark, so a lost task leaves nothing behind.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = _tokenizer(tokenizer).get_vocab_size(with_added_tokens=True)
    kind = id_kind(vocabulary)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    parts = own.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "doc_id", "text")
    ids = store(parts.mapInArrow(_encode(tokenizer, end, kind), "part int, seq long, doc_id long, ids binary"), "ids")
    counts = np.zeros(vocabulary, np.int64)
    for i, n in ids.select("ids").mapInArrow(_count(vocabulary, kind), "id long, n long").groupBy("id").agg(F.sum("n")).collect():
        counts[i] = n
    lengths = code_lengths(counts)
    (spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, bits int")
     .coalesce(1).write.parquet(f"{path}/code"))
    (ids.mapInArrow(_write(lengths, kind), "part int, seq long, n_tokens long, doc_ids array<long>, lengths array<long>, "
                    "blocks array<binary>, checkpoints array<binary>")
     .write.option("compression", "uncompressed").parquet(f"{path}/chunks"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Decode the files below ``path``: doc_id, start, n_tokens and ids_crc32 of every document.

    ``start`` counts the ids of all documents before it, by sums of parts and then of chunks.
    """
    ship(spark)
    known = spark.read.parquet(f"{path}/code").collect()
    lengths = np.zeros(max([r.id for r in known], default=0) + 1, np.uint8)
    for r in known:
        lengths[r.id] = r.bits
    chunks = spark.read.parquet(f"{path}/chunks")
    sizes = chunks.select("part", "seq", "n_tokens")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    of_parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    of_parts = of_parts.select("part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("head"))
    heads = (sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(before(Window.partitionBy("part").orderBy("seq"))), F.lit(0)))
             .join(of_parts, "part").select("part", "seq", (F.col("head") + F.col("inner")).alias("base")))
    rows = chunks.mapInArrow(_read(lengths), "part int, seq long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return (rows.join(heads, ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"))


def token_digest(docs: DataFrame, tokenizer: str, end: int = 1) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and report what reading them gives."""
    path = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end)
    return read_tokens(docs.sparkSession, path)
