"""Bytes that repeat across documents: a collection's suffixes put in order column by column."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from crashlake.llm.common import ship, text_of
from crashlake.llm.words import INVERSE, mix, powers, slices, text_bytes

#: Bytes of a string that is removed, and of the anchor that picks the block it is compared in.
LENGTH, ANCHOR = 50, 25
#: Anchors or segment bytes of a task that are sent on together; symbols of a block; bytes whose
#: anchors are sought at once, few enough for a processor's cache.
ENTRIES, HELD, BLOCK, STRETCH = 1 << 21, 1 << 24, 1 << 18, 1 << 16
NOTE = "part int, kind int, block int, rows binary, counts binary, docs binary, a binary, b binary, c binary, texts binary"
NAMES = [c.split()[0] for c in NOTE.split(", ")]
TYPES = [pa.int32()] * 3 + [pa.binary()] * 7


def ordered_suffixes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all suffixes of all lines, in order, and the prefix each shares with the one before.

    Starts count through the lines laid end to end, with one place for the end of each; shared
    prefixes stop at ``LENGTH``. The Burrows-Wheeler transform of the collection grows by one
    symbol of every line a round, from the right: the symbol before a suffix stands at the
    suffix's place, and its rank among its equals there is the place of the next longer suffix.
    A new suffix shares one symbol more than the least prefix between its symbol and the one
    before it. Transform, prefixes and starts take six bytes a symbol, less than the ranks of a
    round, and are held in memory.
    """
    n = len(lines)
    sizes = np.array([len(s) for s in lines], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.zeros(int(ends[-1]) + 1, np.uint8)
    symbols[np.delete(np.arange(len(symbols)), ends)] = np.frombuffer(b"".join(lines), np.uint8) + 1  # no byte of UTF-8 is 255
    before = np.where(sizes > 0, symbols[ends - 1], 0)
    bwt, lcp, starts = before.astype(np.uint8), np.zeros(n, np.uint8), ends.astype(np.uint32)
    live, at = np.flatnonzero(sizes > 0), np.flatnonzero(sizes > 0)
    for k in range(1, int(sizes.max(initial=0)) + 1):
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        r = rank[at]
        new = n - np.count_nonzero(bwt == 0) + r
        prev, after = order[np.maximum(r - 1, 0)], order[np.minimum(r + 1, len(order) - 1)]
        has_prev, has_next = (r > 0) & (bwt[prev] == bwt[at]), (r + 1 < len(order)) & (bwt[after] == bwt[at])
        shared = np.zeros(len(at), np.uint8)
        shared[has_prev] = _least(lcp, prev[has_prev] + 1, at[has_prev] + 1)
        follow = _least(lcp, at[has_next] + 1, after[has_next] + 1)

        own = ends[live] - k
        old = np.ones(len(bwt) + len(new), bool)
        old[new] = False
        bwt, lcp, starts = (_grown(c, old, new, v) for c, v in ((bwt, np.where(sizes[live] > k, symbols[own - 1], 0)), (lcp, shared), (starts, own)))
        lcp[new[has_next] + 1] = follow
        more = sizes[live] > k
        live, at = live[more], new[more]
    return starts.astype(np.int64), lcp


def _grown(column: np.ndarray, old: np.ndarray, new: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The column with the values set in at their places, what was there moved on."""
    grown = np.empty(len(old), column.dtype)
    grown[old], grown[new] = column, values
    return grown


def _least(lcp: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One more than the least prefix of each range, at most ``LENGTH``."""
    if not len(low):
        return np.zeros(0, np.uint8)
    turn = np.argsort(-low, kind="stable")  # so that what lies between two ranges costs nothing
    cuts = np.stack([low[turn], high[turn]], axis=1).ravel()
    out = np.empty(len(low), np.uint8)
    out[turn] = np.minimum.reduceat(np.append(lcp, np.uint8(0)), cuts)[::2]
    return np.minimum(out + 1, LENGTH)


def first_owners(lines: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For every line, the least of ``docs`` among lines that hold the string at each of its places."""
    starts, shared = ordered_suffixes(lines)
    sizes = np.array([len(s) for s in lines], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    line = np.searchsorted(ends, starts)
    heads = np.flatnonzero(np.append(True, shared[1:] < LENGTH))
    least = np.minimum.reduceat(docs[line], heads)
    owner = np.empty(len(starts), np.int64)
    owner[starts] = np.repeat(least, np.diff(np.append(heads, len(starts))))
    return [owner[e - s:e - LENGTH + 1] for s, e in zip(sizes, ends)]


def anchored(texts: pa.Array) -> Iterator[tuple]:
    """Runs of places whose ``LENGTH`` bytes have the same anchor.

    Yields bytes, row of each run, first and last place in the bytes, what to add for the place
    in the row's text, and hash. The anchor is the least hash of ``ANCHOR`` bytes, so equal
    strings have equal anchors, whatever surrounds them.
    """
    for low, high in slices(texts):
        data, at = text_bytes(texts[low:high])
        of = np.repeat(np.arange(high - low, dtype=np.int32), np.diff(at))
        for begin in range(0, max(1, len(data)), STRETCH):
            part = data[begin:begin + STRETCH + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part + np.uint64(1)) * powers(len(part)), dtype=np.uint64, out=sums[1:])
            hashes = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * powers(len(part) + 1, INVERSE)[:len(part) - ANCHOR + 1])
            least = (hashes & ~np.uint64((1 << 23) - 1)) | np.arange(len(hashes), dtype=np.uint64)
            width, wanted = 1, LENGTH - ANCHOR + 1
            while 2 * width <= wanted:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            least = np.minimum(least[:len(least) - wanted + width], least[wanted - width:])
            anchor = (least & np.uint64((1 << 23) - 1)).astype(np.int32)
            row = of[begin:begin + len(anchor)]
            places = np.flatnonzero(row == of[begin + LENGTH - 1:begin + LENGTH - 1 + len(anchor)])  # strings that end in the text they start in
            row, anchor = row[places], anchor[places]
            if not len(places):
                continue
            new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (np.diff(places) != 1)))
            last = places[np.append(new[1:], len(places)) - 1]
            yield part, low + row[new], places[new], last, begin - at[row[new]], hashes[anchor[new]]


def _note(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)] if rows else [pa.array([], t) for t in TYPES], NAMES)


def _packed(part, kind: int, block: int, row, doc, *columns, texts=None) -> Iterator[tuple]:
    """One note for each part: its rows, how many entries each has, and the entries' columns."""
    if not len(part):
        return
    order = np.lexsort((row, part))
    part, row = part[order], row[order]
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]):
        rows, first, counts = np.unique(row[low:high], return_index=True, return_counts=True)
        own = order[low:high]
        more = [np.ascontiguousarray(c[own]).tobytes() for c in columns]
        joined = zstandard.compress(b"".join([texts[i] for i in own.tolist()]), 3) if texts is not None else None
        yield (int(part[low]), kind, block, rows.tobytes(), counts.astype(np.uint32).tobytes(),
               doc[own[first]].tobytes() if doc is not None else None, *more, *[None] * (3 - len(more)), joined)


def _pack_texts(batches):
    """Notes of kind 1: the texts of each part with their rows and doc_ids, compressed together."""
    def flush(held):
        rows = []
        for part in sorted({x[0] for x in held}):
            _, row, doc, raw = zip(*[x for x in held if x[0] == part])
            rows.append((part, 1, 0, np.array(row, np.int64).tobytes(), np.array([d is None for d in doc], np.uint8).tobytes(),
                         np.array([d or 0 for d in doc], np.int64).tobytes(), np.array([len(x) for x in raw], np.uint32).tobytes(),
                         None, None, zstandard.compress(b"".join(raw), 3)))
        return _note(rows)

    held, n = [], 0
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        for row in zip(batch["part"].to_pylist(), batch["row"].to_pylist(), batch["doc_id"].to_pylist(), texts):
            held.append(row)
            n += len(row[3])
            if n >= HELD:
                yield flush(held)
                held, n = [], 0
    if held:
        yield flush(held)


def _unpacked(note: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Rows, doc_ids, whether these are null, and texts of a note of texts."""
    raw, ends = zstandard.decompress(note["texts"]), np.cumsum(np.frombuffer(note["a"], np.uint32), dtype=np.int64).tolist()
    return (np.frombuffer(note["rows"], np.int64), np.frombuffer(note["docs"], np.int64), np.frombuffer(note["counts"], np.uint8) > 0,
            [raw[a:b] for a, b in zip([0, *ends], ends)])


def _one_by_one(batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _entries(note: dict) -> np.ndarray:
    return np.repeat(np.frombuffer(note["rows"], np.int64), np.frombuffer(note["counts"], np.uint32))


def _ask_anchors(parts: int):
    """Notes of anchors: kind 0 asks whether others have it, kind 1 knows that others do."""
    def flush(hashes, rows):
        h, row = np.concatenate(hashes), np.concatenate(rows)
        order = np.lexsort((row, h))
        h, row = h[order], row[order]
        new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))
        h, row = h[new], row[new]
        head = np.append(True, h[1:] != h[:-1])
        common = ~head
        common[:-1] |= common[1:]
        part, low = ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int32), h.astype(np.uint32)
        return _note([*_packed(part[head], 0, 0, row[head], None, low[head]),
                      *_packed(part[common], 1, 0, row[common], None, low[common])])

    def ask(batches):
        hashes, rows, n = [], [], 0
        for batch in batches:
            keys = batch["row"].to_numpy()
            for _, row, _, _, _, h in anchored(batch["text"]):
                hashes.append(h)
                rows.append(keys[row])
                n += len(h)
                if n >= ENTRIES:
                    yield flush(hashes, rows)
                    hashes, rows, n = [], [], 0
        if n:
            yield flush(hashes, rows)
    return ask


def _turns(batches, finish, passed):
    """Feed the notes of kind 0 of each part to ``finish`` together; those of kind 1, as many as ``HELD`` bytes, to ``passed``."""
    part, kind, held, n = None, None, [], 0

    def flush():
        return _note(finish(part, held) if kind == 0 else list(passed(part, held)))

    for note in _one_by_one(batches):
        if held and ((note["part"], note["kind"]) != (part, kind) or (kind == 1 and n >= HELD)):
            yield flush()
            held, n = [], 0
        part, kind = note["part"], note["kind"]
        held.append(note)
        n += sum(len(x) for x in note.values() if isinstance(x, bytes))
    if held:
        yield flush()


def _groups(rows: np.ndarray, parts: int) -> np.ndarray:
    return (rows % parts).astype(np.int32)


def _answer_anchors(parts: int):
    """Notes, for the groups of rows, of the anchors that at least two rows have."""
    def finish(part, notes):
        row = np.concatenate([_entries(x) for x in notes])
        low = np.concatenate([np.frombuffer(x["a"], np.uint32) for x in notes])
        order = np.argsort(low, kind="stable")
        row, low = row[order], low[order]
        heads = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        sizes = np.diff(np.append(heads, len(low)))
        common = np.repeat(np.minimum.reduceat(row, heads) != np.maximum.reduceat(row, heads), sizes)
        row, low = row[common], low[common]
        return list(_packed(_groups(row, parts), 0, part, row, None, low))

    def passed(part, notes):
        row, low = np.concatenate([_entries(x) for x in notes]), np.concatenate([np.frombuffer(x["a"], np.uint32) for x in notes])
        return _packed(_groups(row, parts), 0, part, row, None, low)

    return lambda batches: _turns(batches, finish, passed)


def _cut_segments(parts: int):
    """Notes of the runs with a common anchor: kind 0 with their bytes; kind 1 are known to repeat.

    A run whose bytes also stand in a smaller doc_id of the same task is known at once.
    """
    def flush(rows, docs, starts, lows, blocks, texts):
        row, doc, start = np.concatenate(rows), np.concatenate(docs), np.concatenate(starts)
        low, block = np.concatenate(lows), np.concatenate(blocks)
        least: dict[bytes, int] = {}
        for t, d in zip(texts, doc.tolist()):
            if least.setdefault(t, d) > d:
                least[t] = d
        known = doc > np.array([least[t] for t in texts], np.int64)
        size = np.array([len(t) for t in texts], np.uint32)  # at most 2 * LENGTH - ANCHOR
        ask, k = np.flatnonzero(~known), np.flatnonzero(known)
        k = k[np.lexsort((start[k], row[k]))]
        end = start[k] + size[k]  # runs follow each other within a text, so stretches that touch are one
        new = np.append(True, (row[k][1:] != row[k][:-1]) | (start[k][1:] > end[:-1]))[:len(k)]
        last = end[np.append(np.flatnonzero(new)[1:], len(k)) - 1] if len(k) else end
        k = k[new]
        return _note([*_packed(block[ask], 0, 0, row[ask], doc[ask], start[ask], size[ask].astype(np.uint8), low[ask], texts=[texts[i] for i in ask.tolist()]),
                      *_packed(block[k], 1, 0, row[k], None, start[k], last)])

    def cut(batches):
        part, keys, ids, notes = None, None, None, []
        held, n = [[], [], [], [], [], []], 0
        for note in _one_by_one(batches):  # a group's notes come before its texts
            if note["part"] != part:
                part, keys, notes = note["part"], None, []
            if note["kind"] == 0:
                notes.append((_entries(note), np.frombuffer(note["a"], np.uint32).astype(np.uint64) | np.uint64(note["block"] << 32)))
                continue
            if not notes:
                continue
            if keys is None:
                ids, keys = (np.concatenate(c) for c in zip(*notes))
                order = np.lexsort((keys, ids))
                ids, keys = ids[order], keys[order]
            row_ids, docs, _, texts = _unpacked(note)
            for data, row, first, last, shift, h in anchored(pa.array(texts, pa.large_binary()).view(pa.large_string())):
                block = (h >> np.uint64(32)) % np.uint64(parts)
                key = (block << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
                common = np.zeros(len(key), bool)
                cuts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(row)]):
                    i, j = np.searchsorted(ids, row_ids[row[a]]), np.searchsorted(ids, row_ids[row[a]], "right")
                    if j > i:
                        at = np.minimum(np.searchsorted(keys[i:j], key[a:b]), j - i - 1)
                        common[a:b] = keys[i:j][at] == key[a:b]
                if not common.any():
                    continue
                row, first, last, shift = row[common], first[common], last[common], shift[common]
                raw = data.tobytes()
                texts_cut = [raw[a:b] for a, b in zip(first.tolist(), (last + LENGTH).tolist())]
                for column, values in zip(held, (row_ids[row], docs[row], (first + shift).astype(np.uint32),
                                                 key[common].astype(np.uint32), block[common].astype(np.int32))):
                    column.append(values)
                held[5] += texts_cut
                n += int((last - first + LENGTH).sum())
                if n >= HELD:
                    yield flush(*held)
                    held, n = [[], [], [], [], [], []], 0
        if n:
            yield flush(*held)
    return cut


def _judge_segments(parts: int):
    """Notes, for the groups of rows, of the stretches that stand in a smaller doc_id as well."""
    def finish(part, notes):
        row = np.concatenate([_entries(x) for x in notes])
        doc = np.concatenate([np.repeat(np.frombuffer(x["docs"], np.int64), np.frombuffer(x["counts"], np.uint32)) for x in notes])
        start, low = (np.concatenate([np.frombuffer(x[c], np.uint32) for x in notes]).astype(np.int64) for c in "ac")
        number: dict[bytes, int] = {}
        which, at = np.empty(len(row), np.int64), 0
        for x in notes:
            raw, place = zstandard.decompress(x["texts"]), 0
            for s in np.frombuffer(x["b"], np.uint8).tolist():
                which[at] = number.setdefault(raw[place:place + s], len(number))
                place, at = place + s, at + 1
        lines = list(number)
        least = np.full(len(lines), np.iinfo(np.int64).max)
        np.minimum.at(least, which, doc)
        anchor = np.empty(len(lines), np.int64)
        anchor[which] = low
        # a line whose anchor no other line has is equal to itself alone
        owners = [np.full(len(x) - LENGTH + 1, d) for x, d in zip(lines, least.tolist())]
        order = np.argsort(anchor, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(anchor[order]) != 0))
        sizes = np.diff(np.append(heads, len(order)))
        order = order[np.repeat(sizes > 1, sizes)]
        total = np.cumsum([len(lines[i]) for i in order.tolist()])
        new = np.append(True, np.diff(anchor[order]) != 0)[:len(order)]
        begin = 0
        for end in [*np.flatnonzero(new)[1:].tolist(), len(order)] if len(order) else []:  # a block ends where an anchor does
            if end == len(order) or total[end - 1] - (total[begin - 1] if begin else 0) >= BLOCK:
                own = order[begin:end].tolist()
                for i, o in zip(own, first_owners([lines[i] for i in own], least[own])):
                    owners[i] = o
                begin = end
        counts = np.array([len(o) for o in owners])
        flat, base = np.concatenate(owners), np.cumsum(counts) - counts
        times = counts[which]
        entry = np.repeat(np.arange(len(row)), times)
        place = np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times)
        gone = flat[base[which[entry]] + place] < doc[entry]
        entry, place = entry[gone], place[gone]
        if not len(entry):
            return []
        head = np.flatnonzero(np.append(True, (np.diff(entry) != 0) | (np.diff(place) != 1)))
        last = np.append(head[1:], len(entry)) - 1
        e = entry[head]
        return list(_packed(_groups(row[e], parts), 0, 0, row[e], None, (start[e] + place[head]).astype(np.uint32),
                            (start[e] + place[last] + LENGTH).astype(np.uint32)))

    def passed(part, notes):
        row = np.concatenate([_entries(x) for x in notes])
        return _packed(_groups(row, parts), 0, 0, row, None, *(np.concatenate([np.frombuffer(x[c], np.uint32) for x in notes]) for c in "ab"))

    return lambda batches: _turns(batches, finish, passed)


def _kept(data: bytes, low: np.ndarray, high: np.ndarray) -> tuple[int, int, str]:
    """Bytes that the stretches cover, their maximal runs, and the digest of the rest."""
    digest, at, removed, runs = hashlib.sha256(), 0, 0, 0
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    heads = np.flatnonzero(np.append(True, low[1:] > reach[:-1])) if len(low) else np.zeros(0, np.int64)
    for a, b in zip(low[heads].tolist(), reach[np.append(heads[1:], len(low)) - 1].tolist() if len(low) else []):
        digest.update(data[at:a])
        removed, runs, at = removed + b - a, runs + 1, b
    digest.update(data[at:])
    return removed, runs, digest.hexdigest()


def _finish(batches):
    """The digest of every document less the stretches noted for it; notes come before texts."""
    part, held, sorted_ = None, [], None
    for note in _one_by_one(batches):
        if note["part"] != part:
            part, held, sorted_ = note["part"], [], None
        if note["kind"] == 0:
            held.append((_entries(note), np.frombuffer(note["a"], np.uint32).astype(np.int64), np.frombuffer(note["b"], np.uint32).astype(np.int64)))
            continue
        if sorted_ is None:
            sorted_ = [np.concatenate(c) for c in zip(*held)] if held else [np.zeros(0, np.int64)] * 3
            order = np.argsort(sorted_[0], kind="stable")
            sorted_, held = [c[order] for c in sorted_], []
        ids, low, high = sorted_
        rows, docs, unnamed, texts = _unpacked(note)
        first, last = np.searchsorted(ids, rows), np.searchsorted(ids, rows, "right")
        kept = [_kept(data, low[i:j], high[i:j]) for data, i, j in zip(texts, first.tolist(), last.tolist())]
        yield pa.record_batch([pa.array(docs, pa.int64(), mask=unnamed), pa.array([len(t) for t in texts], pa.int64()),
                               *(pa.array(c, t) for c, t in zip(zip(*kept), (pa.int64(), pa.int64(), pa.string())))],
                              ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Return doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row.

    Every byte covered by a string of ``LENGTH`` bytes that also starts in a row of smaller
    doc_id is removed; n_spans counts the removed runs, and the digest is of the bytes left.

    Every place of a text belongs to the anchor of its string. Anchors of one row only are set
    aside by their hashes; the stretches around the others meet in blocks by anchor, where the
    distinct ones are put in suffix order (``ordered_suffixes``): strings that are equal stand
    together there, and the least doc_id among them owns the string. Of stretches that a task
    meets many times only one goes on, so a passage in every document costs a row a task.

    Null texts are empty. Rows without doc_id keep all and remove nothing elsewhere; rows that
    share a doc_id remove nothing from each other. Other columns are not read; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    source = source.withColumn("row", F.xxhash64("doc_id", "text"))
    source = source.withColumn("part", F.expr(f"CAST(pmod(row, {parts}) AS INT)"))
    named, texts = source.where("doc_id IS NOT NULL"), source.select("part", "row", "doc_id", "text").mapInArrow(_pack_texts, NOTE)

    def ordered(notes: DataFrame) -> DataFrame:
        return notes.repartition("part").sortWithinPartitions("part", "kind")

    asked = named.select("row", "text").mapInArrow(_ask_anchors(parts), NOTE)
    common = ordered(asked).mapInArrow(_answer_anchors(parts), NOTE)
    segments = ordered(common.unionByName(named.select("part", "row", "doc_id", "text").mapInArrow(_pack_texts, NOTE))).mapInArrow(_cut_segments(parts), NOTE)
    found = ordered(segments).mapInArrow(_judge_segments(parts), NOTE)
    return (ordered(found.unionByName(texts))
            .mapInArrow(_finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
