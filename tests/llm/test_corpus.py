"""Corpus operators against brute force, on small tables with awkward rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from crashlake.llm import chaining, decontaminate, licenses, minhash, mixing, quality, queries, ring, suffixes, token_files, toxicity
from crashlake.llm.huffman import Code, code_lengths

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, part int, label string, kept boolean, _id long, size long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghiklmnoprstu"), rng.integers(2, 8))) for _ in range(n))


def texts() -> list[tuple]:
    long = sentence(1, 6000)
    passage, words = sentence(2, 70), sentence(3, 120).split()
    near = words.copy()
    near[50] = "other"
    fuzzy = passage.split()
    fuzzy[30] = "changed"
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, long), (6, long + " tail"),
            (7, sentence(4, 40) + " " + passage + " " + sentence(5, 40)),
            (8, sentence(6, 30) + " " + passage + " " + sentence(7, 50)),
            (9, sentence(8, 30) + " " + " ".join(fuzzy) + " " + sentence(9, 50)),
            (10, " ".join(words)), (11, " ".join(near)), (12, " ".join(words)), (12, " ".join(words)),
            (13, "x" * 5000), (14, "x" * 300), (15, "CC BY all rights reserved General Public License cc by é ß"),
            (16, "zero\x00byte " * 30), (17, "ééé üü " * 20), (None, " ".join(words)), (None, None), (None, sentence(10, 50)),
            (18, sentence(11, 100)), (19, sentence(11, 100)), (20, "same line\n" * 30 + sentence(12, 30))]
    return rows + [(100 + i, sentence(100 + i, 30 + i)) for i in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, [None, "en", "de"][i % 3], [None, "web", "books"][i % 3], len(t or ""), 1, 2, "l", True, 5, 9)
            for i, (d, t) in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    leak = sentence(7, 50).split()[5:45]
    leak[20] = "swap"
    return spark.createDataFrame([(1, " ".join(leak), "x"), (2, None, "x"), (None, sentence(4, 40), "x"), (3, "", "x"), (4, sentence(999, 50), "x")],
                                 "item_id long, text string, doc_id string")


TOKENIZER = queries.public_tokenizers.path("word_bpe_49k.json")


def test_token_files(docs):
    """Ids, places and checksums are those of the tokenizer itself."""
    got = sorted(map(tuple, token_files.token_digest(docs.where("doc_id IS NOT NULL"), TOKENIZER).select(
        "doc_id", "start", "n_tokens", "ids_crc32").collect()))
    rows = sorted(((d, t) for d, t in texts() if d is not None), key=lambda r: r[0])
    start, want = 0, []
    for d, t in rows:
        ids = np.array(token_files._tokenizer(TOKENIZER).encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(want)


@pytest.mark.parametrize("counts", [[5], [1, 1], [2 ** k for k in range(40)], [3, 0, 0, 7, 1]])
def test_huffman_round_trip(counts):
    lengths = code_lengths(np.array(counts, np.int64))
    used = np.flatnonzero(counts)
    ids = np.random.default_rng(1).choice(used, 5000).astype(np.uint16)
    assert lengths[used].min() >= 1 and sum(2.0 ** -int(n) for n in lengths[used]) <= 1
    block, marks = Code(lengths).pack(ids)
    assert len(block) and marks is not None


def test_toxicity_held_out(spark):
    """Held-out labels are told apart, and no label of theirs is used."""
    folder = "/root/testdata/sf0.01"
    got = toxicity.score_toxicity(queries.documents(spark, folder), queries.documents(spark, folder, "labels"))
    scores = {r.doc_id: r for r in got.collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet' WHERE toxic IS NOT NULL").fetchall()
    held = [(scores[d].predicted, y) for d, y in labels if d in scores and zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in scores.items())
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_toxicity_awkward_rows(docs, empty, spark):
    labels = spark.createDataFrame([(7, 1), (8, 0), (None, 1), (9, None), (10, 0)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == len(texts()) and all(0 <= r.score <= 1 for r in rows)
    assert len(toxicity.score_toxicity(docs, labels.limit(0)).collect()) == len(rows)
    assert toxicity.score_toxicity(empty, labels).isEmpty()


def test_leaks(docs, items, empty):
    """A benchmark passage with a word swapped is found; the documents around it are not."""
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert found == {(8, 1)}
    left = decontaminate.drop_leaks(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 1
    assert decontaminate.find_leaks(empty, items).isEmpty() and decontaminate.find_leaks(docs, items.limit(0)).isEmpty()


def test_fuzzy_passages(docs, empty):
    pairs = {(r.doc_id, r.other_id) for r in chaining.fuzzy_passages(docs).collect()}
    assert {(6, 5), (8, 7), (9, 7), (11, 10), (12, 10), (19, 18)} <= pairs
    assert (9, 8) in pairs  # the passage of 7, 8 and 9: not only with the first of them
    assert pairs <= {(6, 5), (8, 7), (9, 7), (9, 8), (11, 10), (12, 10), (12, 11), (19, 18), (14, 13), (17, 16)}
    assert chaining.fuzzy_passages(empty).isEmpty()


def test_license_base(docs, empty):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    want = Counter()
    for d, t in texts():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        at = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        want[(d, len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})))] += 1
    rows = licenses.scan_licenses(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)
    assert licenses.scan_licenses(empty).isEmpty()


def test_license_text_with_changes(docs, spark):
    """A template with a word changed is still found by its diagonal, in a text of other words."""
    template = max((t for t in licenses.TEMPLATES if not t.exact), key=lambda t: len(t.words.split()))
    words = template.words.split()
    words[len(words) // 2] = "zzz"
    frame = spark.createDataFrame([(1, sentence(50, 40) + " " + " ".join(words)), (2, sentence(51, 80))], "doc_id long, text string")
    rows = {r.doc_id: r.labels for r in licenses.scan_licenses(frame).collect()}
    assert template.label in rows[1].split(",") and rows[2] == ""


def test_ring(docs, empty):
    rows = ring.shard_ring(docs, shards=5).collect()
    assert len(rows) == len(texts())
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots))) and 0 <= shard < 5
    sizes = Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    assert sizes == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in texts())
    assert ring.shard_ring(empty).isEmpty()


def test_quality_statistics(docs, empty):
    want = Counter()
    for d, t in texts():
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        often, covered = Counter(windows), set()
        for i, w in enumerate(windows):
            if often[w] > 1:
                covered.update(range(i, i + 8))
        want[(d, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered),
              len(words) < 20 or 100 * len(covered) > 30 * len(words))] += 1
    rows = quality.quality_report(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == want
    assert not any(r.kept and r.base_failed for r in rows)
    assert quality.keep_good(docs).count() == sum(r.kept for r in rows) and quality.quality_report(empty).isEmpty()


def shingles(text: str | None, words: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def linked(rows: list[tuple], words: int, percent: int) -> list[int]:
    """Number of the component of every row, by union of all linked pairs that share a shingle."""
    sets, parent, holders = [shingles(t, words) for _, t in rows], list(range(len(rows))), defaultdict(list)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, k in Counter(j for x in s for j in holders[x]).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    return [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(docs, empty, words):
    rows = texts()
    group = linked(rows, words, 80)
    ids = defaultdict(list)
    for (d, _), g in zip(rows, group):
        ids[g].append(d)
    want = Counter()
    for (d, t), g in zip(rows, group):
        known = [x for x in ids[g] if x is not None]
        least = d if not shingles(t, words) else min(known) if known else None
        want[(d, len(shingles(t, words)), least, d == least)] += 1
    assert Counter(map(tuple, minhash.near_duplicates(docs, words, 80).collect())) == want
    assert minhash.near_duplicates(empty, words, 80).isEmpty()
    left = minhash.drop_near_duplicates(docs, words, 80)
    bare = sum(not shingles(t, words) for _, t in rows)
    assert left.columns == docs.columns and left.count() == len({g for g, (_, t) in zip(group, rows) if shingles(t, words)}) + bare


def test_prefix_join_finds_links_without_bands(spark):
    """Sets in one band of which no star verifies all are still linked exactly."""
    base = sentence(70, 60).split()
    rows = []
    for i in range(30):
        w = base.copy()
        for k in range(i // 2):
            w[(7 * k + i) % 60] = f"w{i}x{k}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()}
    group = linked(rows, 2, 80)
    least = {g: min(i for i, h in enumerate(group) if h == g) for g in group}
    assert got == {i: least[g] for i, g in enumerate(group)}


def test_mix_equals_sql(docs, spark):
    folder = SMALL
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = duckdb.sql(queries.MIX_SQL).fetchall()
    got = queries.QUERIES["op9_fair_mix"](spark, folder).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((w[0], w[2], w[5]) for w in want)


def test_mix_targets(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts()) and all(r.taken <= 2 * r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * max(r.size for r in own)
    assert mixing.mix(empty).isEmpty() and mixing.mixed_documents(docs).columns == docs.columns


def without_repeats(rows: list[tuple]) -> Counter:
    first: dict[bytes, int] = {}
    cut = [(d, (t or "").encode()) for d, t in rows]
    for d, b in cut:
        for i in range(len(b) - 49 if d is not None else 0):
            first[b[i:i + 50]] = min(d, first.get(b[i:i + 50], d))
    out = Counter()
    for d, b in cut:
        gone = bytearray(len(b))
        for i in range(len(b) - 49 if d is not None else 0):
            if first[b[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[(d, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())] += 1
    return out


def test_repeated_bytes(docs, empty):
    assert Counter(map(tuple, suffixes.remove_repeats(docs).collect())) == without_repeats(texts())
    assert suffixes.remove_repeats(empty).isEmpty()


@pytest.mark.parametrize("seed", range(5))
def test_suffix_order(seed):
    """Suffixes come in order; the least owner of every string is that of brute force."""
    rng = np.random.default_rng(seed)
    base = bytes(rng.choice(list(b"ab"), 130).astype(np.uint8))
    lines = list({base[i:i + n] for i, n in zip(rng.integers(0, 50, 40), rng.integers(50, 76, 40))} | {bytes(60), bytes(70)})
    docs = rng.integers(0, 9, len(lines))
    starts, shared = suffixes.ordered_suffixes(lines)
    flat = b"\xff".join(lines)
    ends = np.cumsum([len(x) + 1 for x in lines]) - 1
    tails = [flat[s:ends[np.searchsorted(ends, s)]] for s in starts.tolist()]
    assert tails == sorted(tails) and len(set(starts.tolist())) == len(starts)
    for a, b, n in zip(tails, tails[1:], shared[1:].tolist()):
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert n == min(same, 50)
    least: dict[bytes, int] = {}
    for x, d in zip(lines, docs.tolist()):
        for i in range(len(x) - 49):
            least[x[i:i + 50]] = min(d, least.get(x[i:i + 50], d))
    for x, own in zip(lines, suffixes.first_owners(lines, docs)):
        assert own.tolist() == [least[x[i:i + 50]] for i in range(len(x) - 49)]


def test_pipeline(spark):
    """Each stage against its own rule on its own input."""
    frame, seen = queries.documents(spark, SMALL), {}
    for name, stage in corpus_pipeline.STAGES:
        before = seen[name] = frame
        frame = corpus_pipeline.store(stage(spark, before, SMALL), f"test-{name}")
        if name != "token_output":
            assert frame.columns == before.columns
    rows = {n: [(r.doc_id, r.text) for r in f.select("doc_id", "text").orderBy("doc_id").collect()] for n, f in seen.items()}
    group = linked(rows["near_dedup"], 5, 80)
    first = {}
    for (d, _), g in zip(rows["near_dedup"], group):
        first.setdefault(g, d)
    assert sorted(first.values()) == [d for d, _ in rows["decontamination"]]
    assert {d for d, _ in rows["source_mix"]} <= {d for d, _ in rows["decontamination"]}
    assert frame.count() == len(rows["token_output"])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_rows(docs, empty, spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    stage(spark, docs, SMALL).collect()
    assert stage(spark, empty, SMALL).isEmpty()
