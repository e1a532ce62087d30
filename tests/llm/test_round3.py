"""Language, manifest and hard-negative operators against brute force, on small tables with awkward rows."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from crashlake.llm import chaining, languages, merkle, minhash, negatives, quality, queries, token_files
from crashlake.llm.huffman import Code, code_lengths
from test_corpus import SCHEMA, docs, empty, sentence, texts  # noqa: F401  (fixtures)


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree: list[list[str]], i: int) -> list[tuple[str, bool]]:
    """Siblings from a leaf up: (sibling or None, whether it is to the left)."""
    out = []
    for level in tree[:-1]:
        other = i ^ 1
        out.append((level[other] if other < len(level) else None, bool(i & 1)))
        i >>= 1
    return out


def manifest(rows: list[dict]) -> list[tuple]:
    def leaf(r, more=0):
        fields = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
        return h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {k: sorted((r for r in rows if r["lang"] == k), key=lambda r: (r["doc_id"] is not None, r["doc_id"], leaf(r))) for k in langs}
    trees = {k: levels([leaf(r) for r in own[k]]) for k in langs}
    top = levels([trees[k][-1][0] for k in langs])
    out = []
    for place, k in enumerate(langs):
        for i, r in enumerate(own[k]):
            steps = way(trees[k], i) + way(top, place)
            hit = r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf(r, int(hit))
            for other, left in steps:
                node = h(node) if other is None else h(other, node) if left else h(node, other)
            siblings = [o for o, _ in steps if o]
            out.append((r["doc_id"], leaf(r), trees[k][-1][0], top[-1][0], h(*siblings), node, node == top[-1][0], len(siblings)))
    return out


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_is_that_of_brute_force(spark, docs, bits):
    """Null, empty, repeated and tied rows; pages of 2, 4 and 1024 leaves give the same proofs."""
    got = [tuple(r) for r in merkle.prove_documents(docs, bits).collect()]
    want = manifest([r.asDict() for r in docs.collect()])
    assert Counter(got) == Counter(want)
    assert {r[6] for r in got} == {True, False}


def test_manifest_of_odd_trees(spark, empty):
    assert merkle.prove_documents(empty).isEmpty()
    for n in (1, 2, 3, 5, 9):
        rows = [(i, f"t{i}", None if i % 2 else "en", "s", None if i == 1 else i, 1, 2, "l", True, 5, 9) for i in range(n)]
        df = spark.createDataFrame(rows, SCHEMA)
        want = manifest([r.asDict() for r in df.collect()])
        assert Counter(map(tuple, merkle.prove_documents(df, 1).collect())) == Counter(want)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 13, 64, 100])
def test_places_are_postorder(n):
    """Closed-form places are those of a walk that writes a node once its children are written."""
    order = []

    def walk(height, j):
        if height:
            walk(height - 1, 2 * j)
            if (2 * j + 1) << (height - 1) < n:
                walk(height - 1, 2 * j + 1)
        order.append((height, j))
    walk(merkle.height_of(n), 0)
    assert [int(merkle.node_place(*node, n)) for node in order] == list(range(len(order)))


def test_places_of_a_single_proof():
    """The places of one leaf's siblings in a log of many pages hold what a whole tree has there."""
    n, bits = 23, 2
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    log = merkle.complete(leaves, merkle.height_of(n))
    tree = levels([x.hex() for x in leaves])
    for i in range(n):
        want = [o for o, _ in way(tree, i) if o]
        assert [log[p * 32:p * 32 + 32].hex() for *_, p in merkle.proof_places(i, n, bits)] == want


def brute(rows, every=50):
    """(anchor, positive, rank, negative, positive score, negative score) in plain Python."""
    fine = []
    for id_, vec, label in rows:
        if label is not None and vec is not None and all(x is not None and np.isfinite(x) for x in vec):
            fine.append((id_, (label + 1) % 10 if id_ is not None and id_ % 7 == 0 else label, np.floor(np.array(vec, float) * 256)))
    size = max((len(v) for *_, v in fine), default=0)
    fine = [(i, k, np.pad(v, (0, size - len(v)))) for i, k, v in fine]
    last, out = 1 << 62, []
    for a, label, q in fine:
        if a is None or a % every:
            continue
        scored = sorted(((-int(q @ v), last if i is None else i, i, k) for i, k, v in fine if i != a), key=lambda t: t[:2])
        for s, _, p, _ in [t for t in scored if t[3] == label][:5]:
            band = [t for t in scored if t[3] != label and 50 * -s <= 100 * -t[0] <= 95 * -s][:3]
            out += [(a, p, rank, t[2], -s, -t[0]) for rank, t in enumerate(band, 1)]
    return Counter(out)


VECTORS = "vec_id long, embedding array<float>, label int, score long, part int, seq string"


def vectors(seed: int, n: int, size: int, copies: int = 0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=size) * rng.choice([0.1, 0.3, 3])).round(3).tolist(), int(rng.integers(0, 4))) for i in range(n)]
    near = rows[0][1]
    rows += [(n + i, near, i % 3) for i in range(copies)]
    rows += [(n + 500 + i, (np.array(near) * rng.uniform(0.5, 1)).tolist(), i % 5) for i in range(40)]
    return rows


@pytest.mark.parametrize("seed,size,copies", [(1, 3, 0), (2, 8, 150), (3, 40, 30), (4, 1, 5)])
def test_negatives_are_those_of_brute_force(spark, monkeypatch, seed, size, copies):
    """Ties, copies, many lengths and small buckets; few and many dimensions."""
    monkeypatch.setattr(negatives, "BUCKET_BYTES", 1)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 1)
    rows = vectors(seed, 300, size, copies)
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], VECTORS).repartition(3)
    got = Counter(map(tuple, negatives.hard_negatives(df).collect()))
    assert got == brute(rows) and got


def test_negatives_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(9, 60, 4, 10) + [(2000, None, 1), (2050, [1.0] * 4, None), (2100, [nan, 1.0, 1.0, 1.0], 1), (2150, [inf] * 4, 1),
                                    (2200, [None, 1.0], 2), (2250, [], 1), (2300, [2.0, 1.0], 1), (2300, [2.0, 1.5], 1),
                                    (None, [1.0, 1.0, 1.0, 1.0], 2), (None, [1.0, 1.0, 1.0, 1.0], 2), (2350, [0.0] * 4, 3), (2400, [300.0] * 4, 1)]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], VECTORS)
    assert Counter(map(tuple, negatives.hard_negatives(df).collect())) == brute(rows)
    assert negatives.hard_negatives(df.limit(0)).isEmpty()
    assert negatives.hard_negatives(df.where("vec_id % 50 <> 0")).isEmpty()


def test_feasible_ranges_lose_nothing():
    """Every pair above a cosine lies in the range of every focus coordinate, and high cosines prune."""
    rng = np.random.default_rng(5)
    vecs = rng.normal(size=(400, 6))
    ids = np.arange(400)
    anchors = negatives.Anchors(ids[:50] + 1000, np.zeros(50, int), vecs[:50] + 0.01, np.zeros((50, 1)), np.full((50, 1), np.inf), True, 3)
    row = {"ids": ids.astype(np.int64).tobytes(), "kind": "<f8", "vectors": vecs.tobytes(), "dims": 6,
           "longest": float(np.linalg.norm(vecs, axis=1).max())}
    bucket = negatives.Bucket(row)
    cosines = anchors.unit @ bucket.unit.T
    for t in (-1.0, -0.5, 0.0, 0.4, 0.9, 0.99):
        begin, end, lower, upper = anchors._feasible(bucket, np.arange(50), np.full(50, t))
        for a in range(50):
            hits = np.flatnonzero(cosines[a] >= t)
            for k, f in enumerate(anchors.focus[a]):
                listed = set(bucket.sorted_list(int(f))[0][begin[a, k]:end[a, k]].tolist())
                assert set(hits.tolist()) <= listed
                assert ((bucket.unit[hits, f] >= lower[a, k]) & (bucket.unit[hits, f] <= upper[a, k])).all()
        if t == 0.99:
            assert (end - begin).min(1).mean() < 0.3 * len(ids)


def test_codewords():
    for n in (1, 2, 3, 4, 6):
        assert languages.codewords(n).shape == (n, 2 ** (n - 1) - 1)
    for n in (3, 4, 6, 7, 20):
        code = languages.codewords(n)
        apart = (code.shape[1] - code @ code.T) // 2
        least = apart[~np.eye(n, dtype=bool)].min()
        assert least >= (2 ** (n - 2) if n <= 6 else 0.25 * code.shape[1])
        assert (np.abs(code.sum(0)) < n).all()


def test_decoding_mends_a_wrong_bit():
    code = languages.codewords(6)
    wrong = code.astype(float).copy()
    wrong[:, :5] *= -1  # five of 31 bits answer wrongly; words are 16 bits apart
    far = languages.decode(wrong, code, np.ones(31), np.full(code.shape, 1 / 31))
    assert far.argmin(1).tolist() == list(range(6))


def test_grams_over_blocks(monkeypatch):
    """n-grams of a very long text are those of a plain walk, whatever the size of a block."""
    text = "Hello, wörld! 12 ab " * 200 + "ÀÉ"
    whole = Counter(np.concatenate(languages.grams(text)).tolist())
    monkeypatch.setattr(languages, "BLOCK", 7)
    assert Counter(np.concatenate(languages.grams(text)).tolist()) == whole
    spaced = "".join(c.lower() if c.isalpha() else " " for c in f" {text} ")
    points = " " + " ".join(spaced.split()) + " "
    assert sum(whole.values()) == sum(len(points) - n + 1 for n in (2, 3)) + sum(c != " " for c in points)
    assert languages.grams("") == [] == languages.grams("123 --- 456")


def test_fit_is_naive_bayes():
    """Weights of every bit are the logs of the groups' mean shares."""
    rng = np.random.default_rng(1)
    counts = {k: rng.integers(0, 50, 1 << languages.BITS) for k in ("de", "en", "fr")}
    langs, code, weights = languages.fit(counts)
    share = {k: (v + 0.5) / (v + 0.5).sum() for k, v in counts.items()}
    for b in range(code.shape[1]):
        one = np.mean([share[k] for k, c in zip(langs, code[:, b]) if c > 0], axis=0)
        rest = np.mean([share[k] for k, c in zip(langs, code[:, b]) if c < 0], axis=0)
        np.testing.assert_allclose(weights[:, b], np.log(one / rest), atol=1e-5)


def test_languages_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = languages.identify_languages(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == df.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out and r.lang and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.98 * len(tested) and len(tested) > 100


def test_languages_never_see_the_held_out_fold(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    swapped = df.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'zz' ELSE lang END AS lang", "source", "n_chars")
    assert sorted(languages.identify_languages(df).collect()) == sorted(languages.identify_languages(swapped).collect())


def test_languages_of_awkward_rows(spark, docs, empty):
    assert languages.identify_languages(empty).isEmpty()
    got = languages.identify_languages(docs).collect()
    assert len(got) == len(texts())
    by_text = {}
    for r in docs.collect():
        by_text.setdefault(r.doc_id, []).append(r.text)
    for r in got:
        lettered = [any(c.isalpha() for c in t or "") for t in by_text[r.doc_id]]
        assert r.lang_pred in {"und", "en", "de"} and (r.doc_id is not None or r.held_out)
        if r.doc_id is not None:
            assert (r.lang_pred != "und") == lettered[0]
    unknown = docs.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in languages.identify_languages(unknown).collect()} == {"und"}
    one = docs.drop("lang").selectExpr("*", "'xx' AS lang")
    assert {(r.lang_pred, r.score) for r in languages.identify_languages(one).collect()} == {("und", 0.0), ("xx", 1.0)}


@pytest.mark.parametrize("name", ["op12_postorder_manifest", "op13_pruned_negatives"])
def test_same_rows_as_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert Counter(map(tuple, df.collect())) == Counter(want) and want


@pytest.mark.parametrize("counts,longest", [([5, 9, 12, 13, 16, 45], 16), ([1] * 7, 3), ([1, 1, 2, 3, 5, 8, 13, 21, 34], 4), ([100, 1, 1, 1, 1], 3)])
def test_huffman_lengths_are_the_best_of_their_limit(counts, longest):
    """Held against all non-increasing lengths that a prefix code of the limit can have."""
    lengths = code_lengths(np.array(counts, np.int64), longest)
    assert lengths.max() <= longest and sum(2.0 ** -int(n) for n in lengths) <= 1
    order = sorted(counts, reverse=True)
    best = [math.inf]

    def walk(i, least, room, cost):
        if cost >= best[0]:
            return
        if i == len(order):
            best[0] = cost
            return
        for n in range(least, longest + 1):
            if room >= (len(order) - i) * 0.5 ** longest and room >= 0.5 ** n:
                walk(i + 1, n, room - 0.5 ** n, cost + n * order[i])
    walk(0, 1, 1.0, 0)
    assert int((lengths.astype(int) * np.array(counts)).sum()) == best[0]


@pytest.mark.parametrize("symbols,n", [(1, 5), (2, 64), (3, 65), (300, 1), (300, 5000), (49152, 200_000)])
def test_huffman_blocks_decode_to_what_was_packed(symbols, n):
    rng = np.random.default_rng(symbols)
    ids = np.minimum(rng.zipf(1.3, n) - 1, symbols - 1).astype(np.uint32)
    code = Code(code_lengths(np.bincount(ids, minlength=symbols)))
    raw, marks = code.pack(ids)
    assert len(marks) == -(-n // 64) and len(raw) == -(-int(code.lengths[ids].sum()) // 8)
    assert (code.unpack(raw, marks, n) == ids).all()
    if n > 640:  # a reader starts at any checkpoint
        tail = code.unpack(raw, marks, n)[640:]
        skipped = int(marks[:10].sum())
        whole = "".join(f"{b:08b}" for b in raw[skipped // 8:skipped // 8 + 200])[skipped % 8:]
        want = "".join(f"{int(code.codes[i]):0{int(code.lengths[i])}b}" for i in tail[:40])
        assert whole.startswith(want[:1000])


def test_passages_that_earlier_documents_hold_in_parts(spark):
    """Two texts share 60 words, and every word run of these is in an earlier text as well."""
    shared = sentence(50, 60).split()
    rows = [(i, " ".join([sentence(60 + i, 40), *shared[i * 3:i * 3 + 25], sentence(90 + i, 40)])) for i in range(12)]
    rows += [(100, " ".join([sentence(31, 80), *shared, sentence(32, 30)])), (101, " ".join([sentence(33, 20), *shared, sentence(34, 70)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.other_id): (r.first_word, r.n_words, r.other_first, r.n_matched) for r in chaining.fuzzy_passages(df).collect()}
    assert found == {(101, 100): (20, 60, 80, 60)}


def test_passages_of_seeds_in_many_places(spark):
    """As above, with every seed in more places than are paired, the first ones in texts that share too little; equal texts meet by their first."""
    shared = sentence(50, 60).split()
    rows = [(i, " ".join([sentence(160 + i, 40), *shared[i % 12 * 3:i % 12 * 3 + 25], sentence(290 + i, 40)])) for i in range(120)]
    rows += [(200, " ".join([sentence(31, 80), *shared, sentence(32, 30)])), (201, " ".join([sentence(33, 20), *shared, sentence(34, 70)]))]
    rows += [(300 + i, rows[-1][1]) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.other_id): (r.first_word, r.n_words, r.other_first, r.n_matched) for r in chaining.fuzzy_passages(df).collect()}
    assert found[(201, 200)] == (20, 60, 80, 60)
    assert all(found[(300 + i, 201)] == (0, 150, 0, 150) for i in range(12))


def test_anchors_of_two_texts_are_those_of_all_matches(monkeypatch):
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 5, 60), rng.integers(0, 5, 50)
    y, x = np.nonzero(a[:, None] == b[None, :])
    want = chaining.anchors(y, x)
    for at_once in (1, 7, 1000):
        monkeypatch.setattr(chaining, "AT_ONCE", at_once)
        got = chaining.common(a, np.arange(60), b, np.arange(50))
        assert all((g == w).all() for g, w in zip(got, want))


def test_passages_are_those_of_brute_force(spark):
    """Verbatim and changed passages of random length between random texts, against all pairs word by word."""
    rng = np.random.default_rng(12)
    bodies = [sentence(200 + i, int(rng.integers(60, 160))).split() for i in range(40)]
    planted = set()
    for _ in range(25):
        a, b = sorted(rng.choice(40, 2, replace=False).tolist())
        n = int(rng.integers(45, 60))
        start = int(rng.integers(0, len(bodies[a]) - n))
        part = bodies[a][start:start + n].copy()
        for k in range(12, n - 12, 17):
            part[k] = "changed"
        at = int(rng.integers(0, len(bodies[b])))
        bodies[b] = bodies[b][:at] + part + bodies[b][at:]
    texts_ = [" ".join(b) for b in bodies]

    def shares(a, b):
        """Whether 40 words in a row of a are found in b with at most four of them, none at an end, replaced."""
        width = {}
        for i in range(len(a)):
            for j in range(len(b)):
                if a[i] == b[j]:
                    width.setdefault(i - j, []).append(i)
        return any(s + 39 in hits and sum(s <= i < s + 40 for i in hits) >= 36 for hits in width.values() if len(hits) >= 36 for s in hits)
    for i in range(40):
        for j in range(i):
            if shares(bodies[i], bodies[j]):
                planted.add((i, j))
    df = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    got = {(r.doc_id, r.other_id) for r in chaining.fuzzy_passages(df).collect()}
    assert planted <= got and len(planted) >= 20
    for i, j in got:  # what is found shares at least its least words
        assert len(set(bodies[i]) & set(bodies[j])) >= 25


def test_long_texts_have_no_false_repeats(spark):
    """Few hash bits are left beside a place in a long text; the words decide."""
    df = spark.range(1).selectExpr("array_join(transform(sequence(1, 400000), i -> concat('w', i)), ' ') AS text")
    assert quality.with_statistics(df).select("n_repeat_words").first()[0] == 0
    twice = df.selectExpr("concat(text, ' ', substring_index(text, ' ', 20)) AS text")
    assert quality.with_statistics(twice).select("n_repeat_words").first()[0] == 40


def test_stars_are_split_and_exact(spark, monkeypatch):
    """A star of many partners goes to several tasks; the pairs are those of plain set arithmetic."""
    monkeypatch.setattr(minhash, "STAR", 3)
    rng = np.random.default_rng(3)
    sets = {f"s{i:02d}".encode(): np.unique(rng.integers(0, 12, 10).astype(np.uint64)) for i in range(40)}
    full = spark.createDataFrame([(bytearray(k), bytearray(v.tobytes())) for k, v in sets.items()], "set_id binary, shingles binary")
    pairs = [(a, b) for a in list(sets)[:4] for b in sets if a != b] + [(list(sets)[0], list(sets)[1])]
    df = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in pairs], "a binary, b binary")
    got = {(bytes(r.a), bytes(r.b)) for r in minhash._verified(df, full, 60).collect()}
    both = lambda a, b: (len(np.intersect1d(sets[a], sets[b])), len(np.union1d(sets[a], sets[b])))
    assert got == {(a, b) for a, b in pairs if 100 * both(a, b)[0] >= 60 * both(a, b)[1]} and 0 < len(got) < len(set(pairs))


def test_ids_of_odd_texts_are_the_tokenizer_s():
    """Letters that lower to a letter and a mark, odd spaces, contractions, digits and marks, whole lines of new words."""
    path = queries.public_tokenizers.path("word_bpe_49k.json")
    rng = np.random.default_rng(4)
    odd = ["", " ", "\x1c a\x1db", "İ.", "x\x0by\x0cz", "Hello, WORLD!!! don't", "ß É İ ſ ŉ ﬁ ǰ", "\x00a", "日本 語", "é 🙂🙂", "ᾳ ᾼ ǅ ʰ ª º"]
    odd += ["".join(rng.choice(list("aB '!.,\t\n\xa0éİ9_-🙂ǅª"), rng.integers(0, 40))) for _ in range(500)]
    odd += [sentence(1000 + i, 300) for i in range(5)]
    encoder, tokenizer = token_files.Encoder(path, np.dtype("<u2")), token_files._tokenizer(path)
    got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(odd)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in odd]
