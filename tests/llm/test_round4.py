"""What the corpus operators keep on disk and how often they compute a thing."""

from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from crashlake.llm import chaining, minhash, quality, suffixes, token_files
from test_corpus import sentence


def test_suffix_order_writes_no_files(monkeypatch):
    def refuse(*args, **kwargs):
        raise AssertionError("a file was asked for")

    monkeypatch.setattr("tempfile.TemporaryDirectory", refuse)
    line = bytes(range(60, 112))
    owners = suffixes.first_owners([line, b"-" + line, line[:51]], np.array([5, 3, 4]))
    assert [o.tolist() for o in owners] == [[3, 3, 3], [3, 3, 3, 3], [3, 3]]


def test_packed_texts_come_back(monkeypatch):
    monkeypatch.setattr(suffixes, "HELD", 3000)
    texts = ["", "ein Wört ", "an ordinary sentence, and again an ordinary sentence " * 40, "x" * 5000]
    batch = pa.record_batch([pa.array([1, 0, 1, 1], pa.int32()), pa.array([7, 8, 9, 10]), pa.array([None, 0, 4, -2], pa.int64()), pa.array(texts)],
                            ["part", "row", "doc_id", "text"])
    notes = [n for b in suffixes._pack_texts([batch]) for n in b.to_pylist()]
    assert {n["part"] for n in notes} == {0, 1} and sum(len(n["texts"]) for n in notes) < 500
    found = [(n["part"], int(r), None if gone else int(d), t.decode())
             for n in notes for r, d, gone, t in zip(*suffixes._unpacked(n))]
    assert sorted(found, key=lambda f: f[1]) == list(zip([1, 0, 1, 1], [7, 8, 9, 10], [None, 0, 4, -2], texts))


def test_known_stretches_go_on_together():
    """Notes of as many tasks as there are make one note for each group of rows, not one for each task."""
    kinds = lambda k, rows: [(3, k, 0, np.array([r]).tobytes(), np.array([1], np.uint32).tobytes(), None,
                              np.array([r], np.uint32).tobytes(), np.array([r + 60], np.uint32).tobytes(), None, None) for r in rows]
    batch = suffixes._note(kinds(1, range(40)))
    for step in (suffixes._answer_anchors(4), suffixes._judge_segments(4)):
        assert sum(b.num_rows for b in step(iter([batch]))) == 4


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.n, self.model = tokenizer, 0, tokenizer.model

    def encode_batch_fast(self, texts, **more):
        self.n += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **more)


@pytest.mark.parametrize("ends_known", [True, False])
def test_new_words_are_encoded_by_the_line(ends_known):
    """One call for a line of new words; where the ends of words are not known, word by word, with the same ids."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdeföéß"), 7)) for _ in range(320)]
    texts = [" ".join(words), "", " \t".join(words[:50]) + ", ", "a\x1cb c\u2028d 1st it's", f"{words[3]}!!\n{words[4].upper()}"]
    encoder = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"), np.dtype("<u2"))
    plain, counted = encoder.tokenizer, Counted(encoder.tokenizer)
    encoder.tokenizer = counted
    if not ends_known:
        encoder.ends[:] = False
    assert encoder.encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert (counted.n < 40) == ends_known


def test_texts_that_nobody_asks_for_are_not_joined(spark):
    """The bits keep every document that is asked for, null ids among them, and few others."""
    rows = spark.range(2000).selectExpr("IF(id = 5, NULL, id) AS doc_id", "xxhash64(id) AS text_key", "concat('text ', id) AS text", "id AS _word")
    keys = rows.where("_word % 50 = 5").selectExpr("doc_id AS _id", "text_key AS _key")
    maybe, sure = minhash._maybe(rows, keys, "doc_id", "text_key")
    assert maybe.columns == rows.columns == sure.columns and maybe.count() + sure.count() == 2000
    assert sure.where("_word % 50 = 5").isEmpty() and 40 <= maybe.count() < 60


def test_two_sets_meet_once(spark, monkeypatch):
    """Sets that share bands without being near are verified in one round, and go no further."""
    rows = []
    for i in range(8):
        words = [f"w{i}x{k}" for k in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:170] + [f"v{i}x{k}" for k in range(30)]))]
    rounds, plain = [], minhash._verified

    def verified(pairs, *args, **more):
        rounds.append([frozenset(map(bytes, p)) for p in pairs.distinct().collect()])
        return plain(pairs, *args, **more)

    monkeypatch.setattr(minhash, "_verified", verified)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert minhash.near_duplicates(docs, 2, 80).where("kept").count() == 16
    assert len(rounds[0]) == 8 and not any(rounds[1:])


def test_a_member_that_leaves_a_band_has_met_the_others(spark):
    """Of every band, two sets of different components are a pair of this turn, or both stay."""
    rng = np.random.default_rng(5)
    rows = [(band, bytes([s]), bytes([label])) for band in range(30) for s, label in enumerate(rng.integers(0, 3, rng.integers(2, 9)))]
    named = spark.createDataFrame([(b, bytearray(s), bytearray(x)) for b, s, x in rows], "band long, set_id binary, label binary")
    apart, pairs = minhash._turn(named, 0)
    stay = {(r.band, bytes(r.set_id)) for r in apart.collect()}
    met = {frozenset((bytes(p.a), bytes(p.b))) for p in pairs.collect()}
    apart_pairs = [(b, s, t) for b, s, x in rows for c, t, y in rows if b == c and s < t and x != y]
    assert all(frozenset((s, t)) in met or {(b, s), (b, t)} <= stay for b, s, t in apart_pairs)
    assert len(stay) == sum(len({x for c, _, x in rows if c == b}) > 1 for b, _, _ in rows) - len({b for b, _, _ in apart_pairs})


def test_texts_that_are_kept_are_not_joined(spark, monkeypatch):
    """Few texts besides the rejected ones meet the verdicts; null keys and rows that differ in one key alone are told apart."""
    rows = [(None if i % 9 == 0 else i, " ".join(f"w{i}x{k}" for k in range(40 if i % 10 else 5)), None if i % 7 == 0 else "en", f"s{i % 2}", 3)
            for i in range(300)]
    rows += [(10, rows[11][1], "en", "s0", 4), (11, rows[10][1], "en", "s1", 4), (11, rows[11][1], "de", "s1", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _text_hash int")
    moved, plain = [], quality.maybe_asked

    def asked(*args):
        maybe, sure = plain(*args)
        moved.append(maybe.count())
        return maybe, sure

    monkeypatch.setattr(quality, "maybe_asked", asked)
    report = quality.quality_report(docs)
    names = ["doc_id", "lang", "source"]
    good = quality.keep_good(docs)
    bad = report.where("NOT kept").count()
    assert good.columns == docs.columns and bad <= moved[0] < bad + 20 and 30 < bad < 200
    assert sorted(map(str, good.select(*names).collect())) == sorted(map(str, report.where("kept").select(*names).collect()))


def test_a_common_line_does_not_pair_its_documents(spark):
    """Documents that share a line of 17 words and no more are no pairs; of those that go on alike after it none is lost."""
    line, more = sentence(700, 17), sentence(701, 40)
    rows = [(i, f"{sentence(710 + i, 60)} {line} {sentence(810 + i, 60)}") for i in range(60)]
    rows += [(100 + i, f"{sentence(910 + i, 60)} {line} {more} {sentence(930 + i, 60)}") for i in range(4)]
    rows += [(200 + i, f"{sentence(950 + i, 60)} {'the ' * (12 + i % 9)} {sentence(980 + i, 60)}") for i in range(30)]
    rows += [(300 + i, f"{sentence(1050 + i, 60)} {'the ' * (45 + i)} {sentence(1080 + i, 60)}") for i in range(3)]
    asked, plain = [], chaining._unmet_pairs

    def unmet_pairs(*args):
        out = plain(*args)
        asked.append({tuple(r) for r in out.collect()})
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(chaining, "_unmet_pairs", unmet_pairs)
        found = chaining.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    near = {(100 + i, 100 + j) for i in range(4) for j in range(i)} | {(300 + i, 300 + j) for i in range(3) for j in range(i)}
    assert {(r.doc_id, r.other_id) for r in found} == near
    assert len(asked[0] - near) <= 4  # all pairs are over 2,000


def test_links_grow_as_passages_do():
    """Pairs that meet at a link are those that ``grow`` takes to the least length, however many parts they are dealt to."""
    rng = np.random.default_rng(4)
    sides = rng.integers(0, 9, (2, 40))
    words = [[np.where(rng.random(40) < 0.85, s, rng.integers(9, 18, 40))[:rng.integers(0, 41)].astype(np.uint32) for s in sides] for _ in range(60)]
    rows = {"doc_id": list(range(60)), "bucket": [0] * 60, "unmet": [i % 3 > 0 for i in range(60)], "away": [9] * 60, "free": [False] * 60, "size": [14] * 60,
            "part": [i % 2 for i in range(60)], "word": [7] * 60, "before": [a.tobytes() for a, _ in words], "after": [b.tobytes() for _, b in words]}
    got = Counter(p for q in ((0, 0), (0, 1), (1, 1)) for p in zip(*(c.tolist() for c in chaining.meetings(rows, *q))))
    grown = lambda i, j: sum(chaining.grow(words[i][side], words[j][side])[0] for side in (0, 1))
    want = {(i, j) for i in range(60) for j in range(i) if (i % 3 or j % 3) and 14 + grown(i, j) >= chaining.LEAST_WORDS}
    assert got == Counter(want) and 20 < len(want) < 1500
