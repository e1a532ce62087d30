"""Language of a text by error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crashlake.llm.common import ship, store

#: Characters of an n-gram; hashed features; smoothing of their counts; points hashed at once.
SIZES, BITS, SMOOTHING, BLOCK = (1, 2, 3), 16, 0.5, 1 << 18
#: Up to this many languages every way to part them is a bit; beyond, a random code is drawn
#: with this many bits per doubling of languages, the best of so many draws.
EXHAUSTIVE, LENGTH, DRAWS = 6, 10, 64
#: A text is ambiguous when the two nearest codewords' distances differ by a smaller share.
AMBIGUOUS = 0.2


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 for each of ``n`` languages; no column is constant."""
    if n <= EXHAUSTIVE:
        ways = np.arange(1, 1 << max(n - 1, 0))
        return np.array([np.ones(len(ways), int), *[1 - 2 * (ways >> k & 1) for k in range(n - 1)]][:n]).reshape(n, len(ways))
    best, distance = None, -1
    for seed in range(DRAWS):
        code = np.random.default_rng(seed).choice([-1, 1], (n, math.ceil(LENGTH * math.log2(n))))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = (code.shape[1] - code @ code.T) // 2
        least = int(apart[~np.eye(n, dtype=bool)].min())
        if least > distance:
            best, distance = code, least
    return best


@lru_cache(1)
def letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for anything else."""
    out = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            out[point] = ord(c.lower()[0])
    return out


def grams(text: str) -> list[np.ndarray]:
    """Hashed n-grams of the letters of a text, each run of other characters being one gap."""
    points = letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    points = np.concatenate([[0], points, [0]]).astype(np.uint32)
    points = points[np.append(True, (points[1:] != 0) | (points[:-1] != 0))]
    if len(points) < 2:
        return []
    out = []
    for low in range(0, len(points), BLOCK):
        for n in SIZES:
            part = points[low:low + BLOCK + n - 1]
            if len(part) < n:
                continue
            total = np.full(len(part) - n + 1, n, np.uint32)
            for k in range(n):
                total = (total ^ part[k:k + len(total)]) * np.uint32(0x9E3779B1)
                total ^= total >> np.uint32(15)
            hashed = total >> np.uint32(32 - BITS)
            out.append(hashed[part[:len(hashed)] != 0] if n == 1 else hashed)
    return out


def _count(batches):
    """n-grams of each language in this task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            for g in grams(text):
                if lang not in sums:
                    sums[lang] = np.zeros(1 << BITS, np.int64)
                sums[lang] += np.bincount(g, minlength=1 << BITS)
    for lang, n in sums.items():
        used = np.flatnonzero(n)
        yield pa.record_batch([pa.array([lang] * len(used)), pa.array(used, pa.int32()), pa.array(n[used])], ["lang", "gram", "n"])


def held_out(doc_id: str = "doc_id"):
    """Whether a document is never learned from; one with a null doc_id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(counts: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their codewords, and the weights of every n-gram for every bit.

    A bit's classifier is a naive Bayes one of two groups of languages that count alike: an
    n-gram's weight is the log of its mean share in the one over that in the other.
    """
    langs = sorted(counts, key=str.encode)
    code = codewords(len(langs))
    n = np.array([counts[k] for k in langs], float).reshape(len(langs), 1 << BITS) + SMOOTHING
    share = n / n.sum(1, keepdims=True)
    ones, rest = (code > 0).astype(float), (code < 0).astype(float)
    one = (ones / np.maximum(ones.sum(0), 1)).T @ share
    other = (rest / np.maximum(rest.sum(0), 1)).T @ share
    with np.errstate(divide="ignore"):
        return langs, code, np.ascontiguousarray((np.log(one) - np.log(other)).T.astype(np.float32))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Classifiers from the n-gram counts of all texts of the learning fold."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("lang", "text")
    found = known.mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, np.ndarray] = {}
    lang = np.array(found["lang"].to_pylist(), object)
    for name in set(lang.tolist()):
        mine = lang == name
        counts[name] = np.bincount(found["gram"].to_numpy()[mine], found["n"].to_numpy()[mine], 1 << BITS)
    return fit(counts)


def _answers(model):
    def answer(batches):
        """Every bit's answer to a text: the mean weight of its n-grams."""
        weights = model.value
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                parts = grams(text or "")
                n = sum(map(len, parts))
                total = sum((weights[g].sum(0, dtype=float) for g in parts), np.zeros(weights.shape[1]))
                out.append((total / n).tolist() if n else None)
            yield pa.record_batch([batch["doc_id"], batch["held_out"], batch["lang"], batch["wordless"], pa.array(out, pa.list_(pa.float64()))],
                                  ["doc_id", "held_out", "lang", "wordless", "answers"])
    return answer


def reliability(answers: DataFrame, langs: list[str], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far each bit's answers reach, and how often it is right on each language's texts.

    Both are means over the learning fold; a language's shares are made to sum to 1.
    """
    bits = range(code.shape[1])
    known = answers.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("answers").isNotNull())
    rows = known.groupBy("lang").agg(F.array(*[F.avg(F.abs(F.col("answers")[b])) for b in bits]).alias("reach"),
                                     F.array(*[F.avg((F.col("answers")[b] > 0).cast("double")) for b in bits]).alias("ones")).collect()
    reach, right = np.ones((len(langs), len(bits))), np.full(code.shape, 0.5)
    for r in rows:
        k = langs.index(r.lang)
        reach[k], right[k] = r.reach, np.where(code[k] > 0, r.ones, 1 - np.array(r.ones))
    right = np.maximum(right, 1e-6)
    return np.maximum(reach.mean(0), 1e-9), right / right.sum(1, keepdims=True)


def decode(answers: np.ndarray, code: np.ndarray, reach: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distance of every text to every codeword: the exponential losses of the bits, weighted
    by how reliable each is for the language."""
    scaled = np.clip(answers / reach, -3, 3)
    return np.stack([np.exp(-code[k] * scaled) @ right[k] for k in range(len(code))], axis=1)


def _decoder(langs: list[str], code: np.ndarray, reach: np.ndarray, right: np.ndarray):
    def run(batches):
        for batch in batches:
            given = batch["answers"].to_pylist()
            empty = np.array([a is None or w for a, w in zip(given, batch["wordless"].to_pylist())], bool) | (not langs)
            names, scores, second = np.full(len(given), "und", object), np.zeros(len(given)), np.full(len(given), None, object)
            unsure = np.ones(len(given), bool)
            at = np.flatnonzero(~empty)
            if len(at):
                far = decode(np.array([given[i] for i in at], float).reshape(len(at), -1), code, reach, right)
                order = np.argsort(far, axis=1, kind="stable")
                names[at] = np.array(langs, object)[order[:, 0]]
                least = far.min(1, keepdims=True)
                chance = np.exp(-code.shape[1] * (far - least))
                scores[at] = chance.max(1) / chance.sum(1)
                unsure[at] = False
                if len(langs) > 1:
                    next_ = np.take_along_axis(far, order[:, 1:2], 1)
                    unsure[at] = (next_ - least < AMBIGUOUS * next_)[:, 0]
                    second[at] = np.array(langs, object)[order[:, 1]]
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores),
                                   pa.array(unsure), pa.array(second, pa.string())],
                                  ["doc_id", "held_out", "lang_pred", "score", "ambiguous", "second"])
    return run


def identify_languages(docs: DataFrame) -> DataFrame:
    """Return doc_id, held_out, lang_pred, score, ambiguous and second of every document.

    Languages are those of the learning fold. A bit of their codewords parts them in two
    groups, and its classifier is learned from the n-grams of all texts of that fold; a text
    gets the language whose codeword is nearest to the bits' answers, by losses weighted by how
    reliable each bit is for the language. ``score`` is the nearest codeword's share of the
    likelihoods that the losses stand for; ``ambiguous`` marks texts whose second codeword is
    nearly as near, and texts without a language. Ties go to the first language by UTF-8 bytes.

    A null text or one without a letter is ``und`` with score 0, as all texts are when no
    language can be learned; with a single one all others are of that one. Rows are judged one
    by one, so equal texts are judged alike; lang, source and doc_id are never inputs. A null
    doc_id counts as held out; other columns are not read; an empty table gives no rows.

    Texts are read twice, to count and to answer. Counts by language and feature, at most
    ``2**BITS`` a language, reach the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    langs, code, weights = train(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "lang",
                       (~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).alias("wordless"), "text")
    shape = "doc_id long, held_out boolean, lang string, wordless boolean, answers array<double>"
    answers = store(rows.mapInArrow(_answers(spark.sparkContext.broadcast(weights)), shape), "answers")
    reach, right = reliability(answers, langs, code) if code.size else (np.ones(0), np.ones(code.shape))
    return answers.mapInArrow(_decoder(langs, code, reach, right), "doc_id long, held_out boolean, lang_pred string, score double, "
                              "ambiguous boolean, second string")
