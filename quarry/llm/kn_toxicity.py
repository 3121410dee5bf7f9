"""Toxicity by class-conditional Kneser-Ney language models.

One bigram model is kept for each class. Its lower order is the class's continuation
counts, interpolated with continuation counts shared by both classes, so an expression
that is rare in a class backs off to what the whole sample says about it and moves the
comparison little. A document's evidence is the difference of the two length-normalised
log-likelihoods, over the whole text and over its most telling window of ``WINDOW``
words; a logistic curve fitted by cross-fitting turns it into a score from 0 to 1.

The models are fitted on a bounded sample of labelled documents, up to ``sample`` rows of
each class by itself, those with the smallest seeded keys; counting runs on the executors. Every document
is scored over its whole text. Only words are inputs.

Defined results: null and empty texts have no evidence and get the curve's value at
zero; without labels of both classes every score is 0; equal rows give equal rows; an
empty table gives an empty frame.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes, cut, filter_rows, labelled_sample, map_rows

WINDOW = 32
MARGIN = 0.85
FLOOR = 1e-3
GROUP = 200_000
FOLDS = 10           # of the curve's cross-fitting: evidence of nine tenths is close to the final model's
START = 0x5851F42D4C957F2D  # stands before the first word
# ASCII upper case becomes lower case, ASCII other than letters, digits and ' a space
FOLD = bytes(c + 32 if 65 <= c <= 90 else (c if c > 127 or chr(c).isalnum() or c == 39 else 32) for c in range(256))


def folded_words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


class _Hashes(dict):
    def __missing__(self, w: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def word_hashes(raw: bytes, cache: _Hashes) -> np.ndarray:
    words = folded_words(raw)
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """A hash for each word with the word before it (START before the first)."""
    before = np.concatenate([np.array([START], dtype=np.uint64), h[:-1]]) if len(h) else h
    x = before * np.uint64(0x9E3779B97F4A7C15) ^ (h + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


class Lookup:
    """Sorted 64-bit keys with float columns; an absent key has zeros."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.vstack([np.zeros((1, values.shape[1]), values.dtype), values[order]])

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return self.values[np.zeros(len(keys), dtype=np.int64)]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[np.where(self.keys[at] == keys, at + 1, 0)]


def discounts(met: np.ndarray) -> np.ndarray:
    """Kneser-Ney discounts of counts 1, 2 and 3 or more; ``met``: how many have counts 1, 2, 3 and 4."""
    n = np.maximum(1.0, met)
    y = n[0] / (n[0] + 2 * n[1])
    d = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.clip(d, [0.5, 0.7, 0.9], [1.0, 2.0, 3.0])


def few_types(word: np.ndarray, chance: np.ndarray, words: int) -> np.ndarray:
    """Chances (words x 5) that 0 to 4 of a word's bigram types are met, each by its own chance."""
    p = np.zeros((words, 5))
    p[:, 0] = 1.0
    some = np.flatnonzero(chance > 0)
    some = some[np.lexsort((-chance[some], word[some]))]
    word, chance = word[some], chance[some]
    rank = np.arange(len(word)) - np.searchsorted(word, word)
    turns = np.argsort(rank, kind="stable")
    edges = np.searchsorted(rank[turns], np.arange(rank.max(initial=-1) + 2))
    for at, end in zip(edges, edges[1:]):  # one type of each word, until all surely have more than 4
        i = turns[at:end]
        i = i[p[word[i]].sum(axis=1) > 1e-9]
        if not len(i):
            break
        before, m = p[word[i]], chance[i][:, None]
        p[word[i]] = before * (1.0 - m) + np.hstack([np.zeros((len(i), 1)), before[:, :-1] * m])
    return p


class KneserNey:
    """Both classes' interpolated bigram models over one vocabulary.

    Continuation counts grow slower than the text, so those of unequal classes don't compare.
    All rows count; the lower order takes the counts expected at as many words as the smaller
    class has. Classes of equal size keep their plain counts.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray, pair: np.ndarray, counts: np.ndarray):
        """Bigram types: hashes of both words and of the pair, counts (types x 2 classes)."""
        total = counts.sum(axis=0)
        met = 1.0 - (1.0 - (total.min() / total if total.min() > 0 else np.ones(2))) ** counts
        words, at = np.unique(np.concatenate([first, second]), return_inverse=True)
        a, b = at[:len(first)], at[len(first):]

        def per(index: np.ndarray, values: np.ndarray) -> np.ndarray:
            return np.stack([np.bincount(index, values[:, c], len(words)) for c in (0, 1)], axis=1)

        def discounted(c: np.ndarray) -> np.ndarray:
            d = np.append(0.0, discounts(np.array([(c == k).sum() for k in (1, 2, 3, 4)])))
            return np.maximum(0.0, c - d[np.minimum(c, 3).astype(int)])

        def discounted_types(c: int) -> np.ndarray:
            p = few_types(b, met[:, c], len(words))
            d = discounts(p[:, 1:].sum(axis=0))
            return np.maximum(0.0, cont[:, c] - p[:, 1:3] @ d[:2] - d[2] * np.maximum(0.0, 1.0 - p[:, :3].sum(axis=1)))

        history, cont, types = per(a, counts), per(b, met), np.maximum(1.0, met.sum(axis=0))
        kept = np.stack([discounted(counts[:, c].astype(np.float64)) for c in (0, 1)], axis=1)
        kept_cont = np.stack([discounted_types(c) for c in (0, 1)], axis=1)
        # backed-off mass of a class's lower order, and of each history
        self.rest = 1.0 - kept_cont.sum(axis=0) / types
        weight = np.where(history > 0, 1.0 - per(a, kept) / np.maximum(1, history), 1.0)
        either = 1.0 - (1.0 - met[:, 0]) * (1.0 - met[:, 1])
        mass = either.sum() + len(words) + 1.0
        common = (np.bincount(b, either, len(words)) + 1.0) / mass
        lower = kept_cont / types + self.rest * common[:, None]
        self.unseen = 1.0 / mass
        # per word: lower-order probabilities as second word, backoff weights as first word, shared probability
        self.words = Lookup(words, np.hstack([lower, weight, common[:, None]]).astype(np.float32))
        self.pairs = Lookup(pair, (kept / np.maximum(1, history[a])).astype(np.float32))

    def arrays(self) -> tuple:
        """The model as plain arrays, for a broadcast."""
        return self.words.keys, self.words.values, self.pairs.keys, self.pairs.values, self.rest, self.unseen

    @staticmethod
    def from_arrays(arrays: tuple) -> KneserNey:
        m = KneserNey.__new__(KneserNey)
        m.words, m.pairs = Lookup.__new__(Lookup), Lookup.__new__(Lookup)
        m.words.keys, m.words.values, m.pairs.keys, m.pairs.values, m.rest, m.unseen = arrays
        return m

    def evidence(self, h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log p(word | toxic) - log p(word | ordinary) of each word, by bigrams and by the
        lower order; ``starts``: first words of texts. In the lower order the classes' backed-off
        masses are set equal, so a word that neither class kept says nothing."""
        got = self.words(h)
        known = got[:, 4] > 0
        lower = np.where(known[:, None], got[:, :2], (self.rest * self.unseen)[None, :])
        shared = np.where(known, got[:, 4], self.unseen)[:, None] * self.rest[None, :]
        alone = np.log(lower / shared)
        back = np.ones((len(h), 2))
        back[1:] = np.where((got[:-1, 4] > 0)[:, None], got[:-1, 2:4], 1.0)
        back[starts] = self.words(np.array([START], dtype=np.uint64))[0, 2:4]
        x = np.concatenate([np.array([START], dtype=np.uint64), h[:-1]])
        x[starts] = START
        key = x * np.uint64(0x9E3779B97F4A7C15) ^ (h + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
        p = self.pairs(key ^ (key >> np.uint64(32))) + np.maximum(back, 1e-9) * lower
        return np.log(p[:, 1] / p[:, 0]), alone[:, 1] - alone[:, 0]


def text_evidence(model: KneserNey, hashes: list[np.ndarray]) -> np.ndarray:
    """Of each text: mean bigram evidence, mean strong lower-order evidence, the same in its most toxic window.

    Strong evidence is what exceeds ``MARGIN`` of the most that a word of one class alone can
    have, either way: sampling noise of common and rare words stays below it. Means are on a
    log scale, where both ordinary and toxic documents are compact groups.
    """
    out = np.zeros((len(hashes), 3))
    sizes = np.array([len(h) for h in hashes])
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    pairs, alone = model.evidence(np.concatenate([hashes[i] for i in full]), starts)
    margin = MARGIN * np.log1p(2.0 / max(1e-3, float(np.mean(model.rest))))
    strong = np.sign(alone) * np.maximum(0.0, np.abs(alone) - margin)
    out[full, 0] = np.add.reduceat(pairs, starts) / sizes[full]
    run = np.concatenate([[0.0], np.cumsum(strong)])
    out[full, 1] = (run[starts + sizes[full]] - run[starts]) / sizes[full]
    at, end = np.arange(len(strong)), np.repeat(starts + sizes[full], sizes[full])
    first = np.maximum(np.repeat(starts, sizes[full]), np.minimum(at, end - WINDOW))
    out[full, 2] = np.maximum.reduceat(run[np.minimum(first + WINDOW, end)] - run[first], starts) / WINDOW
    out[:, 1:] = np.log((np.maximum(0.0, out[:, 1:]) + FLOOR) / FLOOR)
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, l2: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps; the last coefficient is the bias."""
    scale = x.std(axis=0) + 1e-9
    z = np.hstack([x / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (weight * (p - y)) + l2 * np.append(w[:-1], 0.0)
        hess = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + l2 * np.diag(np.append(np.ones(len(w) - 1), 1e-6))
        step = np.linalg.solve(hess, g)
        w -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
    return np.concatenate([w[:-1] / scale, w[-1:]])


class Judge:
    """A fitted model and its curve."""

    def __init__(self, model: KneserNey | None, curve: np.ndarray | None):
        self.model, self.curve = model, curve

    def scores(self, texts: list[bytes | None], cache: _Hashes) -> np.ndarray:
        """Scores of whole texts."""
        if self.model is None:
            return np.zeros(len(texts))
        x = whole_evidence(self.model, texts, cache)
        return 1 / (1 + np.exp(-np.clip(x @ self.curve[:-1] + self.curve[-1], -30, 30)))


def whole_evidence(model: KneserNey, texts: list[bytes | None], cache: _Hashes) -> np.ndarray:
    """``text_evidence`` of whole texts, about ``GROUP`` words at a time."""
    parts, group, words = [np.zeros((0, 3))], [], 0
    for t in texts:
        group.append(word_hashes(t or b"", cache))
        words += len(group[-1])
        if words >= GROUP:
            parts.append(text_evidence(model, group))
            group, words = [], 0
    if group:
        parts.append(text_evidence(model, group))
    return np.concatenate(parts)


def sample_counts(picked: DataFrame) -> DataFrame:
    """(fold, y, first, second, n): bigram counts of the sample, made on the executors."""
    def pairs(batch: pa.RecordBatch, cache: _Hashes):
        fold, y, first, second = [], [], [], []
        for f, label, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch, 2), strict=True):
            h = word_hashes(raw or b"", cache)
            if len(h):
                first.append(np.concatenate([np.array([START], dtype=np.uint64), h[:-1]]).view(np.int64))
                second.append(h.view(np.int64))
                fold.append(np.full(len(h), f, dtype=np.int32))
                y.append(np.full(len(h), label, dtype=np.int32))
        return [pa.array(np.concatenate(c) if c else np.zeros(0, t), k) for c, t, k in
                ((fold, np.int32, pa.int32()), (y, np.int32, pa.int32()), (first, np.int64, pa.int64()), (second, np.int64, pa.int64()))]

    rows = map_rows(picked, pairs, "fold int, y int, first long, second long", _Hashes)
    return rows.groupBy("fold", "y", "first", "second").agg(F.count(F.lit(1)).cast("int").alias("n"))


def model_of(table: dict[str, np.ndarray], use: np.ndarray) -> KneserNey:
    """The models of the count rows that ``use`` marks."""
    first, second = (table[c][use].view(np.uint64) for c in ("first", "second"))
    x = first * np.uint64(0x9E3779B97F4A7C15) ^ (second + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    pair, at, back = np.unique(x ^ (x >> np.uint64(32)), return_index=True, return_inverse=True)
    counts = np.zeros((len(pair), 2))
    np.add.at(counts, (back, table["y"][use]), table["n"][use])
    return KneserNey(first[at], second[at], pair, counts)


def _columns(counts: DataFrame) -> dict[str, np.ndarray]:
    """The sample's counts as sorted columns; what Arrow holds of them is released."""
    got = counts.coalesce(1).sortWithinPartitions("fold", "y", "first", "second").toArrow()
    return {c: got.column(c).to_numpy() for c in got.column_names}


def whole_model(spark: SparkSession, sent: Broadcast) -> KneserNey:
    """The models of all count rows, made in a task: the driver gets no more than the finished arrays."""
    def make(batches):
        for _ in batches:
            words, of_words, pairs, of_pairs, rest, unseen = model_of(sent.value, np.ones(len(sent.value["n"]), dtype=bool)).arrays()
            yield pa.RecordBatch.from_pydict({"words": [words.tobytes()], "of_words": [of_words.tobytes()], "pairs": [pairs.tobytes()],
                                              "of_pairs": [of_pairs.tobytes()], "rest": [rest.tolist()], "unseen": [float(unseen)]})

    made = spark.range(0, 1, 1, 1).mapInArrow(make, "words binary, of_words binary, pairs binary, of_pairs binary, rest array<double>, unseen double")
    row = made.first()
    words, pairs = (np.frombuffer(row[c], np.uint64) for c in ("words", "pairs"))
    of_words, of_pairs = (np.frombuffer(row[c], np.float32).reshape(-1, k) for c, k in (("of_words", 5), ("of_pairs", 2)))
    return KneserNey.from_arrays((words, of_words, pairs, of_pairs, np.array(row["rest"]), row["unseen"]))


def fit_judge(docs: DataFrame, labels: DataFrame, use: Column | None = None, sample: int = 1500, seed: int = 23,
              id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Judge:
    """Fit on at most ``sample`` labelled documents of each class (rows of ``docs`` where ``use``)."""
    rows, sizes = labelled_sample(docs, labels, id_col, text_col, label_col, sample, seed, use)
    if len(sizes) < 2:
        return Judge(None, None)
    fold = F.pmod(F.crc32("key"), F.lit(FOLDS)).cast("int").alias("fold")
    picked = [rows.where(F.col("y") == y).orderBy("key", "text").limit(sample) for y in (0, 1)]
    picked = cut(picked[0].unionByName(picked[1]).select(fold, "y", "text", "key"))
    sent = docs.sparkSession.sparkContext.broadcast(_columns(sample_counts(picked.select("fold", "y", "text"))))

    def crossed(pdf: pd.DataFrame) -> pd.DataFrame:
        model = model_of(sent.value, sent.value["fold"] != pdf["fold"].iloc[0])
        x = whole_evidence(model, list(pdf["text"]), _Hashes())
        return pd.DataFrame({"key": pdf["key"], "y": pdf["y"], "x": x.tolist()})

    # a fold has about ``sample / FOLDS`` rows of each class
    dealt = picked.withColumn("text", F.col("text").cast("binary")).repartition(FOLDS, "fold")
    fitted = dealt.groupBy("fold").applyInPandas(crossed, "key string, y int, x array<double>").orderBy("key", "y", "x").collect()
    y = np.array([r["y"] for r in fitted], dtype=float)
    x = np.array([r["x"] for r in fitted])
    drawn = {k: max(1.0, float((y == k).sum())) for k in (0, 1)}
    weight = np.where(y > 0, sizes[1] / drawn[1], sizes[0] / drawn[0])  # back to the labels' own shares
    curve = fit_curve(x, y, weight / weight.mean())
    model = whole_model(docs.sparkSession, sent)
    sent.destroy()
    return Judge(model, curve)


def toxicity(docs: DataFrame, judge: Judge, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast((judge.model.arrays() if judge.model else None, judge.curve))

    def score(batch: pa.RecordBatch, cache: _Hashes):
        arrays, curve = sent.value
        s = Judge(KneserNey.from_arrays(arrays) if arrays else None, curve).scores(as_bytes(batch, 1), cache)
        return [batch.column(0), s, (s >= threshold).astype(np.int32)]

    t = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), score,
                    f"doc_id {t}, score double, predicted int", _Hashes)


def clean_documents(docs: DataFrame, judge: Judge, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast((judge.model.arrays() if judge.model else None, judge.curve))

    def keep(texts: list, cache: _Hashes) -> np.ndarray:
        arrays, curve = sent.value
        return Judge(KneserNey.from_arrays(arrays) if arrays else None, curve).scores(texts, cache) < threshold

    return filter_rows(docs, text_col, keep, _Hashes)
