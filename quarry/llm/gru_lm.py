"""Gated recurrent language model with a class-factored output softmax.

Vocabulary. Every chunk of texts gives its distinct words with their training counts, in
packed blocks dealt to buckets by hash. A bucket adds the counts up and answers every
chunk, so all counts cover all training texts and no word table passes through one place.

Model. p(word | past) = p(class | state) * p(word | class, state). The ``CLASSES *
MEMBERS`` most frequent words lie in classes of ``MEMBERS`` by rank, with a softmax of
their own in each class. Any other word lies in a class of its count's bin and its
ending, inside which it has its share of the counts; words met once share their class
with unseen ones, which together count as one word with Good-Turing's share. A single
gated recurrent unit carries the state.

Training is truncated backpropagation through time in numpy: windows of ``STEPS`` words,
the state carried from window to window of a piece of a document. Every training document
is used once, in one of the rounds; each chunk trains from the round's
weights, and weights are averaged in two levels by the number of tokens. Scoring carries
the state across windows too, from the first word to the end of the whole document.

Defined results: null text is empty and is scored on its end alone; without training
documents the counts are 0 and both scores are the base formula's; equal rows give equal
rows; an empty table gives an empty frame.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes, cut
from quarry.session import shared_path

END = b"\n"          # no word holds it
CLASSES, MEMBERS = 32, 32
TOP = CLASSES * MEMBERS
BINS, ENDINGS = 6, 12  # classes of other words: count bins x endings
OTHERS = BINS * ENDINGS
HIDDEN = 24
STEPS = 16
PIECE = 512          # training cuts documents into pieces of so many words, each a lane of its own
LN10 = math.log(10.0)


def other_class(word: bytes, count: int) -> int:
    """The class of a word outside the top: bin of its count (0: once or never) and its ending."""
    b = 0 if count <= 1 else min(BINS - 1, 1 + (count.bit_length() - 1) // 3)
    return b * ENDINGS + zlib.crc32(word.rstrip(b".,;:!?")[-3:]) % ENDINGS


def _squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _inflate(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(bytes(blob))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[int, list, list, list[bytes]]]:
    """(chunk, ids, flags, texts) of about ``chunk_bytes`` of text."""
    base, no, ids, flags, texts, held = TaskContext.get().partitionId() << 24, 0, [], [], [], 0
    for b in batches:
        for i, f, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), as_bytes(b, 2), strict=True):
            ids.append(i)
            flags.append(f)
            texts.append((t or b"").lower())
            held += len(texts[-1]) + 16
            if held >= chunk_bytes:
                yield base + no, ids, flags, texts
                no, ids, flags, texts, held = no + 1, [], [], [], 0
    if ids:
        yield base + no, ids, flags, texts


def word_blocks(chunks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, words, counts): distinct words of each chunk with their training counts."""
    def run(batches):
        for chunk, packed in _rows_of(batches):
            counts: Counter[bytes] = Counter()
            seen: set[bytes] = {END}
            for _, f, t in _texts(packed):
                words = t.split()
                if f:
                    counts.update(words)
                    counts[END] += 1
                else:
                    seen.update(words)
            parts: dict[int, list[bytes]] = {}
            for w in sorted(seen.union(counts)):
                parts.setdefault(zlib.crc32(w) % buckets, []).append(w)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(list(parts), pa.int32()), "chunk": pa.array([chunk] * len(parts), pa.int64()),
                "words": pa.array([_squeeze(b" ".join(ws)) for ws in parts.values()], pa.binary()),
                "counts": pa.array([_squeeze(np.array([counts[w] for w in ws], dtype="<u4").tobytes()) for ws in parts.values()], pa.binary())})
    return chunks.mapInArrow(run, "bucket int, chunk long, words binary, counts binary")


def counted(blocks: DataFrame, top: int = TOP) -> DataFrame:
    """Blocks with the counts of all chunks, and for each bucket (chunk null) a row of sums:
    its words are the bucket's most frequent ones, its counts [types, tokens, words met once,
    words met twice, tokens of each other class..., counts of the words...]."""
    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        total: Counter[bytes] = Counter()
        read = []
        for chunk, words, counts in zip(pdf["chunk"], pdf["words"], pdf["counts"], strict=True):
            ws, cs = _inflate(words).split(b" "), np.frombuffer(_inflate(counts), dtype="<u4").tolist()
            for w, c in zip(ws, cs, strict=True):
                total[w] += c
            read.append((chunk, bytes(words), ws))
        out = [(chunk, words, _squeeze(np.array([total[w] for w in ws], dtype="<u8").tobytes())) for chunk, words, ws in read]
        kept = sorted(((w, c) for w, c in total.items() if c), key=lambda x: (-x[1], x[0]))
        classes = np.zeros(OTHERS, dtype=np.int64)
        for w, c in kept:
            classes[other_class(w, c)] += c
        sums = [len(kept), sum(c for _, c in kept), sum(c == 1 for _, c in kept), sum(c == 2 for _, c in kept), *classes.tolist()]
        head = kept[:top]
        out.append((None, _squeeze(b" ".join(w for w, _ in head)), _squeeze(np.array(sums + [c for _, c in head], dtype="<u8").tobytes())))
        return pd.DataFrame({"chunk": pd.array([r[0] for r in out], dtype="Int64"), "words": [r[1] for r in out], "counts": [r[2] for r in out]})
    return blocks.groupBy("bucket").applyInPandas(add_up, "chunk long, words binary, counts binary")


class Vocabulary:
    """Sums over all buckets, the top words, and what the classes of other words hold."""

    def __init__(self, rows: list[tuple[bytes, bytes]]):
        sums, words = np.zeros(4 + OTHERS, dtype=np.int64), []
        for packed, counts in rows:
            c = np.frombuffer(_inflate(counts), dtype="<u8").astype(np.int64)
            sums += c[:4 + OTHERS]
            if len(c) > 4 + OTHERS:
                words += zip(_inflate(packed).split(b" "), c[4 + OTHERS:].tolist(), strict=True)
        self.types, self.tokens, once, twice = (int(x) for x in sums[:4])
        ends = dict(words).get(END, 0)
        rest = sorted(((w, c) for w, c in words if w != END), key=lambda x: (-x[1], x[0]))[:TOP - 1]
        self.top = [(END, ends), *rest]  # the end always is a top word
        self.other = sums[4:].astype(float)
        for w, c in self.top:
            if c:
                self.other[other_class(w, c)] -= c
        self.unseen = once / max(1, once + 2 * twice)  # Good-Turing share of unseen words among rare ones

    def arrays(self) -> tuple:
        return self.types, self.tokens, self.top, self.other, self.unseen

    @staticmethod
    def from_arrays(a: tuple) -> Vocabulary:
        v = Vocabulary.__new__(Vocabulary)
        v.types, v.tokens, v.top, v.other, v.unseen = a
        return v


def first_weights(v: Vocabulary, seed: int = 5) -> dict[str, np.ndarray]:
    """Small random weights; output biases start at the words' own frequencies."""
    rng = np.random.default_rng(seed)

    def small(*shape):
        return (rng.standard_normal(shape) * 0.1).astype(np.float32)

    top = np.zeros(TOP)
    top[:len(v.top)] = [c for _, c in v.top]
    mass = np.concatenate([top.reshape(CLASSES, MEMBERS).sum(axis=1), v.other]) + 0.5
    word = np.log(top + 0.5)
    word[len(v.top):] = -30.0
    return {"input": small(TOP + OTHERS + 1, 3 * HIDDEN), "gates": small(HIDDEN, 3 * HIDDEN), "class": small(HIDDEN, CLASSES + OTHERS),
            "class_bias": np.log(mass / mass.sum()).astype(np.float32), "word": small(CLASSES, HIDDEN, MEMBERS),
            "word_bias": word.reshape(CLASSES, MEMBERS).astype(np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def step(w: dict[str, np.ndarray], x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the gated unit: new state, and what backpropagation needs."""
    g, u = w["input"][x], h @ w["gates"]
    rz = _sigmoid(g[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
    r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
    n = np.tanh(g[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
    return n + z * (h - n), r, z, n, u[:, 2 * HIDDEN:]


def log_probs(w: dict[str, np.ndarray], h: np.ndarray, code: np.ndarray, grads: dict[str, np.ndarray] | None = None):
    """Natural log p(class) + log p(word | class) of each coded word, and the state's gradient.

    Codes below TOP are top words; TOP + k is a word of other class k, whose share inside
    the class is added by the caller.
    """
    cls = np.where(code < TOP, code // MEMBERS, code - TOP + CLASSES)
    a = h @ w["class"] + w["class_bias"]
    a -= a.max(axis=1, keepdims=True)
    e = np.exp(a)
    s = e.sum(axis=1)
    at = np.arange(len(code))
    out = a[at, cls] - np.log(s)
    dh = None
    if grads is not None:
        d = e / s[:, None]
        d[at, cls] -= 1.0
        grads["class"] += h.T @ d
        grads["class_bias"] += d.sum(axis=0)
        dh = d @ w["class"].T
    order = np.argsort(cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        i = order[edges[c]:edges[c + 1]]
        if not len(i):
            continue
        b = h[i] @ w["word"][c] + w["word_bias"][c]
        b -= b.max(axis=1, keepdims=True)
        e = np.exp(b)
        s = e.sum(axis=1)
        m, k = code[i] % MEMBERS, np.arange(len(i))
        out[i] += b[k, m] - np.log(s)
        if grads is not None:
            d = e / s[:, None]
            d[k, m] -= 1.0
            grads["word"][c] += h[i].T @ d
            grads["word_bias"][c] += d.sum(axis=0)
            dh[i] += d @ w["word"][c].T
    return out, dh


def _lanes(codes: list[np.ndarray], lanes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, lengths, padded codes) of documents of like length, longest first."""
    order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
    for at in range(0, len(order), lanes):
        ids = np.array(order[at:at + lanes])
        yield ids, np.array([len(codes[i]) for i in ids]), [codes[i] for i in ids]


def _window(docs: list[np.ndarray], lengths: np.ndarray, t0: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets (lanes x size, -1 beyond the end) of the live lanes' window at t0."""
    live = int((lengths > t0).sum())
    x, y = np.full((live, size), TOP + OTHERS, dtype=np.int64), np.full((live, size), -1, dtype=np.int64)
    for j in range(live):
        part = docs[j][t0:t0 + size]
        y[j, :len(part)] = part
        x[j, 1:len(part)] = part[:-1]
        if t0:
            x[j, 0] = docs[j][t0 - 1]
    return x, y


def train(w: dict[str, np.ndarray], codes: list[np.ndarray], lanes: int = 128, rate: float = 0.01) -> tuple[dict[str, np.ndarray], int]:
    """Truncated backpropagation over documents, one pass with Adam; new weights and the tokens seen.

    Long documents are cut into pieces, so that every window is full; within a piece the
    state is carried from window to window. All words are used.
    """
    codes = [c[k:k + PIECE] for c in codes for k in range(0, len(c), PIECE)]
    w = {k: v.copy() for k, v in w.items()}
    m, s = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    seen = turn = 0
    for _, lengths, docs in _lanes(codes, lanes):
        h = np.zeros((len(docs), HIDDEN), dtype=np.float32)
        for t0 in range(0, int(lengths[0]), STEPS):
            x, y = _window(docs, lengths, t0, STEPS)
            h = h[:len(x)]
            size = min(STEPS, int(lengths[0]) - t0)
            trace, states = [], [h]
            for t in range(size):
                h, *rest = step(w, x[:, t], h)
                trace.append(rest)
                states.append(h)
            g = {k: np.zeros_like(v) for k, v in w.items()}
            flat = np.concatenate(states[1:])
            target = np.concatenate([y[:, t] for t in range(size)])
            real = np.flatnonzero(target >= 0)
            dflat = np.zeros_like(flat)
            dflat[real] = log_probs(w, flat[real], target[real], g)[1]
            dh = np.zeros_like(h)
            n_live = len(x)
            into = np.empty((size * n_live, 3 * HIDDEN), dtype=h.dtype)
            for t in range(size - 1, -1, -1):
                dh = dh + dflat[t * n_live:(t + 1) * n_live]
                r, z, n, un = trace[t]
                before = states[t]
                dn = dh * (1.0 - z) * (1.0 - n * n)
                dz = dh * (before - n) * z * (1.0 - z)
                dr = dn * un * r * (1.0 - r)
                du = np.hstack([dr, dz, dn * r])
                into[t * n_live:(t + 1) * n_live] = np.hstack([dr, dz, dn])
                g["gates"] += before.T @ du
                dh = dh * z + du @ w["gates"].T
            # rows of one input word are summed in one sweep over the sorted words
            fed = x[:, :size].T.ravel()
            order = np.argsort(fed, kind="stable")
            words, first = np.unique(fed[order], return_index=True)
            g["input"][words] = np.add.reduceat(into[order], first, axis=0)
            turn += 1
            seen += len(real)
            fade1, fade2 = 1 - 0.9 ** turn, 1 - 0.99 ** turn
            for k in w:
                grad = g[k] / max(1, len(real))
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.99 * s[k] + 0.01 * grad * grad
                w[k] -= (rate / fade1) * m[k] / (np.sqrt(s[k] / fade2) + 1e-6)
    return w, seen


def document_scores(w: dict[str, np.ndarray], codes: list[np.ndarray], lanes: int = 512, size: int = 32) -> np.ndarray:
    """Natural log p of each whole document, without other words' shares inside their classes."""
    out = np.zeros(len(codes))
    for ids, lengths, docs in _lanes(codes, lanes):
        h = np.zeros((len(docs), HIDDEN), dtype=np.float32)
        for t0 in range(0, int(lengths[0]), size):
            x, y = _window(docs, lengths, t0, size)
            h = h[:len(x)]
            states = []
            for t in range(min(size, int(lengths[0]) - t0)):
                h = step(w, x[:, t], h)[0]
                states.append(h)
            target = np.concatenate([y[:, t] for t in range(len(states))])
            real = np.flatnonzero(target >= 0)
            p, _ = log_probs(w, np.concatenate(states)[real], target[real])
            np.add.at(out, ids[real % len(x)], p)
    return out


class ChunkCodes:
    """Codes, counts and shares of the words of one chunk."""

    def __init__(self, vocabulary: Vocabulary, blocks: pd.DataFrame, needed: set[bytes] | None = None):
        """``needed``: only these words, and the end, get codes."""
        top = {w: i for i, (w, _) in enumerate(vocabulary.top)}
        self.number: dict[bytes, int] = {}
        code, count, share = [], [], []
        for words, counts in zip(blocks["words"], blocks["counts"], strict=True):
            for w, c in zip(_inflate(words).split(b" "), np.frombuffer(_inflate(counts), dtype="<u8").tolist(), strict=True):
                if needed is not None and w not in needed:
                    continue
                self.number[w] = len(code)
                at = top.get(w)
                count.append(c)
                if at is not None:
                    code.append(at)
                    share.append(0.0)
                    continue
                k = other_class(w, c)
                code.append(TOP + k)
                held = max(1.0, vocabulary.other[k])
                if c > 1:
                    share.append(math.log(c / held))
                else:
                    share.append(math.log(max(1e-9, vocabulary.unseen)) if c == 0 else math.log(max(1e-9, 1 - vocabulary.unseen) / held))
        self.code, self.count, self.share = np.array(code), np.array(count, dtype=np.float64), np.array(share)
        self.base = np.log10((self.count + 1.0) / (vocabulary.tokens + vocabulary.types + 1.0))

    def of(self, text: bytes) -> np.ndarray:
        words = text.split()
        words.append(END)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def written_chunks(docs: DataFrame, id_type: str, chunk_bytes: int, folder: str) -> DataFrame:
    """(chunk, doc_ids, flags, parts, sizes, texts) of about ``chunk_bytes`` of lower-cased text, written below ``folder``.

    Counting, every round of training and scoring read the same chunks, so a word's number in
    a chunk holds whatever the order in which the source gives its rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = f"chunk long, doc_ids array<{id_type}>, flags array<boolean>, parts array<int>, sizes array<long>, texts binary"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for chunk, ids, marks, texts in _chunks(batches, chunk_bytes):
            row = (chunk, ids, [m["train"] for m in marks], [m["part"] for m in marks], [len(t) for t in texts], _squeeze(b"".join(texts)))
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    docs.select("doc_id", F.struct("train", "part").alias("m"), "text").mapInArrow(run, ddl).write.parquet(folder)
    return docs.sparkSession.read.schema(StructType.fromDDL(ddl)).parquet(folder)


def training_part(chunks: DataFrame, part: int) -> DataFrame:
    """The chunks' training documents of one part."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(chunks.schema)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                at = [i for i, (f, p) in enumerate(zip(r["flags"], r["parts"], strict=True)) if f and p == part]
                if at:
                    texts = [t for _, _, t in _texts({k: [r[k]] for k in ("doc_ids", "flags", "sizes", "texts")})]
                    row = (r["chunk"], *([r[k][i] for i in at] for k in ("doc_ids", "flags", "parts", "sizes")), _squeeze(b"".join(texts[i] for i in at)))
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)
    return chunks.mapInArrow(run, chunks.schema)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
    """(chunk, its columns) of rows of the chunk table."""
    for b in batches:
        for r in b.to_pylist():
            yield r["chunk"], {k: [r[k]] for k in ("doc_ids", "flags", "sizes", "texts")}


def _texts(packed) -> Iterator[tuple]:
    for ids, flags, sizes, blob in zip(packed["doc_ids"], packed["flags"], packed["sizes"], packed["texts"], strict=True):
        joined, at = (_inflate(blob) if sum(sizes) else b""), 0
        for i, f, n in zip(ids, flags, sizes, strict=True):
            yield i, f, joined[at:at + n]
            at += n


def _weights_row(w: dict[str, np.ndarray]) -> bytes:
    return b"".join(w[k].astype("<f4").tobytes() for k in sorted(w))


def _weights_of(blob: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    flat, at, out = np.frombuffer(blob, dtype="<f4"), 0, {}
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def _mean(pdf: pd.DataFrame) -> pd.DataFrame:
    n = pdf["tokens"].to_numpy(dtype=float)
    mean = sum(np.frombuffer(bytes(b), dtype="<f4").astype(np.float64) * k for b, k in zip(pdf["weights"], n, strict=True)) / n.sum()
    return pd.DataFrame({"weights": [mean.astype("<f4").tobytes()], "tokens": [int(n.sum())]})


def _learner(words, start, shapes: dict[str, tuple], rate: float):
    """Training of one chunk's documents from the broadcast weights."""
    def learn(packed: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(packed):
            return pd.DataFrame({"lane": [], "weights": [], "tokens": []})
        texts = [t for _, _, t in _texts(packed)]
        codes = ChunkCodes(Vocabulary.from_arrays(words.value), blocks, {END}.union(*(t.split() for t in texts)))
        w = _weights_of(start.value, {n: np.empty(s, dtype=np.float32) for n, s in shapes.items()})
        w, seen = train(w, [codes.code[codes.of(t)] for t in texts], rate=rate)
        return pd.DataFrame({"lane": [int(packed["chunk"].iloc[0] >> 24) % 16], "weights": [_weights_row(w)], "tokens": [seen]})
    return learn


def lm_scores(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", share: int = 1, rounds: int = 3,
              chunk_bytes: int = 8 << 20, buckets: int | None = None, seed: int = 31) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    ``training`` marks the documents to learn from. They train the recurrent weights in ``rounds``
    disjoint parts by a seeded hash of id and text; with ``share`` 1 the parts cover all of them,
    above that one in ``share``.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(training, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    id_type = named.schema["doc_id"].dataType.simpleString()
    part = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.crc32("text")), F.lit(share * rounds))
    chunks = written_chunks(named.withColumn("part", part.cast("int")), id_type, chunk_bytes, shared_path(spark, "lm-chunks"))
    table = cut(counted(word_blocks(chunks, buckets)))
    vocabulary = Vocabulary([(r["words"], r["counts"]) for r in table.where("chunk is null").collect()])  # one row per bucket
    answers = table.where("chunk is not null")
    words = spark.sparkContext.broadcast(vocabulary.arrays())
    w = first_weights(vocabulary)

    for k in range(rounds):
        start = spark.sparkContext.broadcast(_weights_row(w))
        some = training_part(chunks, k)
        learned = some.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
            _learner(words, start, {n: v.shape for n, v in w.items()}, 0.01 / (1 + k)), "lane int, weights binary, tokens long")
        means = learned.where("tokens > 0").groupBy("lane").applyInPandas(lambda pdf: _mean(pdf), "weights binary, tokens long")
        got = means.toPandas()  # at most 16 rows
        if len(got):
            w = _weights_of(_mean(got)["weights"][0], w)

    final = spark.sparkContext.broadcast(w)

    def score(packed: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        v = Vocabulary.from_arrays(words.value)
        codes = ChunkCodes(v, blocks)
        found = list(_texts(packed))
        numbers = [codes.of(t) for _, _, t in found]
        model = document_scores(final.value, [codes.code[n] for n in numbers]) if v.tokens else None
        out = []
        for i, ((doc_id, f, _), n) in enumerate(zip(found, numbers, strict=True)):
            base = float(codes.base[n].sum())
            out.append((doc_id, not f, len(n), int((codes.count[n] > 0).sum()), v.tokens, base,
                        base if model is None else float(model[i] + codes.share[n].sum()) / LN10))
        return pd.DataFrame(out, columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        score, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
