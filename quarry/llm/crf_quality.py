"""Quality rules by line labelling: a linear-chain CRF marks content or boilerplate.

Every line with a word is a position of a two-state chain (0 boilerplate, 1 content)
with numeric line features. Viterbi decoding of the whole document labels its lines, and
the share of words in content lines decides retention.

The CRF is trained here by maximum conditional likelihood (forward-backward, gradient
ascent) on a bounded sample of labelled documents: the ``sample`` sequences of each class
with the smallest seeded keys, a sequence being at most ``SEQUENCE`` consecutive lines of
a document. A line takes its document's quality label; then the lines of rejected
documents are relabelled by the first fit, and the chain is fitted again.

Defined results: null and empty texts have no words, fail the base rule and are not
kept; a document is judged by its whole text; without labels of both classes every line
counts as content; equal rows give equal rows; an empty table gives an empty frame.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes, cut, filter_rows, labelled_sample, map_rows

SEQUENCE = 64
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
BLANKS = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
FEATURES = ("bias", "symbols", "upper", "digits", "shouts", "others", "repeats", "next_same", "word_length", "long_words",
            "short_line", "ends", "duplicate")


def line_features(line: bytes, words: list[bytes], seen: bool) -> tuple[float, ...]:
    """Features of one line with words; ``seen``: an earlier line is equal."""
    n, size = len(words), len(line)
    letters = len(line.translate(None, BLANKS)) or 1
    upper = size - len(line.translate(None, UPPER))
    lower = size - len(line.translate(None, LOWER))
    same = sum(map(bytes.__eq__, words, words[1:]))
    mean = letters / n
    return (1.0, min(1.0, 4.0 * (size - len(line.translate(None, SYMBOLS))) / letters), upper / letters,
            (size - len(line.translate(None, DIGITS))) / letters, min(1.0, 4.0 * line.count(b"!") / letters),
            max(0.0, (letters - upper - lower) / letters), 1.0 - len(set(words)) / n, same / n, min(3.0, mean / 6.0),
            float(mean > 15), float(n < 4), float(line.rstrip(BLANKS)[-1:] in (b".", b"!", b"?", b":")), float(seen))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of ``WINDOW`` words that occur twice or more, first ones included."""
    n = len(words)
    if n <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, n)
    if len(number) >= n - WINDOW + 1 and len(number) == n:
        return 0
    h = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    m = n - WINDOW + 1
    w = h[:m].copy()
    for k in range(1, WINDOW):
        w = w * np.uint64(0x94D049BB133111EB) + h[k:k + m]
    order = np.argsort(w, kind="stable")
    equal = w[order[1:]] == w[order[:-1]]
    if not equal.any():
        return 0
    twice = np.zeros(m, dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edge = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def read_text(raw: bytes | None) -> tuple[int, int, int, int, int, list[int], list[tuple]]:
    """(words, word characters, symbols, duplicate lines, repeated words, words of each line, line features)."""
    raw = raw or b""
    words, sizes, rows, seen, dup = [], [], [], set(), 0
    for line in raw.split(b"\n"):
        found = line.split()
        if not found:
            continue
        again = line in seen
        dup += again
        seen.add(line)
        rows.append(line_features(line, found, again))
        sizes.append(len(found))
        words += found
    chars = len(raw.translate(None, BLANKS).decode("utf-8", "replace"))
    return len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), dup, repeated_words(words), sizes, rows


class Chain:
    """Weights of the CRF: features x 2, transitions 2 x 2, starts 2."""

    def __init__(self, emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.emit, self.move, self.start = emit, move, start

    def viterbi(self, rows: list[tuple]) -> list[int]:
        """The best label sequence of one document's lines; ties go to content."""
        e = (np.array(rows) @ self.emit).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        a0, a1 = self.start[0] + e[0][0], self.start[1] + e[0][1]
        back = []
        for x0, x1 in e[1:]:
            f0, f1 = a1 + m10 >= a0 + m00, a1 + m11 >= a0 + m01
            a0, a1 = x0 + (a1 + m10 if f0 else a0 + m00), x1 + (a1 + m11 if f1 else a0 + m01)
            back.append((int(f0), int(f1)))
        s = int(a1 >= a0)
        out = [s]
        for f in reversed(back):
            s = f[s]
            out.append(s)
        return out[::-1]


def content_only() -> Chain:
    emit = np.zeros((len(FEATURES), 2))
    emit[0] = (-1.0, 1.0)
    return Chain(emit, np.zeros((2, 2)), np.zeros(2))


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_chain(x: list[np.ndarray], y: list[np.ndarray], rounds: int = 60, rate: float = 0.5, l2: float = 1e-3) -> Chain:
    """Maximum conditional likelihood of label sequences by forward-backward and Adam.

    x: a lines x features array for each sequence; y: its labels. Sequences are sorted by
    length, longest first, so the steps of the recursions work on a shrinking head.
    """
    order = sorted(range(len(x)), key=lambda i: -len(x[i]))
    x, y = [x[i] for i in order], [y[i] for i in order]
    length = np.array([len(r) for r in x])
    longest, f = int(length[0]), x[0].shape[1]
    live = [int((length > k).sum()) for k in range(longest)]
    # position k of every live sequence, one array for each k
    xs = [np.stack([x[i][k] for i in range(n)]) for k, n in enumerate(live)]
    ys = [np.array([y[i][k] for i in range(n)]) for k, n in enumerate(live)]
    flat, one, total = np.concatenate(xs), np.eye(2), sum(live)
    seen = [flat.T @ one[np.concatenate(ys)],
            sum((one[ys[k][:live[k + 1]]].T @ one[ys[k + 1]] for k in range(longest - 1)), np.zeros((2, 2))),
            one[ys[0]].sum(axis=0)]
    w = [np.zeros((f, 2)), np.zeros((2, 2)), np.zeros(2)]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    for step in range(1, rounds + 1):
        emit, move, start = w
        e = [r @ emit for r in xs]
        ahead = [start + e[0]]
        for k in range(1, longest):
            ahead.append(_log_sum(ahead[-1][:live[k], :, None] + move, 1) + e[k])
        z = np.empty(live[0])
        for k in range(longest):
            n = live[k + 1] if k + 1 < longest else 0
            z[n:live[k]] = _log_sum(ahead[k][n:], 1)
        after, gamma, moves = np.zeros((live[-1], 2)), [None] * longest, np.zeros((2, 2))
        for k in range(longest - 1, -1, -1):
            if k < longest - 1:
                n = live[k + 1]
                into = (e[k + 1] + after)[:, None, :] + move
                moves += np.exp(ahead[k][:n, :, None] + into - z[:n, None, None]).sum(axis=0)
                after = np.concatenate([_log_sum(into, 2), np.zeros((live[k] - n, 2))])
            gamma[k] = np.exp(ahead[k] + after - z[:live[k], None])
        want = [flat.T @ np.concatenate(gamma), moves, gamma[0].sum(axis=0)]
        for i in range(3):
            g = (seen[i] - want[i]) / total - l2 * w[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            w[i] = w[i] + rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    return Chain(*w)


def sample_sequences(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int,
                     seed: int) -> list[tuple[int, list[list[float]]]]:
    """(label, line features) of the bounded sample, in seeded order."""
    def sequences(batch: pa.RecordBatch, _):
        out = []
        for key, y, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch, 2), strict=True):
            rows = read_text(raw)[6]
            out += [(f"{key}{k:08d}", y, [list(r) for r in rows[k:k + SEQUENCE]]) for k in range(0, len(rows), SEQUENCE)]
        return list(zip(*out, strict=True)) if out else ([], [], [])

    rows, _ = labelled_sample(docs, labels, id_col, text_col, label_col, sample, seed)
    seq = cut(map_rows(rows, sequences, "key string, y int, x array<array<double>>"))
    got = [seq.where(F.col("y") == y).orderBy("key").limit(sample).collect() for y in (0, 1)]
    return [(r["y"], r["x"]) for part in got for r in part]


def train_chain(sequences: list[tuple[int, list[list[float]]]]) -> Chain:
    """Fit on document labels, relabel the lines of rejected documents by the fit, fit again."""
    if len({y for y, _ in sequences}) < 2:
        return content_only()
    x = [np.array(rows) for _, rows in sequences]
    y = [np.full(len(rows), label) for label, rows in sequences]
    first = fit_chain(x, y)
    # lines that decode as content inside a rejected document are content
    y = [np.array(first.viterbi(rows)) if label == 0 else y[i] for i, (label, rows) in enumerate(sequences)]
    return fit_chain(x, y)


def judged(raw: bytes | None, chain: Chain, min_share: float) -> tuple:
    """Base counts, base_failed, content share, kept and line labels of one text."""
    n, chars, symbols, dup, repeat, sizes, rows = read_text(raw)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    marks = chain.viterbi(rows) if rows else []
    share = sum(k for k, s in zip(sizes, marks, strict=True) if s) / n if n else 0.0
    return n, chars, symbols, dup, repeat, failed, share, not failed and share >= min_share, marks


def quality_rules(docs: DataFrame, chain: Chain, min_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                  with_lines: bool = False) -> DataFrame:
    """One row per document: the base counts, base_failed, content_share, kept (and line labels)."""
    def judge(batch: pa.RecordBatch, _):
        rows = [judged(raw, chain, min_share) for raw in as_bytes(batch, 1)]
        cols = list(zip(*rows, strict=True))
        return [batch.column(0), *cols[:8], cols[8] if with_lines else [None] * len(rows)]

    t = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), judge,
                    f"doc_id {t}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                    "base_failed boolean, content_share double, kept boolean, line_labels array<int>")


def trained_quality_rules(docs: DataFrame, labels: DataFrame, sample: int = 1000, min_share: float = 0.5, seed: int = 11,
                          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **kw) -> DataFrame:
    """Train on at most ``sample`` labelled sequences of each class, then judge every document."""
    chain = train_chain(sample_sequences(docs, labels, id_col, text_col, label_col, sample, seed))
    return quality_rules(docs, chain, min_share, id_col, text_col, **kw)


def kept_documents(docs: DataFrame, labels: DataFrame, sample: int = 1000, min_share: float = 0.5, seed: int = 11,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the trained rules keep, with all their columns."""
    chain = train_chain(sample_sequences(docs, labels, id_col, text_col, label_col, sample, seed))
    return filter_rows(docs, text_col, lambda texts, _: [judged(t, chain, min_share)[7] for t in texts])
