"""Exact token counts at every prefix by dynamic programming over the pieces.

A BPE encoding is the only chain of pieces in which each neighbouring pair encodes to
itself. So the encoding of a prefix ends in the one piece that is compatible with the
last piece of the shorter prefix before it, and count[p] = count[p - len(piece)] + 1
gives the exact count at every prefix p from left to right. No piece of these models
reaches across the start of a word (a space is only ever the head of a piece) or across
a line break, so a text is a sequence of segments; the table of a segment, its count at
each of its prefixes, comes from one pass of an automaton that names the pieces ending at
each place, is kept in the worker while it is asked for, and a text's table is the running
sum of its segments' tables. Truncation and budget questions are answered from the tables.

Defined results: null and empty texts have no tokens; equal rows give equal rows; an
empty table gives an empty frame. Nothing is normalised, truncated or padded, and special
strings are ordinary text, as the library's default is. A very long text is counted whole,
segment by segment; a long segment without spaces takes time and room in proportion to it.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes, map_rows

SPACE = "▁"


class PrefixTables:
    """Prefix tables of segments for a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str, most: int = 400_000):
        from sentencepiece import sentencepiece_model_pb2 as pb
        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        n, t = spec.normalizer_spec, spec.trainer_spec
        if (t.model_type != 2 or not t.byte_fallback or n.name != "identity" or n.precompiled_charsmap or not n.add_dummy_prefix
                or n.remove_extra_whitespaces or not n.escape_whitespaces or t.treat_whitespace_as_suffix):
            raise ValueError(f"{path}: another kind of model")
        self.score = {p.piece: p.score for p in spec.pieces if p.type == 1}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.score):
            raise ValueError(f"{path}: pieces reach across words")
        if not self.score.keys() >= set().union(*self.score):
            raise ValueError(f"{path}: a letter of a piece is no piece")
        # only pieces that encode to themselves can stand in an encoding; all that end at a place are found in one pass
        self.pieces = [p for p in self.score if self.merge(p) == [p]]
        self.machine = ahocorasick.Automaton()
        for k, p in enumerate(self.pieces):
            self.machine.add_word(p, (k, len(p)))
        self.machine.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.most = most
        self.counts: dict[str, bytes | tuple] = {}
        self.older: dict[str, bytes | tuple] = {}
        self.last = _Last(self)
        self.segments = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall

    def merge(self, text: str) -> list[str]:
        """Plain BPE of a short string: the best-scored neighbouring pair first, leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether pieces a and b side by side encode to themselves."""
        if len(self.pairs) > 4 * self.most:
            self.pairs.clear()
        x, y = self.pieces[a], self.pieces[b]
        ok = self.pairs[a << 32 | b] = self.merge(x + y) == [x, y]
        return ok

    def table(self, segment: str) -> list[int]:
        """Token counts of the segment's prefixes of 1, 2, ... characters."""
        pairs, done = self.pairs, 0
        count, tail = [0] * (len(segment) + 1), [-1] * (len(segment) + 1)
        for end, (k, size) in self.machine.iter(segment):
            if end < done:  # this prefix has its one compatible piece
                continue
            if end > done:
                done = self.letters(segment, count, done, end)
            at = end + 1 - size
            before = tail[at]
            if before >= 0:
                ok = pairs.get(before << 32 | k)
                if not (self.fits(before, k) if ok is None else ok):
                    continue
            done = end + 1
            count[done], tail[done] = count[at] + 1, k
        self.letters(segment, count, done, len(segment))
        return count[1:]

    @staticmethod
    def letters(segment: str, count: list[int], start: int, end: int) -> int:
        """Letters outside the vocabulary: a token for each of their bytes."""
        for i in range(start, end):
            count[i + 1] = count[i] + len(segment[i].encode("utf-8", "replace"))
        return end

    def split(self, text: str) -> list[str]:
        return self.segments(SPACE + text.replace(" ", SPACE)) if text else []

    def totals(self, texts: Iterable[str], room: int = 1 << 21) -> Iterator[int]:
        """The count of each text. New segments of some texts of about ``room`` characters are filled in
        sorted order, so that neighbours walk the same part of the automaton."""
        for group in _groups(texts, room):
            parts = [self.split(t) for t in group]
            for s in sorted(set().union(*parts).difference(self.last)):
                self.last[s]
            for p in parts:
                yield sum(map(self.last.__getitem__, p))

    def prefix_counts(self, text: str) -> np.ndarray:
        """Exact count of text[:p] for p = 0 .. len(text)."""
        out, done = [0], 0
        for k, s in enumerate(self.split(text)):
            own = [done + c for c in self.counts_of(s)]
            out += own[1:] if k == 0 else own  # the first character is the model's own space
            done = own[-1]
        return np.array(out, dtype=np.int64)

    def counts_of(self, segment: str) -> tuple[int, ...]:
        self.last[segment]
        return self.counts[segment]

    def longest_within(self, text: str, limit: int) -> int:
        """Characters of the longest prefix of at most ``limit`` tokens."""
        parts = self.split(text)
        if not parts:
            return 0
        ends = np.cumsum([self.last[s] for s in parts])
        if ends[-1] <= limit:
            return len(text)
        k = int(np.searchsorted(ends, limit, side="right"))  # the first segment that does not fit whole
        before = sum(map(len, parts[:k]))
        base = int(ends[k - 1]) if k else 0
        inside = [p for p, c in enumerate(self.counts_of(parts[k]), 1) if base + c <= limit]
        return max(0, before + (inside[-1] if inside else 0) - 1)


def _groups(texts: Iterable[str], room: int) -> Iterator[list[str]]:
    group, held = [], 0
    for t in texts:
        group.append(t)
        held += len(t)
        if held >= room:
            yield group
            group, held = [], 0
    yield group


class _Last(dict):
    """Segment -> its whole count; fills the tables. When they are many, those not asked for since the last time go."""

    def __init__(self, tables: PrefixTables):
        super().__init__()
        self.tables = tables

    def __missing__(self, segment: str) -> int:
        t = self.tables
        if 2 * len(self) >= t.most:
            self.clear()
            t.older, t.counts = t.counts, {}
        got = t.older.get(segment)
        if got is None:
            got = t.table(segment)
            got = bytes(got) if max(got) < 256 else tuple(got)
        t.counts[segment] = got
        self[segment] = got[-1]
        return got[-1]


def tables_at(path: str) -> PrefixTables:
    """The model's tables, kept in a Python worker from task to task."""
    kept = sys.modules.setdefault("_kept_prefix_tables", types.ModuleType("_kept_prefix_tables"))
    if path not in kept.__dict__:
        kept.__dict__[path] = PrefixTables(path)
    return kept.__dict__[path]


def token_counts(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (characters of the longest prefix within the limit)."""
    def count(batch: pa.RecordBatch, tables: PrefixTables):
        raw = [r or b"" for r in as_bytes(batch, 1)]
        sizes = [len(r) for r in raw]
        tokens = list(tables.totals(r.decode("utf-8", "replace") for r in raw))
        texts = (r.decode("utf-8", "replace") for r in raw)
        fit = [len(t) if n <= limit else tables.longest_within(t, limit) for t, n in zip(texts, tokens, strict=True)]
        return [batch.column(0), sizes, tokens, [n > limit for n in tokens], fit]

    t = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), count,
                    f"doc_id {t}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long", lambda: tables_at(path))


def prefix_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts: the whole table of each text, counts[p] for the prefix of p characters."""
    t = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                    lambda b, tables: [b.column(0), [tables.prefix_counts((x or b"").decode("utf-8", "replace")).tolist() for x in as_bytes(b, 1)]],
                    f"doc_id {t}, counts array<long>", lambda: tables_at(path))
