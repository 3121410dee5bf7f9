"""Fill-in-middle transformation over an indexable skip list of each text's lines.

A text's lines are appended to a skip list. Every link of every express lane carries two
widths, the units and the code points it skips, so one descent by accumulated unit-widths
reaches a cut rank in logarithmic steps and the accumulated code-point widths give the
cut's place in the text exactly. Two seeded ranks cut a text into prefix, middle and
suffix, which are written in prefix-suffix-middle or suffix-prefix-middle order with
sentinels, or left plain. ``restore`` rebuilds the text from output and form alone.

A row depends on nothing but its own id and text: one pass, no shuffle.

Defined results: null text is empty, has 0 units and is plain; a text that holds a
sentinel is plain (its pieces could not be told apart); a null id draws as the text
``null``; equal rows give equal rows (the ties of equal ids draw alike); very long texts
are cut whole, with memory in proportion to the text; bytes that are no UTF-8 are kept as
they are; other columns, whatever their names, are left out; an empty table gives an
empty frame.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes, map_rows

SENTINELS = ("<P>", "<S>", "<M>")


class SkipList:
    """Units in order; node k of a lane stands behind some number of units, the head before all.

    A lane holds, for its k-th link, the units and code points between node k and node
    k + 1, and for each node its place in the lane below.
    """

    def __init__(self):
        self.units: list[list[int]] = [[]]
        self.chars: list[list[int]] = [[]]
        self.below: list[list[int]] = [[0]]
        self.ends: list[tuple[int, int]] = [(0, 0)]  # units and code points before each lane's last node
        self.n = self.size = 0

    @staticmethod
    def height(k: int) -> int:
        """Lanes of the node behind ``k`` units: one more with probability 1/4 each, by a hash of ``k``."""
        h = (k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 24
        lanes = 1
        while h & 3 == 3 and lanes < 20:
            lanes, h = lanes + 1, h >> 2
        return lanes

    def append(self, chars: int) -> None:
        self.n += 1
        self.size += chars
        at = 0
        for lane in range(self.height(self.n)):
            if lane == len(self.units):
                self.units.append([])
                self.chars.append([])
                self.below.append([0])
                self.ends.append((0, 0))
            u, c = self.ends[lane]
            self.units[lane].append(self.n - u)
            self.chars[lane].append(self.size - c)
            self.ends[lane] = (self.n, self.size)
            if lane:
                self.below[lane].append(at)
            at = len(self.units[lane])

    def reach(self, rank: int) -> tuple[int, int]:
        """Code points before the first ``rank`` units' end, and the links walked."""
        if not 0 <= rank <= self.n:
            raise ValueError(f"rank {rank} of {self.n} units")
        at = units = chars = steps = 0
        for lane in range(len(self.units) - 1, -1, -1):
            wide, long = self.units[lane], self.chars[lane]
            while at < len(wide) and units + wide[at] <= rank:
                units, chars, at, steps = units + wide[at], chars + long[at], at + 1, steps + 1
            at = self.below[lane][at] if lane else at
        return chars, steps


def line_list(text: str) -> SkipList:
    """The skip list of the text's lines, each with its line break."""
    units, at = SkipList(), 0
    while at < len(text):
        end = text.find("\n", at) + 1 or len(text)
        units.append(end - at)
        at = end
    return units


def draws(seed: int, doc_id: object) -> list[int]:
    """The four seeded numbers of a document."""
    key = "null" if doc_id is None else str(doc_id)
    h = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(h[8 * k:8 * k + 8], 16) for k in range(4)]


def transform(text: str, doc_id: object, seed: int = 7, rate: int = 100, spm: int = 50,
              sentinels: tuple[str, str, str] = SENTINELS) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix, of middle, output) of one text."""
    units, (h1, h2, h3, h4) = line_list(text), draws(seed, doc_id)
    if not text or h3 % 100 >= rate or any(s in text for s in sentinels):
        return units.n, "plain", None, None, text
    first, second = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = units.reach(first)[0], units.reach(second)[0]
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = sentinels
    if h4 % 100 < spm:
        return units.n, "spm", a, b - a, "".join((s, suffix, p, prefix, m, middle))
    return units.n, "psm", a, b - a, "".join((p, prefix, s, suffix, m, middle))


def restore(output: str, form: str, sentinels: tuple[str, str, str] = SENTINELS) -> str:
    """The text behind an output of the given form."""
    p, s, m = sentinels
    if form == "plain":
        return output
    lead, follow = (p, s) if form == "psm" else (s, p)
    if not output.startswith(lead):
        raise ValueError(f"no {form} output")
    one, rest = output[len(lead):].split(follow, 1)
    two, middle = rest.split(m, 1)
    return one + middle + two if form == "psm" else two + middle + one


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100,
                   spm: int = 50, sentinels: tuple[str, str, str] = SENTINELS, with_output: bool = True) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256, and ``output`` if asked for.

    ``rate`` and ``spm`` are percentages: texts transformed, and of these the share in
    suffix-prefix-middle order. The second digest is of the text rebuilt from the output.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = named.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

    def one(batch: pa.RecordBatch, _: object) -> list:
        out = []
        for doc_id, raw in zip(batch.column(0).to_pylist(), as_bytes(batch, 1), strict=True):
            n, form, a, b, text = transform((raw or b"").decode("utf-8", "surrogateescape"), doc_id, seed, rate, spm, sentinels)
            back = restore(text, form, sentinels).encode("utf-8", "surrogateescape")
            text = text.encode("utf-8", "surrogateescape")
            row = (n, form, a, b, hashlib.sha256(text).hexdigest(), hashlib.sha256(back).hexdigest())
            out.append((*row, text) if with_output else row)
        columns = [list(c) for c in zip(*out, strict=True)]
        if with_output:
            columns[-1] = pa.array(columns[-1], pa.binary()).view(pa.string())
        return [batch.column(0), *columns]

    return map_rows(named, one, schema + (", output string" if with_output else ""))
