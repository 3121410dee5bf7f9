"""Packing by lexical retrieval: windows filled with a seed document's unused BM25 neighbours.

1. Every text is tokenized once. Windows that a long document fills by itself are whole
   sequences at once; what is left of it (less than a window) goes on, together with a
   min-hash of its adjacent token pairs. This table is written to the shared folder.
2. Documents of equal min-hash share a piece of a shard, so likely neighbours meet. A key
   that weighs more than an eighth of a shard (a passage that a third of the rows hold) is
   dealt by row to pieces of that weight; pieces are dealt by hash to shards, whose number
   follows the corpus. A shard's size therefore stays the same at any size of the corpus.
3. Each shard builds a BM25 inverted index over token ids. The longest unused document
   seeds a window; the index scores all documents of the shard against its terms; unused
   neighbours are placed whole, best first, as long as one fits; the room that is left is
   filled with the head of the best unused neighbour, whose rest stays in the shard. Only
   a shard's last window can be short.

Ids are those of the ``tokenizers`` library for the given file. A rank-based encoder of the
same vocabulary gives them faster; letters on which the two could split otherwise are
found by a probe and such texts go through the library itself.

Defined results: null text is empty and has the end id only; equal rows are packed each;
ties of scores go to the longer document, then to the smaller id (null first); very long
texts are whole windows and one rest; columns of other names are left out, clashing names
included; an empty table gives an empty frame.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes
from quarry.session import shared_path

SALTS = 64
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteEncoder:
    """Ids of a byte-level BPE tokenizer file, with its special strings inside texts."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        step = spec["pre_tokenizer"]
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.fast = None
        plain = all(not t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word"))
        if spec["normalizer"] is None and step["type"] == "ByteLevel" and not step["add_prefix_space"] and plain:
            byte, special = byte_of_letter(), {t["content"] for t in spec["added_tokens"]}
            ranks = {bytes(byte[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
            import public_tokenizers
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if special else None
        self.agreed: dict[str, bool] = {}

    def _agrees(self, c: str) -> bool:
        ok = self.agreed.get(c)
        if ok is None:
            probe = f"a{c}a 1{c}1 -{c}- {c}{c} {c}"
            ok = self.agreed[c] = self.fast.encode_ordinary(probe) == self.library(probe)
        return ok

    def library(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        if self.fast is None or not text.isascii() and not all(map(self._agrees, set(text))):
            return self.library(text)
        if self.split is None or "<" not in text or not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        out: list[int] = []
        for part in self.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self.fast.encode_ordinary(part)
        return out


def encoder_at(path: str) -> ByteEncoder:
    """The encoder, loaded once in a Python worker."""
    kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = ByteEncoder(path)
    return kept.__dict__[path]


def pair_min_hash(ids: np.ndarray) -> int:
    """The least 63-bit hash over adjacent pairs of ids (a lone id pairs with itself)."""
    a = ids.astype(np.uint64)
    h = (a[:-1] << np.uint64(32) | a[1:]) if len(a) > 1 else a << np.uint64(32) | a
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mul)
    return int((h ^ (h >> np.uint64(31))).min() >> np.uint64(1)) if len(h) else 0


def _blob(ids: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(ids.astype("<u4").tobytes())


def _ids(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype="<u4")


def tokenized(docs: DataFrame, path: str, window: int, end_id: int, with_ids: bool) -> DataFrame:
    """(doc_id, row, n, key, heads, ids): a document's tokens; ``heads`` are the CRCs of its full
    windows, ``ids`` the packed rest (with ``with_ids`` all ids)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row long, n long, key long, heads array<long>, ids binary"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder_at(path), TaskContext.get().partitionId() << 40
        for b in batches:
            out = []
            for raw in as_bytes(b, 1):
                ids = np.array([*enc.ids((raw or b"").decode("utf-8", "replace")), end_id], dtype="<u4")
                full = len(ids) // window * window
                heads = [zlib.crc32(ids[k:k + window].tobytes()) for k in range(0, full, window)]
                out.append((row, len(ids), pair_min_hash(ids[full:]), heads, _blob(ids if with_ids else ids[full:])))
                row += 1
            if out:
                cols = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(schema)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), *cols], schema=schema)
    return docs.mapInArrow(run, ddl)


class Index:
    """BM25 inverted index of a shard's documents over token ids."""

    def __init__(self, docs: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        n = len(docs)
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        flat = np.concatenate(docs).astype(np.int64) if n else np.zeros(0, np.int64)
        pairs, tf = np.unique(flat * max(n, 1) + np.repeat(np.arange(n), sizes), return_counts=True)
        term, self.doc = pairs // max(n, 1), pairs % max(n, 1)
        self.terms, first, df = np.unique(term, return_index=True, return_counts=True)
        self.first, self.df, self.n = first, df, n
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = k1 * (1 - b + b * sizes / max(1.0, sizes.mean() if n else 1.0))
        self.weight = np.repeat(idf, df) * tf * (k1 + 1) / (tf + norm[self.doc])
        by_doc = np.argsort(self.doc, kind="stable")
        self.of_doc = np.split(np.repeat(np.arange(len(df)), df)[by_doc], np.cumsum(np.bincount(self.doc, minlength=max(n, 1)))[:-1])

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the distinct terms of ``seed``."""
        terms = self.of_doc[seed]
        df = self.df[terms]
        at = np.repeat(self.first[terms] - np.cumsum(df) + df, df) + np.arange(df.sum())
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def pack(rests: list[np.ndarray], window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start in its rest, length); documents come longest first."""
    index = Index(rests)
    left = np.array([len(r) for r in rests], dtype=np.int64)
    start = np.zeros(len(rests), dtype=np.int64)
    windows, seed = [], 0
    while seed < len(rests):
        if not left[seed]:
            seed += 1
            continue
        out, room = [], window

        def place(d: int, length: int) -> None:
            nonlocal room
            out.append((d, int(start[d]), length))
            start[d] += length
            left[d] -= length
            room -= length

        place(seed, int(left[seed]))
        unused = np.flatnonzero(left)
        if room and len(unused):
            ranked = unused[np.argsort(-index.scores(seed)[unused], kind="stable")]
            rest = ranked
            while room and len(fits := np.flatnonzero(left[rest] <= room)):
                place(int(rest[fits[0]]), int(left[rest[fits[0]]]))
                rest = rest[fits[0] + 1:]  # those before it don't fit, nor later: the room only shrinks
            if room and len(longer := ranked[left[ranked] > 0]):
                place(int(longer[0]), room)  # none fits whole, so the best gives its head
        windows.append(out)
    return windows


def pack_documents(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", shard_tokens: int = 1 << 19, with_ids: bool = False,
                   folder: str | None = None) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the piece's
    ``ids`` (unsigned 32-bit little-endian) if asked for.

    ``shard_tokens`` is the weight of a shard; it bounds what one task holds and how far
    a document's neighbours are looked for.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = named.schema["doc_id"].dataType.simpleString()
    folder = folder or shared_path(spark, "packing")
    tokenized(named, path, window, end_id, with_ids).write.parquet(folder)
    rows = spark.read.parquet(folder).withColumn("weight", F.col("n") % window + 64)

    total = rows.agg(F.sum("weight")).first()[0] or 0
    shards, part = max(1, -(-total // shard_tokens)), max(1, shard_tokens // 8)
    heavy = (rows.groupBy("key").agg(F.sum("weight").alias("w")).where(F.col("w") > part)
             .select("key", F.ceil(F.col("w") / part).alias("parts")))
    # a heavy key's rows are spread over SALTS keys of the join, where they would else meet in one task
    heavy = heavy.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    piece = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("row"), F.col("parts")))
    dealt = rows.withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS))).join(heavy, ["key", "salt"], "left").select(
        "doc_id", "n", "heads", "ids",
        F.pmod(F.xxhash64("key", F.coalesce(piece, F.lit(0))), F.lit(shards)).alias("shard"))
    return _pack_shards(dealt, window, id_type, with_ids)


def _pack_shards(dealt: DataFrame, window: int, id_type: str, with_ids: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = f"doc_id {id_type}, {PIECES}" + (", ids binary" if with_ids else "")
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(group: pa.Table) -> pa.Table:
        doc_ids, n = group["doc_id"].to_pylist(), group["n"].to_pylist()
        heads, blobs = group["heads"].to_pylist(), group["ids"].to_pylist()
        every = [_ids(x) for x in blobs]
        full = [len(h) * window for h in heads]
        rests = [ids[f:] if with_ids else ids for ids, f in zip(every, full, strict=True)]
        # the same order whatever order the rows come in; equal keys mean equal rows
        order = sorted(range(len(n)), key=lambda i: (-len(rests[i]), doc_ids[i] is not None, doc_ids[i], n[i], rests[i].tobytes(), heads[i]))
        order_rest = [i for i in order if len(rests[i])]
        seq, out = group["shard"][0].as_py() << 32, []
        for i in order:
            for k, crc in enumerate(heads[i]):
                row = (doc_ids[i], k * window, window, crc, n[i], seq, 0)
                out.append((*row, every[i][k * window:(k + 1) * window].tobytes()) if with_ids else row)
                seq += 1
        for placed in pack([rests[i] for i in order_rest], window):
            offset = 0
            for d, start, length in placed:
                i = order_rest[d]
                raw = rests[i][start:start + length].tobytes()
                row = (doc_ids[i], full[i] + start, length, zlib.crc32(raw), n[i], seq, offset)
                out.append((*row, raw) if with_ids else row)
                offset += length
            seq += 1
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return dealt.groupBy("shard").applyInArrow(run, ddl)
