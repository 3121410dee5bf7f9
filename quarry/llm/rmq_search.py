"""Ranked lexical search: range-maximum sparse tables over each posting list's impacts.

1. One pass counts the terms of every whole text and writes an inverted index as rows of
   (chunk, term, postings), a chunk being some documents of one partition, and a header
   row with the chunk's ids and lengths. Only terms that some item asks for are kept: a
   semi-join that Spark broadcasts or shuffles by the size of the items' terms.
2. Document frequencies, the number of documents and of terms are sums over those rows.
3. Chunks are dealt to shards of some ``shard_docs`` documents, items to blocks of some
   ``block_items``; each (shard, block) meets once. There every term's list gets a sparse
   table of positions of maxima, so the greatest impact in any document interval takes two
   look-ups. An item starts with the interval of all documents. The interval whose summed
   maxima are highest is taken first: its document of the greatest impact is scored
   exactly and cuts it in two, whose bounds come from the tables again. It ends when no
   bound can reach the k-th best score any more, so every rank is exact. A few intervals
   are taken at a time, which changes the order of work only.
4. The shards' best k of each item are ranked together.

Defined results: a null text has no terms and does not count; an item without known terms,
or null, gives no rows; an item listed twice with the same terms counts once, the same id
with other terms is another item; equal scores rank by ascending id, null last; repeated
rows are candidates each; very long texts are counted whole; other columns, whatever their
names, are left out; an empty table on either side gives an empty frame.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes
from quarry.session import shared_path

# Fixed value: a term is a maximal run of ASCII letters, digits and all code points from 128 on.
TERM_CLASS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# On UTF-8 bytes: A-Z lower-cased, every other separator a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_LETTERS).split()


class Numbers(dict):
    """A number for each term, in order of appearance."""

    def __missing__(self, term):
        self[term] = k = len(self)
        return k


def _binary(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Cut an integer array into little-endian blobs of its first ``ends`` values each."""
    values = np.ascontiguousarray(flat, dtype="<i4")
    offsets = np.concatenate([[0], ends * 4]).astype("<i8")
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def index_rows(docs: DataFrame, chunk_docs: int) -> DataFrame:
    """(chunk, term, n, total, doc_ids, data): postings (place in the chunk, occurrences) of each term, and for
    the term ``''`` the chunk's header: documents with a term, all their terms, ids and lengths."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"chunk long, term string, n long, total long, doc_ids array<{id_type}>, data binary"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def rows(chunk: int, ids: list, counts: list[int], numbers: Numbers, places: list[np.ndarray]) -> pa.RecordBatch:
        size = len(ids)
        flat = np.concatenate(places) * size + np.repeat(np.arange(size), counts)
        pairs, tf = np.unique(flat, return_counts=True)
        df = np.bincount(pairs // size, minlength=len(numbers))
        data = np.concatenate([np.array(counts), np.stack([pairs % size, tf], axis=1).ravel()])
        ends = size + np.concatenate([[0], 2 * np.cumsum(df)])
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(df) + 1, chunk), pa.int64()), pa.array([b"", *numbers], pa.binary()).view(pa.string()),
            pa.array(np.concatenate([[size], df]), pa.int64()), pa.array([sum(counts), *([0] * len(df))], pa.int64()),
            pa.array([ids, *([None] * len(df))], schema.field("doc_ids").type), _binary(data, ends)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        ids, counts, numbers, places = [], [], Numbers(), []
        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), as_bytes(b, 1), strict=True):
                found = terms_of(raw)
                if not found:
                    continue
                ids.append(doc_id)
                counts.append(len(found))
                places.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
                if len(ids) == chunk_docs:
                    yield rows(chunk, ids, counts, numbers, places)
                    chunk, ids, counts, numbers, places = chunk + 1, [], [], Numbers(), []
        if ids:
            yield rows(chunk, ids, counts, numbers, places)

    return docs.mapInArrow(run, ddl)


class MaxTables:
    """Posting lists with sparse tables: the place of the greatest impact in any stretch of a list."""

    def __init__(self, first: np.ndarray, doc: np.ndarray, impact: np.ndarray, size: int):
        """``first``: where each list starts (and the end of the last); ``doc`` ascends in a list."""
        self.first, self.doc, self.impact, self.size = first, doc, impact, size
        lists = np.diff(first)
        self.key = np.repeat(np.arange(len(lists)), lists) * size + doc
        longest = int(lists.max()) if len(lists) else 0
        level = np.arange(len(doc), dtype=np.int32)
        self.table = [level]
        for j in range(max(0, longest.bit_length() - 1)):
            one, two = level[:-(1 << j)], level[1 << j:]
            level = np.concatenate([np.where(impact[two] > impact[one], two, one), level[-(1 << j):]])
            self.table.append(level)  # entries that reach beyond a list's end are never asked for
        self.table = np.stack(self.table)
        self.log = np.zeros(longest + 1, dtype=np.int64)
        for n in range(2, longest + 1):
            self.log[n] = self.log[n >> 1] + 1

    def best(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(greatest impact, its place) in [lo, hi) of the lists; nothing there: 0."""
        some = hi > lo
        j = self.log[np.where(some, hi - lo, 0)]
        a = self.table[j, np.where(some, lo, 0)]
        b = self.table[j, np.where(some, hi - (1 << j), 0)]
        at = np.where(self.impact[b] > self.impact[a], b, a)
        return np.where(some, self.impact[at], 0), at

    def search(self, lists: np.ndarray, k: int, width: int = 32) -> tuple[list[tuple[int, int]], int]:
        """The k best (document, score) with a score above 0, ties to the smaller document; documents scored."""
        found: list[tuple[int, int]] = []  # heap of (score, -document), the worst first
        scored, base = 0, lists * self.size
        queue: list[tuple] = []

        def add(lo: np.ndarray, hi: np.ndarray) -> None:
            value, at = self.best(lo, hi)
            bound = value.sum(axis=1)
            doc = self.doc[np.take_along_axis(at, value.argmax(axis=1)[:, None], 1)[:, 0]]
            least = np.where(hi > lo, self.doc[np.where(hi > lo, lo, 0)], self.size).min(axis=1)
            for i in np.flatnonzero(bound):
                heapq.heappush(queue, (-int(bound[i]), int(least[i]), int(doc[i]), lo[i], hi[i]))

        def open_(bound: int, least: int) -> bool:
            return len(found) < k or (bound, -least) > found[0]

        add(self.first[lists][None, :], self.first[lists + 1][None, :])
        while queue and open_(-queue[0][0], queue[0][1]):
            taken = []
            while queue and len(taken) < width and open_(-queue[0][0], queue[0][1]):
                taken.append(heapq.heappop(queue))
            doc = np.array([t[2] for t in taken])
            lo, hi = np.stack([t[3] for t in taken]), np.stack([t[4] for t in taken])
            at = np.searchsorted(self.key, base[None, :] + doc[:, None])
            at = np.clip(at, lo, hi)
            there = (at < hi) & (self.doc[np.minimum(at, len(self.doc) - 1)] == doc[:, None])
            score = np.where(there, self.impact[np.minimum(at, len(self.doc) - 1)], 0).sum(axis=1)
            scored += len(doc)
            for d, s in zip(doc.tolist(), score.tolist(), strict=True):
                if len(found) < k:
                    heapq.heappush(found, (s, -d))
                elif (s, -d) > found[0]:
                    heapq.heapreplace(found, (s, -d))
            add(np.concatenate([lo, at + there]), np.concatenate([at, hi]))
        return [(-d, s) for s, d in sorted(found, reverse=True)], scored


def impacts(tf: np.ndarray, weight: np.ndarray, m: np.ndarray) -> np.ndarray:
    """w * ((10^9 tf) div (1000 tf + 8 m)), in 64-bit integers."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def search_shard(rows: pa.Table, items: pa.Table, total_docs: int, total_terms: int, k: int) -> list[tuple]:
    """(item, doc_id, score) of the best k of each item among the shard's documents."""
    terms, chunks = rows["term"].to_pylist(), rows["chunk"].to_pylist()
    raw, weights = [np.frombuffer(x, dtype="<i4").astype(np.int64) for x in rows["data"].to_pylist()], rows["w"].to_pylist()
    ids, sizes, start = [], [], {}
    for i in sorted((i for i, t in enumerate(terms) if not t), key=chunks.__getitem__):
        start[chunks[i]] = len(ids)
        ids += rows["doc_ids"][i].as_py()
        sizes.append(raw[i])
    lists = sorted((i for i, t in enumerate(terms) if t), key=lambda i: (terms[i], chunks[i]))
    if not lists:
        return []
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i], i))
    place = np.empty(len(ids), dtype=np.int64)
    place[order] = np.arange(len(ids))
    numbers, of = Numbers(), []
    for i in lists:
        of.append(numbers[terms[i]])
    parts = [raw[i].reshape(-1, 2) for i in lists]
    doc = place[np.concatenate([p[:, 0] + start[chunks[i]] for p, i in zip(parts, lists, strict=True)])]
    tf = np.concatenate([p[:, 1] for p in parts])
    counts = [len(p) for p in parts]
    term = np.repeat(np.array(of, dtype=np.int64), counts)
    weight = np.repeat(np.array([weights[i] for i in lists], dtype=np.int64), counts)
    by = np.argsort(term * len(ids) + doc, kind="stable")
    doc, tf, term, weight = doc[by], tf[by], term[by], weight[by]
    n = np.concatenate(sizes)[order]
    m = 100 - 90 + (90 * n * total_docs) // total_terms
    tables = MaxTables(np.searchsorted(term, np.arange(len(numbers) + 1)), doc, impacts(tf, weight, m[doc]), len(ids))
    out = []
    for item, asked in zip(items["item"].to_pylist(), items["terms"].to_pylist(), strict=True):
        known = np.array([numbers[t] for t in asked if t in numbers], dtype=np.int64)
        if len(known):
            out += [(item, ids[order[d]], s) for d, s in tables.search(known, k)[0] if s > 0]
    return out


def _asked(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, terms): the distinct terms of each item, in order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    named = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    ddl = f"item_id {named.schema['item_id'].dataType.simpleString()}, terms array<string>"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [sorted(t.decode("utf-8", "replace") for t in set(terms_of(x))) for x in as_bytes(b, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(terms, schema.field("terms").type)], schema=schema)
    return named.mapInArrow(run, ddl).where(F.size("terms") > 0).distinct()


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", shard_docs: int = 1 << 14,
                  chunk_docs: int = 1 << 11, block_items: int = 64, folder: str | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of the highest score above 0 for each item."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "search")
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = named.schema["doc_id"].dataType.simpleString()

    # items are written once, so that their numbers hold in every later read
    _asked(items, item_col, item_text_col).withColumn("item", F.monotonically_increasing_id()).write.parquet(f"{folder}/items")
    blocks = max(1, -(-spark.read.parquet(f"{folder}/items").count() // block_items))

    def asked() -> DataFrame:
        return spark.read.parquet(f"{folder}/items").withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))

    wanted = asked().select("block", F.explode("terms").alias("term")).distinct()
    known = wanted.select("term").distinct().unionByName(spark.createDataFrame([("",)], "term string"))
    index_rows(named, chunk_docs).join(known, "term", "left_semi").write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")

    heads, postings = index.where("term = ''"), index.where("term <> ''")
    sums = heads.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0)).alias("t")).first()
    n, t = sums["n"], sums["t"]
    shards = max(1, -(-n // shard_docs))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.col("df") + 1)))
    weights = postings.groupBy("term").agg(F.sum("n").alias("df")).select("term", weight.cast("long").alias("w"))
    shard = F.pmod(F.xxhash64("chunk"), F.lit(shards)).alias("shard")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    lists = postings.join(weights.join(wanted, "term"), "term").select(shard, "block", "term", "chunk", "doc_ids", "data", "w")
    rows = lists.unionByName(heads.select(shard, every, "term", "chunk", "doc_ids", "data", F.lit(0).cast("long").alias("w")))
    asked_of = asked().select("item", "terms", "block",
                              F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    ddl = f"item long, doc_id {id_type}, score long"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def search(there: pa.Table, questions: pa.Table) -> pa.Table:
        found = search_shard(there, questions, n, t, k) if there.num_rows and questions.num_rows else []
        return pa.Table.from_arrays([pa.array([r[i] for r in found], f.type) for i, f in enumerate(schema)], schema=schema)

    best = rows.groupBy("shard", "block").cogroup(asked_of.groupBy("shard", "block")).applyInArrow(search, ddl)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.join(asked().select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
