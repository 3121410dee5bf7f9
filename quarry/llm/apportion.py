"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source is a tape of words: its documents in a seeded order, cut into blocks of
``block_tokens`` words (the last may be shorter). The mix has as many block seats as
all words fill. Seats go to sources by the highest quotients target / (2 * seats + 1);
the houses of the output shards are cumulative, and since the method is house-monotone
each shard's quota per source is the difference of two houses, an integer. A source's
seats are then filled from a seeded start block on, in seeded document order, round the
tape as often as its quota asks. Documents are cut only where a quota begins or ends.

Only one row per source (its name and number of words) is gathered; documents are
numbered in two levels, so a source holding most rows is spread over many tasks.

Defined results: null text has size 0 and is never taken; a null source is a source of
its own, last in order; equal rows are separate rows; an empty table gives an empty
frame; columns other than the three named are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes, bucket_count, cut, map_rows, running_start, seeded_key


def capped_targets(sizes: Sequence[int], weights: Sequence[float], max_repeat: float) -> list[float]:
    """Share ``sum(sizes)`` by weight; targets stop at ``max_repeat * size``, excess reshared."""
    total, targets = float(sum(sizes)), [0.0] * len(sizes)
    free = list(range(len(sizes)))
    while free:
        left = total - sum(targets[i] for i in range(len(sizes)) if i not in set(free))
        w = sum(weights[i] for i in free)
        share = {i: left * weights[i] / w for i in free}
        over = [i for i in free if share[i] > max_repeat * sizes[i]]
        if not over:
            for i in free:
                targets[i] = share[i]
            break
        for i in over:
            targets[i] = float(max_repeat * sizes[i])
        gone = set(over)
        free = [i for i in free if i not in gone]
    return targets


def sainte_lague(targets: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotients t / (2s + 1), at most ``most[i]`` for source i.

    Starts from rounding at the natural divisor, which is within half the sources of the
    house, and then moves single seats along the quotients. Ties go to the earlier source.
    """
    total = sum(targets)
    if total <= 0 or seats <= 0:
        return [0] * len(targets)
    got = [min(m, int(t * seats / total + 0.5)) for t, m in zip(targets, most, strict=True)]
    have = sum(got)
    if have < seats:
        heap = [(-t / (2 * s + 1), i) for i, (t, s) in enumerate(zip(targets, got, strict=True)) if t > 0 and s < most[i]]
        heapq.heapify(heap)
        while have < seats and heap:
            _, i = heapq.heappop(heap)
            got[i] += 1
            have += 1
            if got[i] < most[i]:
                heapq.heappush(heap, (-targets[i] / (2 * got[i] + 1), i))
    elif have > seats:
        heap = [(t / (2 * s - 1), -i) for i, (t, s) in enumerate(zip(targets, got, strict=True)) if s > 0]
        heapq.heapify(heap)
        while have > seats:
            _, i = heapq.heappop(heap)
            got[-i] -= 1
            have -= 1
            if got[-i]:
                heapq.heappush(heap, (targets[-i] / (2 * got[-i] - 1), i))
    return got


def mix_plan(sources: Sequence[tuple], cycle: Sequence[float], max_repeat: int, block_tokens: int,
             n_shards: int, seed: int) -> list[dict]:
    """The plan of each source from (name, words): target, seats, start block, shard quotas."""
    rows = sorted(sources, key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(s) for _, s in rows]
    targets = capped_targets(sizes, [cycle[i % len(cycle)] for i in range(len(rows))], max_repeat)
    blocks = [-(-s // block_tokens) for s in sizes]
    house = round(sum(sizes) / block_tokens)
    house = max(house, 1) if sum(sizes) else 0
    most = [max_repeat * b for b in blocks]
    ends = [sainte_lague(targets, round(house * (k + 1) / n_shards), most) for k in range(n_shards)]
    plan = []
    for i, (name, _) in enumerate(rows):
        mark = hashlib.md5(f"{seed}|{'n' if name is None else 's' + name}".encode()).hexdigest()
        start = int(mark[:8], 16) % blocks[i] if blocks[i] else 0
        plan.append({"source": name, "words": sizes[i], "target": targets[i], "blocks": blocks[i],
                     "seats": ends[-1][i], "start": start, "shard_ends": [e[i] for e in ends]})
    return plan


def _source_key(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c))


def document_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, number of words) of each row, from one narrow pass over the texts."""
    def sizes(batch: pa.RecordBatch, _):
        return [batch.column(0), batch.column(1), [0 if t is None else len(t.split()) for t in as_bytes(batch, 2)]]

    t = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                F.col(text_col).alias("text")), sizes,
                    f"doc_id {t}, source string, size long")


def sainte_lague_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     cycle: Sequence[float] = (1, 2, 3), max_repeat: int = 3, block_tokens: int = 64,
                     n_shards: int = 16, seed: int = 17) -> DataFrame:
    """One row per document with its place on the source's tape and the words taken.

    Columns: doc_id, source, size, source_size, target, taken, tape_start (words of the
    source before the document), blocks, seats, start_block, shard_seats (cumulative
    seats of the source after each shard).
    """
    spark = docs.sparkSession
    slim = cut(document_sizes(docs, id_col, text_col, source_col)
               .withColumn("_src", _source_key(F.col("source"))).withColumn("_key", seeded_key("doc_id", seed)))
    per = slim.groupBy("_src", "source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")).collect()
    plan = mix_plan([(r["source"], r["words"]) for r in per], cycle, max_repeat, block_tokens, n_shards, seed)
    table = spark.createDataFrame(
        [("n" if p["source"] is None else "s" + p["source"], p["words"], p["target"], p["blocks"], p["seats"], p["start"],
          p["shard_ends"]) for p in plan],
        "_src string, source_size long, target double, blocks long, seats long, start_block long, shard_seats array<long>")
    buckets = bucket_count(sum(r["rows"] for r in per))
    on_tape = running_start(slim, ["_src"], ["size"], F.col("size"), "tape_start", buckets)
    # the plan has one row per source; a bucket-salted key spreads the documents of a hot source
    salt = F.pmod(F.xxhash64("_key"), F.lit(16)).cast("int")
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    j = on_tape.withColumn("_salt", salt).join(salted, ["_src", "_salt"])
    b, s = F.lit(block_tokens), F.col("tape_start")
    e = s + F.col("size")
    rounds = F.when(F.col("blocks") > 0, F.floor(F.col("seats") / F.col("blocks"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("seats") - rounds * F.col("blocks")
    low = F.col("start_block") * b
    high = (F.col("start_block") + rest) * b
    wrap = F.greatest(F.lit(0), F.col("start_block") + rest - F.col("blocks")) * b

    def overlap(lo: Column, hi: Column) -> Column:
        return F.greatest(F.lit(0), F.least(e, hi) - F.greatest(s, lo))

    taken = rounds * F.col("size") + F.when(rest > 0, overlap(low, F.least(high, F.col("source_size")))
                                            + overlap(F.lit(0), wrap)).otherwise(F.lit(0))
    return j.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
                    "tape_start", "blocks", "seats", "start_block", "shard_seats")


def taken_spans(size: int, tape_start: int, words: int, blocks: int, seats: int, start: int, shard_seats: Sequence[int],
                block_tokens: int) -> list[tuple[int, int, int, int]]:
    """(shard, round, first word, end word) of the parts of one document that the mix takes."""
    out = []
    if not size or not seats:
        return out
    cut_at = start * block_tokens

    def tape(seat: int) -> int:  # words that lie before a seat, rounds included
        turn, i = divmod(seat, blocks)
        if i <= blocks - start:
            at = i * block_tokens
            at = min(at, words - cut_at)
        else:
            at = words - cut_at + (i - (blocks - start)) * block_tokens
        return turn * words + at

    ends = [tape(x) for x in shard_seats]
    for turn in range(-(-seats // blocks)):
        # the document in this round: words from cut_at on come first, those before it after
        for lo, hi, shift in ((max(tape_start, cut_at), tape_start + size, -cut_at),
                              (tape_start, min(tape_start + size, cut_at), words - cut_at)):
            if lo >= hi:
                continue
            base = turn * words + shift
            before = 0
            for k, end in enumerate(ends):
                a, z = max(lo + base, before), min(hi + base, end)
                if a < z:
                    out.append((k, turn, a - base - tape_start, z - base - tape_start))
                before = end
    return out


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    block_tokens: int = 64, **kw) -> DataFrame:
    """The mix itself: ``docs`` with each document's text cut to what the mix takes.

    A document taken whole keeps its text unchanged; one taken in several rounds gives a
    row per round; one cut at the end of a quota keeps the words inside. Documents of
    which nothing is taken are gone. Other columns are kept as they are.
    """
    mix = sainte_lague_mix(docs, id_col, text_col, source_col, block_tokens=block_tokens, **kw)
    plan = mix.where("taken > 0").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("size").alias("_size"),
        _source_key(F.col("source")).alias("_s"),
        F.struct("tape_start", "source_size", "blocks", "seats", "start_block", "shard_seats").alias("_p"))
    plan = plan.groupBy("_id", "_s", "_size").agg(F.sort_array(F.collect_list("_p")).alias("_plans"))
    names, whole_row = docs.columns, F.struct(*docs.columns)
    kind = docs.select(whole_row.alias("r")).schema[0].dataType.simpleString()
    sized = map_rows(docs.select(whole_row.alias("_row"), F.col(text_col).alias("_t")),
                     lambda b, _: [b.column(0), [0 if t is None else len(t.split()) for t in as_bytes(b, 1)]],
                     f"_row {kind}, _size long")
    sized = (sized.withColumn("_id", F.coalesce(F.col("_row")[id_col].cast("string"), F.lit("")))
             .withColumn("_s", _source_key(F.col("_row")[source_col].cast("string"))))
    # equal (id, source, size): the k-th row takes the k-th place on the tape
    same = Window.partitionBy("_id", "_s", "_size").orderBy(F.xxhash64(F.col("_row")[text_col]))
    joined = sized.join(plan, ["_id", "_s", "_size"]).withColumn("_k", F.row_number().over(same))
    joined = joined.where(F.col("_k") <= F.size("_plans")).withColumn("_p", F.element_at("_plans", F.col("_k")))
    spans = F.udf(lambda size, p: [(r, a, z) for _, r, a, z in _merged(taken_spans(size, *p, block_tokens))],
                  "array<struct<r:int,a:long,z:long>>")
    rows = joined.select("_row", "_size", F.explode(spans("_size", "_p")).alias("_x"))
    whole = (F.col("_x.a") == 0) & (F.col("_x.z") == F.col("_size"))
    part = F.udf(_words_between, "string")
    text = F.when(whole, F.col("_row")[text_col]).otherwise(part(F.col("_row")[text_col], F.col("_x.a"), F.col("_x.z")))
    return rows.select(*[text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names])


def _merged(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Neighbouring parts of one round joined, whatever their shards."""
    out: list[list[int]] = []
    for k, r, a, z in sorted(spans, key=lambda x: (x[1], x[2])):
        if out and out[-1][1] == r and out[-1][3] == a:
            out[-1][3] = z
        else:
            out.append([k, r, a, z])
    return [tuple(x) for x in out]


def _words_between(text: str, a: int, z: int) -> str:
    found = list(re.finditer(r"[^\x20\x09-\x0D]+", text))[a:z]
    return text[found[0].start():found[-1].end()] if found else ""
