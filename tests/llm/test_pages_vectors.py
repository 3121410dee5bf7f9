"""WARC chunk table and exact top-k search against plain computations."""

import base64
import gzip
import hashlib
import io
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import tput_topk, warc_chunks
from quarry.session import shared_path


def page_rows():
    rng = random.Random(2)
    big = "".join(rng.choice("abcé<>\r\n") for _ in range(300_000))
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, "<p>x</p>"), (4, "u", None), (5, "u", ""), (6, "v w", big),
            (7, "v", big), (7, "v", big), (8, "q", "WARC/1.1\r\n\r\n"), (9, "é", "日本"), (None, "n", "only"), (10, "z", "only")]
    return rows + [(100 + i, f"http://c/{i}", f"page {i % 17}") for i in range(60)]


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "x", 1) for r in page_rows()], "page_id long, url string, html string, row string, n int").repartition(3)
    got = warc_chunks.warc_round_trip(pages, chunk_bytes=1000).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter(
        (i, len((t or "").encode()), digest(t)) for i, _, t in page_rows())
    best = {}
    for i, _, t in page_rows():
        best[digest(t)] = max(best.get(digest(t), -1), -1 if i is None else i)
    responses = Counter(r.payload_digest for r in got if r.record_type == "response")
    assert responses == Counter(best.keys())
    for r in got:
        assert (r.refers_to == best[r.payload_digest]) if r.record_type == "revisit" else r.refers_to is None
        if r.record_type == "response":
            assert r.page_id == best[r.payload_digest]


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    got = warc_chunks.warc_round_trip(pages, min_revisit_bytes=100).collect()
    assert {r.record_type for r in got if r.payload_bytes < 100} == {"response"}
    assert Counter(r.record_type for r in got if r.payload_bytes >= 100) == {"response": 1, "revisit": 2}


def test_chunks_carry_running_digests_and_files_are_plain_warc(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").coalesce(1)
    folder = shared_path(spark, "warc-test")
    manifest = warc_chunks.write_archives(pages, folder, chunk_bytes=4096, archive_bytes=50_000)
    chunks = warc_chunks.read_chunks(spark, manifest, folder, chunk_bytes=4096).orderBy("record_id", "chunk_no").collect()
    texts = {(i, digest(t)): t or "" for i, _, t in page_rows()}
    whole = {}
    for r in chunks:
        assert r.n_bytes <= 4096 and r.start == len(whole.get(r.record_id, b""))
        whole[r.record_id] = whole.get(r.record_id, b"") + bytes(r.data)
        assert r.digest == base64.b32encode(hashlib.sha1(whole[r.record_id]).digest()).decode()
    for r in chunks:
        if r.is_last and r.record_type == "response" and r.record_id.split(":")[2]:
            assert whole[r.record_id].decode() == texts[(int(r.record_id.split(":")[2]), r.digest)]
    assert manifest.agg(F.sum("records")).first()[0] == len(page_rows())
    path = manifest.first().path
    raw = gzip.open(path).read()
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")


def test_damaged_payload_is_noticed():
    record = b"".join(warc_chunks._record("urn:page:1:x:0", "response", None, None, hashlib.sha1(b"payload").hexdigest(), b"payload", 3))
    plain = gzip.decompress(record)
    assert [r[5] for r in warc_chunks.record_chunks(io.BytesIO(record), 3)][-1] == digest("payload")
    with pytest.raises(ValueError, match="digest"):
        list(warc_chunks.record_chunks(io.BytesIO(gzip.compress(plain.replace(b"payload", b"pbyload"))), 3))


def test_no_pages(spark):
    assert warc_chunks.warc_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def plain_top(rows, k, every):
    data = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in data if i % every == 0}:
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in data if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return Counter(out)


@pytest.mark.parametrize("block", [2, 1000])
def test_top_k(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8) * 0.3)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None]), (310, [float("nan")] * 8), (320, [float("inf")] * 8), (330, rows[7][1]), (331, rows[7][1]),
             (331, rows[7][1]), (340, []), (350, [0.5, -0.25]), (None, rows[3][1])]
    rows += [(400 + i, [0.25] * 8) for i in range(30)]  # ties
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    got = tput_topk.top_k(vectors, F.col("vec_id") % 10 == 0, k=10, block_queries=block).collect()
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in got) == plain_top(rows, 10, 10)


def test_few_candidates_and_large_components(spark):
    rows = [(0, [1e11, 3.0]), (1, [2.0, -1.0]), (2, [1e9, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = tput_topk.top_k(vectors, F.col("vec_id") >= 0, k=10).collect()
    assert len(got) == 6
    small = [r.score for r in got if r.query_id == 1 and r.vec_id == 0]
    assert small == [int(1024 * 1e11) * 2048 - 3072 * 1024]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert tput_topk.top_k(empty, F.col("vec_id") % 100 == 0).count() == 0


def test_scores_are_added_before_they_are_cut(spark):
    rows = [(0, [9765625.0, 9765625.0]), (1, [9765625.0, -9765624.9990234375]), (2, [-9765625.0, 9765625.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in tput_topk.top_k(vectors, F.col("vec_id") == 0, k=2).collect()}
    assert got == {(0, 1): 10_000_000_000, (0, 2): 0}


def test_only_heads_and_collected_rows_are_resolved(spark, monkeypatch):
    rng = np.random.default_rng(8)
    parts = [rng.integers(-50, 50, size=(1, 4000)) for _ in range(4)]
    whole = sum(parts)[0]
    seen = []
    for p in parts:
        seen += list(tput_topk._best(p[0], np.arange(4000), 11))
    heads = np.array(sorted(set(map(int, seen))))
    cutoff = np.sort(tput_topk.resolved(parts, 0, heads))[-10]
    collected = np.flatnonzero(np.any([p[0] >= -((-int(cutoff)) // 4) for p in parts], axis=0))
    assert set(np.argsort(-whole, kind="stable")[:10]) <= set(collected)
    assert len(heads) <= 44 and len(collected) < 4000
    assert (tput_topk.resolved(parts, 0, collected) == whole[collected]).all()


def test_many_archives_are_read_by_many_tasks_and_once(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(50)], "page_id long, url string, html string").repartition(50)
    folder = shared_path(spark, "warc-many")
    manifest = warc_chunks.write_archives(pages, folder, archive_bytes=1)
    assert manifest.count() == 50
    chunks = warc_chunks.read_chunks(spark, manifest, folder)
    last = warc_chunks.last_chunks(chunks.withColumn("n_bytes", F.col("n_bytes")), f"{folder}/last")
    assert len([p for p in last.select(F.input_file_name()).distinct().collect()]) > 20
    assert warc_chunks.archived_pages(last).count() == 50


def test_a_revisit_without_its_response_is_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "same"), (2, "u", "same"), (3, "u", "other")], "page_id long, url string, html string")
    folder = shared_path(spark, "warc-torn")
    manifest = warc_chunks.write_archives(pages, folder)
    last = warc_chunks.last_chunks(warc_chunks.read_chunks(spark, manifest, folder), f"{folder}/last")
    assert warc_chunks.archived_pages(last).count() == 3
    for torn in (last.where("not (record_type = 'response' and record_id like '%:2:%')"),
                 last.withColumn("stated_digest", F.when(F.col("record_type") == "revisit", F.lit("X")).otherwise(F.col("stated_digest")))):
        with pytest.raises(Exception, match="no response with this payload"):
            warc_chunks.archived_pages(torn).collect()
