"""The corpus pipeline stage by stage on a small fixture, against plain computations."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as cp
from quarry.llm import apportion
from tests.llm.conftest import prose
from tests.llm.test_documents import plain_components

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    bad = ["vexfool", "grimdolt", "snarkoaf"]
    rows, labels = [], []
    for i in range(500):
        ws, kind = prose(rng, rng.randint(40, 160)), ("toxic" if i % 4 == 0 else "junk" if i % 10 == 3 else "clean")
        if kind == "toxic":
            parts = ws.split(" ")
            for _ in range(max(2, len(parts) // 40)):
                parts.insert(rng.randrange(len(parts)), rng.choice(bad))
            ws = " ".join(parts)
        if kind == "junk":
            ws = " | ".join(w + "***" for w in ws.split())
        rows.append((i, ws, "en", f"src{i % 5}", len(ws)))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    clean = [r for r, (_, q, t) in zip(rows, labels) if q and not t]
    for k, r in enumerate(clean[:40]):  # near copies: two words changed, words kept in their lines
        parts = r[1].split(" ")
        parts[1] = parts[-2] = "changedword"
        rows.append((1000 + k, " ".join(parts), "en", "src0", 0))
    rows += [(2000, None, None, None, None), (2001, "", "en", "src1", 0), (2002, "too short", "en", "src1", 9)]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows, labels


def words(t):
    return (t or "").encode().split()


def test_stages(spark, tables):
    folder, rows, labels = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, folder)
        if k < len(cp.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/out-{k}")
        docs = spark.read.parquet(f"{folder}/out-{k}")
        seen[name] = docs.collect()
    text = {r[0]: r[1] for r in rows}
    quality, toxic = {i: q for i, q, _ in labels}, {i: t for i, _, t in labels}

    kept = {r.doc_id for r in seen["quality_rules"]}
    assert not kept & {2000, 2001, 2002} and not {i for i in kept if quality.get(i) == 0}
    assert {i for i, q in quality.items() if q} <= kept and set(range(1000, 1040)) <= kept

    calm = {r.doc_id for r in seen["toxicity"]}
    assert calm <= kept and sum(toxic.get(i, 0) for i in calm) <= 3
    assert len({i for i in kept if not toxic.get(i, 0)} - calm) <= 3

    first = [r.doc_id for r in seen["ngram_jaccard_join"]]
    comps = plain_components([(i, text[i]) for i in sorted(calm)], 5, 80)
    assert sorted(first) == sorted({c for _, _, c in comps}) and len(first) < len(calm)

    sizes = Counter()
    for i in first:
        sizes[next(r[3] for r in rows if r[0] == i)] += len(words(text[i]))
    names = sorted(sizes)
    want = apportion.capped_targets([sizes[s] for s in names], [(1, 2, 3)[k % 3] for k in range(len(names))], 3)
    got, each = Counter(), defaultdict(int)
    for r in seen["source_mixing"]:
        got[r.source] += len(words(r.text))
        each[r.doc_id] += len(words(r.text))
    for s, t in zip(names, want):
        assert abs(got[s] - t) <= 4 * 64
    assert all(n <= 3 * len(words(text[i])) for i, n in each.items())

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    plain = Counter()
    for r in seen["source_mixing"]:
        ids = tok.encode(r.text, add_special_tokens=False).ids
        plain[(r.doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in seen["bpe_encoding"]) == plain


def test_run_gives_the_last_stage(spark, tables):
    folder, _, _ = tables
    out = cp.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None


ODD = "doc_id long, text string, lang string, source string, n_chars long, _key string, size int, node int, taken long, class string"


def odd_tables(spark, folder, rows, labels):
    spark.createDataFrame(rows, ODD).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_each_stage_on_odd_rows_and_clashing_columns(spark, tmp_path):
    from tests.llm.conftest import odd_rows
    rows = [(i, t, "en", s, 1, "k", 1, 2, 3, "x") for i, t, s in odd_rows()]
    rows += [(None, None, None, None, None, None, None, None, None, None)] * 2
    labels = [(i, int(i % 3 != 0), int(i % 4 == 0)) for i in range(100, 140)] + [(None, 1, 0), (1, None, None)]
    docs = odd_tables(spark, str(tmp_path), rows, labels)
    have = Counter(tuple(r) for r in docs.collect())
    for name, stage in cp.STAGES[:3]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and not Counter(tuple(r) for r in out.collect()) - have, name
    mixed = cp.STAGES[3][1](spark, docs, str(tmp_path))
    texts = defaultdict(set)  # two rows may share id and source
    for r in have:
        texts[(r[0], r[3])].add(r[1] or "")
    assert mixed.columns == docs.columns
    assert all(any(r.text in t for t in texts[(r.doc_id, r.source)]) for r in mixed.collect())
    last = cp.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in last) == Counter(r[0] for r in docs.collect())


def test_each_stage_on_an_empty_table(spark, tmp_path):
    docs = odd_tables(spark, str(tmp_path), [], [])
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0, name
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_mixing_many_rows_without_an_id(spark):
    rng = random.Random(31)
    rows = [(None, prose(rng, 20), "en", f"s{i % 4}", 1, None, None, None, None, None) for i in range(400)]
    docs = spark.createDataFrame(rows, ODD)
    out = cp.mixing(spark, docs, "").collect()
    sizes = Counter(r[3] for r in rows)
    names = sorted(sizes)
    want = apportion.capped_targets([20 * sizes[s] for s in names], [(1, 2, 3)[k % 3] for k in range(4)], 3)
    got = Counter()
    for r in out:
        got[r.source] += len(words(r.text))
    assert all(abs(got[s] - t) <= 4 * 64 for s, t in zip(names, want))
