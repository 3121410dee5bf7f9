"""Operators on documents against plain computations, on odd rows and on an empty table."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from quarry.llm import apportion, combo_join, crf_quality, gru_lm, kn_toxicity, prefix_tokens, vector_shards, word_bpe
from quarry.llm.common import doc_crc
from tests.llm.conftest import odd_rows, prose

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


# quality rules

def plain_counts(t):
    ws = words(t)
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(ws) - 7):
        windows[tuple(ws[i:i + 8])].append(i)
    marked = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    rep = len(marked)
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t or ""), dup, rep, len(ws) < 20 or 100 * rep > 30 * len(ws))


def test_quality_counts(odd, spark):
    got = crf_quality.quality_rules(odd, crf_quality.content_only()).collect()
    have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert have == Counter((i, *plain_counts(t)) for i, t, _ in odd_rows())
    assert all(r.kept == (not r.base_failed) for r in got)


def test_viterbi_is_the_best_sequence():
    rng = np.random.default_rng(1)
    for _ in range(30):
        chain = crf_quality.Chain(rng.normal(size=(len(crf_quality.FEATURES), 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        x = rng.normal(size=(6, len(crf_quality.FEATURES)))
        e = x @ chain.emit

        def value(ys):
            return chain.start[ys[0]] + sum(e[k, y] for k, y in enumerate(ys)) + sum(chain.move[a, b] for a, b in zip(ys, ys[1:]))
        every = [[(k >> j) & 1 for j in range(6)] for k in range(64)]
        assert value(chain.viterbi([tuple(r) for r in x])) == pytest.approx(max(map(value, every)))


def test_chain_gradient_reaches_the_labels():
    rng = np.random.default_rng(2)
    x, y = [], []
    for _ in range(60):
        labels = np.repeat(rng.integers(0, 2, 3), 4)
        rows = rng.normal(size=(12, len(crf_quality.FEATURES))) * 0.6
        rows[:, 1] += 2.0 * labels - 1.0
        x.append(rows)
        y.append(labels)
    chain = crf_quality.fit_chain(x, y)
    hit = np.mean([np.mean(np.array(chain.viterbi([tuple(r) for r in a])) == b) for a, b in zip(x, y)])
    assert hit > 0.95


def test_trained_rules_keep_prose_and_drop_junk(spark):
    rng = random.Random(5)
    clean = [(i, prose(rng, rng.randint(40, 200)), 1) for i in range(80)]
    junk = [(100 + i, " | ".join(w + "***" for w in prose(rng, 60).split()), 0) for i in range(40)]
    rows = spark.createDataFrame([(i, t, "s") for i, t, _ in clean + junk], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, q) for i, _, q in clean[:40] + junk[:20]], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in crf_quality.trained_quality_rules(rows, labels).collect()}
    assert all(got[i] for i, _, _ in clean) and not any(got[i] for i, _, _ in junk)
    kept = crf_quality.kept_documents(rows, labels)
    assert kept.columns == rows.columns and {r.doc_id for r in kept.collect()} == {i for i, _, _ in clean}


def test_without_labels_every_line_is_content(odd, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.kept for r in crf_quality.trained_quality_rules(odd, labels).where("not base_failed").collect()} == {True}
    assert crf_quality.trained_quality_rules(none, labels).count() == 0


# mixing

def test_targets_and_seats():
    t = apportion.capped_targets([10, 100, 100], [1, 2, 3], 3)
    assert t == pytest.approx([30, 72, 108])
    assert apportion.sainte_lague([53, 24, 23], 7, [99] * 3) == [3, 2, 2]
    rng = random.Random(1)
    for _ in range(100):
        v = [rng.random() * 50 for _ in range(5)]
        house = rng.randint(1, 60)
        quotients = sorted(((-x / (2 * k + 1), i) for i, x in enumerate(v) for k in range(house)))[:house]
        assert apportion.sainte_lague(v, house, [999] * 5) == [sum(i == j for _, j in quotients) for i in range(5)]


def test_mix(odd, none):
    mix = apportion.sainte_lague_mix(odd, block_tokens=16)
    rows = [r.asDict() for r in mix.collect()]
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, len(words(t))) for i, t, _ in odd_rows())
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
        spans = apportion.taken_spans(r["size"], r["tape_start"], r["source_size"], r["blocks"], r["seats"], r["start_block"],
                                      r["shard_seats"], 16)
        assert sum(z - a for _, _, a, z in spans) == r["taken"]
        assert all(0 <= a < z <= r["size"] for _, _, a, z in spans)
    total = sum(r["size"] for r in rows)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    want = apportion.capped_targets([sum(r["size"] for r in by[s]) for s in names], [(1, 2, 3)[k % 3] for k in range(len(names))], 3)
    for s, t in zip(names, want):
        assert by[s][0]["target"] == pytest.approx(t) and {r["source_size"] for r in by[s]} == {sum(r["size"] for r in by[s])}
        assert abs(sum(r["taken"] for r in by[s]) - t) <= 16 * 4
    assert sum(want) == pytest.approx(total)
    again = [r.asDict() for r in apportion.sainte_lague_mix(odd.repartition(7), block_tokens=16).collect()]
    key = lambda r: tuple((x is None, x) for x in (r["doc_id"], r["source"], r["size"], r["taken"]))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert apportion.sainte_lague_mix(none).count() == 0


def test_mixed_documents_hold_what_is_taken(odd):
    mix = apportion.sainte_lague_mix(odd, block_tokens=16)
    want = Counter()
    for r in mix.collect():
        want[(r.doc_id, r.source)] += r.taken
    out = apportion.mixed_documents(odd, block_tokens=16)
    assert out.columns == odd.columns
    got = Counter()
    for r in out.collect():
        got[(r.doc_id, r.source)] += len(words(r.text))
    assert got == +want


# sharding

def test_shards(odd, none):
    rows = vector_shards.vector_shards(odd, n_shards=4).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in odd_rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    for s in range(4):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert vector_shards.vector_shards(none).count() == 0


def test_shards_are_level_and_groups_stay(spark):
    rng = random.Random(7)
    same = prose(rng, 30)
    rows = [(i, prose(rng, rng.randint(20, 120)) if i % 3 else f"{same} {i % 40}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = vector_shards.vector_shards(docs, n_shards=6, fine=4, cell_groups=50)
    got = placed.collect()
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert max(size.values()) < 1.02 * min(size.values())
    texts = dict(rows)
    at = defaultdict(set)
    for r in got:
        at[texts[r.doc_id]].add(r.shard)
    assert all(len(x) == 1 for x in at.values())


def plain_pack(weights, room):
    """The rule by definition, in plain Python: largest first, highest dot product that fits, else most bytes left."""
    room, chosen = [list(r) for r in room], [0] * len(weights)
    for i in sorted(range(len(weights)), key=lambda i: (-weights[i][0], i)):
        w, best, at = weights[i], None, None
        for s, r in enumerate(room):
            dot = sum(x * y for x, y in zip(r, w, strict=True))
            if all(x >= y for x, y in zip(r, w, strict=True)) and (best is None or dot > best):
                best, at = dot, s
        if at is None:
            at = max(range(len(room)), key=lambda s: (room[s][0], -s))
        chosen[i] = at
        room[at] = [x - y for x, y in zip(room[at], w, strict=True)]
    return chosen


def test_pack_against_the_rule():
    rng = random.Random(11)
    for n, shards in ((0, 3), (1, 1), (60, 4), (200, 7)):
        # whole numbers, so that both add up without rounding; small ones, so that ties occur
        weights = [[rng.randint(1, 30), rng.randint(0, 9), rng.randint(1, 3)] for _ in range(n)]
        total = [sum(w[d] for w in weights) for d in range(3)]
        room = [[t // shards for t in total] for _ in range(shards)]
        got = vector_shards.pack(np.array(weights, dtype=float).reshape(-1, 3), np.array(room, dtype=float))
        assert got.tolist() == plain_pack(weights, room)


def test_a_group_above_a_shard_is_split_evenly(spark):
    docs = spark.createDataFrame([(i, "same text" if i < 700 else f"other {i:05d}") for i in range(1000)], "doc_id long, text string")
    got = vector_shards.vector_shards(docs, n_shards=4).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert len(got) == 1000 and max(size.values()) < 1.06 * min(size.values())


# n-gram Jaccard join

def plain_components(rows, width, percent):
    sets = []
    for _, t in rows:
        ws = tuple((t or "").encode().lower().split())
        sets.append({ws} if 0 < len(ws) < width else {ws[i:i + width] for i in range(len(ws) - width + 1)})
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return Counter((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def join_rows():
    rng = random.Random(11)
    common = prose(rng, 50)
    rows = [(i, t) for i, t, _ in odd_rows() if t is None or len(t) < 100_000]
    base = prose(rng, 150).split()
    for k in range(40):  # near copies of one text, some far from each other
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = f"edit{rng.randint(0, 99)}"
        rows.append((1000 + k, " ".join(own)))
    for k in range(60):  # a shared passage and a little text of their own
        rows.append((2000 + k, common + " " + " ".join(f"own{k}x{j}" for j in range(rng.randint(0, 12)))))
    for k in range(30):
        rows.append((3000 + k, common + " " + prose(rng, rng.randint(100, 140))))
    return rows


@pytest.mark.parametrize("width,percent,frequent,spare,least", [(3, 90, 32, 1.25, 32), (3, 90, 2, 1.0, 1), (5, 80, 3, 1.0, 1)])
def test_join_finds_all_components(spark, width, percent, frequent, spare, least):
    rows = join_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = combo_join.JaccardJoin(docs, width=width, percent=percent, frequent=frequent, spare=spare, least=least)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in join.run().collect())
    assert got == plain_components(rows, width, percent)


def test_join_keeps_one_of_each(spark, odd, none):
    kept = combo_join.one_of_each(odd, width=3, percent=90)
    assert kept.columns == odd.columns
    rows = [(i, t) for i, t, _ in odd_rows()]
    comps = plain_components(rows, 3, 90)
    # documents without words stay; every component is down to one row, which has its smallest id
    alone = Counter(d for d, n, _ in comps if not n)
    assert Counter(r.doc_id for r in kept.collect()) == alone + Counter({c for _, n, c in comps if n})
    assert combo_join.jaccard_components(none).count() == 0


def test_combinations_go_on_in_small_batches():
    """2,000 nodes of 40 frequent tokens make 1.6 million combinations; they aren't held at once."""
    rng = np.random.default_rng(4)
    toks = rng.integers(-(1 << 62), 1 << 62, (2000, 60))
    at = [sorted(rng.choice(60, 40, replace=False).tolist()) for _ in toks]
    nodes = pa.RecordBatch.from_pydict({
        "node": pa.array(range(2000), pa.int64()), "n": pa.array([200] * 2000, pa.int64()), "comp": pa.array([7] * 2000, pa.int64()),
        "toks": pa.array(toks.tolist(), pa.list_(pa.int64())), "heavy": pa.array(at, pa.list_(pa.int32())),
        "short": pa.array([k % 3 == 0 for k in range(2000)], pa.bool_())})
    got = list(combo_join.combination_batches(iter([nodes.slice(0, 900), nodes.slice(900)]), most=10_000))
    assert all(0 < b.num_rows < 10_000 + 780 for b in got)
    rows = Counter(zip(*(c.to_pylist() for c in pa.Table.from_batches(got).columns), strict=True))
    assert sum(rows.values()) == 2000 * 780
    u = (1 << 64) - 1
    for k in (0, 1, 1500):
        own = [toks[k][p].item() & u for p in at[k]]
        for x in range(40):
            for y in range(x + 1, 40):
                s = ((own[x] ^ (own[x] >> 31)) * 0x9E3779B97F4A7C15 + own[y] * 0xC2B2AE3D27D4EB4F) & u
                s ^= s >> 32
                assert rows[(s - (1 << 64) if s >> 63 else s, k, 200, 7, k % 3 == 0)] == 1


# token counts

def test_prefix_tokens(odd, none):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = prefix_tokens.token_counts(odd, path, limit=100).collect()
    want = Counter((i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 100) for i, t, _ in odd_rows())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    texts = {i: t or "" for i, t, _ in odd_rows()}
    for r in got[:8]:
        assert len(sp.encode(texts[r.doc_id][:r.fit_chars])) <= 100
    assert prefix_tokens.token_counts(none, path).count() == 0


def test_every_prefix_count():
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    sp, tables = sentencepiece.SentencePieceProcessor(model_file=path), prefix_tokens.PrefixTables(path)
    rng = random.Random(2)
    for _ in range(60):
        t = "".join(rng.choice("aeiorst nd  .,-'\n\t01ABéüß日😀▁") for _ in range(rng.randint(0, 50)))
        want = [len(sp.encode(t[:p])) for p in range(len(t) + 1)]
        assert tables.prefix_counts(t).tolist() == want
        for limit in (0, 1, 7):
            assert tables.longest_within(t, limit) == max(p for p, c in enumerate(want) if c <= limit)


# BPE

def test_word_table_encoding(odd, none):
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    enc = word_bpe.encode_documents(odd, path, chunk_bytes=2000, buckets=3)
    want = Counter()
    for i, t, _ in odd_rows():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want[(i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in enc.collect()) == want
    back = word_bpe.decode_ids(enc.where("n_tokens < 500"), path).collect()
    assert all(hashlib.sha256(r.decoded.encode()).hexdigest() == r.decoded_sha256 for r in back)
    assert word_bpe.encode_documents(none, path).count() == 0


# language model

def test_lm_base_score_and_counts(spark, odd, none):
    rows = [(i, t) for i, t, _ in odd_rows() if t is None or len(t) < 100_000]
    small = odd.where("text is null or length(text) < 100000")
    training = doc_crc("doc_id") % 7 != 2
    got = gru_lm.lm_scores(small, training, chunk_bytes=3000, buckets=3, share=2, rounds=2).collect()
    c = Counter()
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    for i, t in rows:
        if not held(i):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter((i, held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert gru_lm.lm_scores(none, training).count() == 0


def test_lm_reads_the_same_chunks_in_every_pass(spark):
    rng = random.Random(16)
    rows = [(i, prose(rng, rng.randint(1, 30))) for i in range(120)]
    # each read of the source deals its rows anew
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, F.rand()).select("doc_id", "text")
    got = gru_lm.lm_scores(docs, doc_crc("doc_id") % 7 != 2, chunk_bytes=800, buckets=2, rounds=2).collect()
    c = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in [*t.lower().split(), "\n"])
    n, v = sum(c.values()), len(c)
    want = {i: sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*t.lower().split(), "\n"]) for i, t in rows}
    assert len(got) == 120 and all(abs(r.base_score - want[r.doc_id]) < 1e-6 and math.isfinite(r.score) for r in got)


def test_lm_learns_from_all_training_documents_for_held_out_text(spark):
    # a word is followed by the next one of a ring: counts of words alone do not tell it
    rng = random.Random(6)
    rows = []
    for i in range(1500):
        at = rng.randrange(40)
        rows.append((i, " ".join(f"w{(at + k) % 40}" for k in range(rng.randint(40, 80)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def held_out_score(**how):
        got = gru_lm.lm_scores(docs, doc_crc("doc_id") % 7 != 2, buckets=3, **how).where("held_out").collect()
        tokens = sum(r.n_tokens for r in got)
        assert len(got) > 150
        return sum(r.score for r in got) / tokens, sum(r.base_score for r in got) / tokens

    (score, base), (eighth, _) = held_out_score(), held_out_score(share=8)
    assert score > base + 0.2 and score > eighth + 0.1


def test_lm_probabilities_sum_to_one_and_training_helps():
    rng = np.random.default_rng(4)
    words = [f"w{k}".encode() for k in range(40)]
    counts = Counter(words[int(k)] for k in rng.integers(0, 40, 3000))
    kept = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    classes = np.zeros(gru_lm.OTHERS, dtype=np.int64)
    for w, k in kept:
        classes[gru_lm.other_class(w, k)] += k
    sums = [len(kept), 3000, 0, 0, *classes.tolist(), *[k for _, k in kept]]
    v = gru_lm.Vocabulary([(gru_lm._squeeze(b" ".join(w for w, _ in kept)), gru_lm._squeeze(np.array(sums, dtype="<u8").tobytes()))])
    w = gru_lm.first_weights(v)
    h = rng.normal(size=(1, gru_lm.HIDDEN)).astype(np.float32)
    codes = np.arange(gru_lm.TOP + gru_lm.OTHERS)
    p, _ = gru_lm.log_probs(w, np.repeat(h, len(codes), axis=0), codes)
    assert np.exp(p.astype(float)).sum() == pytest.approx(1.0, abs=1e-4)
    # a word is always followed by the next one: the state has to learn it
    texts = [np.array([*((s + np.arange(30)) % 20 + 1), 0]) for s in range(64)]
    before = gru_lm.document_scores(w, texts).sum()
    for _ in range(60):
        w, seen = gru_lm.train(w, texts)
    assert seen == 64 * 31 and gru_lm.document_scores(w, texts).sum() > 0.5 * before


def test_lm_gradient():
    v = gru_lm.Vocabulary([])
    w = {k: x.astype(np.float64) for k, x in gru_lm.first_weights(v).items()}
    rng = np.random.default_rng(3)
    h, code = rng.normal(size=(5, gru_lm.HIDDEN)), np.array([0, 1, 33, gru_lm.TOP + 2, gru_lm.TOP])
    g = {k: np.zeros_like(x) for k, x in w.items()}
    _, dh = gru_lm.log_probs(w, h, code, g)
    for name, at in (("class", (2, 3)), ("class_bias", (1,)), ("word", (0, 3, 1))):
        up, down = w[name].copy(), w[name].copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        slope = (gru_lm.log_probs({**w, name: up}, h, code)[0].sum() - gru_lm.log_probs({**w, name: down}, h, code)[0].sum()) / 2e-5
        assert -slope == pytest.approx(g[name][at], abs=1e-4)


# toxicity

def toxic_rows():
    rng = random.Random(9)
    bad = ["vexfool", "grimdolt", "snarkoaf"]
    rows, labels = [], []
    for i in range(700):
        ws, y = prose(rng, rng.randint(30, 150)).split(), int(i % 4 == 0)
        if y:
            for _ in range(max(2, len(ws) // 40)):
                ws.insert(rng.randrange(len(ws)), rng.choice(bad) + rng.choice(["", ",", "."]))
        rows.append((i, " ".join(ws)))
        labels.append((i, y))
    return rows, labels


def test_toxicity_on_held_out_documents(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    truth = dict(labels)
    judge = kn_toxicity.fit_judge(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), doc_crc("doc_id") % 5 != 0)
    got = [r for r in kn_toxicity.toxicity(docs, judge).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    hit = np.mean([r.predicted == truth[r.doc_id] for r in got])
    assert len(got) > 80 and hit > 0.97 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    clean = kn_toxicity.clean_documents(docs, judge)
    assert clean.columns == docs.columns and clean.count() < 560


def test_toxicity_with_few_toxic_labels(spark):
    rows, labels = toxic_rows()
    fewer = {i for i, y in labels if y and i % 32}  # 22 of 175 toxic rows stay
    rows, labels = [r for r in rows if r[0] not in fewer], [x for x in labels if x[0] not in fewer]
    docs, truth = spark.createDataFrame(rows, "doc_id long, text string"), dict(labels)
    judge = kn_toxicity.fit_judge(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), doc_crc("doc_id") % 3 != 0)
    got = [r for r in kn_toxicity.toxicity(docs, judge).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 0]
    called = Counter((truth[r.doc_id], r.predicted) for r in got)
    assert called[1, 1] > called[1, 0] and called[0, 1] <= 2


def test_lower_orders_of_unequal_classes_compare():
    # both classes speak alike, one has ten times the text
    rng = np.random.default_rng(8)
    share = 1.0 / np.arange(1, 61)
    pairs = np.outer(share, share).ravel() / share.sum() ** 2
    first, second = (x.ravel().astype(np.uint64) for x in np.meshgrid(np.arange(60), np.arange(60), indexing="ij"))
    counts = np.stack([rng.multinomial(n, pairs) for n in (20_000, 2_000)], axis=1).astype(float)
    met = counts.sum(axis=1) > 0
    m = kn_toxicity.KneserNey(first[met], second[met], (first * np.uint64(60) + second)[met], counts[met])
    lower = m.words.values[1:, :2].astype(float)
    assert m.rest[0] == pytest.approx(m.rest[1], abs=0.01)
    assert abs(np.log(lower[:20, 1] / lower[:20, 0]).mean()) < 0.1


def test_chances_of_few_types():
    p = kn_toxicity.few_types(np.array([0, 0, 0, 2, 2]), np.array([1.0, 0.5, 0.25, 0.5, 0.0]), 3)
    assert np.allclose(p, [[0, 0.375, 0.5, 0.125, 0], [1, 0, 0, 0, 0], [0.5, 0.5, 0, 0, 0]])


def test_the_driver_makes_no_toxicity_model(spark, monkeypatch):
    """Models are made in tasks (the driver's memory was exceeded); they equal one made here from the same counts."""
    rows, labels = toxic_rows()
    sample = spark.createDataFrame([(i % 10, int(i % 4 == 0), t) for i, t in rows], "fold int, y int, text string")
    table = kn_toxicity._columns(kn_toxicity.sample_counts(sample))
    key = list(zip(*(table[c].tolist() for c in ("fold", "y", "first", "second")), strict=True))
    assert key == sorted(set(key))
    want = kn_toxicity.model_of(table, np.ones(len(table["n"]), dtype=bool)).arrays()

    made = kn_toxicity.model_of

    def in_a_task(*a):
        assert TaskContext.get() is not None, "a model made by the driver"
        return made(*a)
    monkeypatch.setattr(kn_toxicity, "model_of", in_a_task)
    got = kn_toxicity.whole_model(spark, spark.sparkContext.broadcast(table)).arrays()
    assert len(want) == len(got) and all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))
    judge = kn_toxicity.fit_judge(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert judge.model is not None


def test_toxicity_of_odd_rows(spark, odd, none):
    rows, labels = toxic_rows()
    judge = kn_toxicity.fit_judge(spark.createDataFrame(rows, "doc_id long, text string"),
                                  spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int"))
    got = kn_toxicity.toxicity(odd, judge).collect()
    assert len(got) == len(odd_rows())
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert kn_toxicity.toxicity(none, judge).count() == 0
    nothing = kn_toxicity.fit_judge(odd, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert {r.score for r in kn_toxicity.toxicity(odd, nothing).collect()} == {0.0}


def test_kneser_ney_lower_orders_sum_to_one():
    rng = np.random.default_rng(5)
    first, second = rng.integers(1, 30, 400).astype(np.uint64), rng.integers(1, 30, 400).astype(np.uint64)
    key = np.unique(first * np.uint64(100) + second)
    m = kn_toxicity.KneserNey(key // np.uint64(100), key % np.uint64(100), key, rng.integers(0, 5, (len(key), 2)).astype(float))
    lower = m.words.values[1:, :2].astype(float)
    assert np.allclose(lower.sum(axis=0) + m.rest * m.unseen, 1.0, atol=1e-2)
