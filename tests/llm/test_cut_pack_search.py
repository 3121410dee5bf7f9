"""Fill-in-middle cuts, lexical packing and ranked search against plain computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm import bm25_packing, rmq_search, skiplist_fim
from tests.llm.conftest import odd_rows, prose

P = pytest.importorskip("public_tokenizers")


# fill-in-middle

def plain_fim(doc_id, t, rate=100, spm=50):
    t = t or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    h = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, t
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


MARKS = [(500, "a <P> b\nc\n", "a"), (501, "<S>", "a"), (502, "\n\n\n", "a"), (503, "x\ny", "a"), (504, "ends<\n<S\n<", "a"),
         (505, "日本\n😀😀\nñ", "a"), (506, "\n" * 30_000 + "é", "a")]


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (60, 100)])
def test_fim_rows(spark, odd, rate, spm):
    more = spark.createDataFrame([(*r, "k", 1, 2, 3, 4, "x") for r in MARKS], odd.schema)
    got = skiplist_fim.fill_in_middle(odd.unionByName(more), rate=rate, spm=spm).collect()
    want = Counter((i, *plain_fim(i, t, rate, spm), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in odd_rows() + MARKS)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored_sha256) for r in got) == want
    assert all(hashlib.sha256(r.output.encode()).hexdigest() == r.output_sha256 for r in got)


def test_fim_empty_table(none):
    out = skiplist_fim.fill_in_middle(none)
    assert out.count() == 0 and out.columns[-1] == "output"


def test_skip_list_reaches_every_rank_in_few_steps():
    rng = random.Random(2)
    sizes = [rng.choice([0, 1, 7, 500]) for _ in range(5000)]
    units, ends = skiplist_fim.SkipList(), [0]
    for s in sizes:
        units.append(s)
        ends.append(ends[-1] + s)
    walked = []
    for rank, end in enumerate(ends):
        chars, steps = units.reach(rank)
        assert chars == end
        walked.append(steps)
    assert max(walked) < 80 and len(units.units) >= 5
    for wide, long, below in zip(units.units, units.chars, units.below):
        assert sum(wide) <= 5000 and sum(long) <= ends[-1] and len(below) in (1, len(wide) + 1)
    with pytest.raises(ValueError):
        units.reach(5001)


# packing

PATH = "byte_bpe_50k.json"


def library_ids(t):
    from tokenizers import Tokenizer
    library_ids.tok = getattr(library_ids, "tok", None) or Tokenizer.from_file(P.path(PATH))
    return [*library_ids.tok.encode(t or "", add_special_tokens=False).ids, 1]


def check_pieces(rows, texts, window):
    """Each id in exactly one piece, sequences gapless and within the window; the share of padding."""
    ids = Counter()
    for i, t in texts:
        ids[(i, tuple(library_ids(t)))] += 1
    pieces = defaultdict(Counter)
    for r in rows:
        pieces[r.doc_id][(r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
    for doc_id, found in pieces.items():
        want = Counter()
        for (i, toks), n in ids.items():
            if i == doc_id:
                want[len(toks)] += n * len(toks)
        have = Counter()
        for (start, length, crc, total), n in found.items():
            have[total] += n * length
            assert any(zlib.crc32(np.array(toks[start:start + length], "<u4").tobytes()) == crc
                       for i, toks in ids if i == doc_id and len(toks) == total)
        assert have == want
        for toks in {toks for i, toks in ids if i == doc_id}:
            if sum(n for (i, x), n in ids.items() if i == doc_id and len(x) == len(toks)) == 1:
                at = 0
                for start, length, _, _ in sorted(p for p in found if p[3] == len(toks)):
                    assert start == at
                    at += length
                assert at == len(toks)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return 1 - sum(r.length for r in rows) / (window * len(sequences))


def test_packing_odd_rows(odd):
    rows = bm25_packing.pack_documents(odd, P.path(PATH), with_ids=True).collect()
    assert check_pieces(rows, [(i, t) for i, t, _ in odd_rows()], 2048) < 0.02
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    again = bm25_packing.pack_documents(odd.repartition(5), P.path(PATH), with_ids=False).drop("ids").collect()
    assert Counter(r.doc_id for r in again).keys() == Counter(r.doc_id for r in rows).keys()
    assert check_pieces(again, [(i, t) for i, t, _ in odd_rows()], 2048) < 0.02


def test_packing_empty_table(none):
    assert bm25_packing.pack_documents(none, P.path(PATH)).count() == 0


def test_packing_deals_a_heavy_key_and_stays_within_shards(spark):
    rng = random.Random(8)
    copy = prose(rng, 60)
    texts = [(i, copy if i % 3 == 0 else prose(rng, rng.randint(10, 150))) for i in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = bm25_packing.pack_documents(docs, P.path(PATH), window=512, shard_tokens=20_000).collect()
    assert check_pieces(rows, texts, 512) < 0.05
    shards = Counter()
    for r in rows:
        shards[r.sequence_id >> 32] += r.length
    assert len(shards) > 4 and max(shards.values()) < 5 * 20_000
    assert len({r.sequence_id >> 32 for r in rows if r.doc_id % 3 == 0}) > 2


def plain_pack(rests, window, k1=1.2, b=0.75):
    """The same greedy rule with BM25 scores by definition."""
    n, counts = len(rests), [Counter(r.tolist()) for r in rests]
    df = Counter(t for c in counts for t in c)
    avg = sum(map(len, rests)) / n

    def score(seed, d):
        return sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (k1 + 1) / (c + k1 * (1 - b + b * len(rests[d]) / avg))
                   for t in counts[seed] if (c := counts[d][t]))
    left, start, out = [len(r) for r in rests], [0] * n, []
    for seed in range(n):
        while left[seed]:
            window_, room = [], window

            def place(d, size):
                window_.append((d, start[d], size))
                start[d] += size
                left[d] -= size
            size = left[seed]
            place(seed, size)
            room -= size
            ranked = sorted((d for d in range(n) if left[d]), key=lambda d: (-round(score(seed, d), 9), d))
            for d in ranked:
                if room and left[d] <= room:
                    room -= left[d]
                    place(d, left[d])
            over = [d for d in ranked if left[d]]
            if room and over:
                place(over[0], room)
            out.append(window_)
    return out


def test_packing_against_brute_force():
    rng = np.random.default_rng(5)
    for case in range(6):
        topics = [rng.choice(400, 40, replace=False) for _ in range(5)]
        rests = [np.array(rng.choice(topics[rng.integers(5)], rng.integers(1, 127)), dtype="<u4") for _ in range(60 + case)]
        rests += [rests[3].copy(), rests[3].copy()]
        rests.sort(key=lambda r: -len(r))
        assert bm25_packing.pack(rests, 128) == plain_pack(rests, 128)


def test_neighbours_share_windows():
    rng = np.random.default_rng(6)
    rests, topic = [], []
    for k in range(200):
        topic.append(k % 10)
        rests.append(np.array(rng.integers(100 * (k % 10), 100 * (k % 10) + 60, 40), dtype="<u4"))
    alike = [len({topic[d] for d, _, _ in w}) for w in bm25_packing.pack(rests, 400)]
    assert np.mean(alike) < 2.0


def test_ids_of_odd_texts_are_the_library_s():
    enc = bm25_packing.encoder_at(P.path(PATH))
    texts = [t or "" for _, t, _ in odd_rows()] + [
        "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "x" * 5000, " " * 3000, "\r\n\t   x", "ß́ẞ", "١٢٣ ⅷ ²",
        "\U0001F468‍\U0001F469", "﻿a", "͸ᲉꟋ\U0001e4d0", "it's I'LL don't 'S"]
    for t in texts:
        assert [*enc.ids(t), 1] == library_ids(t), t[:40]


# ranked search

TERM = re.compile(rmq_search.TERM_CLASS)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def plain_search(docs, items, k=10):
    counts = [(i, c, sum(c.values())) for i, t in docs if (c := Counter(terms(t)))]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = Counter()
    for item, text in {(i, tuple(sorted(set(terms(t))))) for i, t in items}:
        scored = []
        for i, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in text if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1):
            out[(item, rank, i, -s)] += 1
    return out


ITEMS = [(1, "alpha bravo CHARLIE0 nothere"), (2, None), (3, "..."), (4, "日本語 naïve one"), (5, "zulu9 zulu9 zulu9"), (5, "zulu9"),
         (5, "tango1"), (None, "one two"), (6, "nowhere"), (7, "a stop don t s")]


@pytest.mark.parametrize("shard_docs,chunk_docs,block_items", [(1 << 14, 1 << 11, 64), (7, 3, 2)])
def test_search_odd_rows(spark, odd, shard_docs, chunk_docs, block_items):
    rng = random.Random(4)
    items = ITEMS + [(100 + k, prose(rng, 30)) for k in range(12)] + [(200, odd_rows()[0][1])]
    table = spark.createDataFrame([(*r, 1, "x") for r in items], "item_id long, text string, doc_id int, term string")
    out = rmq_search.ranked_search(odd, table, shard_docs=shard_docs, chunk_docs=chunk_docs, block_items=block_items)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in out.collect()) == plain_search([(i, t) for i, t, _ in odd_rows()], items)


def test_search_empty_tables(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rmq_search.ranked_search(none, items).count() == 0
    assert rmq_search.ranked_search(odd, items.where("item_id = -1")).count() == 0


def test_best_first_stops_early_and_is_exact():
    rng = np.random.default_rng(9)
    size, lists, scored_all = 4000, [], 0
    for p in (0.5, 0.3, 0.05, 0.01, 0.002):
        docs = np.flatnonzero(rng.random(size) < p)
        lists.append((docs, rng.integers(1, 50, len(docs)) * int(1 / p)))
    first = np.concatenate([[0], np.cumsum([len(d) for d, _ in lists])])
    tables = rmq_search.MaxTables(first, np.concatenate([d for d, _ in lists]), np.concatenate([i for _, i in lists]), size)
    for lo, hi in [(0, 3), (5, 400), (17, 18), (40, 40)]:
        value, at = tables.best(np.array([[lo]]), np.array([[hi]]))
        assert value[0, 0] == (tables.impact[lo:hi].max() if hi > lo else 0)
        assert hi <= lo or tables.impact[at[0, 0]] == value[0, 0] and lo <= at[0, 0] < hi
    for asked in ([0], [1, 3], [0, 1, 2, 3, 4], [4], [3, 4]):
        total = np.zeros(size, dtype=np.int64)
        for a in asked:
            total[lists[a][0]] += lists[a][1]
        want = sorted(((-int(s), d) for d, s in enumerate(total) if s))[:10]
        for width in (1, 32):
            got, scored = tables.search(np.array(asked), 10, width)
            assert got == [(d, -s) for s, d in want]
            scored_all += scored
    assert scored_all < 10 * size / 3
