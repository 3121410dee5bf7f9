"""Property tests on random texts: fast paths equal the full chain; Spark equals the DuckDB twin."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import text as tf
from quarry.operators import text as tx
from quarry.plans import sqltext as sq

ALPHABET = list("abcXYZ019_") + list("éÉçß'!?,.-") + [" ", "\t", "\x0b", "\f", "\r", "\n"] + ["the", "of", "and "]
texts = st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join)


@settings(max_examples=5, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_fast_tokens_equal_full_chain_and_duckdb(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, line string")
    full = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(df, "line", "clean")), "words", "kept")
    rows = full.select("i", "line", "clean", "kept", tf.clean_tokens("line").alias("fast")).orderBy("i").collect()
    con = duckdb.connect()
    for r in rows:
        assert r["kept"] == r["fast"]
        lit = sq.q(r["line"])
        dclean, dwords = con.execute(f"SELECT {sq.cleanse(lit)}, {sq.line_words(lit)}").fetchone()
        assert dclean == r["clean"]
        assert list(dwords) == list(r["kept"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(texts, min_size=1, max_size=8).map("\n".join), min_size=1, max_size=10),
       st.integers(min_value=1, max_value=4))
def test_array_lane_equals_row_lane_on_random_texts(spark, docs, n):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id int, text string, label string")
    a = tx.text_verses(df, n=n, label="label")
    d = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(tx.split_lines(df))))
    r = tx.build_verses(d, n=n, words="filtered", label="label")
    key = ["doc_id", "verse_id", "label", "verse"]
    assert sorted(map(tuple, a.select(*key).collect())) == sorted(map(tuple, r.select(*key).collect()))
    words = df.select("doc_id", tx.document_words("text", multiword_lines=True).alias("w"))
    flat = df.select("doc_id", F.flatten(tx.line_word_arrays("text")).alias("w"))
    assert sorted(map(tuple, words.collect())) == sorted(map(tuple, flat.collect()))
