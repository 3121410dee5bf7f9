"""Registered queries: one per operator of the inventory, each with its DuckDB twin.

Every query reads the given tables whole. Doubles are rounded to 6 digits on both
sides; integer outputs are bigint on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import terms as tm
from quarry.operators import text as tx
from quarry.plans import sqltext as sq
from quarry.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def big(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


# ---------------------------------------------------------------------------------
# T1..T10, W1, P2, P3: text chain
# ---------------------------------------------------------------------------------

@register("split_lines", f"""
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM ({sq.DOC_LINES})
""")
def q_split_lines(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    return tx.split_lines(docs).select("doc_id", big("line_no").alias("line_no"), "line")


@register("cleansed_lines", f"""
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, {sq.cleanse('line')} AS clean FROM ({sq.DOC_LINES})
""")
def q_cleansed_lines(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    return tx.cleanse_text(tx.split_lines(docs)).select(
        "doc_id", big("line_no").alias("line_no"), "clean")


@register("line_tokens", f"""
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no,
       CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens,
       CAST(len({sq.drop_stop('t')}) AS BIGINT) AS n_kept, array_to_string({sq.drop_stop('t')}, ' ') AS kept
FROM (SELECT doc_id, line_no, {sq.tokens(sq.cleanse('line'))} AS t FROM ({sq.DOC_LINES}))
""")
def q_line_tokens(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    d = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(tx.split_lines(docs))), "words", "kept")
    return d.select("doc_id", big("line_no").alias("line_no"),
                    big(F.size("words")).alias("n_tokens"), F.array_join("words", " ").alias("tokens"),
                    big(F.size("kept")).alias("n_kept"), F.array_join("kept", " ").alias("kept"))


@register("exploded_words", f"""
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(word_pos AS BIGINT) AS word_pos, word
FROM ({sq.DOC_WORDS})
""")
def q_exploded_words(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    d = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(tx.split_lines(docs))))
    e = tx.explode_words(d.select("doc_id", "line_no", "filtered"))
    return e.select("doc_id", big("line_no").alias("line_no"), big("word_pos").alias("word_pos"), "word")


@register("stemmed_words", f"""
SELECT word, {sq.s_stem('word')} AS stem, count(*) AS occurrences FROM ({sq.DOC_BAG}) GROUP BY 1, 2
""")
def q_stemmed_words(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    words = tx.explode_rows(docs, [], tx.document_words("text"), "word")
    return (tx.stem_words(words, "word", "stem", mode="s")
            .groupBy("word", "stem").agg(F.count(F.lit(1)).alias("occurrences")))


@register("united_sentences", f"""
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, string_agg(word, ' ' ORDER BY word_pos) AS sentence
FROM ({sq.DOC_WORDS}) GROUP BY doc_id, line_no
""")
def q_united_sentences(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    d = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(tx.split_lines(docs))))
    e = tx.explode_words(d.select("doc_id", "line_no", "filtered"))
    u = tx.unite_sentence(e, ("doc_id", "line_no"))
    return u.select("doc_id", big("line_no").alias("line_no"), "sentence")


_VERSE_N = 4
_VERSES_SQL = f"""
SELECT doc_id, CAST(verse_id AS BIGINT) AS verse_id, lang AS label, count(*) AS n_words,
       string_agg(word, ' ' ORDER BY line_no, word_pos) AS verse_text
FROM (SELECT *, CAST(floor((line_no - 1) / {_VERSE_N}) + 1 AS BIGINT) AS verse_id FROM ({sq.DOC_WORDS}))
GROUP BY doc_id, verse_id, lang
"""


@register("verses", _VERSES_SQL)
def q_verses(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text", "lang")
    v = tx.text_verses(docs, n=_VERSE_N, label="lang")
    return tx.verse_text(v).select("doc_id", big("verse_id").alias("verse_id"), F.col("lang").alias("label"),
                                   big(F.size("verse")).alias("n_words"), "verse_text")


@register("verses_row_lane", _VERSES_SQL)
def q_verses_row_lane(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text", "lang")
    d = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(tx.split_lines(docs))))
    v = tx.build_verses(d, n=_VERSE_N, words="filtered", label="lang")
    return tx.verse_text(v).select("doc_id", big("verse_id").alias("verse_id"), F.col("lang").alias("label"),
                                   big(F.size("verse")).alias("n_words"), "verse_text")


@register("bigrams", f"""
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(g AS BIGINT) AS gram_pos,
       array_to_string(list_slice(ws, g, g + 1), ' ') AS gram
FROM (SELECT doc_id, line_no, ws, unnest(generate_series(1, len(ws) - 1)) AS g
      FROM (SELECT doc_id, line_no, {sq.line_words('line')} AS ws FROM ({sq.DOC_LINES})) WHERE len(ws) >= 2)
""")
def q_bigrams(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    d = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(tx.split_lines(docs))))
    g = tx.ngrams(d, "filtered", "grams", 2)
    g = tx.explode_rows(g, ["doc_id", "line_no"], F.col("grams"), "gram", "gram_pos")
    return g.select("doc_id", big("line_no").alias("line_no"), big("gram_pos").alias("gram_pos"), "gram")


# ---------------------------------------------------------------------------------
# F10..F12: term statistics (the flagship is tf_idf_top_terms)
# ---------------------------------------------------------------------------------

_DOC_TERMS_SQL = f"SELECT doc_id, word AS term, count(*) AS tf FROM ({sq.DOC_BAG}) GROUP BY 1, 2"


def _doc_terms(spark, root) -> tuple[DataFrame, DataFrame]:
    docs = read_table(spark, root, "documents").select("doc_id", "text", "lang")
    words = docs.select("doc_id", tx.document_words("text").alias("words"))
    return docs, tm.document_terms(words, "doc_id", "words")


@register("tf_idf_top_terms", f"""
WITH tf AS ({_DOC_TERMS_SQL}),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT count(*) AS m FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf, dfq.df, tf.tf * ln((m.m + 1.0) / (dfq.df + 1.0)) AS x
      FROM tf JOIN dfq USING (term) CROSS JOIN m)
SELECT doc_id, CAST(rank AS BIGINT) AS rank, term, tf, df, round(x, 6) AS tfidf FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY x DESC, term) AS rank FROM w) WHERE rank <= 5
""")
def q_tf_idf_top_terms(spark, root):
    _, terms = _doc_terms(spark, root)
    # m = number of documents: counted on the plain scan (no text read)
    n_docs = read_table(spark, root, "documents").count()
    weighted = tm.tf_idf(terms, n_docs)
    top = tm.top_terms(weighted, 5)
    return top.select("doc_id", big("rank").alias("rank"), "term", "tf", "df", r6("tfidf").alias("tfidf"))


# ---------------------------------------------------------------------------------
# S1..S6, S9: sources and sinks (written to and read back from the shared folder)
# ---------------------------------------------------------------------------------

from quarry.operators import encoders as en  # noqa: E402
from quarry.operators import filters as fl  # noqa: E402
from quarry.operators import metrics as mt  # noqa: E402
from quarry.operators import sampling as sp  # noqa: E402
from quarry.session import shared_path  # noqa: E402
from quarry.sources import files as fs  # noqa: E402

PART_SCHEMA = ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
               "p_size INT, p_retailprice DOUBLE")


@register("typed_csv_part", "SELECT * FROM part")
def q_typed_csv_part(spark, root):
    path = fs.write_csv(read_table(spark, root, "part"), shared_path(spark, "csv", "part"))
    return fs.read_typed_csv(spark, path, PART_SCHEMA)


@register("inferred_csv_part", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def q_inferred_csv_part(spark, root):
    path = fs.write_csv(read_table(spark, root, "part"), shared_path(spark, "csv", "part"))
    return fs.read_inferred_csv(spark, path)


@register("labeled_text_lines", """
SELECT lang AS label, line FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE line <> '' AND contains(line, ' ')
""")
def q_labeled_text_lines(spark, root):
    docs = read_table(spark, root, "documents")
    path = fs.write_labeled_text(docs, shared_path(spark, "text", "documents"), "lang", "text")
    return fs.read_labeled_text(spark, path).select(F.col("lang").alias("label"), F.col("value").alias("line"))


@register("union_labeled", "SELECT doc_id, lang AS label FROM documents")
def q_union_labeled(spark, root):
    """One folder per class, null included, written in one scan; each is read alone (the others are pruned) and labelled again."""
    path = shared_path(spark, "classes")
    read_table(spark, root, "documents").select("doc_id", "lang").write.partitionBy("lang").parquet(path)
    docs = spark.read.schema("doc_id long, lang string").parquet(path)
    classes = [r["lang"] for r in docs.select("lang").distinct().collect()]  # a row per class
    return sp.union_labeled({k: docs.filter(F.col("lang").eqNullSafe(F.lit(k))).select("doc_id") for k in classes})


@register("labeled_vectors_roundtrip", """
SELECT CAST(label AS DOUBLE) AS label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS features FROM embeddings
""")
def q_labeled_vectors_roundtrip(spark, root):
    from pyspark.ml.functions import vector_to_array
    emb = read_table(spark, root, "embeddings")
    path = fs.write_labeled_vectors(emb, shared_path(spark, "vectors", "embeddings"), "label", "embedding")
    return spark.read.parquet(path).select("label", vector_to_array("features").alias("features"))


@register("request_lines", f"""
SELECT conv_id, turn, role, CAST(line_no AS BIGINT) AS line_no, line FROM (
  SELECT conv_id, turn, role, unnest(generate_series(1, len(ls))) AS line_no, unnest(ls) AS line
  FROM (SELECT conv_id, turn, role,
               list_filter(regexp_split_to_array(text, {sq.q(r'\r?\n')}), lambda l: trim(l) <> '') AS ls
        FROM conversations))
""")
def q_request_lines(spark, root):
    conv = read_table(spark, root, "conversations")
    return fs.requests_to_df(conv).select("conv_id", "turn", "role", big("line_no").alias("line_no"), "line")


@register("labeled_csv_records", """
SELECT CAST(label AS DOUBLE) AS label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS features
FROM embeddings
""")
def q_labeled_csv_records(spark, root):
    emb = read_table(spark, root, "embeddings")
    path = fs.write_text(fs.to_labeled_csv(emb, "label", "embedding"), shared_path(spark, "records", "emb"))
    back = fs.parse_labeled_csv(spark, path)
    return back.select("label", F.transform("values", lambda x: x.cast("float").cast("double")).alias("features"))


# ---------------------------------------------------------------------------------
# P1, P4..P6: projections and filters
# ---------------------------------------------------------------------------------

@register("role_filter_parts", """
SELECT p_partkey, p_name, p_type FROM part
WHERE contains(p_type, 'PRO') OR p_type IN ('LARGE', 'SMALL')
""")
def q_role_filter_parts(spark, root):
    part = read_table(spark, root, "part")
    return fl.role_filter(part, "p_type", contains=("PRO",), equals=("LARGE", "SMALL")).select(
        "p_partkey", "p_name", "p_type")


@register("required_columns_docs", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL
""")
def q_required_columns_docs(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "lang")
    lab = read_table(spark, root, "labels")
    return fl.require_columns(docs.join(lab, "doc_id", "left"), ["quality", "toxic"]).select(
        "doc_id", "lang", "quality", "toxic")


@register("unknown_label_docs", """
SELECT doc_id, CAST(-1.0 AS DOUBLE) AS label, 'unknown' AS id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def q_unknown_label_docs(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id")
    lab = read_table(spark, root, "labels").select("doc_id")
    return fl.with_unknown_label(docs.join(lab, "doc_id", "left_anti"), "label", -1.0, id="id")


# ---------------------------------------------------------------------------------
# F1..F9, F14, F15: encoders
# ---------------------------------------------------------------------------------

# fixed values: ordinal levels of part types and of order priorities
TYPE_LEVELS = {"ECONOMY": 1, "STANDARD": 2, "MEDIUM": 3, "LARGE": 4, "PROMO": 5}
PRIORITY_LEVELS = {"5-LOW": 1, "3-MEDIUM": 2, "2-HIGH": 3, "1-URGENT": 4}
# fixed values: brand slots (unknown brands go to the slot after the last)
BRAND_SLOTS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6", "Brand#7",
               "Brand#8", "Brand#9", "Brand#10", "Brand#11"]
# fixed values: class values of document languages
LANG_CLASSES = {"en": 0.0, "fr": 1.0, "de": 2.0, "es": 3.0}


def _case_sql(col: str, mapping: dict, default) -> str:
    whens = " ".join(f"WHEN {sq.q(k) if isinstance(k, str) else k} THEN {v}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


_LVL_SQL = f"CAST({_case_sql('p_type', TYPE_LEVELS, 0)} AS DOUBLE)"
_SLOT_SQL = _case_sql("trim(p_brand)", {b: i for i, b in enumerate(BRAND_SLOTS)}, len(BRAND_SLOTS))


@register("ordinal_part_types", f"""
SELECT p_partkey, p_type, {_LVL_SQL} AS level FROM part
""")
def q_ordinal_part_types(spark, root):
    part = read_table(spark, root, "part")
    return en.ordinal_encode(part, "p_type", TYPE_LEVELS, 0.0, "level").select("p_partkey", "p_type", "level")


@register("ordinal_order_priority", f"""
SELECT o_orderpriority, CAST({_case_sql('o_orderpriority', PRIORITY_LEVELS, 0)} AS DOUBLE) AS level,
       count(*) AS n FROM orders GROUP BY 1, 2
""")
def q_ordinal_order_priority(spark, root):
    o = read_table(spark, root, "orders")
    e = en.ordinal_encode(o, "o_orderpriority", PRIORITY_LEVELS, 0.0, "level")
    return e.groupBy("o_orderpriority", "level").agg(F.count(F.lit(1)).alias("n"))


@register("brand_slots", f"""
SELECT p_partkey, p_brand, CAST({_SLOT_SQL} AS INTEGER) AS slot,
       CASE WHEN {_SLOT_SQL} = {len(BRAND_SLOTS)} THEN 'Other' ELSE trim(p_brand) END AS slot_name FROM part
""")
def q_brand_slots(spark, root):
    part = read_table(spark, root, "part").select("p_partkey", "p_brand")
    e = en.slot_encode(part, "p_brand", BRAND_SLOTS, out="slot")
    return en.slot_decode(e, "slot", BRAND_SLOTS, out="slot_name")


_ONEHOT_SQL = ", ".join(f"CASE WHEN {_SLOT_SQL} = {i} THEN 1.0 ELSE 0.0 END" for i in range(len(BRAND_SLOTS) + 1))


@register("regression_examples", f"""
SELECT p_partkey, p_retailprice AS label,
       [CAST(p_size AS DOUBLE), {_LVL_SQL}, {_ONEHOT_SQL}]::DOUBLE[] AS features FROM part
""")
def q_regression_examples(spark, root):
    from pyspark.ml.functions import vector_to_array
    part = read_table(spark, root, "part")
    ex = en.regression_examples(part, "p_retailprice", "p_size", "p_type", TYPE_LEVELS, "p_brand", BRAND_SLOTS)
    return ex.select("p_partkey", "label", vector_to_array("features").alias("features"))


@register("clustering_examples", f"""
SELECT p_partkey, [p_retailprice, CAST(p_size AS DOUBLE), {_LVL_SQL}]::DOUBLE[] AS features FROM part
""")
def q_clustering_examples(spark, root):
    from pyspark.ml.functions import vector_to_array
    part = read_table(spark, root, "part")
    ex = en.clustering_examples(part, "p_retailprice", "p_size", "p_type", TYPE_LEVELS)
    return ex.select("p_partkey", vector_to_array("features").alias("features"))


@register("wide_examples", """
SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS features FROM embeddings
""")
def q_wide_examples(spark, root):
    from pyspark.ml.functions import vector_to_array
    emb = read_table(spark, root, "embeddings")
    dim = en.vector_width(emb, "embedding")
    wide = en.widen(emb, "embedding", dim).drop("embedding")
    ex = en.wide_examples(wide, [f"feat_{i + 1}" for i in range(dim)], "label")
    return ex.select("vec_id", "label", vector_to_array("features").alias("features"))


@register("lang_index", """
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
i AS (SELECT lang, CAST(row_number() OVER (ORDER BY n DESC, lang) - 1 AS DOUBLE) AS lang_index FROM c)
SELECT doc_id, lang, lang_index, lang AS lang_back FROM documents JOIN i USING (lang)
""")
def q_lang_index(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "lang")
    d, model = en.string_index(docs, "lang", "lang_index")
    return en.index_to_string(d, "lang_index", model.labels, out="lang_back")


@register("brand_index", """
WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand)
SELECT p_brand, n, CAST(row_number() OVER (ORDER BY n DESC, p_brand) - 1 AS DOUBLE) AS brand_index FROM c
""")
def q_brand_index(spark, root):
    part = read_table(spark, root, "part").select("p_brand")
    d, _ = en.string_index(part, "p_brand", "brand_index")
    return d.groupBy("p_brand", "brand_index").agg(F.count(F.lit(1)).alias("n"))


@register("vector_index_parts", f"""
WITH b AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, {_LVL_SQL} - 2.0 AS shifted FROM part),
v AS (SELECT DISTINCT shifted FROM b),
m AS (SELECT shifted, CASE WHEN shifted = 0 THEN 0.0 ELSE CAST(row_number() OVER (ORDER BY shifted) AS DOUBLE)
        - (CASE WHEN shifted > 0 AND EXISTS (SELECT 1 FROM v WHERE shifted = 0) THEN 1 ELSE 0 END)
        + (CASE WHEN EXISTS (SELECT 1 FROM v WHERE shifted = 0) THEN 0 ELSE -1 END) END AS code
      FROM v)
SELECT p_partkey, b.shifted, p_size AS size_out, code AS shifted_code FROM b JOIN m USING (shifted)
""")
def q_vector_index_parts(spark, root):
    from pyspark.ml.functions import vector_to_array
    part = read_table(spark, root, "part")
    d = en.ordinal_encode(part, "p_type", TYPE_LEVELS, 0.0, "level").withColumn("shifted", F.col("level") - 2.0)
    d = en.assemble(d.withColumn("p_size_d", F.col("p_size").cast("double")), ["p_size_d", "shifted"], "features")
    out, _ = en.vector_index(d, "features", "indexed", 10)
    a = vector_to_array("indexed")
    return out.select("p_partkey", "shifted", a[0].alias("size_out"), a[1].alias("shifted_code"))


@register("max_abs_parts", f"""
WITH b AS (SELECT p_partkey, p_retailprice, CAST(p_size AS DOUBLE) AS p_size, {_LVL_SQL} AS level FROM part),
m AS (SELECT max(abs(p_retailprice)) AS a, max(abs(p_size)) AS b, max(abs(level)) AS c FROM b)
SELECT p_partkey, round(p_retailprice / CASE WHEN a = 0 THEN 1 ELSE a END, 6) AS price_scaled,
       round(p_size / CASE WHEN m.b = 0 THEN 1 ELSE m.b END, 6) AS size_scaled,
       round(level / CASE WHEN c = 0 THEN 1 ELSE c END, 6) AS level_scaled FROM b CROSS JOIN m
""")
def q_max_abs_parts(spark, root):
    part = read_table(spark, root, "part")
    d = en.ordinal_encode(part, "p_type", TYPE_LEVELS, 0.0, "level")
    s = en.max_abs_scale(d, ["p_retailprice", "p_size", "level"])
    return s.select("p_partkey", r6("p_retailprice_scaled").alias("price_scaled"),
                    r6("p_size_scaled").alias("size_scaled"), r6("level_scaled").alias("level_scaled"))


@register("class_lookup", f"""
SELECT doc_id, lang, CAST({_case_sql('lower(trim(lang))', LANG_CLASSES, -1)} AS DOUBLE) AS class_value,
       CASE WHEN lower(trim(lang)) IN ('en', 'fr', 'de', 'es') THEN lower(trim(lang)) ELSE 'unknown' END AS class_name
FROM documents
""")
def q_class_lookup(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "lang")
    d = en.class_by_name(docs, "lang", LANG_CLASSES, "class_value")
    return en.class_by_value(d, "class_value", LANG_CLASSES, "class_name")


# ---------------------------------------------------------------------------------
# hashed terms, vocabulary, count vectors
# ---------------------------------------------------------------------------------

@register("hashed_terms", f"""
SELECT doc_id, CAST({sq.hash_bucket('word', 4096)} AS INTEGER) AS bucket, count(*) AS tf
FROM ({sq.DOC_BAG}) GROUP BY 1, 2
""")
def q_hashed_terms(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    words = docs.select("doc_id", tx.document_words("text").alias("words"))
    return tm.hashing_tf(words, "doc_id", "words", 4096)


VOCABULARY = 15_000  # fixed value: the original job's vocabulary size, with terms of 3 documents or more

_VOCAB_SQL = f"""
WITH tf AS ({_DOC_TERMS_SQL}),
st AS (SELECT term, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_freq FROM tf GROUP BY term HAVING count(*) >= 3)
SELECT CAST(row_number() OVER (ORDER BY term_count DESC, term) - 1 AS INTEGER) AS term_index, term,
       term_count, doc_freq FROM st ORDER BY term_count DESC, term LIMIT 15000
"""


@register("vocabulary", _VOCAB_SQL)
def q_vocabulary(spark, root):
    _, terms = _doc_terms(spark, root)
    return tm.vocabulary(terms, vocab_size=VOCABULARY, min_df=3)


@register("count_vectors", f"""
WITH v AS ({_VOCAB_SQL}), tf AS ({_DOC_TERMS_SQL})
SELECT doc_id, term_index, tf FROM tf JOIN v USING (term)
""")
def q_count_vectors(spark, root):
    _, terms = _doc_terms(spark, root)
    vocab = tm.vocabulary(terms, vocab_size=VOCABULARY, min_df=3)
    # bounded by the vocabulary's size, so the terms of all documents are not dealt out again for the join
    return tm.count_terms(terms, F.broadcast(vocab)).select("doc_id", "term_index", "tf")


# ---------------------------------------------------------------------------------
# R1, R2, U2, E2 folds; A1, A2
# ---------------------------------------------------------------------------------

_TRAIN = sq.below("doc_id", sp.SPLIT_SEED, 0.8)


@register("hash_split_docs", f"""
SELECT doc_id, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split FROM documents
""")
def q_hash_split_docs(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id")
    return sp.hash_split(docs, "doc_id", (0.8, 0.2), ("train", "test"))


_LI_KEY_SQL = "concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
_LI_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
_LI_OUT = ", ".join(_LI_COLS[:-1]) + ", strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate"


def _li_out(df):
    return df.select(*_LI_COLS[:-1], F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))



def _lineitem_sample(spark, root):
    li = read_table(spark, root, "lineitem")
    keyed = li.withColumn("_k", sp.row_key(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]))
    return li, sp.hash_sample(keyed, "_k", 0.7).drop("_k")


@register("hash_sample_lineitem", f"""
SELECT {_LI_OUT} FROM lineitem WHERE {sq.below(_LI_KEY_SQL, sp.SAMPLE_SEED, 0.7)}
""")
def q_hash_sample_lineitem(spark, root):
    _, s = _lineitem_sample(spark, root)
    return _li_out(s)


@register("holdout_complement", f"""
SELECT {_LI_OUT} FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT * FROM lineitem WHERE {sq.below(_LI_KEY_SQL, sp.SAMPLE_SEED, 0.7)}) s
  WHERE {' AND '.join(f's.{c} IS NOT DISTINCT FROM l.{c}' for c in _LI_COLS)})
""")
def q_holdout_complement(spark, root):
    li, s = _lineitem_sample(spark, root)
    return _li_out(sp.holdout_complement(li, s))


@register("fold_assignment", f"""
SELECT doc_id, CAST({sq.seeded_hash('doc_id', sp.FOLD_SEED)} % 10 AS INTEGER) AS fold FROM documents
""")
def q_fold_assignment(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id")
    return sp.assign_folds(docs, "doc_id", 10)


@register("dataset_overview", """
SELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars,
       count(CASE WHEN text <> '' THEN 1 END) AS n_nonempty FROM documents
""")
def q_dataset_overview(spark, root):
    return mt.dataset_overview(read_table(spark, root, "documents"), "text")


@register("class_distribution", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def q_class_distribution(spark, root):
    return mt.class_distribution(read_table(spark, root, "documents"), "lang")


# ---------------------------------------------------------------------------------
# M4 (relational naive Bayes), C1..C3, A3, E3, E6, E7, O2
# ---------------------------------------------------------------------------------

from quarry.operators import bayes as nb  # noqa: E402

def _nb_sql(bag: str) -> str:
    return f"""
docs AS (SELECT doc_id, lang, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split FROM documents),
words AS (SELECT doc_id, word FROM ({bag})),
train_docs AS (SELECT * FROM docs WHERE split = 'train'),
test_docs AS (SELECT * FROM docs WHERE split = 'test'),
cls AS (SELECT lang AS class, count(*) AS n_c FROM train_docs GROUP BY lang),
tot AS (SELECT sum(n_c) AS n, count(*) AS c FROM cls),
ctf AS (SELECT d.lang AS class, w.word AS term, count(*) AS tf FROM words w JOIN train_docs d USING (doc_id) GROUP BY 1, 2),
voc AS (SELECT count(DISTINCT term) AS v FROM ctf),
sc AS (SELECT class, sum(tf) AS s FROM ctf GROUP BY class),
cc AS (SELECT cls.class, ln(cls.n_c + 1.0) - ln(tot.n + tot.c) AS prior, ln(coalesce(sc.s, 0) + voc.v) AS den
       FROM cls CROSS JOIN tot CROSS JOIN voc LEFT JOIN sc USING (class)),
tw AS (SELECT w.doc_id, w.word AS term FROM words w JOIN test_docs USING (doc_id)
       WHERE w.word IN (SELECT term FROM ctf)),
xd AS (SELECT doc_id, count(*) AS x FROM tw GROUP BY doc_id),
pt AS (SELECT tw.doc_id, ctf.class, sum(ln(ctf.tf + 1.0)) AS s FROM tw JOIN ctf USING (term) GROUP BY 1, 2),
scores AS (SELECT t.doc_id, t.lang AS label, cc.class,
                  cc.prior - coalesce(xd.x, 0) * cc.den + coalesce(pt.s, 0) AS score
           FROM test_docs t CROSS JOIN cc LEFT JOIN xd ON xd.doc_id = t.doc_id
           LEFT JOIN pt ON pt.doc_id = t.doc_id AND pt.class = cc.class),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class) AS rk,
                  exp(score - max(score) OVER (PARTITION BY doc_id)) AS e FROM scores),
probs AS (SELECT *, e / sum(e) OVER (PARTITION BY doc_id) AS p FROM ranked),
pred AS (SELECT doc_id, label, class AS prediction FROM probs WHERE rk = 1)
"""


_NB_SQL = _nb_sql(sq.DOC_BAG)


def _nb_scored(spark, root, bag=None):
    docs = read_table(spark, root, "documents").select("doc_id", "text", "lang")
    words = docs.select("doc_id", "lang", (tx.document_words("text") if bag is None else bag).alias("words"))
    words = sp.hash_split(words, "doc_id", (0.8, 0.2), ("train", "test"))
    train = words.filter(F.col("split") == "train")
    test = words.filter(F.col("split") == "test")
    model = nb.nb_model(train, label="lang", words="words")
    scored = nb.nb_score(model, test, "doc_id", "words", carry=("lang",)).withColumnRenamed("lang", "label")
    return model, scored


@register("nb_predictions", f"""
WITH {_NB_SQL}
SELECT doc_id, label, prediction, CAST(label = prediction AS BOOLEAN) AS correct FROM pred
""")
def q_nb_predictions(spark, root):
    _, scored = _nb_scored(spark, root)
    pairs = scored.select("doc_id", "label", "prediction")
    return pairs.withColumn("correct", F.col("label") == F.col("prediction"))


@register("nb_confusion", f"""
WITH {_NB_SQL}
SELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2
""")
def q_nb_confusion(spark, root):
    _, scored = _nb_scored(spark, root)
    return mt.confusion_counts(scored, "label", "prediction")


@register("nb_metrics", f"""
WITH {_NB_SQL},
cm AS (SELECT label AS l, prediction AS p, count(*) AS n FROM pred GROUP BY 1, 2),
bl AS (SELECT l AS c, sum(n) AS n_true, sum(CASE WHEN l = p THEN n ELSE 0 END) AS tp FROM cm GROUP BY 1),
bp AS (SELECT p AS c, sum(n) AS n_pred FROM cm GROUP BY 1),
per AS (SELECT bl.c, CAST(bl.n_true AS DOUBLE) AS n_true, CAST(bl.tp AS DOUBLE) AS tp,
               CASE WHEN coalesce(bp.n_pred, 0) > 0 THEN bl.tp / CAST(bp.n_pred AS DOUBLE) ELSE 0.0 END AS prec,
               bl.tp / CAST(bl.n_true AS DOUBLE) AS rec FROM bl LEFT JOIN bp USING (c))
SELECT round(sum(tp) / sum(n_true), 6) AS accuracy,
       round(sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END * n_true) / sum(n_true), 6) AS f1,
       round(sum(prec * n_true) / sum(n_true), 6) AS weighted_precision,
       round(sum(rec * n_true) / sum(n_true), 6) AS weighted_recall FROM per
""")
def q_nb_metrics(spark, root):
    _, scored = _nb_scored(spark, root)
    m = mt.multiclass_metrics(scored, "label", "prediction")
    return m.select(*[r6(c).alias(c) for c in m.columns])


@register("nb_class_probabilities", f"""
WITH {_NB_SQL}
SELECT doc_id, class, round(p, 4) AS probability FROM probs
""")
def q_nb_class_probabilities(spark, root):
    model, scored = _nb_scored(spark, root)
    m = nb.class_probabilities(scored, model.names())
    return m.select("doc_id", F.explode("class_probabilities").alias("class", "p")).select(
        "doc_id", "class", F.round("p", 4).alias("probability"))


@register("nb_ranked_probabilities", f"""
WITH {_NB_SQL}
SELECT doc_id, class, round(p, 4) AS probability, CAST(rk AS BIGINT) AS rank,
       round(p / sum(p) OVER (PARTITION BY doc_id) * 100.0, 4) AS share, rk = 1 AS is_predicted FROM probs
""")
def q_nb_ranked_probabilities(spark, root):
    model, scored = _nb_scored(spark, root)
    r = nb.ranked_probabilities(scored, model.names(), "doc_id")
    return r.select("doc_id", "class", F.round("probability", 4).alias("probability"), big("rank").alias("rank"),
                    F.round("share", 4).alias("share"), "is_predicted")


@register("nb_sample_predictions", f"""
WITH {_NB_SQL}
SELECT doc_id, label, prediction FROM pred ORDER BY doc_id LIMIT 20
""")
def q_nb_sample_predictions(spark, root):
    _, scored = _nb_scored(spark, root)
    return mt.sample_predictions(scored.select("doc_id", "label", "prediction"), 20, ("doc_id",))


# ---------------------------------------------------------------------------------
# E4 AUC, M1 closed-form least squares, E5
# ---------------------------------------------------------------------------------

@register("auc_quality_by_length", """
WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS s, CAST(quality AS DOUBLE) AS y FROM documents JOIN labels USING (doc_id)),
r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS ar FROM d),
t AS (SELECT sum(CASE WHEN y > 0.5 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN y > 0.5 THEN 0 ELSE 1 END) AS n,
             sum(CASE WHEN y > 0.5 THEN ar ELSE 0 END) AS rs FROM r)
SELECT round((rs - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n), 6) AS auc,
       CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg FROM t
""")
def q_auc_quality_by_length(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, root, "labels").select("doc_id", "quality")
    a = mt.auc_roc(docs.join(lab, "doc_id"), "n_chars", "quality")
    return a.select(r6("auc").alias("auc"), "n_pos", "n_neg")


@register("linear_fit_lineitem", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
           FROM lineitem)
SELECT round(any_value(b), 6) AS slope, round(any_value(a), 6) AS intercept,
       round(sqrt(avg(power(a + b * l_quantity - l_extendedprice, 2))), 6) AS rmse
FROM lineitem CROSS JOIN f
""")
def q_linear_fit_lineitem(spark, root):
    li = read_table(spark, root, "lineitem").select("l_quantity", "l_extendedprice")
    b, a = mt.least_squares(li, "l_quantity", "l_extendedprice")
    pred = li.select((F.lit(a) + F.lit(b) * F.col("l_quantity")).alias("prediction"),
                     F.col("l_extendedprice").alias("label"))
    m = mt.regression_metrics(pred)
    return m.select(F.round(F.lit(b), 6).alias("slope"), F.round(F.lit(a), 6).alias("intercept"), r6("rmse").alias("rmse"))


@register("regression_metrics_lineitem", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
           FROM lineitem),
e AS (SELECT a + b * l_quantity - l_extendedprice AS err, l_extendedprice AS y FROM lineitem CROSS JOIN f)
SELECT round(sqrt(avg(err * err)), 6) AS rmse, round(avg(err * err), 4) AS mse, round(avg(abs(err)), 6) AS mae,
       round(1 - avg(err * err) / var_pop(y), 6) AS r2 FROM e
""")
def q_regression_metrics_lineitem(spark, root):
    li = read_table(spark, root, "lineitem").select("l_quantity", "l_extendedprice")
    b, a = mt.least_squares(li, "l_quantity", "l_extendedprice")
    pred = li.select((F.lit(a) + F.lit(b) * F.col("l_quantity")).alias("prediction"),
                     F.col("l_extendedprice").alias("label"))
    m = mt.regression_metrics(pred)
    return m.select(r6("rmse").alias("rmse"), F.round("mse", 4).alias("mse"), r6("mae").alias("mae"),
                    r6("r2").alias("r2"))


# ---------------------------------------------------------------------------------
# Cosine against class centroids; nearest members
# ---------------------------------------------------------------------------------

from quarry.operators import pairs as pr  # noqa: E402

_COS_SQL = """
e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(generate_series(1, len(embedding))) AS i FROM embeddings),
c AS (SELECT label AS c_label, i, avg(v) AS m FROM e GROUP BY label, i),
cn AS (SELECT c_label, sqrt(sum(m * m)) AS n FROM c GROUP BY c_label),
en AS (SELECT vec_id, sqrt(sum(v * v)) AS n FROM e GROUP BY vec_id),
dots AS (SELECT e.vec_id, c.c_label, sum(e.v * c.m) AS dot FROM e JOIN c USING (i) GROUP BY 1, 2),
cos AS (SELECT dots.c_label AS label, dots.vec_id,
               CASE WHEN en.n * cn.n > 0 THEN dot / (en.n * cn.n) END AS cosine
        FROM dots JOIN en USING (vec_id) JOIN cn USING (c_label))
"""


def _centroid_cos(spark, root):
    emb = read_table(spark, root, "embeddings")
    cents = pr.centroids(emb, "label", "embedding")
    return emb, cents


@register("centroid_cosines", f"""
WITH {_COS_SQL}
SELECT label, vec_id, round(cosine, 6) AS cosine FROM cos
""")
def q_centroid_cosines(spark, root):
    emb, cents = _centroid_cos(spark, root)
    p = pr.cosine_pairs(emb, cents, "vec_id", "embedding", "label", "centroid")
    return p.select("label", "vec_id", r6("cosine").alias("cosine"))


@register("centroid_neighbors", f"""
WITH {_COS_SQL}
SELECT label, CAST(rank AS BIGINT) AS rank, vec_id, round(cosine, 6) AS cosine FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY cosine DESC, vec_id) AS rank FROM cos
  WHERE cosine IS NOT NULL) WHERE rank <= 5
""")
def q_centroid_neighbors(spark, root):
    emb, cents = _centroid_cos(spark, root)
    nn = pr.nearest_neighbors(emb, cents, 5, "vec_id", "embedding", "label", "centroid")
    return nn.select("label", big("rank").alias("rank"), "vec_id", r6("cosine").alias("cosine"))


# ---------------------------------------------------------------------------------
# M2 assignment + one Lloyd step, E10 profile, C4 named levels
# ---------------------------------------------------------------------------------

from quarry.operators import clusters as cl  # noqa: E402

# fixed values: three starting centres in max-abs scaled units (price, size, level)
START_CENTERS = [[0.45, 0.25, 0.2], [0.6, 0.5, 0.6], [0.8, 0.8, 0.9]]
LEVEL_NAMES = ["junior", "middle", "senior"]
_FEATS = ["price_s", "size_s", "level_s"]


def _scaled_parts(spark, root):
    part = read_table(spark, root, "part").select("p_partkey", "p_retailprice", "p_size", "p_type")
    d = en.ordinal_encode(part, "p_type", TYPE_LEVELS, 0.0, "level")
    s = en.max_abs_scale(d, ["p_retailprice", "p_size", "level"])
    s = (s.withColumnRenamed("p_retailprice_scaled", "price_s").withColumnRenamed("p_size_scaled", "size_s")
         .withColumnRenamed("level_scaled", "level_s"))
    return cl.assign_clusters(s, _FEATS, START_CENTERS)


_CL_SQL = f"""
b AS (SELECT p_partkey, p_retailprice, CAST(p_size AS DOUBLE) AS p_size, {_LVL_SQL} AS level FROM part),
m AS (SELECT max(abs(p_retailprice)) AS ma, max(abs(p_size)) AS mb, max(abs(level)) AS mc FROM b),
s AS (SELECT b.*, p_retailprice / ma AS price_s, p_size / mb AS size_s, level / mc AS level_s FROM b CROSS JOIN m),
d AS (SELECT *, [{', '.join('+'.join(f'power({f} - {v}, 2)' for f, v in zip(_FEATS, c)) for c in START_CENTERS)}] AS dist
      FROM s),
a AS (SELECT *, CAST(list_position(dist, list_min(dist)) - 1 AS INTEGER) AS cluster FROM d),
prof AS (SELECT cluster, count(*) AS n, avg(p_retailprice) AS avg_price, avg(p_size) AS avg_size,
                avg(level) AS avg_level FROM a GROUP BY cluster)
"""


@register("cluster_assignment", f"""
WITH {_CL_SQL}
SELECT p_partkey, cluster FROM a
""")
def q_cluster_assignment(spark, root):
    return _scaled_parts(spark, root).select("p_partkey", "cluster")


@register("cluster_update", f"""
WITH {_CL_SQL}
SELECT cluster, round(avg(price_s), 6) AS price_s, round(avg(size_s), 6) AS size_s,
       round(avg(level_s), 6) AS level_s FROM a GROUP BY cluster
""")
def q_cluster_update(spark, root):
    u = cl.update_centers(_scaled_parts(spark, root), _FEATS)
    return u.select("cluster", *[r6(c).alias(c) for c in _FEATS])


@register("cluster_profile", f"""
WITH {_CL_SQL}
SELECT cluster, n, round(avg_price, 6) AS avg_price, round(avg_size, 6) AS avg_size,
       round(avg_level, 6) AS avg_level FROM prof
""")
def q_cluster_profile(spark, root):
    a = _scaled_parts(spark, root).withColumnRenamed("p_retailprice", "price").withColumnRenamed(
        "p_size", "size")
    p = cl.cluster_profile(a, ["price", "size", "level"])
    return p.select("cluster", "n", r6("avg_price").alias("avg_price"), r6("avg_size").alias("avg_size"),
                    r6("avg_level").alias("avg_level"))


@register("cluster_levels", f"""
WITH {_CL_SQL}
SELECT cluster, CAST(rk AS INTEGER) AS level_rank,
       CASE rk {' '.join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(LEVEL_NAMES))} ELSE 'unknown' END AS level
FROM (SELECT cluster, dense_rank() OVER (ORDER BY avg_price, cluster) AS rk FROM prof)
""")
def q_cluster_levels(spark, root):
    a = _scaled_parts(spark, root).withColumnRenamed("p_retailprice", "price")
    p = cl.cluster_profile(a, ["price"])
    return cl.level_from_cluster(p, "avg_price", LEVEL_NAMES).select("cluster", "level_rank", "level")


# ---------------------------------------------------------------------------------
# T5 porter2; M1..M8, F13, E8, E11 (pyspark.ml); jobs JB1..JB13; C5 streaming
# ---------------------------------------------------------------------------------

from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: E402

from quarry.plans import jobs as jb  # noqa: E402
from quarry.plans import models as md  # noqa: E402


@register("porter2_stems", f"""
WITH b AS ({sq.DOC_BAG}),
{sq.porter2("b")},
c AS (SELECT word, count(*) AS occurrences FROM b GROUP BY word)
SELECT word, occurrences, stem FROM c JOIN stems USING (word)
""")
def q_porter2_stems(spark, root):
    """Distinct words with their English Snowball stems and occurrence counts (rows check)."""
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    words = tx.explode_rows(docs, [], tx.document_words("text"), "word")
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))
    return tx.stem_words(counted, "word", "stem", mode="porter2", distinct=True)


@register("linear_normal_equation", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem
""")
def q_linear_normal_equation(spark, root):
    """LinearRegression(solver=normal, reg 0) on one feature equals closed-form least squares."""
    li = read_table(spark, root, "lineitem").select(
        array_to_vector(F.array(F.col("l_quantity"))).alias("features"), F.col("l_extendedprice").alias("label"))
    m = md.train_linear(li, reg=0.0, elastic_net=0.0, solver="normal")
    return spark.createDataFrame([(round(float(m.coefficients[0]), 4), round(float(m.intercept), 4))],
                                 "slope double, intercept double")


def _part_examples(spark, root):
    part = read_table(spark, root, "part")
    return en.regression_examples(part, "p_retailprice", "p_size", "p_type", TYPE_LEVELS, "p_brand", BRAND_SLOTS)


@register("train_linear_parts")
def q_train_linear_parts(spark, root):
    ex = _part_examples(spark, root)
    m = md.train_linear(ex, reg=0.3, elastic_net=0.8, max_iter=50)
    return m.transform(ex).select("p_partkey", "label", r6("prediction").alias("prediction"))


@register("training_summary_parts")
def q_training_summary_parts(spark, root):
    ex = _part_examples(spark, root)
    return md.training_summary(md.train_linear(ex, reg=0.3, elastic_net=0.8, max_iter=50))


@register("kmeans_parts")
def q_kmeans_parts(spark, root):
    part = read_table(spark, root, "part")
    ex = en.clustering_examples(part, "p_retailprice", "p_size", "p_type", TYPE_LEVELS)
    m = md.train_kmeans(ex, 3, seed=1)
    return m.transform(ex).select("p_partkey", F.col("prediction").alias("cluster"))


def _quality_docs(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    lab = read_table(spark, root, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return docs.join(lab, "doc_id")


@register("logistic_quality_docs")
def q_logistic_quality_docs(spark, root):
    """TF-IDF of document words -> binary logistic regression (M3)."""
    from pyspark.ml.feature import IDF, HashingTF
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml import Pipeline
    from quarry.plans.stages import DocumentWords
    d = _quality_docs(spark, root)
    pipe = Pipeline(stages=[DocumentWords(), HashingTF(inputCol="words", outputCol="tf", numFeatures=4096),
                            IDF(inputCol="tf", outputCol="features"), LogisticRegression(maxIter=50, regParam=0.01)])
    return pipe.fit(d).transform(d).select("doc_id", "label", "prediction")


@register("nb_ml_predictions", ORACLES["nb_predictions"])
def q_nb_ml_predictions(spark, root):
    """Count vectors over the training vocabulary + ml NaiveBayes equals the relational NB."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer, IndexToString, StringIndexer
    from pyspark.ml import Pipeline
    docs = read_table(spark, root, "documents").select("doc_id", "text", "lang")
    words = docs.select("doc_id", "lang", tx.document_words("text").alias("words"))
    # written once: counting the terms, both fits and the scoring read words, not texts
    path = shared_path(spark, "nb-ml")
    sp.hash_split(words, "doc_id", (0.8, 0.2), ("train", "test")).write.parquet(path)
    words = spark.read.parquet(path)
    train, test = words.filter(F.col("split") == "train"), words.filter(F.col("split") == "test")
    # alphabetical class order, so ties resolve to the same class as the relational form
    idx = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc")
    pipe = Pipeline(stages=[idx, CountVectorizer(inputCol="words", outputCol="features", vocabSize=(1 << 31) - 1),  # all terms
                            NaiveBayes(smoothing=1.0)])
    model = pipe.fit(train)
    pred = IndexToString(inputCol="prediction", outputCol="pred_lang", labels=model.stages[0].labels).transform(
        model.transform(test))
    return pred.select("doc_id", F.col("lang").alias("label"), F.col("pred_lang").alias("prediction"),
                       (F.col("lang") == F.col("pred_lang")).alias("correct"))


def _emb_vectors(spark, root):
    emb = read_table(spark, root, "embeddings")
    return emb.select("vec_id", F.col("label").cast("double").alias("label"),
                      array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@register("forest_embeddings")
def q_forest_embeddings(spark, root):
    d = _emb_vectors(spark, root)
    m = md.train_forest(d, num_trees=20, max_depth=6)
    return m.transform(d).select("vec_id", "label", "prediction")


@register("mlp_embeddings")
def q_mlp_embeddings(spark, root):
    d = _emb_vectors(spark, root)
    m = md.train_mlp(d, hidden=(50,), max_iter=100)
    return m.transform(d).select("vec_id", "label", "prediction")


@register("svm_embeddings")
def q_svm_embeddings(spark, root):
    d = _emb_vectors(spark, root).withColumn("label", (F.col("label") > 4).cast("double"))
    m = md.train_svm(d, max_iter=50)
    return m.transform(d).select("vec_id", "label", "prediction")


@register("logistic_multinomial_embeddings")
def q_logistic_multinomial_embeddings(spark, root):
    d = _emb_vectors(spark, root)
    m = md.train_logistic(d, family="multinomial", max_iter=50)
    return m.transform(d).select("vec_id", "label", "prediction")


@register("word2vec_synonyms")
def q_word2vec_synonyms(spark, root):
    """Word2Vec over 4-line verses; 5 synonyms of the 3 most frequent words."""
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    syn = jb.synonyms_job(docs, k=5, n_query_words=3, vector_size=32)
    return syn.select("word", big("rank").alias("rank"), "synonym", r6("similarity").alias("similarity"))


@register("similar_verses")
def q_similar_verses(spark, root):
    """For each line of each turn, the most similar other line of that request."""
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    conv = read_table(spark, root, "conversations")
    req = conv.select(F.concat_ws("-", "conv_id", "turn").alias("request_id"), "text")
    sim = jb.request_similarity_job(docs, req, vector_size=32)
    return sim.select("request_id", big("verse_id").alias("verse_id"), big("best_id").alias("best_id"),
                      r6("cosine").alias("cosine"))


@register("salary_regression_job")
def q_salary_regression_job(spark, root):
    part = read_table(spark, root, "part")
    return jb.salary_regression_job(part, "p_retailprice", "p_size", "p_type", TYPE_LEVELS, "p_brand",
                                    BRAND_SLOTS, model_path=shared_path(spark, "models", "salary"))


@register("level_clustering_job")
def q_level_clustering_job(spark, root):
    part = read_table(spark, root, "part")
    return jb.level_clustering_job(part, "p_retailprice", "p_size", "p_type", TYPE_LEVELS,
                                   model_path=shared_path(spark, "models", "levels"))


# The registered logistic and mlp queries search a smaller grid than the jobs' defaults, over all rows and 2 folds.
SMALL_GRIDS = {
    "logistic": {"sentencesInVerse": [4], "vectorSize": [32], "regParam": [0.01], "maxIter": [100]},
    "mlp": {"sentencesInVerse": [4], "vectorSize": [32], "maxIter": [100]},
}


def _verse_job(kind):
    def run(spark, root):
        if kind not in SMALL_GRIDS:  # the job's own grid and folds
            return jb.verse_classifier_job(_quality_docs(spark, root), kind)
        return jb.verse_classifier_job(_quality_docs(spark, root), kind, grid=SMALL_GRIDS[kind], folds=2)
    run.__name__ = f"q_verse_classifier_{kind}"
    return run


for _k in ("logistic", "forest", "mlp"):
    register(f"verse_classifier_{_k}")(_verse_job(_k))


@register("multiclass_text_nb")
def q_multiclass_text_nb(spark, root):
    return jb.multiclass_text_job(read_table(spark, root, "documents"), "nb")


@register("multiclass_text_lr")
def q_multiclass_text_lr(spark, root):
    return jb.multiclass_text_job(read_table(spark, root, "documents"), "lr", folds=2,
                                  model_path=shared_path(spark, "models", "text-lr"))


@register("product_classifier_job")
def q_product_classifier_job(spark, root):
    emb = read_table(spark, root, "embeddings")
    dim = en.vector_width(emb, "embedding")
    wide = en.widen(emb, "embedding", dim).drop("embedding")
    return jb.product_classifier_job(wide, [f"feat_{i + 1}" for i in range(dim)], "label", "vec_id", folds=2, max_depth=6)


@register("vector_classifier_job")
def q_vector_classifier_job(spark, root):
    emb = read_table(spark, root, "embeddings")
    return jb.vector_classifier_job(spark, emb, "label", "embedding", "vec_id", shared_path(spark, "digits"))


@register("baseline_trainers_job")
def q_baseline_trainers_job(spark, root):
    return jb.baseline_trainers_job(read_table(spark, root, "embeddings"), "label", "embedding", "vec_id")


@register("model_statistics")
def q_model_statistics(spark, root):
    """Parameters and sizes of every stage of a fitted text pipeline."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer, StringIndexer
    from pyspark.ml import Pipeline
    from quarry.plans.stages import DocumentWords
    docs = read_table(spark, root, "documents").select("text", "lang")
    pipe = Pipeline(stages=[StringIndexer(inputCol="lang", outputCol="label"), DocumentWords(),
                            CountVectorizer(inputCol="words", outputCol="features", vocabSize=VOCABULARY, minDF=3.0),
                            NaiveBayes()])
    return md.model_statistics(pipe.fit(docs))


_STREAM_NB_SQL = f"""
WITH words AS (SELECT doc_id, word FROM ({sq.DOC_BAG})),
cls AS (SELECT lang AS class, count(*) AS n_c FROM documents GROUP BY lang),
idx AS (SELECT class, CAST(row_number() OVER (ORDER BY n_c DESC, class) - 1 AS DOUBLE) AS ci FROM cls),
tot AS (SELECT sum(n_c) AS n, count(*) AS c FROM cls),
ctf AS (SELECT d.lang AS class, w.word AS term, count(*) AS tf FROM words w JOIN documents d USING (doc_id) GROUP BY 1, 2),
voc AS (SELECT count(DISTINCT term) AS v FROM ctf),
sc AS (SELECT class, sum(tf) AS s FROM ctf GROUP BY class),
cc AS (SELECT cls.class, idx.ci, ln(cls.n_c + 1.0) - ln(tot.n + tot.c) AS prior, ln(coalesce(sc.s, 0) + voc.v) AS den
       FROM cls JOIN idx USING (class) CROSS JOIN tot CROSS JOIN voc LEFT JOIN sc USING (class)),
xd AS (SELECT doc_id, count(*) AS x FROM words GROUP BY doc_id),
pt AS (SELECT w.doc_id, ctf.class, sum(ln(ctf.tf + 1.0)) AS s FROM words w JOIN ctf ON ctf.term = w.word GROUP BY 1, 2),
scores AS (SELECT d.doc_id, d.lang, cc.ci, cc.prior - coalesce(xd.x, 0) * cc.den + coalesce(pt.s, 0) AS score
           FROM documents d CROSS JOIN cc LEFT JOIN xd ON xd.doc_id = d.doc_id
           LEFT JOIN pt ON pt.doc_id = d.doc_id AND pt.class = cc.class)
SELECT doc_id, lang, ci AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ci) AS rk FROM scores) WHERE rk = 1
"""


@register("stream_scored_documents", _STREAM_NB_SQL)
def q_stream_scored_documents(spark, root):
    """Documents arriving as Parquet files are scored by a saved table-backed model in a stream."""
    from quarry.streaming import answer_stream, publish
    docs = read_table(spark, root, "documents").select("doc_id", "text", "lang")
    base = shared_path(spark, "stream")
    publish(nb.nb_model(docs.select("lang", tx.document_words("text").alias("words")), "lang", "words"), f"{base}/model", 1)
    docs.write.mode("overwrite").parquet(f"{base}/incoming")

    def answer(model, settings, batch):
        scored = nb.nb_score(model, batch.select("doc_id", "lang", tx.document_words("text").alias("words")), carry=("lang",))
        # class indexes by falling frequency, as the label indexer numbers them
        ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "class")))
        order = model.class_table.agg(F.transform(ranked, lambda x: x["class"]).alias("x")).scalar()
        index = F.array_position(order, F.col("prediction")) - 1
        return scored.select("doc_id", "lang", index.cast("double").alias("prediction"))

    answer_stream(spark, f"{base}/model", f"{base}/incoming", docs.schema, f"{base}/scored", f"{base}/checkpoint", answer)
    return spark.read.parquet(f"{base}/scored").select("doc_id", "lang", "prediction")


@register("document_word_numbers", f"""
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(word_pos AS BIGINT) AS word_pos,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, word_pos) AS BIGINT) AS word_no
FROM ({sq.DOC_WORDS})
""")
def q_document_word_numbers(spark, root):
    """Consecutive word numbers per document over word rows (W1, row lane, skew-safe numbering)."""
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    d = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(tx.split_lines(docs))))
    e = tx.explode_words(d.select("doc_id", "line_no", "filtered"))
    n = tx.number_words(e, "doc_id", "line_no", "word_pos", "word_no")
    return n.select("doc_id", big("line_no").alias("line_no"), big("word_pos").alias("word_pos"),
                    big("word_no").alias("word_no"))


_VERSE_MEAN_SQL = f"""
WITH v AS (SELECT doc_id, lang, (line_no - 1) // 4 + 1 AS part, word AS term, {_TRAIN} AS train FROM ({sq.DOC_WORDS})),
r AS (SELECT doc_id, lang, part, train, term, count(*) AS tf FROM v GROUP BY ALL),
rt AS (SELECT DISTINCT doc_id, lang, part, train FROM r),
cls AS (SELECT lang AS c, count(*) AS n FROM rt WHERE train AND lang IS NOT NULL GROUP BY lang),
ctf AS (SELECT lang AS c, term, sum(tf) AS tf FROM r WHERE train AND lang IS NOT NULL GROUP BY ALL),
cc AS (SELECT cls.c, ln(n + 1.0) - ln(sum(n) OVER () + count(*) OVER ()) AS prior, ln(coalesce(s, 0) + (SELECT count(DISTINCT term) FROM ctf)) AS den
       FROM cls LEFT JOIN (SELECT c, sum(tf) AS s FROM ctf GROUP BY c) USING (c)),
te AS (SELECT * FROM rt WHERE NOT train),
x AS (SELECT doc_id, part, sum(tf) AS x FROM r WHERE NOT train AND term IN (SELECT term FROM ctf) GROUP BY ALL),
g AS (SELECT doc_id, part, c, sum(r.tf * ln(ctf.tf + 1.0)) AS g FROM r JOIN ctf USING (term) WHERE NOT train GROUP BY ALL),
sc AS (SELECT te.doc_id, te.part, cc.c, prior - coalesce(x, 0) * den + coalesce(g, 0) AS score FROM te CROSS JOIN cc
       LEFT JOIN x ON x.doc_id = te.doc_id AND x.part = te.part LEFT JOIN g ON g.doc_id = te.doc_id AND g.part = te.part AND g.c = cc.c),
ex AS (SELECT *, exp(score - max(score) OVER (PARTITION BY doc_id, part)) AS e FROM sc),
pr AS (SELECT doc_id, part, c, e / sum(e) OVER (PARTITION BY doc_id, part) AS p FROM ex),
m AS (SELECT doc_id, c, avg(p) AS p, count(*) AS n FROM pr GROUP BY doc_id, c),
a AS (SELECT doc_id, any_value(n) AS n, first(c ORDER BY p DESC, c) AS c FROM m GROUP BY doc_id)
"""


@register("document_class_scores", f"""{_VERSE_MEAN_SQL}
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_verses, c AS predicted_label FROM documents d LEFT JOIN a USING (doc_id) WHERE NOT {_TRAIN}
""")
def q_document_class_scores(spark, root):
    """Verse classifier (4-line verses, counts + NB over all terms) scored per document by mean verse probability."""
    from quarry.streaming.answers import verse_answers
    d = sp.hash_split(read_table(spark, root, "documents").select("doc_id", "text", "lang"), "doc_id")
    train = tx.text_verses(d.filter(F.col("split") == "train"), n=4, label="lang", out="words")
    model = nb.nb_model(train, "lang", "words")
    test = d.filter(F.col("split") == "test")
    return verse_answers(model, {"sentencesInVerse": "4", "stem": "none"}, test).select("doc_id", "n_verses", "predicted_label")


@register("salary_predictions")
def q_salary_predictions(spark, root):
    """Tuned salary-like regression loaded or trained once, then every part scored."""
    part = read_table(spark, root, "part")
    out = jb.salary_predictions_job(spark, part, shared_path(spark, "models", "salary-cv"), "p_retailprice",
                                    "p_size", "p_type", TYPE_LEVELS, "p_brand", BRAND_SLOTS, "p_partkey")
    return out.select("p_partkey", "label", r6("prediction").alias("prediction"))


@register("level_predictions")
def q_level_predictions(spark, root):
    """Clustering pipeline loaded or trained once; every part gets a cluster and a named level (C4)."""
    part = read_table(spark, root, "part")
    return jb.level_predictions_job(spark, part, shared_path(spark, "models", "levels-km"), "p_retailprice",
                                    "p_size", "p_type", TYPE_LEVELS, "p_partkey")


@register("nb_correct_flags", f"""
WITH {_NB_SQL}
SELECT doc_id, CAST({_case_sql('label', LANG_CLASSES, -1)} AS DOUBLE) AS label_value,
       CAST({_case_sql('prediction', LANG_CLASSES, -1)} AS DOUBLE) AS prediction_value,
       CAST({_case_sql('label', LANG_CLASSES, -1)} AS BIGINT) = CAST({_case_sql('prediction', LANG_CLASSES, -1)} AS BIGINT)
         AS correct
FROM pred
""")
def q_nb_correct_flags(spark, root):
    """Predictions as class values; the correct flag compares integer parts."""
    _, scored = _nb_scored(spark, root)
    v = en.class_by_name(scored, "label", LANG_CLASSES, "label_value")
    v = en.class_by_name(v, "prediction", LANG_CLASSES, "prediction_value")
    return mt.is_correct(v.select("doc_id", "label_value", "prediction_value"), "label_value", "prediction_value")


@register("vocabulary_full", f"""
WITH tf AS ({_DOC_TERMS_SQL}),
st AS (SELECT term, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_freq FROM tf GROUP BY term)
SELECT CAST(row_number() OVER (ORDER BY term_count DESC, term) - 1 AS INTEGER) AS term_index, term,
       term_count, doc_freq FROM st
""")
def q_vocabulary_full(spark, root):
    """Every distinct term, numbered by the exact distributed global index."""
    _, terms = _doc_terms(spark, root)
    return tm.vocabulary(terms)


_PLAIN_BAG = f"SELECT doc_id, lang, unnest({sq.drop_stop(sq.tokens('text'))}) AS word FROM documents"


@register("text_nb_plain_words", f"""
WITH {_nb_sql(_PLAIN_BAG)}
SELECT doc_id, label, prediction FROM pred
""")
def q_text_nb_plain_words(spark, root):
    """Naive Bayes on the multi-class jobs' own chain: tokens of the whole text without stop words (JB8)."""
    from quarry.functions import text as tf
    _, scored = _nb_scored(spark, root, tf.drop_stop_words(tf.tokens("text")))
    return scored.select("doc_id", "label", "prediction")


@register("fold_rmse_lineitem", f"""
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y, {sq.seeded_hash(_LI_KEY_SQL, sp.FOLD_SEED)} % 3 AS fold FROM lineitem),
k AS (SELECT DISTINCT fold FROM d),
f AS (SELECT k.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM k JOIN d ON d.fold <> k.fold GROUP BY k.fold)
SELECT CAST(d.fold AS INTEGER) AS fold, round(sqrt(avg(power(a + b * x - y, 2))), 6) AS rmse FROM d JOIN f ON f.fold = d.fold GROUP BY d.fold
""")
def q_fold_rmse_lineitem(spark, root):
    """3-fold cross-validation of one-feature least squares: RMSE of each held-out fold."""
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.functions import array_to_vector
    li = read_table(spark, root, "lineitem").withColumn("_k", sp.row_key(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]))
    d = sp.assign_folds(li, "_k", 3).select(array_to_vector(F.array(F.col("l_quantity").cast("double"))).alias("features"),
                                            F.col("l_extendedprice").cast("double").alias("label"), "fold").persist()
    try:
        rows = []
        for k in range(3):
            m = LinearRegression(solver="normal").fit(d.filter(F.col("fold") != k))
            rows.append((k, float(mt.regression_metrics(m.transform(d.filter(F.col("fold") == k))).first()["rmse"])))
        return spark.createDataFrame(rows, "fold int, rmse double").withColumn("rmse", r6("rmse"))
    finally:
        d.unpersist()


@register("saved_linear_predictions", """
WITH f AS (SELECT regr_slope(p_retailprice, p_size) AS b, regr_intercept(p_retailprice, p_size) AS a FROM part)
SELECT p_partkey, round(a + b * p_size, 4) AS prediction FROM part CROSS JOIN f
""")
def q_saved_linear_predictions(spark, root):
    """Least squares trained, saved, loaded and scored."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression, LinearRegressionModel
    from quarry.sources.models import load_or_train
    d = read_table(spark, root, "part").select(
        "p_partkey", array_to_vector(F.array(F.col("p_size").cast("double"))).alias("features"), F.col("p_retailprice").cast("double").alias("label"))
    path = shared_path(spark, "models", "least-squares")
    load_or_train(spark, path, lambda: LinearRegression(solver="normal").fit(d), kind=LinearRegressionModel)
    model = load_or_train(spark, path, lambda: None, kind=LinearRegressionModel)
    return model.transform(d).select("p_partkey", F.round("prediction", 4).alias("prediction"))


@register("linear_summary", """
WITH f AS (SELECT regr_slope(p_retailprice, p_size) AS b, regr_intercept(p_retailprice, p_size) AS a, regr_r2(p_retailprice, p_size) AS r2 FROM part),
e AS (SELECT sqrt(avg(power(a + b * p_size - p_retailprice, 2))) AS rmse FROM part CROSS JOIN f)
SELECT 'coefficient' AS metric, round(b, 4) AS value FROM f UNION ALL SELECT 'intercept', round(a, 4) FROM f
UNION ALL SELECT 'r2', round(r2, 4) FROM f UNION ALL SELECT 'rmse', round(rmse, 4) FROM e
""")
def q_linear_summary(spark, root):
    """Training summary and coefficients of a least-squares model."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression
    d = read_table(spark, root, "part").select(
        array_to_vector(F.array(F.col("p_size").cast("double"))).alias("features"), F.col("p_retailprice").cast("double").alias("label"))
    m = LinearRegression(solver="normal").fit(d)
    own = md.training_summary(m).filter(F.col("metric").isin("rmse", "r2", "intercept"))
    coef = md.explain_linear(m, ["coefficient"]).filter("name = 'coefficient'").toDF("metric", "value")
    return own.unionByName(coef).select("metric", F.round("value", 4).alias("value"))


from quarry.plans import operator_queries, search_queries  # noqa: E402, F401  (they register their queries)
