import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quarry.operators import encoders as en
from quarry.operators import sampling as sp
from quarry.operators import terms as tm


def test_ordinal_encode_known_unknown_null(spark):
    df = spark.createDataFrame([("LARGE",), ("HUGE",), (None,)], "t string")
    got = [r["c"] for r in en.ordinal_encode(df, "t", {"LARGE": 4}, 0.0, "c").collect()]
    assert got == [4.0, 0.0, 0.0]


def test_slot_encode_unknown_blank_null(spark):
    df = spark.createDataFrame([("b",), ("zz",), ("",), (None,)], "t string")
    e = en.slot_encode(df, "t", ["a", "b"], out="s")
    assert [r["s"] for r in e.collect()] == [1, 2, 2, 2]
    d = en.slot_decode(e, "s", ["a", "b"], out="n")
    assert [r["n"] for r in d.collect()] == ["b", "Other", "Other", "Other"]


def test_vector_index_zero_first(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,)], "x double").select(
        array_to_vector(F.array("x")).alias("features"))
    out, _ = en.vector_index(df)
    got = [r[0] for r in out.select(vector_to_array("indexed")[0]).collect()]
    assert got == [1.0, 0.0, 2.0]


def test_string_index_frequency_then_alphabet(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",), ("c",), ("c",)], "v string")
    _, model = en.string_index(df, "v")
    assert model.labels == ["c", "a", "b"]


def test_index_to_string_unknown(spark):
    df = spark.createDataFrame([(0.0,), (5.0,)], "i double")
    assert [r["l"] for r in en.index_to_string(df, "i", ["x"], "l").collect()] == ["x", "Unknown"]


def test_vocabulary_order(spark):
    # Corpus count first; Spark's CountVectorizer leaves equal counts in hash order, here ties go by term.
    df = spark.createDataFrame([(1, ["b", "a", "c", "c", "c"]), (2, ["a", "b", "d"])],
                               "doc_id int, words array<string>")
    terms = tm.document_terms(df, "doc_id", "words")
    v = tm.vocabulary(terms).orderBy("term_index").collect()
    assert [r["term"] for r in v] == ["c", "a", "b", "d"]
    assert [r["term"] for r in tm.vocabulary(terms, vocab_size=2).orderBy("term_index").collect()] == ["c", "a"]
    assert [r["term"] for r in tm.vocabulary(terms, min_df=2).orderBy("term_index").collect()] == ["a", "b"]


def test_tf_idf_value(spark):
    df = spark.createDataFrame([(1, ["x", "x"]), (2, ["y"]), (3, ["z"])], "doc_id int, words array<string>")
    terms = tm.document_terms(df, "doc_id", "words")
    r = tm.tf_idf(terms, 3).filter(F.col("term") == "x").first()
    assert abs(r["tfidf"] - 2 * math.log(4 / 2)) < 1e-12


def test_tf_idf_equals_spark_idf(spark):
    from pyspark.ml.feature import IDF, CountVectorizer
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["a"])], "doc_id int, words array<string>")
    cvm = CountVectorizer(inputCol="words", outputCol="tf").fit(docs)
    idf = IDF(inputCol="tf", outputCol="w").fit(cvm.transform(docs))
    vocab = cvm.vocabulary
    got = {(r["doc_id"], r["term"]): r["tfidf"]
           for r in tm.tf_idf(tm.document_terms(docs, "doc_id", "words"), 3).collect()}
    for r in idf.transform(cvm.transform(docs)).collect():
        for i, v in zip(r["w"].indices, r["w"].values):
            assert abs(got[(r["doc_id"], vocab[i])] - v) < 1e-12


def test_max_abs_zero_column(spark):
    df = spark.createDataFrame([(0.0, 2.0), (0.0, -4.0)], "a double, b double")
    got = en.max_abs_scale(df, ["a", "b"]).collect()
    assert [r["a_scaled"] for r in got] == [0.0, 0.0] and [r["b_scaled"] for r in got] == [0.5, -1.0]


def test_hash_split_is_stable_under_repartition(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = sorted(map(tuple, sp.hash_split(df, "k").collect()))
    b = sorted(map(tuple, sp.hash_split(df.repartition(5), "k").collect()))
    assert a == b
    share = sum(1 for _, s in a if s == "train") / len(a)
    assert 0.75 < share < 0.85


def test_holdout_complement_removes_all_copies(spark):
    full = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    part = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert [tuple(r) for r in sp.holdout_complement(full, part).collect()] == [(3, "c")]


def test_hashing_tf_md5_bucket_matches_python(spark):
    import hashlib
    df = spark.createDataFrame([(1, ["hello"])], "doc_id int, words array<string>")
    b = tm.hashing_tf(df, "doc_id", "words", 4096).first()["bucket"]
    assert b == int(hashlib.md5(b"hello").hexdigest()[:8], 16) % 4096


def test_global_index_equals_window(spark):
    from pyspark.sql import Window
    from quarry.operators.ranking import global_index
    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id")).repartition(7)
    got = {(r["k"], r["id"]): r["index"] for r in global_index(df, ["k", "id"]).collect()}
    want = {(r["k"], r["id"]): r["rn"] - 1 for r in df.withColumn(
        "rn", F.row_number().over(Window.orderBy("k", "id"))).collect()}
    assert got == want


def test_vocabulary_is_the_head_of_the_whole_numbering(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    from quarry.operators import text as tx
    terms = tm.document_terms(docs.select("doc_id", tx.document_words("text").alias("words")), "doc_id", "words")
    a = sorted(map(tuple, tm.vocabulary(terms, vocab_size=300).collect()))
    b = sorted(map(tuple, tm.vocabulary(terms).filter("term_index < 300").collect()))
    assert a == b and len(a) == 300


def test_folds_are_per_document(spark):
    from quarry.operators import text as tx
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    verses = sp.assign_folds(tx.text_verses(docs, n=1), "doc_id", 5)
    per_doc = verses.groupBy("doc_id").agg(F.countDistinct("fold").alias("k"))
    assert per_doc.filter(F.col("k") > 1).count() == 0
    assert verses.select("fold").distinct().count() == 5


def test_labeled_records_with_name_rule(spark, tmp_path):
    from quarry.sources import files as fs
    df = spark.createDataFrame([("/x/cat_01.jpg", [1.0, 2.5]), ("/x/dog_02.jpg", [0.0, 3.0])],
                               "path string, px array<double>")
    rule = F.when(F.col("path").contains("cat"), 1).otherwise(0)
    path = fs.write_text(fs.to_labeled_csv(df, rule, "px"), str(tmp_path / "rec"))
    back = sorted((r["label"], r["values"]) for r in fs.parse_labeled_csv(spark, path).collect())
    assert back == [(0.0, [0.0, 3.0]), (1.0, [1.0, 2.5])]


def test_partitions_are_the_callers_choice(spark):
    from quarry.sources.tables import read_table
    assert read_table(spark, "/root/testdata/sf0.001", "region").rdd.getNumPartitions() == 1
    assert read_table(spark, "/root/testdata/sf0.001", "region", partitions=3).rdd.getNumPartitions() == 3


def test_small_weights_seeds_and_independent_folds(spark):
    df = spark.range(100_000).withColumnRenamed("id", "k")
    n = sp.hash_split(df, "k", (0.004, 0.996), ("a", "b")).filter("split = 'a'").count()
    assert 300 < n < 500
    assert 1 <= sp.hash_sample(df, "k", 0.0001).count() < 40
    assert sp.hash_sample(df, "k", 0.1, seed=1).exceptAll(sp.hash_sample(df, "k", 0.1, seed=2)).count() > 5000
    train = sp.hash_split(df, "k").filter("split = 'train'")
    folds = [r["count"] for r in sp.assign_folds(train, "k", 50).groupBy("fold").count().collect()]
    assert len(folds) == 50 and max(folds) < 1.3 * min(folds)


def test_widths_must_agree(spark):
    import pytest
    from quarry.operators.encoders import vector_width
    assert vector_width(spark.createDataFrame([([1.0, 2.0],), (None,), ([3.0, 4.0],)], "a array<double>"), "a") == 2
    with pytest.raises(ValueError, match="lengths"):
        vector_width(spark.createDataFrame([([1.0],), ([3.0, 4.0],)], "a array<double>"), "a")


def test_index_to_string_keeps_rows_and_names_unknown_indices(spark):
    from quarry.operators.encoders import index_to_string
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 7.0), (4, None)], "k int, i double")
    got = {r["k"]: r["i_label"] for r in index_to_string(df, "i", ["a", "b"]).collect()}
    assert got == {1: "a", 2: "b", 3: "Unknown", 4: "Unknown"}
