import pytest
from pyspark.sql import functions as F

from quarry.functions import text as tf
from quarry.functions import stemming as st
from tests.porter2_plain import stem
from quarry.operators import text as tx


def test_cleanse_accents_punctuation_spaces(spark):
    df = spark.createDataFrame([(" Été don't  stop! ",)], ["line"])
    assert tx.cleanse_text(df, "line", "clean").first()["clean"] == "t dont stop"


def test_tokenize_drops_empty_tokens(spark):
    df = spark.createDataFrame([(" a  B c ",)], ["clean"])
    assert tx.tokenize(df).first()["words"] == ["a", "b", "c"]


def test_clean_tokens_equals_full_chain(spark):
    rows = [(" Été don't  stop! ",), ("!!! ???",), ("The  cat\tsat, on the mat.",), ("",), ("a\x0bb",)]
    df = spark.createDataFrame(rows, ["line"])
    full = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(df, "line", "clean")), "words", "kept")
    got = full.select("kept", tf.clean_tokens("line").alias("fast")).collect()
    assert all(r["kept"] == r["fast"] for r in got)


def test_stop_words_keep_duplicates_and_order(spark):
    df = spark.createDataFrame([(["love", "the", "love"],)], ["words"])
    assert tx.remove_stop_words(df).first()["filtered"] == ["love", "love"]


def test_stop_word_list_is_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(tf.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def _five_lines(spark):
    text = "one two\nthree four\nthe of\nfive six\nseven eight"
    return spark.createDataFrame([(1, text, "x")], ["doc_id", "text", "label"])


def test_verses_gaps_do_not_shift_ids(spark):
    docs = _five_lines(spark)
    d = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(tx.split_lines(docs))))
    lines = {r["line_no"]: r["filtered"] for r in d.collect()}
    assert lines[3] == []
    v = tx.build_verses(d, n=2, words="filtered").orderBy("verse_id").collect()
    assert [(r["verse_id"], r["verse"]) for r in v] == [
        (1, ["one", "two", "three", "four"]), (2, ["five", "six"]), (3, ["seven", "eight"])]


def test_array_lane_equals_row_lane(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    a = tx.text_verses(docs, n=3, label="lang")
    d = tx.remove_stop_words(tx.tokenize(tx.cleanse_text(tx.split_lines(docs))))
    r = tx.build_verses(d, n=3, words="filtered", label="lang")
    key = ["doc_id", "verse_id", "lang", "verse"]
    assert sorted(map(tuple, a.select(*key).collect())) == sorted(map(tuple, r.select(*key).collect()))


def test_line_numbers_survive_repartition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    base = sorted(map(tuple, tx.split_lines(docs).collect()))
    again = sorted(map(tuple, tx.split_lines(docs.repartition(7)).collect()))
    assert base == again


def test_unite_restores_word_order(spark):
    rows = [(1, 1, 3, "c"), (1, 1, 1, "a"), (1, 1, 2, "b")]
    df = spark.createDataFrame(rows, ["doc_id", "line_no", "word_pos", "word"]).repartition(3)
    assert tx.unite_sentence(df).first()["sentence"] == "a b c"


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], ["w"])
    got = [r["g"] for r in df.select(tf.ngrams("w", 2).alias("g")).collect()]
    assert got == [["a b", "b c"], [], []]
    assert df.select(tf.ngrams("w", 3).alias("g")).first()["g"] == ["a b c"]


@pytest.mark.parametrize("word,expected", [
    ("ponies", "pony"), ("cries", "cry"), ("ties", "ty"), ("aies", "aie"), ("goes", "goe"), ("cats", "cat"),
    ("bus", "bus"), ("glass", "glass"), ("shoes", "shoe"), ("agrees", "agree"),
])
def test_s_stemmer(spark, word, expected):
    df = spark.createDataFrame([(word,)], ["w"])
    assert df.select(tf.s_stem("w").alias("s")).first()["s"] == expected


@pytest.mark.parametrize("word,expected", [
    ("caresses", "caress"), ("ponies", "poni"), ("running", "run"), ("generously", "generous"),
    ("hopefulness", "hope"), ("dying", "die"), ("news", "news"), ("agreed", "agre"), ("happily", "happili"),
    ("university", "univers"), ("consignment", "consign"), ("knightly", "knight"),
])
def test_porter2_known_pairs(word, expected):
    assert stem(word) == expected


def test_porter2_columns_equal_the_plain_stemmer(spark):
    import random
    rng = random.Random(11)
    ends = [e for e, _ in st.STEP2 + st.STEP3] + st.STEP4 + ["s", "sses", "ies", "ied", "ed", "edly", "ing", "ingly", "eed", "eedly", "e", "ll", "l", "y",
                                                             "'s", "'s'", "'", "logi", "tion", "sion", "us", "ss", "ly", ""]
    words = ["", "a", "by", "sky", "yy", "ayy", "yay", "byy", "'tis", "o'clock's", "x1ed", "naïve", "bed", "shred", "hop", "hoping", "hopping", "falling",
             "hissing", "failing", "cry", "say", "enjoyed", "generically", "communing", "arsenal", *st.EXCEPTIONS, *st.AFTER_1A, "innings", "exceeds"]
    for _ in range(3000):
        core = "".join(rng.choice(["b", "c", "d", "t", "l", "y", "a", "e", "i", "o", "s", "nn", "th", "gener", "w", "x"]) for _ in range(rng.randint(0, 4)))
        words.append(core + rng.choice(ends) + (rng.choice(ends) if rng.random() < 0.3 else ""))
    df = spark.createDataFrame([(w,) for w in words] + [(None,), ("hoping",)], "w string")
    want = {w: stem(w) for w in words} | {None: None}
    for made in (tx.stem_words(df, "w", "s2", mode="porter2"), tx.stem_words(df, "w", "s2", mode="porter2", distinct=True)):
        got = made.collect()
        assert len(got) == len(words) + 2 and {r["w"]: r["s2"] for r in got} == want
    arrays = spark.createDataFrame([(words[:400],), (None,), (["running", "cats", None],)], "w array<string>")
    got = {tuple(r["w"]) if r["w"] is not None else None: r["s2"] for r in tx.stem_words(arrays, "w", "s2", mode="porter2").collect()}
    assert got == {tuple(words[:400]): [stem(w) for w in words[:400]], None: None, ("running", "cats", None): ["run", "cat", None]}


def test_verse_chain_stems_with_porter2(spark):
    df = spark.createDataFrame([(1, "running dogs barked\nhopefulness is dying"), (2, None)], "doc_id int, text string")
    got = tx.text_verses(df, n=2, stem="porter2").collect()
    assert [r["verse"] for r in got] == [["run", "dog", "bark", "hope", "die"]]


def test_request_lines_skip_blank(spark):
    from quarry.sources.files import requests_to_df
    df = spark.createDataFrame([(1, "a b\r\n\r\n  \nc d")], ["id", "text"])
    got = [(r["line_no"], r["line"]) for r in requests_to_df(df).orderBy("line_no").collect()]
    assert got == [(1, "a b"), (2, "c d")]


def test_number_lines_bucketed_equals_window(spark):
    from pyspark.sql import Window
    rows = [(d, p) for d in (1, 2) for p in range(0, 300, 3)] + [(3, 5)]
    df = spark.createDataFrame(rows, "doc int, pos int").repartition(4)
    got = sorted(map(tuple, tx.number_lines(df, "doc", "pos", bucket_size=16).collect()))
    want = sorted(map(tuple, df.withColumn("line_no", F.row_number().over(
        Window.partitionBy("doc").orderBy("pos"))).collect()))
    assert got == want


def test_labeled_text_readers(spark, tmp_path):
    from quarry.sources import files as fs
    for label, body in (("pop", "a b\n\nsingle\nc d"), ("rock", "e f")):
        d = tmp_path / "dirs" / label
        d.mkdir(parents=True)
        (d / "one.txt").write_text(body)
    dirs = {k: str(tmp_path / "dirs" / k / "*") for k in ("pop", "rock")}
    lines = fs.read_class_dirs(spark, dirs)
    assert sorted((r["label"], r["value"]) for r in lines.collect()) == [("pop", "a b"), ("pop", "c d"), ("rock", "e f")]
    assert all(r["id"].endswith("one.txt") for r in lines.collect())
    docs = spark.createDataFrame([("x", "p q\nr"), ("y", "s t")], "lang string, text string")
    path = fs.write_labeled_text(docs, str(tmp_path / "part"), "lang", "text")
    whole = fs.read_labeled_text(spark, path, whole=True)
    assert sorted((r["lang"], r["value"].strip()) for r in whole.collect()) == [("x", "p q\nr"), ("y", "s t")]
    per_line = fs.read_labeled_text(spark, path)
    assert sorted(r["value"] for r in per_line.collect()) == ["p q", "s t"]


def test_number_lines_hot_document(spark):
    from pyspark.sql import Window
    rows = [(1, p) for p in range(3000)] + [(d, p) for d in range(2, 12) for p in range(5)]
    df = spark.createDataFrame(rows, "doc int, pos int").repartition(8)
    got = tx.number_lines(df, "doc", "pos", bucket_size=100)
    want = df.withColumn("line_no", F.row_number().over(Window.partitionBy("doc").orderBy("pos")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # no bucket group holds more than bucket_size rows
    sizes = df.groupBy("doc", F.floor(F.col("pos") / 100).alias("b")).count()
    assert sizes.agg(F.max("count")).first()[0] <= 100
