"""Cross-validated naive Bayes search by subtraction.

All training counts of a fold are those of all rows minus the fold's own, so one
aggregation of (variant, fold, class, term) counts serves every fold and every grid
point; nothing is fitted fold by fold. A variant is a setting that changes the rows or the
terms (lines in a verse, number of hash buckets); points inside it (smoothing, least
document frequency) are columns of the same aggregation. The whole grid is one plan over
one written term table:

  n(k, c)      rows of class c outside fold k
  N(k, c, t)   occurrences of term t in them
  idf(k, t)    1, or ln((m + 1) / (df + 1)) over the rows outside fold k
  score        prior + sum_t tf idf (ln(idf N + l) - ln(sum_t idf N + V l))

With counts, V is the number of terms seen outside the fold and other terms say nothing,
as a count vectorizer fitted on those rows would have it; with hashed TF-IDF, V is the
number of buckets. Both equal ``pyspark.ml``'s multinomial model fitted per fold.

Scores are rounded to 9 decimals before they are compared, so equal texts tie whatever the
order of their sums. Ties go to the first class by name. Rows without a class take no
part; rows without a known term get the priors. Classes that a fold's other rows lack are
not scored in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_bucket
from quarry.operators.sampling import assign_folds
from quarry.operators.text import explode_rows, line_word_arrays
from quarry.session import shared_path, shared_root

ROW = ("variant", "id", "part")
BROADCAST_CELLS = 4_000_000   # weights of hash buckets up to here (some 200 MB) go to every executor; more are joined by a shuffle


def verse_variants(docs: DataFrame, lengths: Sequence[int], id: str, text: str, label: str, folds: int, stem: str = "s",
                   hashed: bool = False) -> DataFrame:
    """(variant, id, part, fold, label, words): the verses of every length, variant i having ``lengths[i]`` lines.

    The text chain runs once for all lengths; folds are drawn per document. ``hashed`` gives the words' portable
    32-bit hashes for ``bucket_variants``, so a word is hashed once however many verses it comes in.
    """
    known = assign_folds(docs.filter(F.col(label).isNotNull()), id, folds)
    lines = line_word_arrays(text, stem=stem)
    lines = F.transform(lines, word_hashes) if hashed else lines
    staged = known.select(F.col(id).alias("id"), "fold", F.col(label).cast("string").alias("label"), lines.alias("_lw"))
    sizes = F.explode(F.array(*[F.struct(F.lit(i).alias("v"), F.lit(n).alias("n")) for i, n in enumerate(lengths)]))
    each = staged.select("id", "fold", "label", "_lw", sizes.alias("_s"))
    n = F.col("_s.n")
    # documents without lines are left out here: a filter on their number would run the text chain a second time
    verses = F.transform(F.sequence(F.lit(1), F.ceil(F.size("_lw") / n).cast("int")),
                         lambda v: F.flatten(F.slice("_lw", (v - 1) * n + 1, n)))
    rows = explode_rows(each, [F.col("_s.v").alias("variant"), "id", "fold", "label"], F.when(F.size("_lw") > 0, verses), "words", "part")
    return rows.filter(F.size("words") > 0)


def word_hashes(words: str | Column) -> Column:
    return F.transform(words, lambda w: hash_bucket(w, 1 << 32))


def bucket_variants(rows: DataFrame, sizes: Sequence[int], words: str = "words", hashed: bool = False) -> DataFrame:
    """Each variant once for every number of buckets: variant v becomes v * len(sizes) + j with words hashed
    to ``sizes[j]`` buckets (portable md5 buckets, as text). ``hashed``: the words are their hashes already."""
    each = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(m).cast("long").alias("m")) for j, m in enumerate(sizes)]))
    s = (rows if hashed else rows.withColumn(words, word_hashes(words))).select("*", each.alias("_b"))
    return (s.withColumn(words, F.transform(words, lambda h: F.pmod(h, F.col("_b.m")).cast("string")))
            .withColumn("variant", F.col("variant") * len(sizes) + F.col("_b.j")).drop("_b"))


def _written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written and read again: what made it runs once, later reads take the columns they need."""
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()   # Spark deletes a shuffle's files once the driver has collected what led to them
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cells(rows: DataFrame, sizes: Sequence[int], points: int) -> int:
    """The numbers that the buckets' weights hold at most: buckets x folds x (classes + points) of every variant."""
    each = rows.groupBy("variant").agg(F.count_distinct("fold").alias("k"), F.count_distinct("label").alias("c")).collect()  # a row per variant
    return sum(sizes[r["variant"]] * r["k"] * (r["c"] + points) for r in each)


def _outside(total: Column, by_fold: Column, fold: Column) -> Column:
    return total - F.coalesce(F.try_element_at(by_fold, fold), F.lit(0).cast("long"))


def nb_fold_scores(rows: DataFrame, smoothings: Sequence[float] = (1.0,), idf_features: Sequence[int] | None = None,
                   min_doc_freqs: Sequence[int] = (0,)) -> DataFrame:
    """(variant, id, part, fold, label, point, classes, scores): each row scored by the model of the other folds.

    ``rows``: (variant, id, part, fold, label, words). ``idf_features`` gives each variant's
    number of buckets and turns counts into TF-IDF. Point p stands for
    ``min_doc_freqs[p // len(smoothings)]`` and ``smoothings[p % len(smoothings)]``.
    """
    spark = rows.sparkSession
    points = [(d, s) for d in (min_doc_freqs if idf_features else (0,)) for s in smoothings]
    folder, own = shared_path(spark, "nb-search"), [*ROW, "fold", "label"]
    rows = _written(rows.select(*own, "words", F.size("words").alias("size")), f"{folder}/rows")
    # dealt out by row, so a row's terms are counted and written together
    terms = explode_rows(rows.repartition(*own), own, F.col("words"), "term").groupBy(*own, "term").agg(F.count(F.lit(1)).alias("tf"))
    terms = _written(terms, f"{folder}/terms")
    # what the classes hold, by fold: rows and occurrences
    sizes = (rows.groupBy("variant", "label", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
             .groupBy("variant", "label").agg(F.sum("n").alias("n"), F.sum("s").alias("s"),
                                              F.map_from_entries(F.collect_list(F.struct("fold", "n"))).alias("n_in"),
                                              F.map_from_entries(F.collect_list(F.struct("fold", "s"))).alias("s_in")))
    folds = rows.select("variant", "fold").distinct()
    classes = (folds.join(sizes, "variant").select("variant", "fold", "label", _outside(F.col("n"), F.col("n_in"), F.col("fold")).alias("n"),
                                                   _outside(F.col("s"), F.col("s_in"), F.col("fold")).alias("s")).filter("n > 0"))

    # each term with its counts by class and fold; a term's row is bounded by classes x folds. Dealt out by term once
    # and written, as the sums and the rows both ask for it
    counts = (terms.groupBy("variant", "term", "label", "fold").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))
              .repartition("variant", "term").groupBy("variant", "term", "label").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"),
                                                       F.map_from_entries(F.collect_list(F.struct("fold", "tf"))).alias("tf_in"),
                                                       F.map_from_entries(F.collect_list(F.struct("fold", "df"))).alias("df_in")))
    per_term = counts.groupBy("variant", "term").agg(F.collect_list(F.struct("label", "tf", "df", "tf_in", "df_in")).alias("c"))

    def left(k: Column) -> Column:
        return F.filter(F.transform("c", lambda x: F.struct(x["label"].alias("label"), _outside(x["tf"], x["tf_in"], k).alias("tf"),
                                                            _outside(x["df"], x["df_in"], k).alias("df"))), lambda x: x["tf"] > 0)

    if idf_features:
        # a bucket weighs in every fold's sums
        per_term, every = _written(per_term, f"{folder}/per-term"), folds.groupBy("variant").agg(F.collect_set("fold").alias("k"))
        spread = per_term.join(every, "variant").select("variant", "term", "c", F.explode("k").alias("fold"))
        weights = spread.select("variant", "term", "fold", left(F.col("fold")).alias("c"))
    else:
        # a counted term weighs only where it occurs: its classes outside each of these folds, in one row
        inside = F.array_distinct(F.flatten(F.transform("c", lambda x: F.map_keys(x["tf_in"]))))
        outside = F.map_from_entries(F.transform(inside, lambda k: F.struct(k, left(k))))
        per_term = _written(per_term.select("variant", "term", outside.alias("by")), f"{folder}/per-term")

    if idf_features:
        width = spark.createDataFrame(list(enumerate(map(float, idf_features))), "variant int, v double")
        m = classes.groupBy("variant", "fold").agg(F.sum("n").alias("m"))
        df = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x["df"])
        idf = F.log((F.col("m") + 1.0) / (F.col("df") + 1.0))
        weights = (weights.withColumn("df", df).join(m, ["variant", "fold"])
                   .select("variant", "term", "fold", "c", *[F.when(F.col("df") >= d, idf).otherwise(0.0).alias(f"w{p}")
                                                             for p, (d, _) in enumerate(points)]))
        mass = (weights.select("variant", "fold", F.explode("c").alias("x"), *[f"w{p}" for p in range(len(points))])
                .groupBy("variant", "fold", F.col("x.label").alias("label"))
                .agg(*[F.sum(F.col("x.tf") * F.col(f"w{p}")).alias(f"s{p}") for p in range(len(points))]))
        const = classes.join(mass, ["variant", "fold", "label"], "left").join(width, "variant")
        sums = [F.coalesce(F.col(f"s{p}"), F.lit(0.0)) for p in range(len(points))]
        # what one occurrence adds to a row's sums: its weight (no label), and its gain in each class
        gain = lambda x, p, s: F.col(f"w{p}") * (F.log(F.col(f"w{p}") * x["tf"] + F.lit(s)) - F.log(F.lit(s)))
        none = F.struct(F.lit(None).cast("string").alias("label"), *[F.col(f"w{p}").alias(f"g{p}") for p in range(len(points))])
        weights = weights.select("variant", "term", "fold", F.concat(F.array(none), F.transform("c", lambda x: F.struct(
            x["label"].alias("label"), *[gain(x, p, s).alias(f"g{p}") for p, (_, s) in enumerate(points)]))).alias("c"))
    else:
        # terms that occur in one fold alone are unknown to the model of the others
        found = per_term.select("variant", F.explode("by").alias("fold", "c"))
        alone = found.groupBy("variant", "fold").agg(F.count(F.when(F.size("c") == 0, 1)).alias("alone"))
        width = per_term.groupBy("variant").agg(F.count(F.lit(1)).alias("all"))
        width = alone.join(width, "variant").select("variant", "fold", (F.col("all") - F.col("alone")).cast("double").alias("v"))
        const = classes.join(width, ["variant", "fold"], "left").withColumn("v", F.coalesce("v", F.lit(0.0)))
        sums = [F.col("s").cast("double")] * len(points)

    # one row per fold: its classes in order, with prior and denominator of every point
    group = Window.partitionBy("variant", "fold")
    total, many = F.sum("n").over(group), F.count(F.lit(1)).over(group)
    const = const.select("variant", "fold", "label", *[
        F.struct((F.log(F.col("n") + F.lit(s)) - F.log(total + many * F.lit(s))).alias("p"),
                 F.log(sums[p] + F.col("v") * F.lit(s)).alias("d")).alias(f"c{p}") for p, (_, s) in enumerate(points)])
    const = const.groupBy("variant", "fold").agg(F.array_sort(F.collect_list(F.struct(
        "label", *[f"c{p}" for p in range(len(points))]))).alias("const"))

    # the rows' sums: what a known term adds over an unseen one, per class; and the weight of all known terms
    if not idf_features:   # a term's folds meet its rows as one row
        seen = terms.join(per_term.hint("merge"), ["variant", "term"]).select(*ROW, "fold", "tf", F.try_element_at("by", F.col("fold")).alias("c"))
        none = F.struct(F.lit(None).cast("string").alias("label"), F.lit(0).cast("long").alias("tf"), F.lit(0).cast("long").alias("df"))
        parts = seen.filter(F.size("c") > 0).select(*ROW, "fold", "tf", F.explode(F.concat(F.array(none), F.col("c"))).alias("x"))
        one = [F.when(F.col("x.label").isNull(), F.col("tf").cast("double"))
               .otherwise(F.col("tf") * (F.log(F.col("x.tf") + F.lit(s)) - F.log(F.lit(s)))) for _, s in points]
    else:
        # broadcast, the terms stay with their rows, whose sums are made before anything moves
        few = _cells(rows, idf_features, len(points)) <= BROADCAST_CELLS
        seen = terms.join(F.broadcast(weights) if few else weights.hint("merge"), ["variant", "term", "fold"])
        parts = explode_rows(seen, [*ROW, "fold", "tf"], F.col("c"), "x")
        one = [F.col("tf") * F.col(f"x.g{p}") for p in range(len(points))]
    keys, cls = [*ROW, "fold"], F.col("x.label")
    sums_of = parts.groupBy(*keys, cls.alias("c")).agg(*[F.sum(e).alias(f"g{p}") for p, e in enumerate(one)])
    every = rows.select(*keys, F.col("label").alias("_y"), F.lit(None).cast("string").alias("c"),
                        *[F.lit(0.0).alias(f"g{p}") for p in range(len(points))])
    per_row = sums_of.withColumn("_y", F.lit(None).cast("string")).unionByName(every).groupBy(*keys).agg(
        F.max("_y").alias("label"), F.collect_list(F.struct("c", *[f"g{p}" for p in range(len(points))])).alias("g"))
    known = F.filter("g", lambda x: x["c"].isNotNull())
    scored = per_row.join(const, ["variant", "fold"]).select(
        *keys, "label", "const", "g", F.map_from_arrays(F.transform(known, lambda x: x["c"]), known).alias("by"))

    def scores(p: int, s: float) -> Column:
        x = F.aggregate(F.filter("g", lambda e: e["c"].isNull()), F.lit(0.0), lambda a, e: a + e[f"g{p}"])
        gain = lambda e: F.coalesce(F.try_element_at(F.col("by"), e["label"])[f"g{p}"], F.lit(0.0))
        return F.transform("const", lambda e: F.round(e[f"c{p}"]["p"] + x * (F.log(F.lit(s)) - e[f"c{p}"]["d"]) + gain(e), 9))

    each = F.explode(F.array(*[F.struct(F.lit(p).alias("point"), scores(p, s).alias("scores")) for p, (_, s) in enumerate(points)]))
    return (scored.select(*keys, "label", F.transform("const", lambda e: e["label"]).alias("classes"), each.alias("_e"))
            .select(*keys, "label", F.col("_e.point").alias("point"), "classes", F.col("_e.scores").alias("scores")))


def fold_accuracy(scored: DataFrame) -> DataFrame:
    """(variant, point, fold, n_rows, accuracy) of the first highest score."""
    best = F.element_at("classes", F.array_position("scores", F.array_max("scores")).cast("int"))
    return (scored.groupBy("variant", "point", "fold")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.avg((best == F.col("label")).cast("double")).alias("accuracy")))


def auc_by(df: DataFrame, groups: Sequence[str], score: str, positive: str) -> DataFrame:
    """(*groups, auc): area under ROC in each group, ties by average ranks; null where a class is missing.

    Distinct scores are range-partitioned over (groups, score), so a group may span many
    partitions: negatives below a score are those of the group's earlier partitions (a
    prefix over one row per group and partition) and of its earlier scores inside this one.
    """
    shared_root(df.sparkSession)
    hit = F.col(positive).cast("boolean")
    g = df.filter(F.col(score).isNotNull() & hit.isNotNull()).groupBy(*groups, F.col(score).alias("s")).agg(
        F.count(F.when(hit, 1)).alias("p"), F.count(F.when(~hit, 1)).alias("n"))
    g = g.repartitionByRange(*groups, "s").checkpoint().withColumn("_pid", F.spark_partition_id())
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (g.groupBy(*groups, "_pid").agg(F.sum("n").alias("_n"))
               .select(*groups, "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    inner = Window.partitionBy(*groups, "_pid").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    g = g.join(offsets, [*groups, "_pid"]).withColumn("_below", F.col("_before") + F.coalesce(F.sum("n").over(inner), F.lit(0)))
    return g.groupBy(*groups).agg(F.try_divide(F.sum(F.col("p") * (F.col("_below") + F.col("n") / 2.0)),
                                               F.sum("p").cast("double") * F.sum("n").cast("double")).alias("auc"))


def fold_auc(scored: DataFrame) -> DataFrame:
    """(variant, point, fold, auc) of two-class scores: log-odds of the second class by name.

    Joint log scores alone would rank rows by their length, so the difference is ranked.
    """
    two = scored.filter(F.size("classes") == 2).select(
        "variant", "point", "fold", F.round(F.col("scores")[1] - F.col("scores")[0], 9).alias("odds"),
        (F.col("label") == F.col("classes")[1]).alias("hit"))
    return auc_by(two, ["variant", "point", "fold"], "odds", "hit")


def grid_means(by_fold: DataFrame, metric: str) -> list[tuple[int, int, float]]:
    """(variant, point, mean of the folds) of every grid point, best first; ties to the first of the grid."""
    rows = by_fold.groupBy("variant", "point").agg(F.avg(metric).alias("m")).collect()  # one row per grid point
    return sorted(((r["variant"], r["point"], r["m"]) for r in rows), key=lambda r: (r[2] is None, -(r[2] or 0.0), r[0], r[1]))
