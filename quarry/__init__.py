"""quarry: text and tabular feature engineering, model training and scoring on Spark DataFrames.

Operators are free functions ``DataFrame -> DataFrame`` built from Spark column
expressions, aggregations and windows so that Catalyst plans them and the work
stays on the executors.

Quick start::

    from quarry.session import local_session
    from quarry.sources.tables import read_table
    from quarry.operators import text, terms

    spark = local_session()
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    words = docs.select("doc_id", text.document_words("text").alias("words"))
    tf = terms.document_terms(words, "doc_id", "words")
    top = terms.top_terms(terms.tf_idf(tf, docs.count()), k=5)

Modules: ``functions`` (column expressions), ``operators`` (text, terms, encoders,
filters, sampling, metrics, bayes, pairs, clusters, ranking), ``sources`` (tables,
files, input formats, models), ``plans`` (registered queries, pipeline stages, model
training, jobs, scoring), ``streaming`` (scoring streams).
"""

__version__ = "0.1.0"
