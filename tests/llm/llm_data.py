"""Small tables for the operator tests."""

from pyspark.sql import types as T

CLASH = ["fp", "rep", "node", "root", "label", "ids", "stats", "drop", "h1", "topic", "share", "x", "host", "v"]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASH]])
VECS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                     *[T.StructField(c, T.StringType()) for c in CLASH if c != "label"]])
PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      *[T.StructField(c, T.StringType()) for c in CLASH]])


def docs(spark, rows):
    """rows: (doc_id, text[, source[, lang]])"""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1]), *["c"] * len(CLASH)) for r in rows]
    return spark.createDataFrame(full, DOCS)


def vecs(spark, rows):
    """rows: (vec_id, embedding[, label])"""
    return spark.createDataFrame([(r[0], None if r[1] is None else [None if x is None else float(x) for x in r[1]], r[2] if len(r) > 2 else 0,
                                   *["c"] * (len(CLASH) - 1)) for r in rows], VECS)


def pages(spark, rows):
    return spark.createDataFrame([(*r, *["c"] * len(CLASH)) for r in rows], PAGES)


def components(n, links):
    """The smallest member of each node's component, by plain union-find."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
