"""Small tables and plain references for the text operators."""

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
PROSE = "The lamp stood by the window and nobody had lit it since the spring rains began to fall on the hills"
#: NULLs everywhere, empty and blank texts, ties, repeated rows, a very long text.
ODD = [
    (1, PROSE, "en", "a", len(PROSE)), (1, PROSE, "en", "a", len(PROSE)), (2, PROSE, None, "b", None), (3, None, "en", "a", None), (4, "", "en", None, 0), (5, " \n\t ", None, None, 4),
    (None, PROSE + " again", "en", "a", None), (None, None, None, None, None), (6, "x" * 50_000, "en", "a", 50_000), (7, "wörter ünd 中文 😀 " * 3_000, "de", "b", None), (8, "a b c " * 4_000, "en", "a", None),
]


def odd(spark, extra=False):
    """The odd rows; with extra columns whose names clash with results and inner names."""
    df = spark.createDataFrame(ODD, DOCS)
    if extra:
        from pyspark.sql import functions as F

        names = ["key", "score", "size", "n_tokens", "spans", "target", "anchor", "block", "_id", "_h", "_text", "_y", "k0", "t", "fingerprint", "position", "held_out", "hits", "a.b"]
        df = df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    return df


def nothing(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
