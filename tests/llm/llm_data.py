import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def frame(spark, rows, parts=3):
    """documents from (doc_id, text[, lang[, source]]) rows"""
    full = [(d, t, *(list(rest) + ["en", "src1"][len(rest):]), len(t) if t is not None else None) for d, t, *rest in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def words(rnd, n, vocabulary=400):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def awkward():
    """nulls in every column, empty and very long texts, ties, repeated rows, one id with two texts"""
    rnd = random.Random(5)
    long = " ".join(words(rnd, 30_000, 9_000)) + "."
    text = " ".join(words(rnd, 60)) + "."
    return [(1, None), (2, ""), (3, "   \n\t "), (4, long), (5, long), (6, text), (7, text), (7, text), (8, "!?! ..."),
            (9, "one"), (9, "two other words here"), (None, text), (None, None), (10, text, None, None),
            (11, "Ärger über Öl. 中文字 текст"), (12, "\u0000 null byte"), (13, "é" * 300)]


CLASHES = ["row_no", "shard", "score", "key", "tag", "at", "_text", "_keep", "part", "bucket", "size", "domain", "_c0", "text2"]


def with_clashes(df):
    from pyspark.sql import functions as F
    for c in CLASHES:
        df = df.withColumn(c, F.lit("x"))
    return df
