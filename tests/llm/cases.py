"""Awkward inputs that every operator must take."""

from pyspark.sql import types as T

LONG = ("lorem ipsum dolor sit amet " * 9000) + "end"

DOCS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf today", "en", "src0", 85),
    (2, None, "en", "src0", None),
    (3, "", None, "src1", 0),
    (4, " \t\n \x0b ", "fr", None, 6),
    (5, LONG, "en", "src1", len(LONG)),
    (6, "Le renard brun saute par-dessus le chien paresseux près de la forêt <|endoftext|> fin", "fr", "src2", 80),
    (6, "Le renard brun saute par-dessus le chien paresseux près de la forêt <|endoftext|> fin", "fr", "src2", 80),
    (7, "1234 5678 !!! ???", "en", "src0", 17),
    (8, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf today", "en", "src0", 85),
    (9, "日本語のテキスト Ünïcödé \x00 İstanbul it's DON'T \x1c x", "en", "src0", 30),
    (None, "A document without an id but with words enough to count as one", "en", "src0", 50),
]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def docs(spark, rows=None):
    return spark.createDataFrame(DOCS if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crowded(df):
    """Columns with names that the operators use themselves."""
    from pyspark.sql import functions as F
    for name in ("id", "n_words", "spans", "items", "ids", "score", "kept", "key", "node", "tokens", "word", "n",
                 "lang_pred", "text_score", "n_tokens", "decoded", "path", "candidate", "unit", "start", "end", "y"):
        df = df.withColumn(name, F.lit("clash"))
    return df
