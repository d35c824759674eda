"""Documents with every awkward case: NULLs, empty and very long texts, ties,
repeated rows, and columns whose names clash with the operators' own."""

from pyspark.sql import functions as F

REPEATED = "one text that stands here more than once, word for word the same"
LONG = "lorem ipsum dolor " * 40_000
ROWS = [
    (None, "a text without an id but with words", "en"),
    (1, None, "en"),
    (2, "", None),
    (3, " \n\t ", "en"),
    (4, "!!! 123 --- $$$", "en"),
    (5, REPEATED, "en"),
    (5, REPEATED, "en"),
    (6, REPEATED, "en"),
    (7, LONG, "fr"),
    (8, "x" * 120_000, "fr"),
    (9, "日本語 のテキスト 😀 é ñ ▁", None),
    (10, "short", "en"),
]
SCHEMA = "doc_id long, text string, lang string"
CLASHES = ("row", "h", "key", "score", "rank", "term", "n", "piece", "length", "ids", "word", "at", "spans", "label")


def documents(spark, rows=None):
    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    df = df.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit("clash") for c in _new_columns(df)})


def _new_columns(df):
    return [c for c in CLASHES if c not in df.columns]


def empty(spark):
    return documents(spark, [])
