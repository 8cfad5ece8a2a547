"""Documents with nulls, blanks, ties, repeats, long texts and clashing column names."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 97}x{i}" for i in range(6000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again until night falls."),
    (2, "The quick brown fox jumps over the lazy dog again and again until night falls."),
    (2, "The quick brown fox jumps over the lazy dog again and again until night falls."),
    (3, ""),
    (4, None),
    (None, "A text without a number."),
    (5, " \t\n "),
    (6, "one"),
    (7, LONG),
    (8, "12345 !!! 678"),
    (9, "  doubled  spaces and\nlines \n here too, café naïve \U0001f600 ok"),
    (-3, "Grüße aus München, übermorgen wird es schön."),
]
TAKEN = ["slot", "shard", "grown_shard", "secrets", "score", "lang_pred", "key", "value", "start", "print"]


def documents(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    full = df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    return full.withColumns({c: F.lit("taken") for c in TAKEN})


def empty(spark):
    return documents(spark).limit(0)
