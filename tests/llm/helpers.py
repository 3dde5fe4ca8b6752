"""Small tables with the cases that every operator must stand."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("row", "size", "key", "r1", "k1", "part", "shard", "score", "group", "bucket", "cid", "count", "a.b")

LONG = "needle " + " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))

CASES = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "s1", 0),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "s1", 0),   # a repeated row
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "de", "s2", 0),   # a copy
    (3, None, "en", "s1", None),
    (4, "", None, None, 0),
    (None, "a text without an id, long enough to have five words", "en", None, 0),
    (None, None, None, None, None),
    (5, " \t\n ", "fr", "s2", 4),
    (6, "word", "fr", "", 4),
    (7, "!!! ... ---", "es", "s3", 11),
    (8, LONG, "es", "s1", len(LONG)),
    (9, "ünïcode ÉTÉ \U0001f600 \x00 naïve", "fr", "s3", 20),
]


def documents(spark, rows=CASES):
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The same rows with more columns, whose names operators may use themselves."""
    from pyspark.sql import functions as F
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))


def plain(df, *columns):
    """Rows as sorted tuples."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))

