"""Small documents with everything that goes wrong: nulls, blanks, repeated rows, ties, long texts, clashing columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ODD = [
    (1, "alpha beta gamma delta", "en", "a", 22),
    (2, "alpha  beta\tgamma delta\n", "en", "a", 24),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n\r\x0b\x0c", "en", "b", 6),
    (6, "Alpha beta gamma delta", "en", "c", 22),
    (7, LONG, "en", "a", len(LONG)),
    (8, LONG + " ", "en", "a", len(LONG) + 1),
    (9, LONG[:-1], "en", "a", len(LONG) - 1),
    (10, "x", "en", "a", 1),
    (11, "x", "en", "a", 1),
    (11, "x", "en", "a", 1),
    (None, "x", "en", "a", 1),
    (None, None, "en", None, 0),
    (12, "un café ﬁn 日本語 <|endoftext|> 🙂 <s>   é", "fr", "z", 40),
    (13, "a b", "en", "a", 3),
    (14, "'s don't 123  456 \n\n  x", "en", "a", 24),
]


def odd(spark):
    """The odd rows, with extra columns named like what operators make."""
    rows = [(*r, "extra", 1, "y") for r in ODD]
    return spark.createDataFrame(rows, SCHEMA + ", kept string, shard int, fp string").repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
