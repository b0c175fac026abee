"""Small tables with nulls, empty and long texts, repeated rows and clashing columns."""

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [
    (0, "The quick brown fox jumps over the lazy dog and runs away.", "a"), (1, None, "a"), (2, "", "b"), (3, " \t\n ", None),
    (4, "The quick  brown fox jumps over\tthe lazy dog and runs away.", "b"), (5, LONG, "c"), (6, LONG + " tail", "c"),
    (7, "one two", None), (8, "One TWO", "a"), (None, "The quick brown fox jumps over the lazy dog and runs away.", "b"), (None, None, None),
    (9, "Ünïcödé Straße İ ΣΑΣ 漢字 <|endoftext|> it's we'll 123 ½ ﬁ", "d"), (9, "Ünïcödé Straße İ ΣΑΣ 漢字 <|endoftext|> it's we'll 123 ½ ﬁ", "d"),
    (10, "licensed under CC BY-NC 4.0. All rights reserved, all RIGHTS reserved", "e"), (11, "released under the MIT\nlicense", "e"),
]
CLASH = ("kept", "keep_id", "group_size", "digest", "size", "target", "taken", "score", "label", "c", "n", "k", "key", "home", "s", "g", "rank", "cell", "v", "host", "rule", "draw", "shard")


def docs(spark, rows=ROWS):
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, source string, n_chars long")
    for i, name in enumerate(CLASH):
        df = df.selectExpr("*", f"{i} AS {name}")
    return df


def empty(spark):
    return docs(spark).where("false")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
