"""Awkward documents that every operator must take: nulls, empty and very long texts, repeats, clashing columns."""

WORDS = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potent brews under a pale moon".split()
AWKWARD = [
    (1, None, None, "a", 0), (2, "", "en", None, 0), (3, "   \n\t ", "en", "a", 1), (4, "one two", "en", "a", 2), (4, "one two", "en", "a", 2),
    (None, "no id here but words", "en", "a", 3), (5, " ".join(WORDS * 800), "en", "a", 4), (6, "x" * 50_000, None, "a", 5),
    (7, "é̂ 🙂 日本語 ß İ \x00 \x1f end", "fr", "a", 6), (8, " ".join(WORDS), "en", "a", 7), (9, " ".join(WORDS).upper(), "en", "a", 8),
    (10, "9" * 3_000 + " " + "1 " * 3_000, "en", "a", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    """The awkward rows, with extra columns named like the operators' own."""
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    for name in ("_text", "_row", "key", "token", "spans", "rules", "n", "uid", "word", "label", "score"):
        df = df.selectExpr("*", f"'{name}' AS {name}")
    return df.repartition(3)


def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)
