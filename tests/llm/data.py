"""Awkward documents that every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score long, n_words string"
LONG = "long words and more of them stand here in a row that never seems to end " * 3000
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def awkward():
    base = " ".join(WORDS * 3)
    texts = [None, "", " \n\t ", "one", "!!! ???", base, base, base.upper(), base + " more", LONG, "naïve café ▁ 中文 😀\x00 x", base.replace("mu", "my"), "\n\n" + base + "\n" + base]
    rows = [(i, t, None if i % 3 else "en", None, None, 7, "clash") for i, t in enumerate(texts)]
    return [*rows, (5, base, "en", "s", 1, 7, "clash"), (None, base, "de", None, None, 7, "clash")]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
