"""Small tables with the cases every operator has to take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cell long, fp string, hash string, n int"


def table(spark, texts, first_id=0):
    """``documents`` with the given texts (or ``(id, text)`` pairs) and extra columns that
    are named like the operators' own."""
    pairs = [t if isinstance(t, tuple) else (first_id + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", None, None, 1, "x", "y", 2) for i, t in pairs], SCHEMA)


def prose(words, seed=0):
    """So many different invented words."""
    return " ".join(f"w{seed}x{i * 7919 % 10007}" for i in range(words))


LONG = prose(30_000)
ODD = [
    None, "", " \t\n", "one", "One", "one", "ONE two", "é É ß 日本語 ▁ ▁x", "a\x00b", LONG, LONG.upper(),
    "same text here", "same text here", "same text here", "!!! 123", "x" * 5000, "line\n\nline\n line \r\nlast\n",
]


def by_id(frame, key="doc_id"):
    return {r[key]: r.asDict(recursive=True) for r in frame.collect()}
