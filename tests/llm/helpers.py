"""Small tables for the training-data operators: odd rows, no rows, clashing column names."""

import random
import re

DDL = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASHES = ("kept", "size", "ids", "n_words", "key", "label", "path", "set_id", "rate", "f", "w", "score", "target", "b", "t")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))


def odd_rows():
    return [(0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t ", None, "a"), (3, "one", "de", None), (4, LONG, "en", "b"),
            (5, "a b c d e f g h " * 10, "fr", "b"), (6, "same text here with words", "en", "a"),
            (6, "same text here with words", "en", "a"), (7, "same text here with words", None, None),
            (None, "no id on this row at all", "en", "a"), (8, "été \U0001f600 naïve \x00 x", "fr", "c"),
            (9, "x" * 5000, "en", ""), (10, "%%% ### $$$ " * 30, "en", "a")]


def table(spark, rows, clash=True):
    df = spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows], DDL)
    return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHES]) if clash else df


def empty(spark):
    return table(spark, [])


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(n, seed=1, vocabulary=400):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(vocabulary)]
    return [" ".join(r.choice(vocab) for _ in range(r.randint(3, 120))) for _ in range(n)]


def by_id(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
