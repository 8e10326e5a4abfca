"""Small tables and brute-force versions."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(texts, source="s"):
    return [(i, t, "en", source if isinstance(source, str) else source[i], None if t is None else len(t)) for i, t in enumerate(texts)]


def messy(spark, seed=0, n=40):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and columns whose names the
    operators use themselves."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(n)]
    texts += [None, "", " \t\n ", "one", "one two three four", "ünï cödé 漢字 \U0001f600 end", " ".join(rng.choices(words, k=30_000)), "x" * 100_000]
    out = [(i, t, rng.choice(["en", None]), rng.choice(["a", "b", None]), None if t is None else len(t), 7, "k") for i, t in enumerate(texts)]
    out += [out[0], out[0], (None, texts[1], "en", "a", 1, 7, "k"), (None, None, None, None, None, None, None)]
    extra = ", key long, node string"
    return spark.createDataFrame(out, SCHEMA + extra)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return (text or "").encode().split()
