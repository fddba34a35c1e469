"""Small fixtures with nulls, empty and long texts, ties, repeated rows and extra columns."""

import random

DDL = "doc_id long, text string, lang string, source string, n_chars long"
EMPTY = DDL


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def corpus(seed=3, n=60):
    """Rows (doc_id, text, lang, source, n_chars) with the odd cases among them."""
    rng = random.Random(seed)
    vocabulary = {"en": ["the", "of", "and", "river", "stone", "light", "walks", "under", "Over", "house"], "fr": ["le", "été", "où", "garçon", "mange", "très", "la", "forêt", "Noël", "jardin"]}
    rows = []
    for i in range(n):
        lang = "en" if i % 3 else "fr"
        text = "\n".join(sentence(rng, vocabulary[lang], rng.randint(3, 40)) + "." for _ in range(rng.randint(1, 5)))
        rows.append((i, text, lang, f"s{i % 4}", len(text)))
    base = rows[5][1]
    rows += [
        (1000, None, None, None, None),
        (1001, "", "en", "s0", 0),
        (1002, " \t\n\x0b\x0c\r ", "en", "s1", 7),
        (1003, "One", "en", "s1", 3),
        (1004, "12 !? 34", None, "s9", 8),
        (None, base, "en", None, len(base)),
        (1005, base, "en", "s2", len(base)),
        (1005, base, "en", "s2", len(base)),
        (1006, base.replace(" ", "  "), "en", "s2", None),
        (1007, "a b c  d \U0001f600 e\x1cf", "en", "s3", 12),
        (1008, sentence(rng, vocabulary["en"], 6000), "en", "s3", 1),
        (1009, "x y z " * 40, "en", "s3", 1),
        (-7, "the river | the stone | the light | over | under", "en", "s0", 2),
    ]
    return rows


def frame(spark, rows=None, extra=True):
    """The rows as a table, with columns whose names the operators use themselves."""
    table = spark.createDataFrame(corpus() if rows is None else rows, DDL)
    if extra:
        from pyspark.sql import functions as F

        for name in ("size", "shard", "fp", "t", "score", "h", "id", "row", "n_words", "__bucket", "word"):
            table = table.withColumn(name, F.lit(name))
    return table


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
