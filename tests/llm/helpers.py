"""Small tables with every awkward row the operators must define a result for."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words=None):
    words = words or ["the", "river", "stone", "walks", "under", "green", "old", "bridges", "while",
                      "children", "sing", "about", "winter", "and", "bread", "quiet", "harbour", "lamps"]
    return " ".join(rng.choice(words) for _ in range(n))


def awkward(seed=0):
    """Nulls, empty and blank texts, repeated rows, ties, one long text, copies
    that differ in white space, shared passages, rare characters."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    passage = prose(rng, 40)
    rows = [
        (0, base, "en", "a", None), (1, base.replace(" ", "  "), "en", "a", 1),
        (2, base.replace(" ", "\n"), None, None, 1), (3, None, "en", "b", 1), (4, "", "en", "b", 1),
        (5, " \t\n", None, "b", 1), (6, "123 456 !!", "en", "b", 1), (7, "word", "en", "c", 1),
        (7, "word", "en", "c", 1), (8, prose(rng, 4000), "en", "c", 1),
        (9, "日本語 テキスト 😀 the river   x", "en", "c", 1), (None, "no id at all here", "en", "c", 1),
        (None, None, None, None, None), (10, "aaaaaaaa" * 60, "en", "d", 1), (11, "aaaaaaaa" * 60, "en", "d", 1),
        (12, "tail space ", "en", "d", 1), (13, "<|endoftext|> in a text", "en", "d", 1),
        (14, "two  spaces and\ttabs \n here", "en", "d", 1),
    ]
    for i in range(20, 32):
        near = base.split()
        near[rng.randrange(len(near))] = f"w{i}"
        rows.append((i, " ".join(near), "en", "e", 1))
    for i in range(40, 52):
        rows.append((i, prose(rng, 30) + " " + passage + " " + prose(rng, 30), "en", "f", 1))
    rng.shuffle(rows)
    return rows


def frame(spark, rows, partitions=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(spark, rows, *names):
    """The table with extra columns called like the operator's own results."""
    from pyspark.sql import functions as F

    out = frame(spark, rows)
    for i, name in enumerate(names):
        out = out.withColumn(name, F.lit(i))
    return out
