"""Small tables for the corpus operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that carry names the operators use inside.
CLASH = ("row string, id string, key string, digest string, kept string, score string, vertex string, root string, "
         "lines string, host string, n_hit string, token_ids string")


def docs(spark, rows):
    """Documents from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(f"x-{c.split()[0]}").alias(c.split()[0]) for c in CLASH.split(", ")])


def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names."""
    words = " ".join(f"w{i % 997}" for i in range(60_000))
    return with_clashes(docs(spark, [
        (1, None), (2, ""), (None, "a null id with five words here"), (None, None), (3, " \t\n "),
        (4, "one two"), (5, "one two"), (5, "one two"), (6, words), (7, words), (8, "x" * 300_000),
        (9, "Ein größerer Text mit ümläuten und 漢字 dazu 🎉"), (9, "another text under one id, of six words")]))


def prose(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    parts = ["ther", "ing", "tion", "and", "er", "es", "on", "le", "que", "sch"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)]


def families(seed: int, groups: int, copies: int, length: int = 90, unrelated: int = 30) -> list[str]:
    """Texts with copies of a base that differ in up to a few words, and
    unrelated texts."""
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = prose(seed * 1000 + g, length)
        for _ in range(copies):
            words = list(base)
            for _ in range(r.randint(0, 3)):
                words[r.randrange(length)] = "changed" + str(r.randrange(10_000))
            out.append(" ".join(words))
    out += [" ".join(prose(seed * 77 + k, r.randint(3, length))) for k in range(unrelated)]
    r.shuffle(out)
    return out
