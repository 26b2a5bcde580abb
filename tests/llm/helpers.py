"""Small corpora with the awkward cases that every operator must take."""

import random

#: Columns whose names operators use inside.
CLASHING = ["row", "ids", "score", "uid", "key", "part", "words"]


def prose(seed: int, n: int, alphabet: str = "abcdefghij é") -> str:
    rnd = random.Random(seed)
    return "".join(rnd.choice(alphabet) for _ in range(n))


def sentences(seed: int, n_words: int, vocabulary: int = 300) -> str:
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n_words))


def awkward() -> list[tuple]:
    """(doc_id, text): null, empty, blank, very long, repeated rows, copies."""
    same = sentences(1, 80)
    return [(1, None), (2, ""), (3, " \t\n\x0b "), (4, sentences(2, 9000)), (5, same), (5, same), (6, same.upper()), (7, "one"), (8, "zwei é"),
            (9, "x" * 5000), (None, "no id " + sentences(3, 40)), (10, sentences(4, 60))]


def documents(spark, rows, clashing: bool = False):
    df = spark.createDataFrame([(*r, "en", "src", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(c) for c in CLASHING})
    return df
