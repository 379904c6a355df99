"""Small tables for the operators' tests."""

import numpy as np

EMPTY = "doc_id long, text string"
WORDS = [f"{a}{b}" for a in "ba de ki lo mar nel or pa ri sa".split() for b in "ten vu wes ya zo lin gra".split()]


def prose(seed, n):
    draw = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in draw.integers(0, len(WORDS), n))


def documents(spark, rows):
    return spark.createDataFrame(rows, EMPTY)


def with_clashes(df):
    """The same rows with columns named as the operators name theirs inside."""
    from pyspark.sql import functions as F

    names = "a b id hash key row n n_lines n_dropped keep_runs copy score fingerprint text_key starts surrogate"
    return df.select("*", *(F.lit(k).alias(name) for k, name in enumerate(names.split())))


def joined(pairs, members):
    """The smallest member each one reaches."""
    above = {m: m for m in members}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        above[b] = a
    return {m: top(m) for m in members}
