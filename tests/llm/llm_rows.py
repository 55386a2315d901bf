"""Small tables for the tests of the operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHES = ["digest", "length", "rank", "part", "shard", "key", "rep", "component", "features", "raw", "held", "of", "rest"]


def table(spark, rows, clash=False):
    """Documents of (doc_id, text) pairs, in several partitions; with columns of clashing names if asked."""
    frame = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], SCHEMA).repartition(3)
    return frame.selectExpr("*", *(f"concat('{c}', doc_id) AS {c}" for c in CLASHES)) if clash else frame


def prose(seed, n, vocabulary=400):
    """n words of an invented vocabulary, the first ones far commoner."""
    rng = random.Random(seed)
    words = ["".join(random.Random(i).choice("abdeghinorstué") for _ in range(2 + i % 9)) for i in range(vocabulary)]
    return " ".join(words[min(int(rng.expovariate(0.02)), vocabulary - 1)] for _ in range(n))


def odd_rows():
    """Nulls, empty texts, white space, copies, a repeated row, a repeated doc_id, a missing one, a long text."""
    long = prose(99, 30_000)
    return [(1, None), (2, ""), (3, " \n\t "), (4, prose(1, 120)), (5, prose(1, 120)), (5, prose(1, 120)), (6, prose(2, 90)),
            (6, prose(3, 80)), (None, prose(1, 120)), (None, prose(4, 50)), (7, long), (8, long), (9, "é\x00 日本\x85語 <|endoftext|>"),
            (10, "One two three."), (11, "one TWO three."), (12, "word " * 400)]


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
