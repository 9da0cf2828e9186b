"""What the tests of the corpus operators share."""

import public_tokenizers
from pyspark.sql import types as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
# Extra columns whose names the operators also use inside.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("line", T.StringType()),
    T.StructField("host", T.StringType()), T.StructField("key", T.StringType()), T.StructField("words", T.StringType()),
    T.StructField("component", T.LongType()), T.StructField("bucket", T.LongType()),
])


def documents(spark, rows, partitions=3):
    """Documents from (doc_id, text[, source]) tuples."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "x", "x", "x", 1, 1) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(partitions)


def prose(n, seed=0, vocabulary=5000):
    import random

    chosen = random.Random(seed)
    return " ".join(f"w{chosen.randrange(vocabulary)}" for _ in range(n))


#: Rows that every operator has to stand: nulls, blanks, ties, repeated rows, long and odd texts.
ODD = [
    (None, "text without an id, twice"), (None, "text without an id, twice"), (1, None), (2, ""), (3, " \n\t "), (4, "one"),
    (5, prose(300)), (5, prose(300)), (5, "another text under the same id"), (6, prose(300)), (7, "a " * 20000),
    (8, "x" * 50000), (9, prose(9000, 3)), (10, "日本語 😀 \x85 \x1c ok<|endoftext|>end  two  spaces \n\n"), (-4, "negative id"), (1 << 60, "été " * 30),
]
