"""Small tables that hold the awkward cases."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns that operators might use inside, with other contents
CLASHING = ["n", "key", "size", "slot", "part", "component", "node", "a", "b", "text_hash", "first", "round", "features", "label"]


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def awkward_docs():
    rng = random.Random(3)
    base = words(rng, 120)
    near = list(base)
    near[60] = "changed"
    long_text = " ".join(words(rng, 12_000, 5000))
    rows = [
        (1, " ".join(base), "en", "s1", 1), (2, " ".join(base), "en", "s1", 1), (3, " ".join(near), "en", "s2", 1),
        (4, None, "en", "s1", None), (5, "", None, None, 0), (6, " \n\t ", "de", "s2", 4), (7, "one", "en", "s3", 3),
        (8, "one two", "fr", None, 7), (9, "ONE Two", "fr", "s3", 7), (10, long_text, "en", "s1", 9), (11, long_text, "en", "s1", 9),
        (12, "12 34 !! ??", "es", "s2", 5), (12, "12 34 !! ??", "es", "s2", 5), (None, "no id at all here", "en", "s1", 3),
    ]
    for i in range(20, 50):
        w = words(rng, 90)
        rows.append((i, " ".join(w), "de", f"s{i % 4}", 3))
    return rows


def docs_frame(spark, rows=None, clash=True):
    df = spark.createDataFrame(awkward_docs() if rows is None else rows, DOCS)
    if clash:
        for c in CLASHING:
            df = df.withColumn(c, F.lit("x"))
    return df.repartition(3)
