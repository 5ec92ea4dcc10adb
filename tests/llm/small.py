"""Small tables with every odd case, for all operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
# Names that the operators use for columns of their own.
CLASHING = ("chunk", "bucket", "n_words", "size", "kept", "score", "host", "v", "row", "win", "key",
            "__id", "__hash", "__keep", "__key", "__slice", "__cut")


def prose(seed: int, n: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def odd_documents() -> list[tuple]:
    """Nulls in each column, empty, white and very long texts, repeated rows."""
    long = " ".join(f"l{i % 4999}x{i % 7}" for i in range(30_000))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", "de", None, 4), (None, "no id here at all", "en", "a", 17),
        (4, prose(1, 60), None, "b", 5), (4, prose(1, 60), None, "b", 5), (5, long, "en", "a", len(long)),
        (6, "Ünï cödé word", "fr", "c", 1), (7, "one", "en", None, 3), (None, None, None, None, None),
        (8, prose(2, 60) + "\n" + prose(3, 30), "de", "b", 9), (9, prose(2, 60) + "\n" + prose(3, 30), "de", "c", 9)]
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING) if c not in df.columns])


def tuples(df, *cols):
    """All rows, sorted, nulls included."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
