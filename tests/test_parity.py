"""The column expressions and the oracle SQL fragments agree on random text
drawn from the characters of the driver tables, and the size-checked
broadcast takes both branches."""

import random
import string

import duckdb
from pyspark.sql import functions as F

from termite.functions import text as tx
from termite.plans import oracle_sql as S
from termite.plans.sizing import broadcast_if_small

ALPHABET = (string.ascii_letters + string.digits + string.punctuation + "  \n\t "
            + "èéñßêçíüöóä" + "ÈÉÑÊÇÍÜÖÓÄ")


def _texts(n=300, seed=13):
    rng = random.Random(seed)
    words = ["the", "queries", "goes", "bus", "glass", "oil-price", "l'été", "aies", "es", "s"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 25)):
            if rng.random() < 0.3:
                parts.append(rng.choice(words))
            else:
                parts.append("".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 9))))
        out.append(rng.choice([" ", "  ", "\n", " "]).join(parts))
    return out


def test_normalisation_matches_sql(spark):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: list(r.t) for r in df.select("id", tx.normalise(F.col("text")).alias("t")).collect()}
    big = {r.id: list(r.t) for r in df.select(
        "id", tx.normalise_for_bigrams(F.col("text")).alias("t")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE docs (id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO docs VALUES (?, ?)", list(enumerate(texts)))
    want = dict(con.execute(f"SELECT id, {S.normalise('text')} FROM docs").fetchall())
    want_big = dict(con.execute(f"SELECT id, {S.normalise_for_bigrams('text')} FROM docs").fetchall())
    assert got == want
    assert big == want_big


def test_broadcast_only_below_the_limit(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    joined_small = big.join(broadcast_if_small(small, max_bytes=800), "k")
    assert "BroadcastHashJoin" in plan(joined_small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined_big = small.join(broadcast_if_small(big, max_bytes=800), "k")
        assert "BroadcastHashJoin" not in plan(joined_big)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert joined_small.count() == 10 and joined_big.count() == 10


def test_codepoint_levenshtein_in_sql_matches_spark(spark):
    rng = random.Random(21)
    letters = string.ascii_lowercase[:8] + string.digits[:3] + "èéñßêçíüöóä"
    pairs = [("".join(rng.choice(letters) for _ in range(rng.randint(0, 9))),
              "".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))) for _ in range(400)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id long, a string, b string")
    got = {r.id: r.d for r in df.select("id", tx.edit_distance("a", "b").alias("d")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE p (id BIGINT, a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    want = dict(con.execute(f"SELECT id, {S.lev('a', 'b')} FROM p").fetchall())
    assert got == want
