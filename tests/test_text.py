from pyspark.sql import functions as F

from termite.functions import constants as K
from termite.functions import text as tx
from termite.functions.stemming import porter_stem, s_stem


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("o")).first()["o"]


def test_stop_words_include_spark_lists_and_single_characters():
    sw = set(K.stop_words())
    assert {"the", "and", "le", "des", "a", "z", "0", "9", "été"} <= sw
    assert "oil" not in sw


def test_normalise_drops_punctuation_stopwords_and_stems(spark):
    out = one(spark, tx.normalise, "The oil-prices, and Courses? (a) of companies")
    # punctuation deleted (not split), S-stemmer, stop words after stemming
    assert out == ["oilprice", "course", "company"]


def test_query_punctuation_is_removed(spark):
    # ledger D17: "?" and "," never become terms
    assert one(spark, tx.normalise, "data, structures?") == ["data", "structure"]


def test_s_stemmer_rules(spark):
    df = spark.createDataFrame([(w,) for w in ["queries", "aies", "goes", "cats", "bus", "glass", "is"]], "w string")
    got = [r[0] for r in df.select(s_stem(F.col("w"))).collect()]
    assert got == ["query", "aie", "goe", "cat", "bus", "glass", "i"]


def test_jaccard_example(spark):
    a = "AI is our friend and it has been friendly"
    b = "AI and humans have always been friendly"
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert abs(df.select(tx.set_jaccard("a", "b")).first()[0] - 1 / 3) < 1e-12


def test_count_term_in_null_list_is_zero(spark):
    df = spark.createDataFrame([(None,), (["x", "y", "x"],)], "t array<string>")
    assert [r[0] for r in df.select(tx.count_term_in_list("t", F.lit("x"))).collect()] == [0, 2]


def test_collapse_whitespace_handles_nbsp(spark):
    assert one(spark, tx.collapse_whitespace, " csi 2110  data\n structures ") == "csi 2110 data structures"


def test_levenshtein_counts_code_points(spark):
    df = spark.createDataFrame([("été", "ete")], "a string, b string")
    assert df.select(tx.edit_distance("a", "b")).first()[0] == 2


def test_porter_examples():
    cases = {"caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre",
             "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat",
             "hopping": "hop", "filing": "file", "happy": "happi", "relational": "relat",
             "generalization": "gener", "electrical": "electr", "adjustment": "adjust",
             "adoption": "adopt", "controll": "control", "rate": "rate"}
    for word, stem in cases.items():
        assert porter_stem(word) == stem, word
