from pyspark.sql import functions as F

from termite.functions import text as tx
from termite.operators import index as ix
from termite.operators import topics as tp
from termite.operators.features import feature_counts
from termite.sources import corpus as cp
from termite.sources import sinks as sk


def page(lang, title, body):
    return (f'<!DOCTYPE html><html lang="{lang}"><head><title>{title}</title>'
            f'<script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">X</a></li></ul></nav>'
            f'<!-- ad --><article><h1>{title}</h1>{body}</article></body></html>')


def test_catalog_ids_consumed_by_blocks_without_description(spark):
    # ledger D5: a header-matching course without a description keeps its id
    pages = spark.createDataFrame([
        (1, "http://a.example.com/en/2110", page("en", "Data Structures (3 units)", "")),
        (2, "http://a.example.com/en/2510", page("en", "Databases", "<p>Tables &amp; queries.</p>")),
        (3, "http://a.example.com/fr/2511", page("fr", "Bases", "<p>Tables.</p>")),
        (4, "http://a.example.com/en/intro", page("en", "No code", "<p>x</p>")),
    ], "page_id long, url string, html string")
    rows = [tuple(r) for r in cp.extract_catalog(pages).collect()]
    assert rows == [(1, 2, "2510", "databases", "Tables & queries.")]
    names = {r.page_id: r.name for r in cp.filter_header(cp.catalog_blocks(pages)).collect()}
    assert names == {1: "data structures", 2: "databases"}  # parenthesised part removed


def test_records_without_body_stay_aligned(spark):
    # ledger D13: the first record has no body; the others keep their own fields
    sgml = ("<reuters><topics><d>Grain</d><d>Corn</d></topics><title>Corn 1987 up!</title></reuters>"
            "<reuters><topics></topics><title>Oil</title><body>Oil-price: 12 up.</body></reuters>")
    files = spark.createDataFrame([("f1", sgml)], "path string, value string")
    got = [tuple(r) for r in cp.extract_records(files).orderBy("rec_pos").collect()]
    assert got == [("f1", 0, ["grain", "corn"], "corn  up", None),
                   ("f1", 1, None, "oil", "oil price  up ")]
    pos = [tuple(r) for r in cp.extract_positional(files).collect()]
    assert pos == [("f1", 0, "Corn 1987 up!", "Oil-price: 12 up.")]  # zipped by position (D13 variant)


def test_three_topic_document_explodes(spark):
    # ledger D6: a document with three topics between two with one each
    news = spark.createDataFrame([
        (1, ["a"], "n1", "d1"), (2, ["t1", "t2", "t3"], "n2", "d2"), (3, ["b"], "n3", "d3"),
    ], "doc_id long, topics array<string>, name string, description string")
    rows = [tuple(r) for r in tp.explode_topics(news).orderBy("doc_id", "topic").collect()]
    assert rows == [(1, "a"), (2, "t1"), (2, "t2"), (2, "t3"), (3, "b")]
    cs = tp.classification_sets(news, stemmer=None).where("doc_id = 2").collect()
    assert len(cs) == 3 and all(r.tokens == ["d2", "n2"] for r in cs)  # tokens kept


def test_fields_joined_with_a_space(spark):
    # ledger D9: border words do not fuse
    df = spark.createDataFrame([("data", "structures and")], "name string, description string")
    assert df.select(tx.concat_fields("name", "description")).first()[0] == "data structures and"


def test_term_named_topic_has_no_clash(spark):
    # ledger D14: long form keeps a term literally named "topic"
    toks = spark.createDataFrame([(1, 0, "topic"), (1, 1, "topic"), (2, 0, "oil")],
                                 "doc_id long, pos long, term string")
    top = spark.createDataFrame([("topic",), ("oil",)], "term string")
    got = {(r.doc_id, r.term): r.cnt for r in feature_counts(toks, top).collect()}
    assert got == {(1, "topic"): 2, (2, "oil"): 1}


def test_csv_round_trip_null_tokens(spark):
    # ledger D8: an empty token list travels as -1 and comes back as NULL
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "doc_id long, tokens array<string>")
    back = {r.doc_id: r.tokens for r in sk.csv_round_trip(spark, df, "t", ("tokens",)).collect()}
    assert back == {1: ["a", "b"], 2: None}


def test_parquet_and_json_round_trips(spark):
    df = spark.createDataFrame([(1, "x", 0.5)], "a long, b string, c double")
    assert sk.parquet_round_trip(spark, df, "p").collect() == df.collect()
    assert sk.json_round_trip(spark, df, "j").collect() == df.collect()


def test_unclosed_elements_are_neither_lost_nor_merged(spark):
    page = ("<html><title>One<article><p>first<p>second</p>rest<P class=x>third</article>"
            "<html><title>Two</title><article>last, never closed")
    files = spark.createDataFrame([("f", page)], "path string, value string")
    recs = [tuple(r) for r in cp.extract_records(files, **cp.PAGE_RECORDS).orderBy("rec_pos").collect()]
    assert [(r[1], r[4]) for r in recs] == [(0, "first second rest third"), (1, "last never closed")]
    paras = files.select(cp.elements(F.col("value"), "p").alias("p")).first().p
    assert [x.split("<")[0] for x in paras] == ["first", "second", "third"]


def test_text_files_by_glob(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part-{i}.sgm").write_text(f"<reuters><title>t{i}</title>\n<body>body {i}</body>")
    (tmp_path / "other.txt").write_text("<reuters><title>no</title></reuters>")
    got = cp.extract_records(cp.read_text_files(spark, f"{tmp_path}/part-*.sgm"))
    assert got.count() == 3 and {r.description for r in got.collect()} == {"body "}


def block(header, description=None, cls="courseblock"):
    text = "" if description is None else f'<p class="courseblockdesc noindent">{description}</p>'
    return f'<div class="{cls}"><p class="courseblocktitle"><strong>{header}</strong></p>{text}</div>'


def test_pages_with_any_number_of_course_blocks(spark):
    many = (block("CSI&nbsp;2110 Data Structures (3 units)", "Trees &amp; <b>graphs</b>.") + block("CSI&#160;2510 Bases", "French.")
            + block("csi&nbsp;3120 Languages") + block("CSI 4110 plain space", "no") + block("ABCD&nbsp;2110 long subject", "no")
            + block("<em>SEG</em>&nbsp;2|10  Odd   digit (a) b", "<script>x</script> kept ", "courseblock last")
            + block("CSI&nbsp;4900 Project", "") + '<div class="courseblocks"><strong>CSI&nbsp;2111 no block</strong></div>')
    pages = spark.createDataFrame([
        (7, "<html><p>no block</p></html>"), (3, block("MAT 1300 One", "Only.")), (5, f"<body>{many}</body>"), (9, None)],
        "page_id long, html string")
    headers = [tuple(r)[:4] for r in cp.filter_course_header(cp.course_blocks(pages)).orderBy("page_id", "block_pos").collect()]
    assert headers == [(3, 0, "mat 1300", "one"), (5, 0, "csi 2110", "data structures"), (5, 2, "csi 3120", "languages"),
                       (5, 5, "seg 2|10", "odd digit b"), (5, 6, "csi 4900", "project")]
    got = [tuple(r) for r in cp.extract_course_blocks(pages).orderBy("doc_id").collect()]
    # The block without a description (id 2) uses up its id; an empty one is a description.
    assert got == [(0, 3, 0, "mat 1300", "one", "Only."), (1, 5, 0, "csi 2110", "data structures", "Trees & graphs ."),
                   (3, 5, 5, "seg 2|10", "odd digit b", "kept"), (4, 5, 6, "csi 4900", "project", "")]


def test_a_large_tagged_file_is_read_in_splits(spark, tmp_path):
    body = "".join(f"<REUTERS ID={i}><TITLE>t{i}</TITLE>\n<BODY>{'x' * (i % 50)} café</BODY>\n</REUTERS>\n" for i in range(600))
    (tmp_path / "a.sgm").write_bytes(b"<!DOCTYPE lewis>\n" + body.encode() + b"<REUTERS><TITLE>open</TITLE>")
    (tmp_path / "b.sgm").write_bytes(b"<REUTERS><TITLE>bad \xff\xfe bytes</TITLE></REUTERS>\n<REUTERS>x<REUTERS>y</REUTERS>")
    (tmp_path / "c.txt").write_bytes(b"<REUTERS>not read</REUTERS>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        pieces = cp.read_tagged_files(spark, f"{tmp_path}/*.sgm", "</REUTERS>")
        assert pieces.rdd.getNumPartitions() > 8
        recs = cp.number_records(pieces, "reuters").orderBy("file", "rec_pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    a = [r for r in recs if r.file.endswith("a.sgm")]
    assert [r.rec_pos for r in a] == list(range(601))
    assert [r.rec.split("</TITLE>")[0] for r in a] == [f"<TITLE>t{i}" for i in range(600)] + ["<TITLE>open"]
    assert "café" in a[0].rec
    assert [(r.rec_pos, r.rec) for r in recs if r.file.endswith("b.sgm")] == [(0, "<TITLE>bad  bytes</TITLE>"), (1, "x"), (2, "y")]
