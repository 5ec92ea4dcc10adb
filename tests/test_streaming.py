import json
import os
import tempfile

from termite.operators import index as ix
from termite.operators import ranking as rk
from termite.streaming.search_stream import start_search_stream


def test_stream_matches_batch(spark):
    docs = spark.createDataFrame([(1, "oil price rises"), (2, "corn price"), (3, "oil oil")],
                                 "doc_id long, text string")
    idx = ix.build_index(docs, stemmer=None)
    qdir = tempfile.mkdtemp(prefix="termite-q-")
    out = os.path.join(tempfile.mkdtemp(prefix="termite-r-"), "results")
    with open(os.path.join(qdir, "q1.json"), "w") as f:
        f.write(json.dumps({"query_id": 1, "text": "oil"}) + "\n")
        f.write(json.dumps({"query_id": 2, "text": "corn price"}) + "\n")
    q = start_search_stream(spark, idx, qdir, out, stemmer=None, trigger_once=True,
                            checkpoint=tempfile.mkdtemp(prefix="termite-c-"))
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch_id").collect())
    queries = spark.createDataFrame([(1, "oil"), (2, "corn price")], "query_id long, text string")
    want = rk.rank_documents(rk.vsm_scores(idx.postings, idx.vocab,
                                           rk.query_term_counts(rk.query_tokens(queries, None))))
    assert got == sorted(tuple(r) for r in want.collect())
