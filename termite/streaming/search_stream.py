"""Ranked search as a Structured Streaming service.

The original answered one query per web request.  Here queries arrive as JSON
files ``{"query_id": ..., "text": ...}`` in a directory; every micro-batch is
scored against the static, stored index tables (a stream-static join inside
``foreachBatch``) and its top-k results are written to the batch's own partition of a
Parquet table, so a replayed batch adds nothing twice.  The
stream's checkpoint lives below ``spark.checkpoint.dir``, so a restarted query
resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from termite.functions import constants as K
from termite.operators import ranking as rk
from termite.operators.index import Index
from termite.session import scratch_path, stored

QUERY_SCHEMA = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("text", T.StringType()),
])


def start_search_stream(spark: SparkSession, index: Index, query_dir: str, result_path: str,
                        k: int = K.RESULTS_PER_QUERY, stemmer: str | None = "s",
                        checkpoint: str | None = None, trigger_once: bool = False) -> StreamingQuery:
    """Start the service; returns the running ``StreamingQuery``."""
    post = stored(index.postings, "stream-postings")
    vocab = stored(index.vocab, "stream-vocabulary")

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        qt = rk.query_term_counts(rk.query_tokens(batch, stemmer))
        top = rk.rank_documents(rk.vsm_scores(post, vocab, qt), k)
        # a batch that is replayed after a failure replaces its own files
        top.write.mode("overwrite").parquet(f"{result_path}/batch_id={batch_id}")

    stream = spark.readStream.schema(QUERY_SCHEMA).json(query_dir)
    writer = stream.writeStream.foreachBatch(score_batch).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "search-stream"))
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()
