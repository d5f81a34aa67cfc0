"""A stream of (user, product) requests scored against fixed artifacts (X1, re-aimed ask/score loop).

Requests arrive as files in a folder (any Structured Streaming file source; Kafka works the same
through ``readStream.format("kafka")`` plus a parse step). Each micro-batch is an ordinary
DataFrame: it pins the newest committed version of the artifacts (``sources.artifacts``), so a training run that saves
meanwhile is picked up whole by a later batch and never in part, and goes through ``score_and_recommend``, or through the
feature joins alone where the version has no model.

A request sent twice (same ``request_id``) is answered once when ``dedupe_within`` is set: ids are kept as state until the
watermark of ``requested_at`` has passed them by that delay, so the state is bounded by the requests of
that time, not by the length of the stream. It lies on disk (RocksDB), with a bounded part in memory. A stream goes on with the kind of
state that its checkpoint was begun with: one begun before that needs a new checkpoint location.

Output goes to ``{output}/batch_id=<n>`` with overwrite, so a micro-batch replayed after a failure
rewrites the same folder: together with the checkpoint location this gives exactly-once files. The version used is in
each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartwise.operators.model import assemble_requests, resolve_requests, score_and_recommend
from cartwise.sources.artifacts import Artifacts, load_artifacts

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("recency", T.IntegerType()),
        T.StructField("frequency", T.IntegerType()),
        T.StructField("monetary", T.DoubleType()),
    ]
)


TIMED_REQUEST_SCHEMA = T.StructType([*REQUEST_SCHEMA.fields, T.StructField("requested_at", T.TimestampType())])


#: Request ids are kept on the executors' disks, with at most so many MB of them in an executor's memory.
_STORE = "spark.sql.streaming.stateStore"
STATE_STORE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "200",
}


def answer(batch: DataFrame, art: Artifacts, top_n: int = 3) -> DataFrame:
    """A batch of requests scored and with recommendations, or with its serving features when there is no model."""
    if art.model is not None:
        return score_and_recommend(batch, art.model, art.interval, art.product_dept, art.dept_freq, art.rules, art.products, art.median, top_n)
    resolved = batch if art.products is None else resolve_requests(batch, art.products)
    return assemble_requests(resolved, art.interval, art.product_dept, art.dept_freq, art.median)


def start_scoring_stream(
    spark: SparkSession,
    requests_path: str,
    artifacts: Artifacts | str,
    output_path: str,
    checkpoint_location: str,
    top_n: int = 3,
    fmt: str = "parquet",
    available_now: bool = False,
    processing_time: str | None = None,
    dedupe_within: str | None = None,
    with_model: bool = True,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start the scoring stream; returns the running query.

    ``artifacts`` is a folder (every micro-batch pins its newest version) or loaded artifacts (the same for all); with a model
    they must hold the lookup tables, the rules and the products. ``with_model=False`` answers with features only.
    ``dedupe_within`` (say ``"1 hour"``) needs requests with ``requested_at`` and drops repeated request ids; requests later than
    that behind the newest are dropped too. ``available_now`` processes what is there and stops; ``max_files`` bounds a micro-batch.
    """
    if isinstance(artifacts, Artifacts) and with_model and (artifacts.model is None or artifacts.rules is None or artifacts.products is None):
        raise ValueError("artifacts need a model, rules and products")
    reader = spark.readStream.schema(TIMED_REQUEST_SCHEMA if dedupe_within else REQUEST_SCHEMA).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    requests = reader.load(requests_path)
    if dedupe_within:
        requests = requests.withWatermark("requested_at", dedupe_within).dropDuplicatesWithinWatermark(["request_id"])

    def handle(batch: DataFrame, batch_id: int) -> None:
        art = artifacts if isinstance(artifacts, Artifacts) else load_artifacts(batch.sparkSession, artifacts, with_model)
        out = answer(batch, art, top_n).withColumns({"version": F.lit(art.version).cast("int"), "batch_id": F.lit(batch_id)})
        out.write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/batch_id={batch_id}")

    writer = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    # a stream keeps the settings that it starts with
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for k, v in STATE_STORE.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
