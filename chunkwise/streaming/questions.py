"""The question loop as a stream: questions arrive, answers are written.

Questions (``session, seq, query``) first pass a keyed state that holds one thing: which
sessions have ended. Later questions of an ended session are dropped there; the state of
a session that has not ended is empty, and that of an ended one expires ``ended_ttl``
after its ``exit``. Each micro-batch is then cut at the first ``exit`` of each session
(P11, salted, so a busy session is not buffered anywhere). The remaining questions are
embedded, searched against the store (J2), given a context and prompt (G1-G3, every
question kept), and answered by the client (G4). Outputs go to ``answers/batch=<id>`` with
overwrite, so a replayed batch is idempotent; the state lives in the stream's checkpoint,
so it holds over restarts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from chunkwise.operators.hits import keep_queries
from chunkwise.operators.rag import DEFAULT_TEMPLATE, context, generate, prompt
from chunkwise.operators.sessions import take_until
from chunkwise.plans.flows import retrieve

QUESTION_SCHEMA = "session string, seq long, query string"
ENDED_TTL_SECONDS = 7 * 24 * 3600
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _OpenSessions(StatefulProcessor):
    """Lets the questions of sessions pass that had not ended before this micro-batch.

    The state of an ended session is the time at which it expires; a timer removes it once
    the watermark of arrival times has passed that.
    """

    def __init__(self, sentinel: str, ttl_seconds: int):
        self.sentinel, self.ttl = sentinel.lower(), ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ended = handle.getValueState("ended", "expires long")

    def handleInputRows(self, key, rows, timerValues):
        until = self.ended.get()[0] if self.ended.exists() else None
        stopped = None
        for pdf in rows:  # frame by frame: a busy session is never held whole
            if len(pdf) == 0:
                continue
            arrived = int(pdf["arrived"].max().timestamp() * 1000)
            if until is not None and arrived < until:
                continue
            if (pdf["query"].str.lower() == self.sentinel).any():
                stopped = max(stopped or 0, arrived + self.ttl)
            yield pdf[["session", "seq", "query"]]
        if stopped is not None:
            self.ended.update((stopped,))
            self.handle.registerTimer(stopped)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.ended.exists() and self.ended.get()[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self.ended.clear()
        return iter(())

    def close(self) -> None:
        pass


def open_questions(questions: DataFrame, sentinel: str = "exit", ended_ttl: int = ENDED_TTL_SECONDS) -> DataFrame:
    """P11 over a stream: ``session, seq, query`` without those of sessions that an earlier
    micro-batch ended. Rows without a session form a session of their own."""
    keyed = questions.select(F.coalesce("session", F.lit("")).alias("session"), F.coalesce("seq", F.lit(0)).alias("seq"),
                             "query", F.current_timestamp().alias("arrived")).withWatermark("arrived", "1 second")
    return keyed.groupBy("session").transformWithStateInPandas(
        _OpenSessions(sentinel, ended_ttl), QUESTION_SCHEMA, outputMode="append", timeMode="EventTime")


def answer_stream(spark: SparkSession, question_dir: str, store: DataFrame, answers_path: str,
                  client: Callable[[list[str]], list[str]], *, k_fetch: int = 5,
                  k_keep: int | None = 3, style: str = "scored", template: str = DEFAULT_TEMPLATE,
                  sentinel: str = "exit", checkpoint: str | None = None,
                  available_now: bool = True,
                  max_files_per_trigger: int | None = None,
                  encoder: Callable | None = None, dim: int = 64,
                  ended_ttl: int = ENDED_TTL_SECONDS) -> StreamingQuery:
    """Start a stream answering question files (JSON lines) dropped in ``question_dir``.

    ``ended_ttl``: seconds for which an ended session stays ended.
    """
    reader = spark.readStream.schema(QUESTION_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    questions = open_questions(reader.json(question_dir), sentinel, ended_ttl)

    def run_batch(live: DataFrame, batch_id: int) -> None:
        kept = take_until(live, ["session"], ["seq"], "query", sentinel)
        qs = kept.select(F.to_json(F.struct("session", "seq")).alias("query_id"), "session", "seq", "query")
        hits = retrieve(qs.select("query_id", "query"), store, k_fetch, k_keep,
                        dim=dim, encoder=encoder)
        ctx = context(hits, style)
        prompts = prompt(keep_queries(qs, ctx).withColumn("context", F.coalesce("context", F.lit(""))),
                         template)
        (generate(prompts, client).select("session", "seq", "query", "prompt", "answer")
         .write.mode("overwrite").parquet(f"{answers_path}/batch={batch_id}"))

    writer = (questions.writeStream.foreachBatch(run_batch)
              .option("checkpointLocation", checkpoint or f"{answers_path}/_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    before = spark.conf.get(_STATE_STORE, None)
    spark.conf.set(_STATE_STORE, _ROCKSDB)  # a query keeps the provider that it starts with
    try:
        return writer.start()
    finally:
        spark.conf.set(_STATE_STORE, before) if before else spark.conf.unset(_STATE_STORE)
