"""Context blocks, prompts, generation, and the whole flow."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.functions.text import fmt2
from chunkwise.operators.hits import _ordered, with_defaults
from chunkwise.operators.outside import apart, error_text
from chunkwise.operators.skew import salted_lookup_join

# --- fixed values: one context line per hit -------------------------------------
# scored:  From {file} (page {page}, chunk {chunk}) with similarity {distance:.2f}
# plain:   From {file} (page {page}): {chunk}
# lines are joined with a newline in rank order.
# ------------------------------------------------------------------------------

DEFAULT_TEMPLATE = (
    "Passages found for the question, best match first:\n{context}\n\n"
    "Question: {query}\n"
    "Reply from these passages alone and name the file each fact comes from. "
    "Reply 'no answer found' where they hold none.\n"
    "Reply:"
)


def context_line(style: str = "scored") -> Column:
    if style == "scored":
        return F.concat(F.lit("From "), F.col("file"), F.lit(" (page "), F.col("page"),
                        F.lit(", chunk "), F.col("chunk"), F.lit(") with similarity "),
                        fmt2("distance"))
    if style == "plain":
        return F.concat(F.lit("From "), F.col("file"), F.lit(" (page "), F.col("page"),
                        F.lit("): "), F.col("chunk"))
    raise ValueError(f"unknown context style {style!r}")


def context(hits: DataFrame, style: str = "scored", query_id: str = "query_id") -> DataFrame:
    """G1/G2 + A2: ``query_id, context`` with one line per hit in rank order."""
    lines = with_defaults(hits).withColumn("_line", context_line(style))
    return lines.groupBy(query_id).agg(
        F.array_join(_ordered(F.col("_line")), "\n").alias("context"))


def merged_context(merged: DataFrame, query_id: str = "query_id") -> DataFrame:
    """G1 over A1 records: one scored line per query, the merged chunk texts
    (newline-joined) in the chunk slot, file/page of the best hit."""
    m = merged.withColumn("chunk", F.array_join("chunks", "\n"))
    return with_defaults(m.select(query_id, "file", "page", "chunk", "distance")) \
        .select(query_id, context_line("scored").alias("context"))


def _template_parts(template: str) -> list[tuple[str, str]]:
    """Split a template into literal text and ``{slot}`` references."""
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(("lit", template[pos:m.start()]))
        parts.append(("col", m.group(1)))
        pos = m.end()
    if pos < len(template):
        parts.append(("lit", template[pos:]))
    return parts


def prompt(df: DataFrame, template: str = DEFAULT_TEMPLATE, out: str = "prompt") -> DataFrame:
    """Fill ``{slot}`` references with columns of the same name.

    Built with ``concat`` of literals and columns, never string replacement, so
    chunk text that happens to contain ``{query}`` stays as it is. A null column
    renders as the empty string.
    """
    pieces = [F.lit(v) if kind == "lit" else F.coalesce(F.col(v).cast("string"), F.lit(""))
              for kind, v in _template_parts(template)]
    return df.withColumn(out, F.concat(*pieces))


def generate(df: DataFrame, client: Callable[[list[str]], list[str]], prompt_col: str = "prompt",
             out: str = "answer", max_parallel: int | None = None, errors: str | None = None) -> DataFrame:
    """Answers from a language-model client, one call per Arrow batch.

    ``max_parallel`` bounds concurrent calls by repartitioning first (by prompt
    hash, so the same prompt lands in the same task on a retry). Answers are
    not deterministic in general: write them before joining on them. A client that
    raises ends the job, or, with ``errors``, leaves the answers of the prompts it raised
    for null and says why in the column of that name.
    """
    if max_parallel:
        df = df.repartition(max_parallel, F.xxhash64(prompt_col))
    filled = lambda prompts: [p if p is not None else "" for p in prompts]

    if errors is None:
        def call(prompts: pd.Series) -> pd.Series:
            answers = list(client(filled(prompts)))
            if len(answers) != len(prompts):
                raise ValueError("client returned a different number of answers")
            return pd.Series(answers, dtype=object)

        # marked as not deterministic: a filter on the answer must not call the client twice
        udf = F.pandas_udf(call, T.StringType()).asNondeterministic()
        return df.withColumn(out, udf(F.col(prompt_col)))

    def call_apart(prompts: pd.Series) -> pd.DataFrame:
        answers, failed = apart(client, filled(prompts))
        return pd.DataFrame({"a": pd.Series(answers, dtype=object), "e": pd.Series(failed, dtype=object)})

    udf = F.pandas_udf(call_apart, "a string, e string").asNondeterministic()
    return (df.withColumn("_said", udf(F.col(prompt_col)))
            .withColumn(out, F.col("_said.a")).withColumn(errors, F.col("_said.e")).drop("_said"))


ANSWERS = "key string, model string, prompt string, answer string, error string, seconds double, tries int"


def kept_answers(spark: SparkSession, path: str) -> DataFrame:
    """The answers stored at ``path``: one row per key, a success before an error, the
    least answer of several."""
    try:
        rows = spark.read.schema(ANSWERS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], ANSWERS)
    best = F.min_by(F.struct("answer", "error", "seconds", "tries"), F.struct(F.col("error").isNotNull().alias("f"), "answer", "tries"))
    return rows.groupBy("key").agg(best.alias("b")).select("key", "b.*")


def answer_once(df: DataFrame, client: Callable[[list[str]], list[str]], path: str, *, model: str,
                prompt_col: str = "prompt", batch_size: int = 8, tries: int = 3, wait: float = 0.0,
                max_parallel: int | None = None) -> DataFrame:
    """G4 + M3 with a store of answers: ``df`` with ``answer, error, seconds, tries``.

    Answers are kept at ``path`` by the hash of model and prompt. Prompts answered there
    are not sent again, equal prompts are sent once, and failures are sent again by the
    next run. A call takes up to ``batch_size`` prompts and is made up to ``tries`` times,
    ``wait`` seconds apart and doubling; a batch that keeps failing is sent prompt by
    prompt. ``seconds`` is the wall time of the call that gave the answer (or failed last),
    ``tries`` the calls made for it. Null prompts count as empty.
    """
    if tries < 1 or batch_size < 1:
        raise ValueError("tries and batch_size must be positive")
    spark = df.sparkSession
    key = F.sha2(F.concat_ws("\u0000", F.lit(model), F.coalesce(F.col(prompt_col), F.lit(""))), 256)
    keyed = df.withColumn("_key", key)
    wanted = keyed.groupBy(F.col("_key").alias("key")).agg(F.first(F.coalesce(prompt_col, F.lit(""))).alias("prompt"))
    done = kept_answers(spark, path).where(F.col("error").isNull()).select("key")
    todo = wanted.join(done, "key", "left_anti")
    if max_parallel:
        todo = todo.repartition(max_parallel, "key")

    def attempt(prompts: list[str]) -> tuple[list | None, str | None, float, int]:
        pause, failed, seconds = wait, None, 0.0
        for n in range(1, tries + 1):
            started = time.perf_counter()
            try:
                answers = list(client(prompts))
                if len(answers) != len(prompts):
                    raise ValueError(f"{len(answers)} answers for {len(prompts)} prompts")
                return answers, None, time.perf_counter() - started, n
            except Exception as e:  # kept with the prompt; the other prompts go on
                failed, seconds = error_text(e), time.perf_counter() - started
                if n < tries and pause:
                    time.sleep(pause)
                    pause *= 2
        return None, failed, seconds, tries

    def run(batches):
        for pdf in batches:
            rows = []
            for s in range(0, len(pdf), batch_size):
                part = pdf.iloc[s:s + batch_size]
                prompts = list(part["prompt"])
                answers, failed, seconds, n = attempt(prompts)
                if answers is None and len(prompts) > 1:
                    for k, p in zip(part["key"], prompts):
                        one, failed, seconds, m = attempt([p])
                        rows.append((k, model, p, one and one[0], failed, seconds, n + m))
                else:
                    rows += [(k, model, p, a, failed, seconds, n)
                             for k, p, a in zip(part["key"], prompts, answers or [None] * len(prompts))]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWERS.split(", ")])

    todo.mapInPandas(run, ANSWERS).write.mode("append").parquet(path)
    kept = kept_answers(spark, path).withColumnRenamed("key", "_key")
    return salted_lookup_join(keyed, kept, ["_key"], "left").drop("_key")
