"""Calls to things outside Spark: models built once a worker, failures kept apart.

``Once`` wraps a factory, so that a model (an encoder, a client) is built in the Python
worker that uses it, once per worker process, however many tasks and batches it serves.

``apart`` runs a batch call so that a failing item fails alone: the batch is halved until
the items that raise are found; all others keep their results. ``write_apart`` writes rows
and rejected inputs in one pass, split by folder.
"""

from __future__ import annotations

import sys
from collections import OrderedDict
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODELS_PER_WORKER = 4


def _models() -> OrderedDict[str, Any]:
    """The models of this Python process, used last comes last. They hang on a module made
    for them: a task's copy of this module may be its own, the table of modules is not."""
    home = sys.modules.setdefault("chunkwise_worker_models", ModuleType("chunkwise_worker_models"))
    return home.__dict__.setdefault("models", OrderedDict())


class Once:
    """``factory()`` is called at most once per worker process for a ``key``.

    Calls go to what the factory built. Only the factory and the key are pickled. A worker
    keeps the ``MODELS_PER_WORKER`` models used last.
    """

    def __init__(self, factory: Callable[[], Callable], key: str):
        self.factory, self.key = factory, key

    def model(self) -> Callable:
        models = _models()
        if self.key not in models:
            models[self.key] = self.factory()
            while len(models) > MODELS_PER_WORKER:
                models.popitem(last=False)
        models.move_to_end(self.key)
        return models[self.key]

    def __call__(self, items: list) -> Any:
        return self.model()(items)


def error_text(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def apart(call: Callable[[list], Any], items: list) -> tuple[list, list[str | None]]:
    """Results and errors of ``call(items)``, one of each per item (one of them null).

    A call that raises, or gives another number of results, is made again on each half.
    """
    if not items:
        return [], []
    try:
        out = list(call(items))
        if len(out) != len(items):
            raise ValueError(f"{len(out)} results for {len(items)} items")
        return out, [None] * len(items)
    except Exception as e:  # whatever a caller's code raises belongs to the input, not to the job
        if len(items) == 1:
            return [None], [error_text(e)]
    half = len(items) // 2
    left, right = apart(call, items[:half]), apart(call, items[half:])
    return left[0] + right[0], left[1] + right[1]


def write_apart(df: DataFrame, path: str, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Write ``df`` once, rows and rejects in folders of their own; returns both, read back.

    Rows are those whose ``error`` is null, and come back without it.
    """
    df.withColumn("rejected", F.col(error).isNotNull()).write.mode("errorifexists").partitionBy("rejected").parquet(path)
    back = df.sparkSession.read.schema(df.schema.add("rejected", "boolean")).parquet(path)
    return back.where(~F.col("rejected")).drop("rejected", error), back.where("rejected").drop("rejected")
