"""O1 / O2: list a folder of files and cut each file into pages.

The file scan is Spark's ``binaryFile`` source: one directory, not recursive,
names filtered by a case-sensitive glob. Page extraction is pluggable: the
default splits decoded text on form feeds inside the JVM; any other format
(PDF, ...) is a caller-supplied ``bytes -> list[str]`` run batch-wise in Python
workers.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwise.operators.outside import error_text

PAGE_BYTES = 1 << 20  # text of the pages that leave a Python worker at a time
PAGES_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("text", T.StringType()),
])


def scan_files(spark: SparkSession, directory: str, suffix: str = ".pdf") -> DataFrame:
    """Files directly inside ``directory`` whose names end in ``suffix``.

    Returns ``path, file (base name), length, content`` plus any partition
    columns Spark discovers (``key=value`` sub-folders).
    """
    df = (spark.read.format("binaryFile")
          .option("pathGlobFilter", f"*{suffix}")
          .option("recursiveFileLookup", "false")
          .load(directory))
    return df.withColumn("file", file_name(df)).drop("modificationTime")


BINARY_COLUMNS = ("path", "modificationTime", "length", "content")


def file_name(files: DataFrame) -> Column:
    """Base name of the file, prefixed by its ``key=value`` partition folders.

    Spark names part files alike in every partition folder, so the base name
    alone is unique only within one folder.
    """
    base = F.element_at(F.split(F.col("path"), "/"), -1)
    parts = [F.concat(F.lit(f"{c}="), F.col(c).cast("string"))
             for c in files.columns if c not in BINARY_COLUMNS and c != "file"]
    return F.concat_ws("/", *parts, base) if parts else base


def text_pages(files: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Default extractor for text files: pages separated by form feeds (0-based).

    A trailing form feed ends the last page; it does not open an empty one.
    """
    keep = keep or []
    body = F.decode(F.col("content"), "UTF-8")
    body = F.regexp_replace(body, "\u000c\\z", "")
    return (files.select(*keep, "file", F.posexplode(F.split(body, "\u000c", -1)).alias("page", "text"))
            .select(*keep, "file", F.col("page").cast("int").alias("page"), "text"))


def extract_pages(files: DataFrame, extractor: Callable[[bytes], list[str]],
                  errors: str | None = None) -> DataFrame:
    """One row per page of every file, using ``extractor`` in Arrow batches.

    Only ``file`` and ``content`` travel to Python, file by file, and pages come back in
    batches of about ``PAGE_BYTES`` of text; blank pages are kept. A file whose extractor raises
    ends the job, or, with ``errors``, gives one row without page and text that holds the
    error in the column of that name. A null content has no pages.
    """
    def run(batches):
        for batch in batches:
            names, contents = batch.column("file"), batch.column("content")
            rows, size = [], 0
            for at in range(batch.num_rows):
                content, name = contents[at].as_py(), names[at].as_py()
                if content is None:
                    continue
                try:
                    pages = extractor(content)
                    pages = pages if isinstance(pages, list) else list(pages)
                except Exception as e:
                    if errors is None:
                        raise
                    rows.append((name, None, None, error_text(e)))
                    continue
                del content
                for i, text in enumerate(pages):
                    rows.append((name, i, text, None))
                    size += 64 + (len(text) if text is not None else 0)
                    if size >= PAGE_BYTES:
                        yield out(rows)
                        rows, size = [], 0
                del pages
            if rows:
                yield out(rows)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string()][:len(schema.fields)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                          schema.fieldNames())

    schema = T.StructType(PAGES_SCHEMA.fields + ([T.StructField(errors, T.StringType())] if errors else []))
    return files.select("file", "content").mapInArrow(run, schema)
