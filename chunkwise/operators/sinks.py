"""Vector-store write semantics on Parquet paths and catalog tables.

* ``merge_latest`` (upsert): last write per key wins, all fields replaced.
* ``merge_first`` (insert-if-absent): a key already stored keeps its record.
* ``append``: no key; every write adds rows with a generated id.
* ``delete_where``: drop rows whose column equals a literal (no wildcard).
* ``reset_store`` / ``create_store``: drop and declare tables.

Merges are hash aggregates over ``max``/``min`` of a struct, not windows: the
aggregate combines map-side, so a key written many times (one chunk text
repeated across a third of the corpus) never lands whole in one task. Parquet
has no MERGE, so a merged store is written to a fresh path and read from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pick(df: DataFrame, key: list[str], order: list[str], latest: bool) -> DataFrame:
    payload = [c for c in df.columns if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload]).alias("_r")
    agg = F.max(packed) if latest else F.min(packed)
    picked = df.groupBy(*key).agg(agg.alias("_r"))
    return picked.select(*key, *[F.col(f"_r.{c}").alias(c) for c in order + payload]) \
                 .select(*df.columns)


def merge_latest(existing: DataFrame | None, incoming: DataFrame, key: list[str],
                 order: list[str]) -> DataFrame:
    """O4 upsert: union both, keep per key the row with the greatest ``order``.

    ``order`` must increase with write time (batch number, then position in
    the batch), so later writes replace earlier ones, as a hash set does.
    """
    rows = incoming if existing is None else existing.unionByName(incoming)
    return _pick(rows, key, order, latest=True)


def merge_first(existing: DataFrame | None, incoming: DataFrame, key: list[str],
                order: list[str]) -> DataFrame:
    """O5 insert-if-absent: first row per key of the batch, only for keys not stored."""
    first = _pick(incoming, key, order, latest=False)
    if existing is None:
        return first
    new = first.join(existing.select(*key), on=key, how="left_anti")
    return existing.unionByName(new)


def with_generated_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """The store generates an id per appended object."""
    return df.withColumn(id_col, F.expr("uuid()"))


def append(existing: DataFrame | None, incoming: DataFrame, id_col: str = "id") -> DataFrame:
    """O6 append: every row is kept, duplicates included."""
    rows = with_generated_id(incoming, id_col)
    return rows if existing is None else existing.unionByName(rows)


def append_to_store(incoming: DataFrame, path: str, id_col: str = "id") -> DataFrame:
    """O6 append as a write: ids are generated once, with the rows, and read back."""
    with_generated_id(incoming, id_col).write.mode("append").parquet(path)
    return incoming.sparkSession.read.parquet(path)


def delete_where(df: DataFrame, column: str, value) -> DataFrame:
    """Drop rows whose ``column`` equals ``value`` literally (``'*'`` is not a wildcard)."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def write_store(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write a store version to ``path`` (never the path it is read from)."""
    df.write.mode(mode).parquet(path)
    return path


def reset_store(spark: SparkSession, table: str) -> bool:
    """Drop a store table if it exists; returns whether it existed."""
    existed = spark.catalog.tableExists(table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return existed


def create_store(spark: SparkSession, table: str, schema: T.StructType, dim: int, metric: str,
                 location: str | None = None) -> None:
    """Declare a store table (get-or-create) with its dimension and metric.

    The dimension is enforced on write by ``valid_vectors``/``check_dim``.
    """
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{loc} "
              f"TBLPROPERTIES ('dim' = '{int(dim)}', 'metric' = '{metric}')")


def check_dim(df: DataFrame, vec: str, dim: int) -> DataFrame:
    """Fail the write if any vector is not ``dim`` long (raised inside the task)."""
    bad = F.col(vec).isNull() | (F.size(vec) != dim)
    return df.withColumn(vec, F.when(bad, F.raise_error(
        F.concat(F.lit(f"vector length must be {dim}, got "), F.size(vec).cast("string"))))
        .otherwise(F.col(vec)))


def insert_into_store(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Append rows to a declared store table, checking the declared dimension."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    vec_cols = [f.name for f in spark.table(table).schema.fields
                if isinstance(f.dataType, T.ArrayType)]
    out = df
    for v in vec_cols:
        out = check_dim(out, v, int(props["dim"]))
    out.select(*spark.table(table).columns).write.insertInto(table)


# --- bucketed stores: merges without shuffling the stored side -------------------

def _num_buckets(spark: SparkSession, table: str) -> int:
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row["col_name"] == "Num Buckets":
            return int(row["data_type"])
    raise ValueError(f"{table} is not bucketed")


def write_bucketed_store(df: DataFrame, table: str, key: list[str], buckets: int,
                         location: str | None = None) -> str:
    """Write a store table bucketed (and sorted) by ``key``: later merges and
    payload joins on ``key`` find it already hash-partitioned."""
    writer = df.write.mode("errorifexists").format("parquet").bucketBy(buckets, *key).sortBy(*key)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)
    return table


def merge_bucketed(spark: SparkSession, table: str, incoming: DataFrame, key: list[str],
                   order: list[str], latest: bool, new_table: str,
                   location: str | None = None) -> str:
    """O4 (``latest``) / O5 merge of a batch into a bucketed store, as a new version.

    The batch is partitioned like the store (same key, same bucket count) and
    reduced to one row per key; the store is joined in place, bucket against
    bucket, so only the batch moves. As in ``merge_latest``, the greater ``order``
    wins: a batch that arrives late does not replace newer rows.
    """
    existing = spark.table(table)
    n = _num_buckets(spark, table)
    picked = _pick(incoming.repartition(n, *key), key, order, latest=latest)
    cols = existing.columns
    if latest:
        marked = picked.select(*key, *[F.col(c).alias(f"_in_{c}") for c in cols if c not in key],
                               F.lit(True).alias("_in"))
        joined = existing.join(marked, on=key, how="full_outer")
        # a key that only one side has is null on the other, and null is the least order
        newer = F.col("_in").isNotNull() & F.coalesce(
            F.struct(*[F.col(f"_in_{c}").alias(c) for c in order]) >= F.struct(*order), F.lit(True))
        merged = joined.select(*[F.col(c) if c in key else
                                 F.when(newer, F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c)
                                 for c in cols])
    else:
        fresh = picked.join(existing.select(*key), on=key, how="left_anti")
        merged = existing.unionByName(fresh.select(*cols))
    return write_bucketed_store(merged.select(*cols), new_table, key, n, location)
