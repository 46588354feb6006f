"""Sinks (K1-K8).  All writes are single distributed jobs."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.schemas import CSV_OPTIONS


def write_split(df: DataFrame, path: str, key: str = "competition", fmt: str = "parquet",
                spread: str | None = "match_id", max_records_per_file: int = 0,
                mode: str = "overwrite", sep: str = ";",
                one_file: bool = False) -> None:
    """One folder per key value in a single pass (K3-K6); keys with no rows
    produce no folder.  Rows are spread over tasks by (key, ``spread``) so a
    key holding a third of the data is written by many tasks in parallel,
    not by one; rows without a ``spread`` value are dealt by a hash of the
    row.  ``max_records_per_file`` bounds the files, ``one_file`` asks for one
    file per key (small outputs only: one task writes each key)."""
    w = df
    if one_file:
        w = w.repartition(key)
    elif spread and spread in df.columns:
        plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.UserDefinedType))]
        w = w.repartition(key, F.col(spread), F.when(F.col(spread).isNull(), F.xxhash64(*plain)))
    writer = w.write.mode(mode).partitionBy(key)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).option("sep", sep).csv(path)
    else:
        writer.format(fmt).save(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """CSV with header and doubled-quote escaping (K1, K2).  Vector columns
    cannot go to CSV and are rejected."""
    bad = [f.name for f in df.schema.fields
           if isinstance(f.dataType, (T.UserDefinedType, T.ArrayType, T.MapType, T.StructType))]
    if bad:
        raise ValueError(f"columns not representable in CSV: {bad}")
    df.write.mode(mode).options(**CSV_OPTIONS).option("sep", sep).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """Parquet (K1, K7); vectors survive the round trip."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_batches(df: DataFrame, path: str, batch_col: str = "batch", fmt: str = "parquet",
                  spread: str | None = None) -> None:
    """Batch-named outputs (K2): one folder per batch.  A batch that is
    written again replaces its folder, so a retry never doubles it, and other
    batches stay.  Rows are dealt by batch, so that files grow as the batches
    and not as batches times tasks; adaptive execution splits a batch beyond
    its advisory partition size into a few files.  ``spread`` deals the rows
    of a batch by a second column as well: more files, written in parallel."""
    keys = [batch_col] + ([spread] if spread and spread in df.columns else [])
    (df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(batch_col).format(fmt).save(path))


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A table of ``buckets`` buckets by ``keys``, sorted by them, at ``path``;
    two such tables of as many buckets join on their keys without an exchange
    (J4).  Rows are dealt by the same hash first, so that each bucket is one file."""
    spark = df.sparkSession
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """The table persisted for as long as the block runs (K8) and released at
    its end, also after an error; it fills when first read.  What leaves the
    block must be written (:func:`kept`) or collected inside it, as a plan made
    from a released table computes it anew."""
    out = df.persist(level)
    try:
        yield out
    finally:
        out.unpersist(blocking=True)


def kept(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: a result that needs nothing of
    what it was made from."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_vectors(df: DataFrame) -> DataFrame:
    """Prediction table without ML vector columns, for CSV (K7)."""
    keep = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.UserDefinedType)]
    return df.select(*keep)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a
    local, executor-bound one), so a lost executor does not recompute the
    whole upstream plan."""
    from pitchlake.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


__all__ = ["write_split", "write_csv", "write_parquet", "write_batches", "write_bucketed", "held", "kept",
           "drop_vectors", "cut_lineage"]
