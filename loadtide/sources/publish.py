"""Publishing a table: append, overwrite, merge, upsert, and typed for a warehouse.

Targets are Parquet folders. `jdbc_append` and `jdbc_overwrite` hand the same frames to a database.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import overflow, warehouse_cast
from ..operators.dedupe import count_duplicates
from ..operators.select import available, join_on
from .layers import write_partitioned
from .scratch import delete_path, fresh_path, path_exists


def typed(df: DataFrame, types: Mapping[str, object]) -> DataFrame:
    """Columns rounded into their warehouse types; what does not fit becomes null."""
    return df.select(*[warehouse_cast(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def overflow_counts(df: DataFrame, types: Mapping[str, object]) -> DataFrame:
    """How many values of each column do not fit their warehouse type."""
    cols = available(df, types)
    row = df.agg(*[F.count(F.when(overflow(c, types[c]), 1)).alias(c) for c in cols])
    return row.unpivot([], cols, "column_name", "overflowed")


def _write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str], dynamic: bool = False) -> None:
    if partition_by:
        write_partitioned(df, path, partition_by, mode, dynamic)
    else:
        df.write.mode(mode).parquet(path)


def publish_append(df: DataFrame, path: str, columns: Sequence[str] | None = None,
                   partition_by: Sequence[str] = ()) -> None:
    _write(df.select(*available(df, columns)) if columns else df, path, "append", partition_by)


def publish_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the rows, keep the table: the new rows must have the columns the table has.

    The rows are first written beside the target, so a frame that reads the target is safe.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        have, new = spark.read.parquet(path).schema, df.schema
        want = {f.name: f.dataType for f in have}
        got = {f.name: f.dataType for f in new}
        if set(want) != set(got):
            raise ValueError(f"columns differ from the table: {sorted(set(want) ^ set(got))}")
        df = df.select(*[F.col(f.name).cast(want[f.name]) for f in have])
    staged = _stage(df, "overwrite")
    _write(spark.read.parquet(staged), path, "overwrite", partition_by)
    delete_path(spark, staged)


def _stage(df: DataFrame, name: str) -> str:
    staged = fresh_path(df.sparkSession, name)
    df.write.parquet(staged)
    return staged


def _count_unique(batch: DataFrame, keys: Sequence[str]) -> int:
    """Rows of a batch whose keys are all there and different, else an error."""
    missing = [k for k in keys if k not in batch.columns]
    if missing:
        raise ValueError(f"key columns missing from the batch: {missing}")
    found = count_duplicates(batch, keys).first()
    if found.duplicated_keys:
        raise ValueError(f"{found.duplicated_keys} of the keys {list(keys)} repeat inside the batch")
    return found.rows


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], time: str | None = None) -> DataFrame:
    """Rows of the batch whose key the target does not have.

    With `time` among the keys only the batch's own time range of the target is looked at (and rows without a
    time). Null keys equal null keys, so that publishing a batch again adds nothing.
    """
    if time is not None and time in keys:
        target = target.filter(F.col(time).isNull() | F.col(time).between(batch.agg(F.min(time)).scalar(), batch.agg(F.max(time)).scalar()))
    return join_on(batch, target.select(*keys), keys, "left_anti").select(*batch.columns)


def merge_new(target: DataFrame, batch: DataFrame, keys: Sequence[str], time: str | None = None) -> DataFrame:
    """The target after inserting the rows it does not have yet."""
    return target.unionByName(new_rows(target, batch, keys, time), allowMissingColumns=True)


def upserted(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after updating rows by key and inserting new ones; columns the batch lacks stay."""
    stays = join_on(target, batch.select(*keys), keys, "left_anti")
    kept = [c for c in target.columns if c not in batch.columns]
    if kept:
        batch = join_on(batch, target.select(*keys, *kept), keys, "left")
    return stays.select(*target.columns).unionAll(
        batch.select(*[F.col(f.name).cast(f.dataType) for f in target.schema]))


def publish_merge(batch: DataFrame, path: str, keys: Sequence[str], time: str | None = None,
                  partition_by: Sequence[str] = ()) -> None:
    """Insert the rows whose key is absent. An empty batch changes nothing."""
    batch = batch.persist()
    try:
        if not _count_unique(batch, keys):
            return
        if not path_exists(batch.sparkSession, path):
            _write(batch, path, "append", partition_by)
            return
        target = batch.sparkSession.read.parquet(path)
        if time is not None and time in keys and batch.filter(F.col(time).isNull()).isEmpty():
            span = batch.agg(F.min(time).alias("low"), F.max(time).alias("high"))
            low, high = span.select(F.unix_micros("low"), F.unix_micros("high")).first()
            # Constants, so that the target's files are skipped by their statistics.
            target = target.filter(F.col(time).between(F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high))))
        staged = _stage(new_rows(target, batch, keys), "merge")
        _write(batch.sparkSession.read.schema(batch.schema).parquet(staged), path, "append", partition_by)
        delete_path(batch.sparkSession, staged)
    finally:
        batch.unpersist()


def publish_upsert(batch: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str],
                   touch: str | None = None, partition_from_key: bool = False) -> None:
    """Insert new rows and update old ones by key, rewriting only the partitions involved.

    Involved are the partitions the batch writes to and those that hold old rows of its keys, so
    a row whose partition changes leaves its old one. Where the partition follows from the key
    (month of the time, say) rows cannot move, and the search for old rows is left out. The new content is staged before anything
    is replaced: if the job dies on the way, running it again gives the same table. An empty
    batch changes nothing.
    """
    if touch:
        batch = batch.withColumn(touch, F.current_timestamp())
    batch = batch.persist()
    try:
        if not _count_unique(batch, keys):
            return
        if path_exists(batch.sparkSession, path):
            _replace_partitions(batch, path, keys, partition_by, partition_from_key)
        else:
            _write(batch, path, "append", partition_by)
    finally:
        batch.unpersist()


def _replace_partitions(batch: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str],
                        partition_from_key: bool) -> None:
    spark = batch.sparkSession
    target = spark.read.parquet(path)
    involved = batch.select(*partition_by)
    if not partition_from_key:
        involved = involved.unionByName(join_on(target, batch.select(*keys), keys, "left_semi").select(*partition_by))
    places = _stage(involved.distinct(), "places")
    parts = spark.read.schema(involved.schema).parquet(places)
    result = upserted(join_on(target, parts, partition_by, "left_semi"), batch, keys)
    staged = _stage(result, "upsert")
    fresh = spark.read.schema(target.schema).parquet(staged)
    emptied = join_on(parts, fresh.select(*partition_by).distinct(), partition_by, "left_anti")
    write_partitioned(fresh, path, partition_by, "overwrite", dynamic=True)
    for p in emptied.toLocalIterator():  # folders that lost their last row: names, one at a time
        names = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if p[c] is None else p[c]}" for c in partition_by]
        delete_path(spark, "/".join([path, *names]))
    delete_path(spark, staged)
    delete_path(spark, places)


def jdbc_append(df: DataFrame, options: Mapping[str, str], table: str, batch_size: int = 5000) -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch_size).mode("append").save()


def jdbc_overwrite(df: DataFrame, options: Mapping[str, str], table: str, batch_size: int = 5000) -> None:
    """Truncate and load; the table definition stays."""
    (df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch_size)
     .option("truncate", "true").mode("overwrite").save())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
