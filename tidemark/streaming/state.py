"""Current state kept up batch by batch, by keys' buckets.

A batch reads and writes only the buckets its keys fall in, as new files; a table of versions
says which batch's files hold each bucket. Files of other buckets stay as they are. Versions
are written last, so a batch that fails halfway leaves the state of the batch before, and a
retry overwrites its own folders only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.lake import latest_change

BUCKETS = 256


def bucket_of(pk: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*pk), F.lit(buckets)).cast("int")


def _folders(path: str, versions: dict[int, int]) -> list[str]:
    return [f"{path}/rows/batch={batch}/bucket={bucket}" for bucket, batch in sorted(versions.items())]


def _versions(spark: SparkSession, path: str, batch_id: int) -> dict[int, int]:
    """Batch whose files hold each bucket: as many rows as there are buckets, at most."""
    found = spark.read.schema("bucket INT, version BIGINT").parquet(f"{path}/versions/batch={batch_id}")
    return {r["bucket"]: r["version"] for r in found.where("bucket is not null").collect()}


def keep_state(committed: DataFrame, path: str, checkpoint: str, pk: list[str], buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the last change of each key of a stream of committed rows under ``path``; stop when
    nothing is left. ``buckets`` must stay the same for a path: so many that one is read and
    written quickly, as a key's change rewrites its bucket.

    Deletes are kept as the last change of their key, so a change that comes after a later one
    of its key, in the same batch or another, changes nothing; rows that come twice count once.
    Null keys are keys. A batch without rows leaves the state as it is. Columns that a later
    batch brings are null in older rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = _versions(spark, path, batch_id - 1) if batch_id else {}
        changes = latest_change(batch, pk)
        changes.persist()
        touched = [r["bucket"] for r in changes.select(bucket_of(pk, buckets).alias("bucket")).distinct().collect()]
        old = _folders(path, {b: versions[b] for b in touched if b in versions})
        if old:
            rows = latest_change(spark.read.schema(changes.schema).parquet(*old).unionByName(changes), pk)
        else:
            rows = changes
        # Gathers a bucket in few files and splits one that is large.
        rows.withColumn("bucket", bucket_of(pk, buckets)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{path}/rows/batch={batch_id}")
        changes.limit(0).write.mode("overwrite").parquet(f"{path}/columns/batch={batch_id}")
        now = versions | {b: batch_id for b in touched}
        # The row without a bucket says that the batch is there, rows or not.
        spark.createDataFrame([(None, batch_id), *now.items()], "bucket INT, version BIGINT").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/versions/batch={batch_id}")
        changes.unpersist()

    return (
        committed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_state(spark: SparkSession, path: str, deleted: bool = False) -> DataFrame:
    """The current row of each key after the last whole batch; needs at least one batch.
    ``deleted`` adds the deletes of keys that are gone."""
    last = spark.read.parquet(f"{path}/versions").agg(F.max("batch")).first()[0]
    columns = spark.read.parquet(f"{path}/columns/batch={last}").schema
    folders = _folders(path, _versions(spark, path, last))
    rows = spark.read.schema(columns).parquet(*folders) if folders else spark.createDataFrame([], columns)
    return rows if deleted else rows.where(F.col("op") != "DELETE")
