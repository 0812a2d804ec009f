"""Which landed files a restart has to read.

A manifest has a row per landed file and connector with the least and greatest position in
it. It is made once per file, when the file has landed, and joined to the stored positions
before a restart, so that files read to the end are not opened again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.offsets import offset_key
from tidemark.operators.joins import side_join
from tidemark.operators.positions import resume, usable_offsets
from tidemark.sources.logs import read_change_log

FILE = "_metadata.file_path"


def file_positions(log: DataFrame) -> DataFrame:
    """Manifest rows of the files that ``log`` reads: ``file, connector, connector_type, least,
    greatest, unreadable`` (rows without a readable position)."""
    key = offset_key(F.col("connector_type"), F.col("offset"))
    return log.select(F.col(FILE).alias("file"), "connector", "connector_type", key.alias("key")).groupBy(
        "file", "connector", "connector_type").agg(
        F.min("key").alias("least"), F.max("key").alias("greatest"), F.count_if(F.col("key").isNull()).alias("unreadable"))


def files_to_read(manifest: DataFrame, offsets: DataFrame, inclusive: bool = True) -> DataFrame:
    """Files with rows that ``resume`` may return: of a connector without a stored position,
    that reach the stored one, or with rows whose position is not readable."""
    kinds = manifest.select("connector", "connector_type").distinct()
    stored = side_join(kinds, usable_offsets(offsets).select("connector", F.col("offset").alias("__stored")), ["connector"], "inner")
    start = stored.groupBy("connector", "connector_type").agg(F.max(offset_key(F.col("connector_type"), F.col("__stored"))).alias("start"))
    joined = side_join(manifest, start, ["connector", "connector_type"], "left")
    reached = F.col("greatest") >= F.col("start") if inclusive else F.col("greatest") > F.col("start")
    needed = F.col("start").isNull() | (F.col("unreadable") > 0) | F.coalesce(reached, F.lit(True))
    return joined.where(needed).select("file").distinct()


def resume_files(spark: SparkSession, path: str, manifest: DataFrame, offsets: DataFrame, inclusive: bool = True,
                 kind: str = "log", fmt: str = "parquet") -> DataFrame:
    """``resume`` over the landed files under ``path`` that the manifest does not rule out.
    Files it does not list yet are the caller's to add (``file_positions``). The list of files to
    read goes through the driver, as any list of input files does."""
    files = [r["file"] for r in files_to_read(manifest, offsets, inclusive).toLocalIterator()]
    log = read_change_log(spark, path, kind, fmt).limit(0)
    if files:
        log = spark.read.schema(log.schema).format(fmt).load(files)
    return resume(log, offsets, inclusive)
