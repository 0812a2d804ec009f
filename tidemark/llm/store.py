"""Reading tables and cutting lineage through the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(table: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as make it no column of the table."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. A local session without it (tests) gets one
    of its own; a cluster without it is refused, as its executors share no other folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe when the
    executors that computed it are lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_path = path
    return back


class Scratch:
    """Written tables of one run, each dropped once what reads it has been written itself,
    so that the shared folder does not hold them all at once."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.tables: list[DataFrame] = []

    def hold(self, table: DataFrame) -> DataFrame:
        """A table from ``written``."""
        self.tables.append(table)
        return table

    def write(self, df: DataFrame, purpose: str) -> DataFrame:
        return self.hold(written(df, purpose))

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.tables = [t for t in self.tables if not any(t is gone for gone in tables)]

    def drop_all(self) -> None:
        self.drop(*self.tables)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that Python tasks find
    it there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for part in (package, package / "llm"):
            for source in sorted(part.glob("*.py")):
                out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
