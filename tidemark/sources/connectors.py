"""Connector configuration files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.binding import with_once

_CONFIG = "name STRING, class STRING, type STRING, config MAP<STRING, STRING>, _corrupt STRING"
_MASK = "****"


def parse_connectors(texts: DataFrame, column: str = "value") -> DataFrame:
    """JSON documents → ``name, type, config, error``. A document that is not valid JSON
    or lacks name, config or a known kind stays in the result with its ``error``."""
    doc = F.from_json(F.col(column), _CONFIG, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = with_once(texts, {"__doc": doc})
    kind = F.regexp_extract(F.lower(F.coalesce("__doc.type", "__doc.class")), "(postgres|mysql|oracle)", 1)
    error = (
        F.when(F.col("__doc").isNull() | F.col("__doc._corrupt").isNotNull(), F.lit("not JSON"))
        .when(F.col("__doc.name").isNull(), F.lit("name missing"))
        .when(F.col("__doc.config").isNull(), F.lit("config missing"))
        .when(F.coalesce(kind, F.lit("")) == "", F.lit("unknown kind"))
    )
    return parsed.select(
        F.col("__doc.name").alias("name"),
        F.nullif(kind, F.lit("")).alias("type"),
        F.col("__doc.config").alias("config"),
        error.alias("error"),
    )


def load_connectors(spark: SparkSession, directory: str) -> DataFrame:
    """Every ``*.json`` file of a directory; a missing directory has no connectors."""
    try:
        texts = spark.read.option("pathGlobFilter", "*.json").text(directory, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        texts = spark.createDataFrame([], "value STRING")
    return parse_connectors(texts)


def usable_connectors(connectors: DataFrame) -> DataFrame:
    """The connectors without an error."""
    return connectors.where(F.col("error").isNull()).drop("error")


def masked(config: Column) -> Column:
    """Config for display: passwords are hidden, also inside a URL."""
    return F.transform_values(
        config,
        lambda k, v: F.when(F.lower(k).contains("password"), F.lit(_MASK)).otherwise(
            F.regexp_replace(v, r"(?i)(password=)[^&;]*", f"$1{_MASK}")
        ),
    )
