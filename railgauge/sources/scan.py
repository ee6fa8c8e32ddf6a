"""Reading folders that may not exist yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_or_empty(spark: SparkSession, load: Callable[[], DataFrame], schema: str | StructType) -> DataFrame:
    """What ``load`` reads; no rows, with the schema, where nothing was ever written."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
