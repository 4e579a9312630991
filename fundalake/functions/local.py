"""Rows that the driver has, as a table."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def small(spark: SparkSession, rows: Sequence[tuple], schema: pa.Schema) -> DataFrame:
    """A few rows, which become a part of the plan; from a list of tuples they would go through a Python worker for each core of the cluster."""
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema))
