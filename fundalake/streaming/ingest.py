"""Incremental ingest: new landed files become upserts, each file once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from fundalake.sources.schemas import KEYS, TABLES
from fundalake.sources.store import Store


def ingest(spark: SparkSession, store: Store, table: str, path: str, checkpoint: str, order_by: Sequence[Column], file_format: str = "parquet", after: Callable[[], None] | None = None) -> int:
    """Upsert all files of ``path`` that earlier runs have not seen; gives the number of batches.

    The checkpoint holds which files are done.  A batch that is repeated after a
    failure upserts the same keys again and changes nothing.
    """
    batches = []

    def apply(batch: DataFrame, number: int) -> None:
        store.upsert(table, batch, KEYS[table], order_by)
        batches.append(number)

    source = spark.readStream.schema(TABLES[table]).format(file_format).load(path)
    query = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if batches and after:
        after()
    return len(batches)
