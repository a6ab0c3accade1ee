"""Recipe documents as they arrive in a folder, through the same operators as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.recipes import recipe_rows
from ..sources.versioned import VersionedTable, property_defaults, valid_property


def document_stream(spark: SparkSession, folder: str, schema: str = "doc_id long, text string, arrived timestamp", files_a_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder, a bounded number a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def ingredient_stream(docs: DataFrame) -> DataFrame:
    """A row for each ingredient of each arriving document; stateless."""
    return recipe_rows(docs, "doc_id")


def arrivals(docs: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Documents in each window of arrival; windows close when ``late`` has passed."""
    return docs.withWatermark("arrived", late).groupBy(F.window("arrived", width)).agg(F.count(F.lit(1)).alias("documents"))


def started(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what has arrived as Parquet, each row once, and stops."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def property_arrivals(found: DataFrame, table: VersionedTable, checkpoint: str, name: str = "properties") -> StreamingQuery:
    """Adds arriving property rows of names that the table lacks, and stops when all that has arrived is in.

    A batch is one change of the table, named by the stream and the batch, so
    a batch that is tried again after a failure is made once.
    """

    def add(batch: DataFrame, k: int) -> None:
        table.appended(batch, f"{name}-{k}", property_defaults(), valid_property, "pos" if "pos" in batch.columns else None)

    return found.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
