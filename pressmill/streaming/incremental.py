"""New article files are cleaned as they arrive and appended to one table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pressmill import constants as C
from pressmill import schemas
from pressmill.operators.cleaning import processed_articles
from pressmill.sources.tables import csv_options, csv_schema, sound_rows


def article_stream(spark: SparkSession, path: str, schema: T.StructType = schemas.ARTICLE,
                   fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream over the files of a directory; CSV files carry a header line.

    CSV rows pass the same tests as in the batch reader.
    """
    csv = fmt == "csv"
    reader = spark.readStream.schema(csv_schema(schema) if csv else schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if csv:
        return sound_rows(reader.options(**csv_options(header=True)).load(path))
    return reader.load(path)


def incremental_clean(articles: DataFrame, output: str, checkpoint: str,
                      content: str = "content",
                      stop_words: Iterable[str] = C.STOP_WORDS) -> StreamingQuery:
    """Process all files that are there and stop; call again after new arrivals.

    The operators are the batch ones and keep no state. File source, checkpoint
    and Parquet sink together give each article exactly once, also when a run is
    cut off and restarted.
    """
    cleaned = processed_articles(articles, content, stop_words)
    return (
        cleaned.writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
