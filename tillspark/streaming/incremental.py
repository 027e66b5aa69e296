"""Load new feed files in bounded batches, each at most once per key.

The stream's checkpoint remembers which files were read; the keyed insert makes a batch
that is repeated after a failure harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillspark.plans.curate import typed_feed
from tillspark.plans.warehouse import load_fact
from tillspark.session import staged, staging
from tillspark.sources.feeds import sales_reader


def stream_raw_sales(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, multi_line: bool = False
) -> DataFrame:
    """Invoice lines of new files as a stream; malformed lines keep their text."""
    return sales_reader(spark.readStream, multi_line).option("maxFilesPerTrigger", files_per_batch).csv(folder)


def load_stream(
    lines: DataFrame, warehouse: str, checkpoint: str, source_system: str = "RETAIL_FEED"
) -> StreamingQuery:
    """Curate and insert every batch that is available now, then stop.

    Malformed and rejected lines go to side tables, one folder per batch, so a repeated batch
    replaces its own lines.
    """

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staging(spark):
            feed = typed_feed(batch)
            for name, rows in (("malformed", feed.malformed()), ("rejected", feed.rejected())):
                rows.write.mode("overwrite").json(f"{warehouse}/{name}_lines/batch={batch_id}")
            curated = feed.curated(source_system, F.current_timestamp())
            # looked at twice, for its months and for its rows
            load_fact(spark, staged(curated, "curated-batch"), warehouse)

    return (
        lines.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
