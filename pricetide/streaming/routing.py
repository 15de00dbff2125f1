"""From window results to re-priced SKUs, and checkpointed queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pricetide.operators.feature_store import merge_live_context
from pricetide.operators.pricing import price_decision
from pricetide.sources.sinks import audit_log, batch_metrics, commit_batch, metric_rows, price_update_messages

CHECKPOINT_EVERY = "30 seconds"  # fixed value


def checkpointed(stream: DataFrame, checkpoint: str, mode: str = "append", every: str | None = CHECKPOINT_EVERY,
                 name: str | None = None) -> DataStreamWriter:
    """A query that restarts from its checkpoint.  Without ``every`` it takes what is there and stops."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.queryName(name) if name else writer


def reprice(windows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """New decisions for the SKUs of window results: demand is the newest count, the rest is the SKU's
    context (base_price, cost, msrp, customer_segment, is_flash_sale)."""
    newest = windows.groupBy("sku_id").agg(
        F.max_by(F.col("order_count").cast("double"), "window_end").alias("demand_score_7d"),
        F.max("window_end").alias("timestamp"))
    live = newest.select("sku_id", "demand_score_7d", F.lit(None).cast("double").alias("inventory_ratio"),
                         F.lit(None).cast("double").alias("competitor_price"))
    context = catalogue.join(newest.select("sku_id", "timestamp"), "sku_id")
    return price_decision(merge_live_context(context, live))


def decision_metrics(decisions: DataFrame) -> DataFrame:
    """Datums of one micro-batch: how many SKUs were priced, the mean price, and the newest window."""
    one = decisions.agg(F.count(F.lit(1)).alias("decisions"), F.avg("final_price").alias("mean_price"),
                        F.max("timestamp").alias("at")).filter("decisions > 0")
    return metric_rows(one.select("decisions", "mean_price"), one.select("at").scalar())


def route_to_pricing(windows: DataFrame, catalogue: DataFrame, audit_path: str, checkpoint: str,
                     publish: Callable[[DataFrame, int], None] | None = None, every: str | None = None,
                     metrics_path: str | None = None) -> DataStreamWriter:
    """Each micro-batch of closed windows is priced, logged and published.

    Log and metrics hold a batch once, however often it is run; ``publish`` gets the batch's number to do the same.
    """
    def price(batch: DataFrame, batch_id: int) -> None:
        decisions = reprice(batch, catalogue).select(
            "sku_id", "base_price", "final_price", "reasoning", "timestamp").persist()
        try:
            audit_log(decisions, audit_path, batch_id)
            if metrics_path:
                commit_batch(batch_metrics(decision_metrics(decisions)), metrics_path, batch_id, "parquet")
            if publish:
                publish(price_update_messages(decisions), batch_id)
        finally:
            decisions.unpersist()

    writer = windows.writeStream.foreachBatch(price).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def run_to_files(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Take all that is available, write it as Parquet and stop."""
    checkpointed(stream, checkpoint, mode, every=None).format("parquet").option("path", path).start().awaitTermination()


def forget_commit(spark: SparkSession, checkpoint: str) -> None:
    """Make the newest micro-batch of a stopped query count as unfinished, so that the next start runs it again: what
    a driver leaves that dies after the sink and before the commit."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    newest = max((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().isdigit()),
                 key=lambda path: int(path.getName()))
    fs.delete(newest, False)
