"""Stage, report and message sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

METRIC_BATCH = 20  # fixed value: metric datums per published batch
FLUSH_EVENTS, FLUSH_EVERY = 100, "500 milliseconds"  # fixed values: micro-batch flush


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def json_message(key: str, columns: list, name: str = "value") -> list[Column]:
    """A key and a JSON text, the two columns a message sink takes."""
    return [F.col(key).cast("string").alias("key"), F.to_json(F.struct(*columns)).alias(name)]


def order_event_json(sales: DataFrame) -> DataFrame:
    """Sales lines as canonical order events."""
    stamp = F.date_format("invoice_date", "yyyy-MM-dd'T'HH:mm:ss")
    return sales.select(*json_message("stock_code", [
        F.lit("order").alias("event_type"), "stock_code", "invoice_no", "quantity", "unit_price",
        "customer_id", "country", stamp.alias("timestamp")]))


def price_update_messages(decisions: DataFrame) -> DataFrame:
    """Decisions as price-update records keyed by SKU."""
    body = [c for c in decisions.columns if c not in ("sku_id", "timestamp")]
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss") if "timestamp" in decisions.columns \
        else F.lit(None).cast("string")
    return decisions.select(*json_message("sku_id", [
        "sku_id", F.col("final_price").alias("price"), F.struct(*body).alias("decision"),
        stamp.alias("timestamp")]))


def publish_updates(decisions: DataFrame, fmt: str = "kafka", **options) -> None:
    price_update_messages(decisions).write.format(fmt).mode("append").options(**options).save()


def commit_batch(df: DataFrame, path: str, batch: int | str, fmt: str = "json", partition_by: list[str] | None = None) -> None:
    """Write a batch as the folder of its number or name, in place of whatever an earlier try of it left.

    A micro-batch that is run again after a failure has the same number and, from the checkpoint, the same rows, so each
    is in the log once.  Numbers start at 0 with every new checkpoint: one log belongs to one checkpoint.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(f"{path}/commit={batch:010d}" if isinstance(batch, int) else f"{path}/commit={batch}")


def audit_log(decisions: DataFrame, path: str, batch: int | str) -> None:
    """Decisions as JSON under one folder per batch and date."""
    dated = decisions.withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
    commit_batch(dated, path, batch, partition_by=["date"])


def metric_rows(metrics: DataFrame, at: Column, dimensions: Column | None = None) -> DataFrame:
    """Long metric datums (name, value, unit, time, dimensions) of a one-row metric table."""
    names = [c for c, t in metrics.dtypes if t in ("double", "bigint", "int", "float")]
    wide = metrics.select(*[F.col(c).cast("double").alias(c) for c in names])
    empty = F.create_map().cast("map<string,string>")
    return wide.unpivot([], names, "name", "value").withColumns({
        "unit": F.lit("None"), "time": at, "dimensions": dimensions if dimensions is not None else empty})


def batch_metrics(rows: DataFrame, size: int = METRIC_BATCH) -> DataFrame:
    """Number the publishing batches of each metric time in name order."""
    w = Window.partitionBy("time").orderBy("name")
    return rows.withColumn("batch", F.floor((F.row_number().over(w) - 1) / F.lit(size)))


def metrics_sink(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    def commit(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch_metrics(batch), path, batch_id, "parquet")

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)


def report_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_metrics_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def flushed(writer: DataStreamWriter, every: str = FLUSH_EVERY) -> DataStreamWriter:
    """Micro-batches by time; ``event_stream(flush=FLUSH_EVENTS)`` ends them by number as well."""
    return writer.trigger(processingTime=every)
