"""Batch and streaming sources."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricetide.sources.replay import RECORD_REPLAY, register_replay
from pricetide.sources.schemas import SALES, SALES_RENAMES, STAR


def standardise(raw: DataFrame, tag: str, years: str, renames: dict[str, str] = SALES_RENAMES) -> DataFrame:
    """One transaction source under the common column names and types, tagged with its origin."""
    df = raw.withColumnsRenamed(renames)
    typed = [
        (F.try_to_timestamp(F.col(f.name).cast("string")) if f.name == "invoice_date"
         else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        for f in SALES.fields if f.name in df.columns]
    return df.select(*typed).withColumns({"source": F.lit(tag), "dataset_year_range": F.lit(years)})


def load_source(spark: SparkSession, path: str, tag: str, years: str, fmt: str = "parquet",
                renames: dict[str, str] = SALES_RENAMES, **options) -> DataFrame:
    """Read a transaction source (CSV as text, typed afterwards, so that dirty cells become NULL)."""
    reader = spark.read.format(fmt).options(**({"header": True} if fmt == "csv" else {}), **options)
    return standardise(reader.load(path), tag, years, renames)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All sources under one schema by column name; a column a source lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_star(spark: SparkSession, paths: dict[str, str], fmt: str = "csv") -> dict[str, DataFrame]:
    """The nine marketplace tables under explicit schemas."""
    options = {"header": True, "timestampFormat": "yyyy-MM-dd HH:mm:ss"} if fmt == "csv" else {}
    return {name: spark.read.format(fmt).schema(STAR[name]).options(**options).load(path)
            for name, path in paths.items()}


def input_version(spark: SparkSession, *paths: str) -> str:
    """A digest of the names, sizes and times of all files of the inputs; it changes when one of them does."""
    told = []
    for path in paths:
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
        while files.hasNext():
            f = files.next()
            told.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(told)).encode()).hexdigest()[:16]


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], inputs: tuple[str, ...] = ()) -> DataFrame:
    """The stage at ``path``, built and written first where no finished one is there.

    A stage is finished once its job has left the success marker; one half written is built anew.  With ``inputs``
    there is one stage for each state of their files, so that a changed input is built from anew.
    """
    if inputs:
        path = f"{path}/inputs={input_version(spark, *inputs)}"
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def event_stream(spark: SparkSession, schema: StructType, fmt: str = "kafka", column: str = "value",
                 flush: int | None = None, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """A stream of JSON text records as columns; records that do not parse are left out.

    ``flush`` is the most records of a micro-batch: with ``flushed`` a batch ends at that number or at the trigger's
    time, whichever comes first.  Spark's own file formats admit whole files, so there it is a number of files.

    Kafka starts at the latest offset, as a live consumer does.  ``record_replay`` reads the lines of a folder and
    admits records, ``flushes`` times ``flush`` of them a micro-batch, numbered in its column ``flush``; other file formats
    serve tests.  ``keep`` names columns of the source to keep beside the parsed ones.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "latest", **options}
        if flush:
            options["maxOffsetsPerTrigger"] = flush
    elif fmt == RECORD_REPLAY:
        register_replay(spark)
        if flush:
            options["records"] = flush
    else:
        reader = reader.schema(f"{column} string")
        if flush:
            options["maxFilesPerTrigger"] = flush
    return parse_json(reader.options(**options).load(), schema, column, keep)


def parse_json(df: DataFrame, schema: StructType, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    strict = StructType([*schema.fields]).add("_bad", "string")
    parsed = F.from_json(F.col(column).cast("string"), strict,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return (df.withColumn("_e", parsed).filter(F.col("_e").isNotNull() & F.col("_e._bad").isNull())
            .select(*keep, "_e.*").drop("_bad"))
