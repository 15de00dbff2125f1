"""What several operators of this folder share."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.session import cut_lineage, shared_folder

# A word is a run of anything but these six characters.
GAP = r"[\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def free_prefix(*frames: DataFrame) -> str:
    """A prefix that no column of the frames starts with, for helper columns."""
    prefix, taken = "_", [c.lower() for f in frames for c in f.columns]
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    return prefix


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that its lineage ends there."""
    return cut_lineage(df, f"llm-{purpose}")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return shared_folder(spark, f"llm-{purpose}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a stage that no later job reads, through Spark's own file systems."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Bits of a bitmap over hashes: its size never depends on the data.
BITMAP_BITS = 1 << 22


def bitmap_of(df: DataFrame, column: str) -> np.ndarray:
    """A bitmap over a bigint column, as 64-bit words; 512 kB at most reach the driver, whatever the table's size.

    It lets tasks skip most rows before an exact join; a full one only lets more rows through.
    """
    bit = F.col(column).bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = df.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    out = np.zeros(BITMAP_BITS // 64, np.uint64)
    for word, bits in words.collect():
        out[word] = np.uint64(bits % (1 << 64))
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes.view(np.uint64) & np.uint64(BITMAP_BITS - 1)
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
