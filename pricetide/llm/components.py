"""Connected components with DataFrame operations: alternating large and small stars.

Every round writes its edges to the shared folder; nothing is gathered on the driver but a count and a checksum.
The minima are written as well, so that both sides of the joins are plain exchanges, which Spark can split where a
hub has most of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import drop_folder, new_folder


ROWS_A_FILE = 200_000


class _Steps:
    """Tables of the rounds; each goes once the next is written."""

    def __init__(self, spark):
        self.spark, self.root, self.n, self.old = spark, new_folder(spark, "components"), 0, []

    def write(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """``rows`` bounds the rows of the table, so that a small one does not end in many files."""
        self.n += 1
        if rows is not None:
            df = df.coalesce(1 + rows // ROWS_A_FILE)
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        self.old.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_last(self) -> None:
        for path in self.old[:-1]:
            drop_folder(self.spark, path)
        self.old = self.old[-1:]


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["x"], row["s"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge that is not a loop; component is the least node reachable.

    Nodes may be of any ordered type.  Edges with a null end, loops and repeated edges are ignored; no edges give no
    rows.
    """
    spark = edges.sparkSession
    steps = _Steps(spark)
    ends = edges.select(F.greatest(F.col(a), F.col(b)).alias("a"), F.least(F.col(a), F.col(b)).alias("b"),
                        (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("whole"))
    e = ends.where("whole and a != b").select("a", "b")
    e = steps.write(e.distinct())
    state = _state(e)
    while state[0]:
        # Large star: every larger neighbour of a node goes to the least of the node and its neighbours.
        both = e.union(e.select("b", "a"))
        least = steps.write(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
                            2 * state[0])
        e = steps.write(both.where("b > a").join(least, "a").where("b != m")
                        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), state[0])
        # Small star: a node and its smaller neighbours go to the least of those.
        least = steps.write(e.groupBy("a").agg(F.min("b").alias("b")), state[0])
        rest = e.join(least.select("a", F.col("b").alias("m")), "a").where("b != m") \
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = steps.write(least.union(rest).distinct(), state[0])
        steps.keep_last()
        before, state = state, _state(e)
        if state == before:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
