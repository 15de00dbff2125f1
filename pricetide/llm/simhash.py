"""SimHash near-duplicates by multi-index hashing.

Fingerprints are 64 majority bits over the XXH64 values of word shingles.  To find pairs within ``max_bits``, each
fingerprint is cut into ``segments``; two such fingerprints differ in at most ``max_bits // segments`` bits of at least
one segment.  So every fingerprint looks up the Hamming ball of that radius around each of its segments in a table of
segment values (an equi-join), and complete distances are checked inside the join.  Equal fingerprints meet before, so
that copies are never paired, and each pair of fingerprints is found from its smaller one.

Defined results: a null or blank text has fingerprint zero and is linked like any other.  Rows are never merged in
``near_duplicates``; repeated rows get the same component.  Rows with a null id take part and get the least id of
their component that is not null, or null.  Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import free_prefix, read_table, staged
from pricetide.llm.components import connected_components

BITS = 64
SEED = 42
_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint of a UTF-8 text, as an unsigned number."""
    # bytes.lower() and bytes.split() know A-Z and the six white characters only, which is what is wanted.
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    ends = starts[min(shingle, len(words)):] - 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _AT_ONCE):
        h = np.array([xxhash.xxh64_intdigest(line[s:e], SEED) for s, e in
                      zip(starts[at:at + _AT_ONCE].tolist(), ends[at:at + _AT_ONCE].tolist())], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fingerprint) of every row; the fingerprint's 64 bits as a bigint."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            values = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values, pa.int64())], names=[id_col, "fingerprint"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {id_type}, fingerprint bigint")


def _segments(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _value(fp: Column, shift: int, width: int) -> Column:
    mask = (1 << width) - 1
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def linked_fingerprints(fps: DataFrame, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct values in ``fps.fingerprint`` that differ in at most ``max_bits``.

    A pair may come once for each segment that shows it.
    """
    radius = max_bits // segments
    tables, probes = [], []
    fp = F.col("fingerprint")
    for i, (shift, width) in enumerate(_segments(segments)):
        flips = [sum(1 << x for x in c) for r in range(radius + 1) for c in combinations(range(width), r)]
        flips = [f - (1 << 64) if f >> 63 else f for f in flips]
        value = _value(fp, shift, width)
        tables.append(fps.select(F.lit(i).alias("segment"), value.alias("value"), fp.alias("b")))
        ball = F.transform(F.array(*[F.lit(f).cast("long") for f in flips]), lambda f: value.bitwiseXOR(f))
        probes.append(fps.select(F.lit(i).alias("segment"), F.explode(ball).alias("value"), fp.alias("a")))
    table, probe = tables[0], probes[0]
    for t, q in zip(tables[1:], probes[1:]):
        table, probe = table.union(t), probe.union(q)
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # Spark sizes the exploded balls like one row a fingerprint and would broadcast them: both sides are exchanged.
    return probe.hint("merge").join(table.hint("merge"), ["segment", "value"]).where(near).select("a", "b")


def _labelled(docs: DataFrame, id_col: str, text: str, shingle: int, max_bits: int, segments: int) -> DataFrame:
    """(id, digest, fingerprint, component_id, first) of every row: ``digest`` tells texts apart, ``component_id`` is the
    least id of the row's component, and ``first`` its first row as (no id, id, digest)."""
    named = docs.select(F.struct(F.col(id_col).alias("id"), F.md5(F.col(text).cast("binary")).alias("digest")).alias(
        "row"), F.col(text).alias("text"))
    rows = staged(fingerprints(named, "row", "text", shingle), "fingerprints").select("row.id", "row.digest", "fingerprint")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    distinct = staged(rows.groupBy("fingerprint").agg(F.min(order).alias("first")), "distinct-fingerprints")
    found = connected_components(linked_fingerprints(distinct, max_bits, segments))
    # Only fingerprints with links; the others are a component of their own.
    linked = staged(distinct.join(found, F.col("fingerprint") == F.col("node")).select(
        "fingerprint", "first", "component"), "linked-fingerprints")
    least = linked.groupBy("component").agg(F.min("first").alias("of_all"))
    moved = linked.join(least, "component").select(F.col("fingerprint").alias("node"), "of_all")
    label = distinct.join(moved, F.col("fingerprint") == F.col("node"), "left").select(
        F.col("fingerprint").alias("node"), F.coalesce("of_all", "first").alias("first"))
    # One row per fingerprint on the right; a fingerprint of many rows is split by Spark.
    return rows.join(label, F.col("fingerprint") == F.col("node")).select(
        "id", "digest", "fingerprint", F.col("first.id").alias("component_id"), "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3,
                    segments: int = 2) -> DataFrame:
    """(id, fingerprint, component_id) of every row; component_id is the least id reachable over links."""
    return _labelled(docs, id_col, text, shingle, max_bits, segments).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3,
             segments: int = 2) -> DataFrame:
    """``docs`` without all but one row of each component: the one with the least id, a null id last, and of rows with
    this id the one with the least digest of its text.  Of rows that share both, the one whose other columns have the
    least hash stays.  A row is judged by its own text: others with its id, or without an id, do not take it along.
    """
    p = free_prefix(docs)
    found = _labelled(docs, id_col, text, shingle, max_bits, segments)
    per = found.groupBy("id", "digest").agg(F.count("*").alias("n"), F.first("first").alias("first"))
    stays = F.col("id").eqNullSafe(F.col("first.id")) & F.col("digest").eqNullSafe(F.col("first.digest"))
    gone = per.where(~stays | (F.col("n") > 1)).select(
        F.col("id").alias(p + "id"), F.col("digest").alias(p + "of"), stays.alias(p + "again"))
    marked = docs.withColumn(p + "digest", F.md5(F.col(text).cast("binary"))).join(gone, F.col(id_col).eqNullSafe(
        F.col(p + "id")) & F.col(p + "digest").eqNullSafe(F.col(p + "of")), "left")
    whole = marked.where(F.col(p + "again").isNull()).select(*docs.columns)
    hashed = [F.col(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    again = marked.where(F.col(p + "again")).groupBy(p + "id", p + "digest").agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*hashed)).alias(p + "row")).select(p + "row.*")
    return whole.union(again)


def op2(spark, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)
