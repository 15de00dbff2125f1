"""Language-model scoring by deleted interpolation.

The probability of a word after another is a mixture of three maximum-likelihood estimates: that of the pair, that of
the word, and the uniform one.  The weights depend on how often the first word was seen (buckets of powers of two).
They are learned by expectation-maximisation on pairs of a part of the training documents, the fold, with counts of
the others; the scores then use the counts of all training documents.

Counts are exchanged in blocks.  A task numbers the words of some 8 MB of text at a time (a batch) and sends each
different word and pair once, as sorted 64-bit hashes, to the part that counts this range of hashes; the part returns
the totals in the same order, and the batch looks them up by position.  So a frequent word costs one number per batch,
no table of counts is ever held whole, and parts and batches are bounded in size while their number grows with the
corpus.  Batches hold documents of one role: scored only, fold, or kept.

Words are told apart by 64-bit hashes; pairs by as many bits as the corpus needs for a chance below 2 ** -SPARE_BITS
that a pair is counted with another.

Defined results: a null or empty text is its end alone.  A null id belongs to the kept training documents.  Rows are
never merged; repeated rows count as often as they come.  A corpus without training tokens gives every token the
uniform probability.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import drop_folder, new_folder, partitions, read_table, staged

SCORED, FOLD, KEPT = 0, 1, 2
START, END = (xxhash.xxh64_intdigest(x) for x in (b" ", b"\n"))  # neither can be a word
SPARE_BITS = 24
_M = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class ScoringRules:
    folds: int = 7
    held_out: int = 2
    fold: int = 3
    batch_bytes: int = 8_000_000
    part_bytes: int = 8_000_000
    rounds: int = 20
    tolerance: float = 1e-4


# Sorted numbers and counts as compressed planes of bytes.

def _pack(a: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).reshape(n)


def _pack_sorted(a: np.ndarray) -> bytes:
    return _pack(np.diff(a, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(data, n, np.uint64), dtype=np.uint64)


def _part_of(h: np.ndarray, bits: int, parts: int) -> np.ndarray:
    return ((h >> np.uint64(bits - 32)) * np.uint64(parts)) >> np.uint64(32)


def _sequence(words: np.ndarray, lengths: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(previous, present) word of every token: all words of a text and its end."""
    ends = np.cumsum(lengths + 1) - 1
    present = np.empty(len(words) + len(lengths), words.dtype)
    is_end = np.zeros(len(present), bool)
    is_end[ends] = True
    present[is_end], present[~is_end] = end, words
    previous = np.empty_like(present)
    previous[1:] = present[:-1]
    previous[ends - lengths] = start
    return previous, present


def _pair_hashes(hashes: np.ndarray, previous: np.ndarray, present: np.ndarray, bits: int) -> np.ndarray:
    h = hashes[previous] * _M
    h = (h ^ (h >> np.uint64(32))) + hashes[present]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) >> np.uint64(64 - bits)


class _Batch:
    """Documents of one role whose words are numbered together."""

    def __init__(self, role: int):
        self.role, self.size = role, 0
        self.numbers: dict[bytes, int] = {}
        self.ids, self.lengths, self.words = [], [], []

    def add(self, id_, text: bytes) -> None:
        numbers = self.numbers
        found = np.array([numbers.setdefault(w, len(numbers)) for w in text.lower().split()], np.int32)
        self.ids.append(id_)
        self.lengths.append(len(found))
        self.words.append(found)
        self.size += len(text) + 64

    def rows(self, key: int, bits: int, parts: int):
        """One row for the batch itself, and one for each part that has words or pairs of it."""
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.numbers] + [START, END], np.uint64)
        hashes, new = np.unique(hashes, return_inverse=True)
        start, end = (int(np.searchsorted(hashes, np.uint64(x))) for x in (START, END))
        words = new.astype(np.int32)[np.concatenate(self.words)] if self.words else np.zeros(0, np.int32)
        lengths = np.array(self.lengths, np.int32)
        previous, present = _sequence(words, lengths, start, end)
        once = np.bincount(present, minlength=len(hashes))
        once[start] = len(lengths)
        pairs, twice = np.unique(_pair_hashes(hashes, previous, present, bits), return_counts=True)
        yield {"kind": 0, "batch": key, "part": None, "role": self.role, "ids": self.ids, "n1": len(hashes),
               "n2": len(words), "a": _pack_sorted(hashes), "b": _pack(words), "c": lengths.tobytes(), "d": None}
        of1, of2 = _part_of(hashes, 64, parts), _part_of(pairs, bits, parts)
        touched = np.union1d(of1, of2)  # never more than the batch has words and pairs, however many parts there are
        edges = [np.searchsorted(of, touched, side) for of in (of1, of2) for side in ("left", "right")]
        for p, x0, x1, y0, y1 in zip(touched.tolist(), *(e.tolist() for e in edges)):
            x, y = slice(x0, x1), slice(y0, y1)
            yield {"kind": 1, "batch": key, "part": p, "role": self.role, "ids": None, "n1": x1 - x0, "n2": y1 - y0,
                   "a": _pack_sorted(hashes[x]), "b": _pack_sorted(pairs[y]),
                   "c": _pack(once[x].astype(np.uint32)), "d": _pack(twice[y].astype(np.uint32))}


def _batches(docs: DataFrame, bits: int, parts: int, rules: ScoringRules) -> DataFrame:
    """Rows of ``_Batch.rows`` from (id, role, text)."""
    id_type = docs.schema["id"].dataType.simpleString()
    schema = (f"kind int, batch bigint, part int, role int, ids array<{id_type}>, n1 int, n2 int, a binary, b binary, "
              "c binary, d binary")
    columns = [("kind", pa.int32()), ("batch", pa.int64()), ("part", pa.int32()), ("role", pa.int32()), ("ids", None),
               ("n1", pa.int32()), ("n2", pa.int32())] + [(c, pa.binary()) for c in "abcd"]

    def run(inputs):
        base, n, open_ = TaskContext.get().partitionId() << 24, 0, {}
        form = None
        for batch in inputs:
            form = pa.schema([(c, t or pa.list_(batch.schema.field(0).type)) for c, t in columns])
            for id_, role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       batch.column(2).cast(pa.binary())):
                own = open_.setdefault(role, _Batch(role))
                own.add(id_, text.as_py() or b"")
                if own.size >= rules.batch_bytes:
                    for row in open_.pop(role).rows(base + n, bits, parts):
                        yield pa.RecordBatch.from_pylist([row], form)
                    n += 1
        for own in open_.values():
            for row in own.rows(base + n, bits, parts):
                yield pa.RecordBatch.from_pylist([row], form)
            n += 1

    return docs.select("id", "role", "text").mapInArrow(run, schema)


def _totals(table: pa.Table) -> pa.Table:
    """Count one part: the totals of each batch's words and pairs, in the batch's order, and the part's sums."""
    rows = table.to_pylist()
    out = {k: [] for k in ("batch", "part", "role", "words", "pairs", "kept_words", "kept_pairs", "tokens", "types",
                           "kept_tokens", "kept_types")}
    answers = []
    for h, n, c in (("a", "n1", "c"), ("b", "n2", "d")):
        lists = [_unpack_sorted(r[h], r[n]) for r in rows]
        counts = [_unpack(r[c], r[n], np.uint32).astype(np.int64) for r in rows]
        every = np.unique(np.concatenate(lists))
        kept, fold = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
        places = [np.searchsorted(every, x) for x in lists]
        for r, at, k in zip(rows, places, counts):
            if r["role"] != SCORED:
                (fold if r["role"] == FOLD else kept)[at] += k  # a batch has each hash once
        answers.append((kept + fold, kept, places))
        if h == "a":
            real = every != np.uint64(START)
            sums = [int((kept + fold)[real].sum()), int(((kept + fold)[real] > 0).sum()), int(kept[real].sum()),
                    int((kept[real] > 0).sum())]
    for i, r in enumerate(rows):
        (all1, kept1, at1), (all2, kept2, at2) = answers
        out["batch"].append(r["batch"])
        out["part"].append(r["part"])
        out["role"].append(r["role"])
        out["words"].append(_pack(all1[at1[i]]))
        out["pairs"].append(_pack(all2[at2[i]]))
        is_fold = r["role"] == FOLD
        out["kept_words"].append(_pack(kept1[at1[i]]) if is_fold else None)
        out["kept_pairs"].append(_pack(kept2[at2[i]]) if is_fold else None)
        for name, value in zip(("tokens", "types", "kept_tokens", "kept_types"), sums):
            out[name].append(value if i == 0 else 0)
    out["n1"], out["n2"] = [r["n1"] for r in rows], [r["n2"] for r in rows]
    return pa.table(out, schema=_TOTALS)


_TOTALS = pa.schema([("batch", pa.int64()), ("part", pa.int32()), ("role", pa.int32()), ("words", pa.binary()),
                     ("pairs", pa.binary()), ("kept_words", pa.binary()), ("kept_pairs", pa.binary()),
                     ("tokens", pa.int64()), ("types", pa.int64()), ("kept_tokens", pa.int64()),
                     ("kept_types", pa.int64()), ("n1", pa.int32()), ("n2", pa.int32())])
_TOTALS_SQL = ("batch bigint, part int, role int, words binary, pairs binary, kept_words binary, kept_pairs binary, "
               "tokens bigint, types bigint, kept_tokens bigint, kept_types bigint, n1 int, n2 int")


def _looked_up(batch: pa.Table, totals: pa.Table, bits: int, words: str, pairs: str):
    """(counts of word, previous word and pair of every token, lengths of the texts, ids) of one batch."""
    row = batch.to_pylist()[0]
    answers = sorted(totals.to_pylist(), key=lambda r: r["part"])
    c1 = np.concatenate([_unpack(r[words], r["n1"], np.int64) for r in answers])
    c2 = np.concatenate([_unpack(r[pairs], r["n2"], np.int64) for r in answers])
    hashes = _unpack_sorted(row["a"], row["n1"])
    lengths = np.frombuffer(row["c"], np.int32)
    start, end = (int(np.searchsorted(hashes, np.uint64(x))) for x in (START, END))
    previous, present = _sequence(_unpack(row["b"], row["n2"], np.int32), lengths, start, end)
    _, inverse = np.unique(_pair_hashes(hashes, previous, present, bits), return_inverse=True)
    return c1[present], c1[previous], c2[inverse], lengths, row["ids"]


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else 1 + the whole part of the binary logarithm of the count."""
    return np.frexp(context.astype(np.float64))[1]


def learn_weights(pairs: DataFrame, tokens: int, types: int, rules: ScoringRules) -> np.ndarray:
    """Weights (pair, word, uniform) of every bucket by expectation-maximisation.

    ``pairs`` has (bucket, c2, context, c1, n): how many tokens of the fold have these counts.  Each round is one
    aggregate; a row for each bucket, 64 at most, reaches the driver.
    """
    weights = np.tile(np.array([1 / 3, 1 / 3, 1 / 3]), (65, 1))
    weights[0] = [0.0, 0.5, 0.5]
    before = -math.inf
    for _ in range(rules.rounds):
        given = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in weights])
        w = F.get(given, F.col("bucket"))
        terms = [F.get(w, F.lit(0)) * F.when(F.col("context") > 0, F.col("c2") / F.col("context")).otherwise(0.0),
                 F.get(w, F.lit(1)) * F.col("c1") / max(tokens, 1), F.get(w, F.lit(2)) / (types + 1)]
        df = pairs.select("bucket", "n", *[t.alias(f"p{i}") for i, t in enumerate(terms)]).withColumn(
            "p", F.col("p0") + F.col("p1") + F.col("p2"))
        sums = df.groupBy("bucket").agg(*[F.sum(F.col("n") * F.col(f"p{i}") / F.col("p")).alias(f"s{i}") for i in
                                          range(3)], F.sum(F.col("n") * F.log("p")).alias("l"),
                                        F.sum("n").alias("n")).collect()
        if not sums:
            break
        for r in sums:
            weights[r["bucket"]] = np.array([r["s0"], r["s1"], r["s2"]]) / r["n"]
        likelihood = sum(r["l"] for r in sums) / sum(r["n"] for r in sums)
        if likelihood - before < rules.tolerance:
            break
        before = likelihood
    # No weight is nought for the uniform part, so that every word keeps a chance.
    weights = np.maximum(weights, [[0.0, 1e-6, 1e-6]])
    return weights / weights.sum(axis=1, keepdims=True)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    rules: ScoringRules = ScoringRules()) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    if docs.isEmpty():
        return spark.createDataFrame([], _result(id_col, docs.schema[id_col].dataType.simpleString()))
    fold = F.coalesce(F.crc32(F.col(id_col).cast("string")) % rules.folds, F.lit(-1))
    source = docs.select(F.col(id_col).alias("id"), F.when(fold == rules.held_out, SCORED).when(
        fold == rules.fold, FOLD).otherwise(KEPT).alias("role"), F.col(text).alias("text"))
    n_bytes = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    parts = max(partitions(spark), n_bytes // rules.part_bytes)
    bits = min(64, max(40, int(n_bytes).bit_length() + SPARE_BITS))
    folder = new_folder(spark, "interpolation")
    _batches(source, bits, parts, rules).write.partitionBy("kind").parquet(folder)
    batches = spark.read.parquet(f"{folder}/kind=0")
    sent = spark.read.parquet(f"{folder}/kind=1")
    totals = staged(sent.groupBy("part").applyInArrow(_totals, _TOTALS_SQL), "interpolation-totals")
    drop_folder(spark, f"{folder}/kind=1")
    sums = totals.agg(*[F.sum(c).alias(c) for c in ("tokens", "types", "kept_tokens", "kept_types")]).first()
    id_type = source.schema["id"].dataType.simpleString()

    def fold_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        c1, context, c2, _, _ = _looked_up(left, right, bits, "kept_words", "kept_pairs")
        rows, n = np.unique(np.stack([c2, context, c1], axis=1), axis=0, return_counts=True)
        return pa.table({"bucket": pa.array(bucket_of(rows[:, 1]), pa.int32()), "c2": rows[:, 0], "context": rows[:, 1],
                         "c1": rows[:, 2], "n": n})

    pairs = batches.where(F.col("role") == FOLD).groupBy("batch").cogroup(
        totals.where(F.col("role") == FOLD).groupBy("batch")).applyInArrow(
        fold_pairs, "bucket int, c2 bigint, context bigint, c1 bigint, n bigint")
    pairs = staged(pairs.groupBy("bucket", "c2", "context", "c1").agg(F.sum("n").alias("n")), "interpolation-fold")
    weights = learn_weights(pairs, sums["kept_tokens"], sums["kept_types"], rules)
    tokens, types = sums["tokens"], sums["types"]

    def scores(left: pa.Table, right: pa.Table) -> pa.Table:
        c1, context, c2, lengths, ids = _looked_up(left, right, bits, "words", "pairs")
        bucket = bucket_of(context)
        p = weights[:, 0][bucket] * c2
        p /= np.maximum(context, 1)
        p += weights[:, 1][bucket] * (c1 / max(tokens, 1))
        p += (weights[:, 2] / (types + 1))[bucket]
        firsts = np.cumsum(lengths + 1) - lengths - 1
        n = lengths + 1
        held = left.column("role")[0].as_py() == SCORED
        per = [np.add.reduceat(x, firsts) for x in (
            (c1 > 0).astype(np.int64), np.log10((c1 + 1) / (tokens + types + 1)), np.log10(p))]
        return pa.table({id_col: pa.array(ids, left.schema.field("ids").type.value_type),
                         "held_out": pa.array([held] * len(ids), pa.bool_()), "n_tokens": pa.array(n, pa.int64()),
                         "n_known": per[0], "train_tokens": pa.array([tokens] * len(ids), pa.int64()),
                         "base_score": per[1], "score": per[2]})

    return batches.groupBy("batch").cogroup(totals.groupBy("batch")).applyInArrow(scores, _result(id_col, id_type))


def _result(id_col: str, id_type: str) -> str:
    return (f"`{id_col}` {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double")


def op6(spark, folder: str) -> DataFrame:
    return score_documents(read_table(spark, folder, "documents"))
