"""Conversation prefix trie from padded turn-id matrices.

A conversation is its turns, each told apart by the 128 bits of its digest; a node of depth d is a different sequence
of the first d turns.  Conversations are dealt into shards by ranges of (sequence, id), so that a group of copies of
any size is cut by its ids.  In a shard the turns are numbered, and the sequences lie as rows of matrices that are
padded with zeros, ``COLUMNS`` turns wide at a time (longer ones go on in the next matrix, with the rows that have
more).  ``numpy.lexsort`` orders them; the changes from row to row, OR-accumulated along the columns, mark where nodes
start; and ``reduceat`` over those starts counts every depth, from the deepest up.

Nodes that hold the first or the last row of a shard may go on in the next one.  Of these, shards give parts: counts of
members add up, and what two neighbours both count - the sequence that the last row of one and the first row of the
other begin with - is taken off again, by one small row per depth.  All other nodes are complete.  Ids of members that
end in a shared node are hashed as a stream, in order, from chunks of joined numbers.

Defined results: rows with a null conversation id belong to no conversation and are left out.  Null role and text are
empty.  Turns are ordered by number, null first; equal numbers, and repeated rows, by the digest of role and text, and
all of them count.  A conversation without turns is a member of the root.  Other columns are not read.  An empty table
has no conversation and gives no node.  A conversation's digests (24 bytes a turn, without its texts) are one row.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import partitions, read_table, staged

COLUMNS = 32
CHUNK_IDS = 50_000
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
NO_ENDS = hashlib.sha256(b"").hexdigest()
COMPLETE, PART, EDGE, ENDS = 0, 1, 2, 3
_FIELDS = [("kind", pa.int8(), "tinyint"), ("key", pa.binary(), "binary"), ("parent_key", pa.binary(), "binary"),
           ("conv_id", pa.int64(), "bigint"), ("depth", pa.int64(), "bigint"), ("parent_conv_id", pa.int64(), "bigint"),
           ("n_convs", pa.int64(), "bigint"), ("n_children", pa.int64(), "bigint"), ("n_leaves", pa.int64(), "bigint"),
           ("saved_tokens", pa.int64(), "bigint"), ("ends_sha256", pa.string(), "string"),
           ("first", pa.binary(), "binary"), ("last", pa.binary(), "binary"),
           ("sizes", pa.list_(pa.int64()), "array<bigint>"), ("ids", pa.binary(), "binary")]
_SCHEMA = ", ".join(f"{name} {kind}" for name, _, kind in _FIELDS)


@dataclass(frozen=True)
class TrieRules:
    shard_turns: int = 200_000


def turn_paths(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """(conv_id, turns): for each conversation its ordered turns as (digest, size), size in bytes of UTF-8."""
    said_by, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    one = F.struct(F.col(turn).alias("turn"), F.md5(F.concat(F.length(said_by).cast("string"), F.lit(":"), said_by, said))
                   .alias("digest"), F.octet_length(said).cast("long").alias("size"))
    rows = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), one.alias("one"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size"))).alias("turns"))


def rebuilt_paths(paths: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, turns): conversation c begins with the first h turns of c - c % ``family``, then come its own after
    the first h; h is the CRC32 of its number modulo ``most``."""
    shared = F.col("conv_id") - F.col("conv_id") % family
    own = paths.select("conv_id", "turns", shared.alias("base"),
                       (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h"))
    heads = paths.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(heads, "base", "left").select(
        "conv_id", F.when(head.isNull(), rest).otherwise(F.concat(head, rest)).alias("turns"))


class _Shard:
    """The conversations of one range, ordered, with what each has in common with the one before."""

    def __init__(self, conv: np.ndarray, path: list[bytes], sizes: list):
        length = np.array([len(p) // 16 for p in path], np.int64)
        flat = np.frombuffer(b"".join(path), ">u8").astype(np.uint64).reshape(-1, 2)
        start = np.cumsum(length) - length
        by_digest = np.lexsort((flat[:, 1], flat[:, 0]))
        new = np.ones(len(flat), np.int64)
        new[1:] = (flat[by_digest][1:] != flat[by_digest][:-1]).any(axis=1)
        self.turn = np.zeros(len(flat) + 1, np.int32)  # numbers of turns from 1, in the order of their digests
        self.turn[by_digest] = np.cumsum(new)
        self.start, self.length = start, length
        order = np.lexsort((conv, self._classes()))
        self.path, self.conv = [path[i] for i in order.tolist()], conv[order]
        self.start, self.length = start[order], length[order]
        self.sizes = np.concatenate([np.asarray(s, np.int64) for s in sizes]) if len(flat) else np.zeros(1, np.int64)
        self.common = self._common()

    def _matrix(self, rows: np.ndarray, column: int, width: int) -> np.ndarray:
        """Turn numbers of the rows from a column on; 0 behind a conversation's end."""
        at = column + np.arange(width)
        inside = at < self.length[rows][:, None]
        return np.where(inside, self.turn[np.where(inside, self.start[rows][:, None] + at, 0)], 0)

    def _blocks(self):
        most = int(self.length.max(initial=0))
        for column in range(0, most, COLUMNS):
            yield column, min(COLUMNS, most - column)

    def _classes(self) -> np.ndarray:
        """A number per conversation, equal for equal sequences and in their order."""
        found = np.zeros(len(self.length), np.int64)
        for column, width in self._blocks():
            alive = np.flatnonzero(self.length > column)
            m = self._matrix(alive, column, width)
            order = np.lexsort((*m.T[::-1], found[alive]))
            m, rows = m[order], alive[order]
            new = (m[1:] != m[:-1]).any(axis=1) | (found[rows][1:] != found[rows][:-1])
            here = np.zeros(len(found), np.int64)
            here[rows] = np.concatenate([[1], 1 + np.cumsum(new)])
            order = np.lexsort((here, found))
            new = (here[order][1:] != here[order][:-1]) | (found[order][1:] != found[order][:-1])
            again = np.zeros_like(found)
            again[order] = np.concatenate([[0], np.cumsum(new)])
            found = again
        return found

    def _common(self) -> np.ndarray:
        """How many first turns each row shares with the row before; -1 for the first row."""
        out = np.zeros(len(self.length), np.int64)
        both = np.minimum(self.length[1:], self.length[:-1])
        rows = np.arange(1, len(out))
        for column, width in self._blocks():
            rows = rows[both[rows - 1] > column]
            changed = self._matrix(rows, column, width) != self._matrix(rows - 1, column, width)
            same = width - np.logical_or.accumulate(changed, axis=1).sum(axis=1)
            out[rows] += np.minimum(same, both[rows - 1] - column)
            rows = rows[same == width]
        out[:1] = -1
        return out

    def levels(self):
        """One dict of arrays per depth, the deepest first: a value for each node."""
        most = int(self.length.max(initial=0))
        longest = np.argsort(-self.length, kind="stable")
        held = np.searchsorted(-self.length[longest], -np.arange(most + 1), side="right")
        below = None
        for d in range(most, -1, -1):
            alive = np.sort(longest[:held[d]])
            at = np.flatnonzero(self.common[alive] < d)
            first = alive[at]
            n = np.diff(np.append(at, len(alive)))
            size = self.sizes[self.start[first] + d - 1] if d else np.zeros(len(first), np.int64)
            node = {"depth": d, "first": first, "n_convs": n, "conv_id": np.minimum.reduceat(self.conv[alive], at),
                    "ends": np.add.reduceat((self.length[alive] == d).astype(np.int64), at),
                    "n_children": np.zeros(len(first), np.int64), "n_leaves": np.zeros(len(first), np.int64),
                    "saved_tokens": (n - 1) * size, "last": alive[np.append(at[1:], len(alive)) - 1]}
            if below is not None:
                up = np.searchsorted(first, below["first"], side="right") - 1
                below["parent"], below["parent_last"] = first[up], node["last"][up]
                below["parent_conv_id"] = node["conv_id"][up]
                node["n_children"] = np.bincount(up, minlength=len(first))
                np.add.at(node["n_leaves"], up, below["n_leaves"])
                np.add.at(node["saved_tokens"], up, below["saved_tokens"])
                node["n_leaves"] += node["n_children"] == 0
                yield below
            else:
                node["n_leaves"] += 1
            below = node
        yield below


def _keys(path: bytes) -> list[bytes]:
    """The key of every prefix of a sequence, the empty one included."""
    h = hashlib.md5()
    out = [h.digest()]
    for i in range(0, len(path), 16):
        h.update(path[i:i + 16])
        out.append(h.digest())
    return out


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _record(**columns) -> pa.RecordBatch:
    n = len(columns["kind"])
    return pa.RecordBatch.from_arrays([pa.array(columns.get(name, [None] * n), kind) for name, kind, _ in _FIELDS],
                                      names=[name for name, _, _ in _FIELDS])


def _shard_rows(shard: _Shard):
    """Record batches: complete nodes, parts of nodes at the edges, the edges, and ids that end in the latter."""
    end = len(shard.conv) - 1
    keys = _keys(shard.path[0]), _keys(shard.path[end])
    for node in shard.levels():
        d, first, last = node["depth"], node["first"], node["last"]
        side = np.where(first == 0, 0, np.where(last == end, 1, -1))  # whose path an edge node lies on
        parent_key = [None] * len(first)
        if d:  # a parent that holds the first or the last row is an edge node too
            on_first, on_last = node["parent"] == 0, node["parent_last"] == end
            parent_key = [keys[0][d - 1] if x else keys[1][d - 1] if y else None
                          for x, y in zip(on_first.tolist(), on_last.tolist())]
        key = [keys[s][d] if s >= 0 else None for s in side.tolist()]
        digests = []
        for i, (a, n, s) in enumerate(zip(first.tolist(), node["ends"].tolist(), side.tolist())):
            ids = shard.conv[a:a + n]  # members that end here come first
            if s < 0:
                digests.append(hashlib.sha256(_joined(ids)).hexdigest() if n else NO_ENDS)
                continue
            digests.append(None)
            for at in range(0, n, CHUNK_IDS):
                part = ids[at:at + CHUNK_IDS]
                yield _record(kind=[ENDS], key=[key[i]], conv_id=[int(part[0])], ids=[_joined(part)])
        for a in range(0, len(first), 20_000):
            cut = slice(a, a + 20_000)
            yield _record(kind=np.where(side[cut] >= 0, PART, COMPLETE).astype(np.int8), key=key[cut],
                          parent_key=parent_key[cut], conv_id=node["conv_id"][cut],
                          depth=np.full(len(first[cut]), d, np.int64),
                          parent_conv_id=[p if k is None else None for p, k in zip(
                              node["parent_conv_id"][cut].tolist(), parent_key[cut])] if d else [None] * len(first[cut]),
                          n_convs=node["n_convs"][cut], n_children=node["n_children"][cut],
                          n_leaves=node["n_leaves"][cut], saved_tokens=node["saved_tokens"][cut],
                          ends_sha256=digests[cut])
    n = int(shard.length[0])
    yield _record(kind=[EDGE], conv_id=[int(shard.conv[0])], first=[shard.path[0]], last=[shard.path[end]],
                  sizes=[shard.sizes[shard.start[0]:shard.start[0] + n]])


def _shards(paths: DataFrame, count: int) -> DataFrame:
    digests = F.transform("turns", lambda x: x["digest"])
    rows = paths.select("conv_id", F.unhex(F.array_join(digests, "")).alias("path"),
                        F.transform("turns", lambda x: x["size"]).alias("sizes"))

    def run(batches):
        conv, path, sizes = [], [], []
        for batch in batches:
            conv.append(batch.column(0).to_numpy())
            path += batch.column(1).to_pylist()
            flat = batch.column(2).flatten().to_numpy()
            offsets = np.cumsum([0] + [len(p) // 16 for p in path[len(path) - batch.num_rows:]]).tolist()
            sizes += [flat[a:b] for a, b in zip(offsets, offsets[1:])]
        if path:
            yield from _shard_rows(_Shard(np.concatenate(conv), path, sizes))

    return rows.repartitionByRange(count, "path", "conv_id").mapInArrow(run, _SCHEMA)


def _counted_twice(edges: DataFrame) -> DataFrame:
    """What two neighbours both count, as rows to add up: one per depth of the sequence that they share.

    There is one edge row per shard, as many as the stage before had tasks.
    """
    before = F.lag("last").over(Window.orderBy("first", "conv_id"))
    pairs = edges.select("first", "sizes", before.alias("before")).where("before is not null")

    def run(batches):
        for batch in batches:
            rows = []
            for first, sizes, last in zip(*(c.to_pylist() for c in batch.columns)):
                most = min(len(first), len(last)) // 16
                a, b = (np.frombuffer(x[:16 * most], np.uint8).reshape(-1, 16) for x in (first, last))
                differ = np.flatnonzero((a != b).any(axis=1))
                depth = int(differ[0]) if len(differ) else most
                size = np.array([0, *sizes[:depth]], np.int64)
                twice = np.cumsum(size[::-1])[::-1]  # of the shared nodes from each depth on
                leaf = -1 if len(last) == 16 * depth else 0  # a leaf there goes on here
                keys = _keys(first[:16 * depth])
                rows += [(k, 0, -1 if d < depth else 0, leaf, int(t)) for d, (k, t) in enumerate(zip(keys, twice))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate([pa.binary()] + [pa.int64()] * 4)],
                names=["key", "n_convs", "n_children", "n_leaves", "saved_tokens"])

    return pairs.mapInArrow(run, "key binary, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint")


def _digests(chunks: DataFrame) -> DataFrame:
    """(key, digest): the ids of each key hashed in their order, a chunk at a time."""
    def run(batches):
        key = h = None
        for batch in batches:
            rows = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if h is not None:
                        rows.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256(ids)
                else:
                    h.update(b"," + ids)
            yield _two(rows)
        yield _two([] if h is None else [(key, h.hexdigest())])

    def _two(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                           pa.array([r[1] for r in rows], pa.string())], names=["key", "digest"])

    return chunks.select("key", "conv_id", "ids").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(
        run, "key binary, digest string")


def prefix_trie(paths: DataFrame, n_turns: int, rules: TrieRules = TrieRules()) -> DataFrame:
    """The nodes of the trie of (conv_id, turns), as ``RESULT`` names them; ``n_turns`` bounds the turns of all."""
    count = max(partitions(paths.sparkSession), -(-n_turns // rules.shard_turns))
    found = staged(_shards(paths, count), "trie-shards")
    parts = found.where(F.col("kind") == PART)
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    twice = _counted_twice(found.where(F.col("kind") == EDGE))
    edge = parts.select("key", *sums, "parent_key", "conv_id", "depth").unionByName(twice, allowMissingColumns=True).groupBy(
        "key").agg(*[F.sum(c).alias(c) for c in sums], F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
                   F.max("parent_key").alias("parent_key"))
    digests = _digests(found.where(F.col("kind") == ENDS))
    edge = staged(edge.join(digests, "key", "left").select(
        "key", "parent_key", "conv_id", "depth", *sums, F.coalesce("digest", F.lit(NO_ENDS)).alias("ends_sha256")), "trie-edges")
    complete = found.where(F.col("kind") == COMPLETE)
    own = [c for c in RESULT if c != "parent_conv_id"]
    # Nodes below an edge node learn its least member from the few edge nodes; the others know it already.
    below = complete.where("parent_key is not null").select("parent_key", *own).unionByName(
        edge.where("parent_key is not null").select("parent_key", *own))
    above = edge.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return below.join(above, "parent_key", "left").select(*RESULT).unionByName(
        complete.where("parent_key is null").select(*RESULT)).unionByName(
        edge.where("parent_key is null").select(*own, F.lit(None).cast("long").alias("parent_conv_id")).select(*RESULT))


def op13(spark, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations")
    paths = staged(turn_paths(turns), "turn-paths")
    return prefix_trie(rebuilt_paths(paths), turns.count())


def trie_sql(family: int = 5, most: int = 9) -> str:
    """DuckDB SQL for ``op13``: every node's members are listed, and every node is added to all its ancestors."""
    step = "lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end"
    crc = (f"xor(list_reduce(list_transform(string_split(c::varchar, ''), lambda x: ord(x)::bigint), lambda s, x: "
           f"list_reduce(range(8), {step}, xor(s, x)), 4294967295::bigint), 4294967295)")
    return rf"""
with said as (select conv_id c, turn, coalesce(role, '') r, coalesce(text, '') t from conversations
    where conv_id is not null),
turns as (select c, md5(length(r)::varchar || ':' || r || t) k, strlen(t) size, row_number() over
    (partition by c order by turn nulls first, md5(length(r)::varchar || ':' || r || t)) pos from said),
convs as (select distinct c, c - c % {family} b, {crc} % {most} h from said),
steps as (select v.c, 0 part, pos, k, size from convs v join turns t on t.c = v.b and pos <= h
    union all select v.c, 1, pos, k, size from convs v join turns t on t.c = v.c and pos > h),
seqs as (select v.c, coalesce(ks, []) ks, coalesce(sizes, []) sizes from convs v left join
    (select c, list(k order by part, pos) ks, list(size order by part, pos) sizes from steps group by c) using (c)),
member as (select c, ks, d, ks[1:d] prefix from (select *, unnest(range(len(ks) + 1)) d from seqs)),
node as (select d, prefix, min(c) m, count(*) n, coalesce(string_agg(c::varchar, ',' order by c)
    filter (where len(ks) = d), '') ends from member group by d, prefix),
inside as (select c, d, m from member join node using (d, prefix)),
up as (select node.*, p.m parent, case when node.d > 0 then (n - 1) * sizes[node.d] else 0 end saved
    from node join seqs on seqs.c = m left join inside p on p.c = node.m and p.d = node.d - 1),
kids as (select parent m, d - 1 d, count(*) kids from up where d > 0 group by all),
own as (select up.*, coalesce(kids, 0) kids from up left join kids using (m, d)),
sub as (select i.m, i.d, sum((kids = 0)::int) leaves, sum(saved) saved from own join inside i
    on i.c = own.m and i.d <= own.d group by all)
select m conv_id, d::bigint as depth, parent parent_conv_id, n n_convs, kids::bigint n_children, leaves::bigint n_leaves,
    sub.saved::bigint saved_tokens, sha256(ends) ends_sha256 from own join sub using (m, d)"""
