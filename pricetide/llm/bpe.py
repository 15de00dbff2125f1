"""Byte-level BPE by corpus-level merge replay, and decoding.

A slice of the corpus (four million characters) is cut into its different pieces, as the pre-tokenizing pattern
says.  All pieces lie in one array of token ids with links to the neighbours.  An inverted index leads from a rank to
the places whose pair merges to it; ranks are replayed in order, each over all its places at once, and only the
touched neighbours look up their new pairs.  Pieces that are found again in later slices keep their ids in a bounded
cache.  Nothing is shuffled: a document is encoded where it is read.

Ranks are those of whole tokens, so two neighbours merge if their joined bytes are a token; a pair that appears with
a rank below the present one is replayed next, as a per-piece encoder would do.

Defined results: a null or empty text has no tokens, and the digests are those of no bytes.  Rows are never merged;
repeated rows are encoded alike, in any order.  A text of any length is encoded whole.  Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.chunks import ChunkCache, chunks_of, slices, word_and_marks
from pricetide.llm.common import read_table

RANKS = "byte_bpe_50k.tiktoken"
SLICE_CHARS = 4_000_000
CACHED_CHUNKS = 150_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class MergeReplay:
    """Encoder of many pieces at once, from the ranks of all tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {r: t for t, r in ranks.items()}
        self.size = max(ranks.values()) + 1
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        # Every way to cut a token into two tokens is a pair that merges to it.
        pairs = [(ranks[a] * self.size + ranks[b], r) for t, r in ranks.items()
                 for a, b in ((t[:i], t[i:]) for i in range(1, len(t))) if a in ranks and b in ranks]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair merges to, or -1."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, where each piece's ids start; one number more than pieces)."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        n = int(lengths.sum())
        ids = np.concatenate([self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)], [0]])
        firsts = np.concatenate([[0], np.cumsum(lengths)])
        last = np.zeros(n + 1, bool)
        last[firsts[1:][lengths > 0] - 1] = True
        follow = np.arange(1, n + 2)
        follow[last] = n  # place n is beyond every piece
        before = np.arange(-1, n)
        before[firsts[:-1][lengths > 0]] = n
        before[n] = n
        merges_to = np.full(n + 1, -1)  # the rank of each place with the next one; -1 for none
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = defaultdict(list)  # rank -> places of the left halves
        due: list[int] = []

        def add(places):
            right = follow[places]
            ranks = np.where(right < n, self._ranks(ids[places], ids[right]), -1)
            merges_to[places] = ranks
            hits = np.flatnonzero(ranks >= 0)
            if not len(hits):
                return
            hits = hits[np.argsort(ranks[hits], kind="stable")]
            places, ranks = places[hits], ranks[hits]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:]):
                if rank not in index:
                    heapq.heappush(due, rank)
                index[rank].append(places[a:b])

        add(np.arange(n))
        while due:
            rank = heapq.heappop(due)
            groups = index.pop(rank)
            places = np.concatenate(groups) if len(groups) > 1 else groups[0]
            places = np.sort(places[merges_to[places] == rank])  # others were touched meanwhile
            if not len(places):
                continue
            new = places[1:] != places[:-1]
            if not new.all():
                places = places[np.concatenate([[True], new])]
            right = follow[places]
            # A run of overlapping pairs (x x x) merges from the left: every second pair of the run is dropped.
            chained = right[:-1] == places[1:]
            if chained.any():
                chained = np.concatenate([[False], chained])
                start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(places))))
                take = (np.arange(len(places)) - start) % 2 == 0
                places, right = places[take], right[take]
            ids[places] = rank
            alive[right] = False
            merges_to[right] = -1
            after = follow[right]
            follow[places] = after
            before[after] = places
            before[n] = n
            previous = before[places]
            add(np.concatenate([previous[previous < n], places]))
        counts = np.concatenate([[0], np.cumsum(alive)])
        return ids[:n][alive], counts[firsts]


class Encoder:
    """Chunks to what a document needs of them: (ids as decimal text, their number, decoded bytes)."""

    def __init__(self, path: str):
        self.replay = MergeReplay(load_ranks(path))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.cache = ChunkCache(self.encode_chunks, CACHED_CHUNKS)

    def encode_chunks(self, chunks: list[str]) -> list[tuple[str, int, bytes]]:
        found = [word_and_marks(c) or self.pattern.findall(c) for c in chunks]
        # A piece that was a chunk of its own has its value already.
        done = {p: self.cache.get(p) for parts in found for p in parts}
        pieces = [p for p, v in done.items() if v is None]
        ids, starts = self.replay.encode([p.encode() for p in pieces])
        ids, starts = ids.tolist(), starts.tolist()
        words = list(map(str, ids))
        tokens = list(map(self.replay.tokens.__getitem__, ids))
        done.update({p: (" ".join(words[a:b]), b - a, b"".join(tokens[a:b]))
                     for p, a, b in zip(pieces, starts, starts[1:])})
        return [done[parts[0]] if len(parts) == 1 else _joined([done[p] for p in parts]) for parts in found]


def _joined(values: list[tuple[str, int, bytes]]) -> tuple[str, int, bytes]:
    return " ".join([v[0] for v in values]), sum([v[1] for v in values]), b"".join([v[2] for v in values])


_ENCODERS: dict = {}


def _encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None,
                     with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, and ``ids`` (array of int) if wanted.

    ``decoded_sha256`` is taken from the bytes that the ids decode to.
    """
    path = path or public_tokenizers.path(RANKS)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encoder = _encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices([len(t) for t in texts], SLICE_CHARS):
                parts = [chunks_of(t) for t in texts[a:b]]
                values, numbered = encoder.cache.look_up(parts)
                counts, digests, decoded, lists = [], [], [], []
                for at in numbered:
                    written, numbers, raw = zip(*map(values.__getitem__, at))
                    line = " ".join(written)  # only an empty text has a chunk without ids, its only one
                    counts.append(sum(numbers))
                    digests.append(hashlib.sha256(line.encode()).hexdigest())
                    decoded.append(hashlib.sha256(b"".join(raw)).hexdigest())
                    if with_ids:
                        lists.append(np.fromstring(line, np.int32, sep=" ") if line else np.empty(0, np.int32))
                columns = [batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()), pa.array(digests),
                           pa.array(decoded)]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text).mapInArrow(
        run, f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
             + ", ids array<int>" * with_ids)


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text) from arrays of ids; bytes that are no UTF-8 become the replacement character, null stays null."""
    path = path or public_tokenizers.path(RANKS)
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        tokens = {r: t for t, r in load_ranks(path).items()}
        for batch in batches:
            texts = [None if x is None else b"".join([tokens[i] for i in x]).decode("utf-8", "replace")
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, ids).mapInArrow(run, f"`{id_col}` {id_type}, text string")


def op9(spark, folder: str) -> DataFrame:
    return encode_documents(read_table(spark, folder, "documents"))


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """The token ids of every document, with their digests."""
    return encode_documents(docs, with_ids=True)
