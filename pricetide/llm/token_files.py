"""Token ids in Arrow stream files with fixed-size-list batches.

All ids follow each other in ascending order of the document ids, cut into sequences of ``length``.  A file is an
Arrow stream of record batches with two columns: ``ids`` (fixed-size list of uint16, or uint32 for large
vocabularies) and ``mask`` (fixed-size list of booleans; false behind the last id of the file).  All batches but the
last hold ``rows`` sequences and so have the same number of bytes: batch k starts at (end of the schema) + k * (bytes
of a batch), and any sequence is reached without reading what is before it, as a view of the mapped file.

Documents are dealt into ranges of ids, sorted and encoded where they land; each task writes one file.  A file is
named by a fresh number, and counts only if the index, which Spark writes when the task has succeeded, names it: a
task that is lost or repeated does no harm.  Where a range starts follows from the sums of the ranges before it.

Defined results: a null or empty text is the end id alone.  A null document id comes first.  Rows that share an id
stand next to each other, in an order given by their texts.  A text of any length may run over many sequences.  An
empty table gives no files and an empty result.  Other columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.chunks import ChunkCache, chunks_of, slices, word_and_marks
from pricetide.llm.common import new_folder, partitions, read_table

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
LENGTH = 1024
ROWS = 64
SLICE_BYTES = 16_000_000
# What needs the careful cut: white space other than single blanks and line ends within the text.
_ODD = (r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
        r"|  | \n|\n |\n\n|\A\z|[ \n]\z")


def _place(uri: str):
    """(file system, path) of an address in the shared storage."""
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[len("file:"):])
    return fs.LocalFileSystem(), uri


class TokenWriter:
    """Writes ids as equal sequences."""

    def __init__(self, uri: str, length: int, rows: int, id_type: pa.DataType):
        self.length, self.rows, self.id_type = length, rows, id_type
        self.schema = pa.schema([("ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length))])
        system, path = _place(uri)
        system.create_dir(os.path.dirname(path), recursive=True)
        self.sink = system.open_output_stream(path)
        self.stream = pa.ipc.new_stream(self.sink, self.schema)
        self.waiting, self.held = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        size = self.length * self.rows
        if self.held >= size:
            whole = np.concatenate(self.waiting)
            for at in range(0, len(whole) - size + 1, size):
                self._write(whole[at:at + size], size)
            rest = whole[len(whole) - len(whole) % size:]
            self.waiting, self.held = [rest], len(rest)

    def _write(self, ids: np.ndarray, valid: int) -> None:
        mask = np.arange(len(ids)) < valid
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(ids, self.id_type), self.length),
                   pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)]
        self.stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.held:
            ids = np.concatenate(self.waiting)
            self._write(np.pad(ids, (0, -len(ids) % self.length)), len(ids))
        self.stream.close()
        self.sink.close()


class TokenFile:
    """Random access to a file of ``TokenWriter``; a local file is mapped and never copied."""

    def __init__(self, uri: str):
        from pyarrow import fs
        system, path = _place(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.source))
        self.first = self.source.tell()
        message = pa.ipc.read_message(self.source)
        self.step = self.source.tell() - self.first
        batch = pa.ipc.read_record_batch(message, self.schema)
        self.length, self.rows = self.schema.field("ids").type.list_size, batch.num_rows
        self._kept = (0, batch)

    def batch(self, k: int) -> pa.RecordBatch:
        if self._kept[0] != k:
            self.source.seek(self.first + k * self.step)
            self._kept = (k, pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema))
        return self._kept[1]

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """(ids, mask) of sequence i; the ids are a view of the file."""
        batch, at = self.batch(i // self.rows), i % self.rows
        ids = batch.column("ids").slice(at, 1).flatten().to_numpy(zero_copy_only=True)
        return ids, batch.column("mask").slice(at, 1).flatten()

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` on."""
        size, parts = self.length * self.rows, []
        while n > 0:
            ids = self.batch(start // size).column("ids").flatten().to_numpy(zero_copy_only=True)
            part = ids[start % size:start % size + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint16)


class Encoder:
    """Chunks to their ids as bytes, by the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # texts that hold a token added to the vocabulary are encoded whole, for no chunk may cut it
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        line_end = self._ids(["\n"])[0]
        self.line_end = line_end[0] if len(line_end) == 1 else None
        self.cache = ChunkCache(self.encode_chunks)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, pieces: list[str]) -> dict[str, bytes]:
        """Many short pieces go as the lines of one text, whose ids are cut at the line ends."""
        bare = [p.strip() for p in pieces]
        simple = [p for p, b in zip(pieces, bare) if b and self.line_end is not None and "\n" not in b and (
            p == b or p == " " + b)]
        out, size = {}, np.dtype(self.kind).itemsize
        runs = [simple[i:i + 2000] for i in range(0, len(simple), 2000)]
        for run, ids in zip(runs, self._ids(["\n".join(run) for run in runs])):
            ids = np.array(ids + [self.line_end], self.kind)
            ends = (np.flatnonzero(ids == self.line_end) * size).tolist()
            raw = ids.tobytes()
            out.update({p: raw[a:b] for p, a, b in zip(run, [0] + [e + size for e in ends], ends, strict=False)})
        others = [p for p in pieces if p not in out]
        return out | {p: np.array(ids, self.kind).tobytes() for p, ids in zip(others, self._ids(others))}

    def encode_texts(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id, one after the other; their number for every text)."""
        plain = pc.invert(pc.match_substring_regex(texts, _ODD)).to_numpy(zero_copy_only=False)
        numbers = np.empty(len(texts), np.int64)
        parts: list = [None] * len(texts)
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(whole).tolist():
            parts[i] = np.array(self._ids([texts[i].as_py()])[0], self.kind)
            numbers[i] = len(parts[i])
        rest = np.flatnonzero(~plain & ~whole).tolist()
        if rest:
            values, at = self.cache.look_up([chunks_of(t) for t in texts.take(pa.array(rest)).to_pylist()])
            for i, own in zip(rest, at):
                parts[i] = np.frombuffer(b"".join(map(values.__getitem__, own)), self.kind)
                numbers[i] = len(parts[i])
        where = np.flatnonzero(plain & ~whole)
        if len(where):
            ids, counts = self._encode_plain(texts.take(pa.array(where)))
            numbers[where] = counts
            for i, own in zip(where.tolist(), np.split(ids, np.cumsum(counts)[:-1])):
                parts[i] = own
        ids = np.concatenate(parts) if parts else np.zeros(0, self.kind)
        return np.insert(ids, np.cumsum(numbers), self.kind(end_id)), numbers + 1

    def _encode_plain(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts with single blanks and line ends only: all chunks are numbered by Arrow."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        coded = lists.flatten().dictionary_encode()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        starts = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
        # A chunk has its blank, unless it is the first, a line end, or behind one.
        bare = at == (words.index("\n") if "\n" in words else -1)
        bare[1:] |= bare[:-1].copy()
        bare[starts] = True
        codes = at.astype(np.int64) * 2 + bare
        used = np.zeros(2 * len(words), bool)
        used[codes] = True
        distinct = np.flatnonzero(used)
        values, numbered = self.cache.look_up([[words[c >> 1] if c & 1 else " " + words[c >> 1] for c in distinct.tolist()]])
        found = [values[k] for k in numbered[0]]
        sizes = np.zeros(len(used), np.int32)
        sizes[distinct] = np.array([len(v) for v in found], np.int64) // np.dtype(self.kind).itemsize
        flat = np.frombuffer(b"".join(found), self.kind)
        counts = sizes[codes]
        begins = (np.cumsum(sizes, dtype=np.int32) - sizes)[codes]
        ends = np.cumsum(counts, dtype=np.int32)
        places = np.repeat(begins - ends + counts, counts) + np.arange(ends[-1], dtype=np.int32)
        return flat[places], np.add.reduceat(counts, starts, dtype=np.int64)

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        found = [word_and_marks(c) or (c,) for c in chunks]
        done = {p: self.cache.get(p) for parts in found for p in parts}
        done |= self._encode([p for p, v in done.items() if v is None])
        return [done[parts[0]] if len(parts) == 1 else b"".join([done[p] for p in parts]) for parts in found]


_ENCODERS: dict = {}


def _encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text: str = "text",
                      path: str | None = None, end_id: int = END_ID, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """Write all ids below ``folder``; the index (id, file, at, n_tokens, start) is returned.

    ``at`` is the document's place in its file, ``start`` the number of ids of all documents before it.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    ranged = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")) \
        .repartitionByRange(partitions(spark), "id").sortWithinPartitions("id", F.xxhash64("text"), "text")

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(path)
        arrow = pa.from_numpy_dtype(encoder.kind)
        part, at, writer = TaskContext.get().partitionId(), 0, None
        uri = f"{folder}/tokens/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        for batch in batches:
            lengths = pc.binary_length(batch.column(1)).to_numpy()
            for a, b in slices(lengths, SLICE_BYTES):
                writer = writer or TokenWriter(uri, length, rows, arrow)
                ids, counts = encoder.encode_texts(batch.column(1).slice(a, b - a), end_id)
                writer.add(ids)
                starts = at + np.concatenate([[0], np.cumsum(counts)])
                at = int(starts[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([part] * (b - a), pa.int32()), pa.array([uri] * (b - a)),
                     pa.array(starts[:-1], pa.int64()), pa.array(counts, pa.int64())],
                    names=["id", "part", "file", "at", "n_tokens"])
        if writer:
            writer.close()

    written = ranged.mapInArrow(run, f"id {id_type}, part int, file string, at bigint, n_tokens bigint")
    written.write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    # One row per file.
    ranges = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    starts = ranges.select(F.col("part"), F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return index.join(starts, "part").select(
        F.col("id").alias(id_col), "file", "at", "n_tokens", (F.col("before") + F.col("at")).alias("start"))


def read_token_files(index: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document of an index, from the files.

    Each file is opened by one task, with its own rows of the index.
    """
    id_type = index.schema[id_col].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        file = TokenFile(table.column("file")[0].as_py())
        sums = [zlib.crc32(file.tokens(at, n).astype("<u4").tobytes()) for at, n in zip(
            table.column("at").to_pylist(), table.column("n_tokens").to_pylist())]
        return pa.table({id_col: table.column(id_col), "start": table.column("start"),
                         "n_tokens": table.column("n_tokens"), "ids_crc32": pa.array(sums, pa.int64())})

    return index.groupBy("file").applyInArrow(
        run, f"`{id_col}` {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def op4(spark, folder: str) -> DataFrame:
    return read_token_files(write_token_files(read_table(spark, folder, "documents"), new_folder(spark, "tokens")))
