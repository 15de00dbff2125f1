"""A stream over text files that admits records, where Spark's own file source admits files.

Records are flushed by number, as a live consumer flushes them, wherever they lie in the files.  A micro-batch takes
the next ``flushes`` flushes of ``records`` lines each, so a long replay need not start a micro-batch for every flush; each
record says which flush it belongs to.  The driver counts lines block by block; tasks read the blocks.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

RECORD_REPLAY = "record_replay"
DEFAULT_RECORDS = 1000
# Bytes that a task reads, at least to the end of a line.
BLOCK = 4 << 20


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _records(block: bytes) -> tuple[list[bytes], list[int]]:
    """The lines of a block, and which of them are records."""
    lines = block.split(b"\n")
    return lines, [i for i, line in enumerate(lines) if line.strip()]


class RecordReader(DataSourceStreamReader):
    """Positions are (file name, byte) and the number of flushes before: files are taken in name order, so a later file
    needs a later name.

    Blank lines are no records; a last line without an end is one, so files must arrive whole.  The last flush of what is
    there may be short; records that arrive later begin a new one.
    """

    def __init__(self, path: str, records: int, flushes: int):
        self.path, self.records, self.flushes = path, records, flushes
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        return {"file": "", "byte": 0, "flush": 0}

    def _spans(self, start: dict, end: dict | None = None) -> Iterator[tuple[str, int, int, int]]:
        """(file, first byte, byte behind, records) of the blocks from ``start`` on, to ``end`` or as far as a micro-batch
        goes."""
        left = self.records * self.flushes if end is None else sys.maxsize
        size = min(BLOCK, 256 * left)
        store, folder = _store(self.path)
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        names = sorted(f.base_name for f in found if f.is_file and not f.base_name.startswith(("_", ".")))
        for name in names:
            if name < start["file"] or (end and name > end["file"]):
                continue
            at = start["byte"] if name == start["file"] else 0
            stop = end["byte"] if end and name == end["file"] else sys.maxsize
            with io.BufferedReader(store.open_input_file(f"{folder}/{name}")) as handle:
                handle.seek(at)
                while left and at < stop and (block := handle.read(min(size, stop - at))):
                    if not block.endswith(b"\n"):
                        block += handle.readline()
                    lines, marks = _records(block)
                    marks = marks[:left]
                    if marks:
                        # a last line without an end has no byte for it
                        behind = min(sum(map(len, lines[:marks[-1] + 1])) + marks[-1] + 1, len(block))
                        yield name, at, at + behind, len(marks)
                        left -= len(marks)
                    at += len(block)
            if not left:
                break

    def latestOffset(self) -> dict:
        start = self.at or self.initialOffset()
        end, count = start, 0
        for name, _, behind, n in self._spans(start):
            count += n
            end = {"file": name, "byte": behind, "flush": start.get("flush", 0) - -count // self.records}
        self.at = end
        return end

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # a query that restarts plans its last batch first, and goes on behind it
        self.at = self.at or end
        out, before = [], 0
        for name, first, behind, n in self._spans(start, end):
            out.append(InputPartition((name, first, behind, start.get("flush", 0), before)))
            before += n
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        name, first, behind, flush, before = partition.value
        store, folder = _store(self.path)
        with io.BufferedReader(store.open_input_file(f"{folder}/{name}")) as handle:
            handle.seek(first)
            lines, marks = _records(handle.read(behind - first))
        yield pa.record_batch({
            "value": pa.array([lines[i].rstrip(b"\r\n").decode("utf-8", "replace") for i in marks], pa.string()),
            "flush": pa.array([flush + (before + i) // self.records for i in range(len(marks))], pa.int64())})


class RecordReplay(DataSource):
    """Options: ``path``, a folder, ``records``, the most lines of a flush, and ``flushes``, the most flushes of a
    micro-batch."""

    @classmethod
    def name(cls) -> str:
        return RECORD_REPLAY

    def schema(self) -> str:
        return "value string, flush long"

    def streamReader(self, schema) -> RecordReader:
        records, flushes = int(self.options.get("records", DEFAULT_RECORDS)), int(self.options.get("flushes", 1))
        if "path" not in self.options or records < 1 or flushes < 1:
            raise ValueError("record_replay needs a path, at least one record a flush and one flush a batch")
        return RecordReader(self.options["path"], records, flushes)


def register_replay(spark: SparkSession) -> None:
    # the process that reads positions does not share the driver's import path, so the classes travel by value
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(RecordReplay)
