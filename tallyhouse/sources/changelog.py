"""A folder of change segments as a stream, through Spark's Python data source interface.

A segment is a folder ``segment=N`` with one file of change envelopes, one to a line; Spark writes such folders with
``partitionBy("segment").text(...)``. Segments are never changed, are numbered without gaps, and the oldest go when
their time is over. An offset is the number of the next segment.

A trigger takes at most ``segmentsPerTrigger`` segments, also the first one over a long log, and each segment is read by
a task of its own in small Arrow batches. Offsets are Spark's, in the checkpoint; on a restart Spark tells the reader
where it stands before it asks for more. A segment that should be there and is not stops the stream, or, where
``failOnDataLoss`` is off, gives one row without a value, so a loss can be counted (``lost_segments``).

Options: ``path`` (local, or any file system that pyarrow opens by URI), ``segmentsPerTrigger`` (8), ``starting``
(``earliest`` or ``latest``), ``failOnDataLoss`` (true).
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "change_segments"
SCHEMA = "segment long, line long, value string"
# Lines of a record batch, and the line number of the row that stands for a lost segment.
BATCH_LINES = 4_096
BUFFER = 1 << 20
LOST = -1


class LostSegments(Exception):
    """Segments between two offsets are not there any more."""


class Segment(InputPartition):
    def __init__(self, number: int, path: str | None):
        self.number = number
        self.path = path


class Log:
    """The segments that are there."""

    def __init__(self, path: str):
        uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
        self.files, self.root = fs.FileSystem.from_uri(uri)

    def folders(self) -> dict[int, str]:
        found = self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        names = ((info.base_name, info.path) for info in found if info.base_name.startswith("segment="))
        return {int(name.partition("=")[2]): path for name, path in names}

    def file(self, folder: str) -> str | None:
        """The file of a segment; None while it is being written."""
        inside = self.files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return next((info.path for info in inside if info.base_name[0] not in "._"), None)


class SegmentReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.log_path = options["path"]
        self.log = Log(self.log_path)
        self.bound = int(options.get("segmentspertrigger", "8"))
        if self.bound < 1:
            raise ValueError("segmentsPerTrigger must be positive")
        self.starting = options.get("starting", "earliest")
        self.fail = options.get("failondataloss", "true").lower() == "true"
        # The end of what has been planned. Spark plans an empty range at the former end when a query restarts.
        self.position: int | None = None

    def initialOffset(self) -> dict:
        numbers = self.log.folders()
        if self.starting == "latest":
            return {"segment": max(numbers, default=-1) + 1}
        return {"segment": min(numbers, default=0)}

    def latestOffset(self) -> dict:
        if self.position is None:
            self.position = self.initialOffset()["segment"]
        newest = max(self.log.folders(), default=-1) + 1
        return {"segment": max(self.position, min(self.position + self.bound, newest))}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        first, after = start["segment"], end["segment"]
        self.position = after
        folders = self.log.folders() if after > first else {}
        segments = [Segment(n, self.log.file(folders[n]) if n in folders else None) for n in range(first, after)]
        lost = [s.number for s in segments if s.path is None]
        if lost and self.fail:
            raise LostSegments(f"segments {lost[0]} to {lost[-1]} are missing ({len(lost)} in all)")
        return segments

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        names = ["segment", "line", "value"]
        if partition.path is None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([partition.number], pa.int64()), pa.array([LOST], pa.int64()), pa.array([None], pa.string())], names=names
            )
            return
        with self.log.files.open_input_file(partition.path) as source:
            lines, at = [], 0
            for line in io.BufferedReader(source, BUFFER):
                lines.append(line.rstrip(b"\n"))
                if len(lines) == BATCH_LINES:
                    yield self._batch(partition.number, at, lines, names)
                    at, lines = at + len(lines), []
            if lines:
                yield self._batch(partition.number, at, lines, names)

    @staticmethod
    def _batch(number: int, at: int, lines: list[bytes], names: list[str]) -> pa.RecordBatch:
        n = len(lines)
        values = pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([number] * n, pa.int64()), pa.array(range(at, at + n), pa.int64()), values], names=names
        )

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "log"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, log=Log(state["log_path"]))


class ChangeSegments(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return SegmentReader({name.lower(): value for name, value in self.options.items()})


def change_stream(
    spark: SparkSession, path: str, segments_per_trigger: int = 8, starting: str = "earliest", fail_on_data_loss: bool = True
) -> DataFrame:
    """The segments of a folder as a stream with columns segment, line and value."""
    # The classes travel to the workers, which need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ChangeSegments)
    options = {"segmentsPerTrigger": str(segments_per_trigger), "starting": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    return spark.readStream.format(FORMAT).options(**options).load(path)


def write_segments(envelopes: DataFrame, path: str) -> None:
    """Add segments from a frame with ``segment`` and ``value``; each segment is written by one task."""
    one_task = envelopes.select("segment", "value").repartition("segment")
    one_task.write.mode("append").partitionBy("segment").text(path)


def lost_segments(stream: DataFrame) -> DataFrame:
    """The numbers of the segments that were gone when the stream came to them."""
    return stream.filter(F.col("line") == LOST).select("segment")
