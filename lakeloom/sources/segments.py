"""A change topic kept as numbered segment files, read as a stream with offsets.

A topic is a folder of partitions, ``partition=<number>/<segment>.jsonl``; segments are
numbered from 0 without gaps, are written once and hold one change record as a JSON object
per line. An offset is the next segment of every partition. A batch is planned from offsets
alone, in ranges of segments that become tasks; the same offsets always read the same
records, so that a replayed batch equals the first one, and the sinks' own commit makes the
whole exactly-once. No server is needed.
"""

from __future__ import annotations

import datetime as dt
import io
import json
import re
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from lakeloom.sources.files import TIME_FORMAT

FORMAT = "lakeloom_segments"
SCHEMA = "topic string, partition int, segment bigint, line int, key string, value string, ts timestamp"
SEGMENT = re.compile(r"partition=(\d+)/(\d+)\.jsonl$")


def _store(path: str):
    """The file system of a path and the path in it; called where files are read or written."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class Range(InputPartition):
    """Segments ``first`` to ``end`` (left out) of one partition."""

    def __init__(self, partition: int, first: int, end: int):
        super().__init__((partition, first, end))


class SegmentReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.per_task = max(int(options.get("segmentsPerTask", 16)), 1)
        self.start = options.get("startingOffsets", "earliest")

    def _ends(self) -> dict[str, int]:
        """The next segment of each partition: the first number that is missing.

        What lies behind a gap is not read before the gap is filled, so no record is passed over.
        """
        from pyarrow import fs

        store, root = _store(self.path)
        seen: dict[int, set[int]] = {}
        for entry in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = SEGMENT.search(entry.path)
            if name:
                seen.setdefault(int(name[1]), set()).add(int(name[2]))
        return {str(p): next(n for n in range(len(found) + 1) if n not in found) for p, found in sorted(seen.items())}

    def initialOffset(self) -> dict:
        return self._ends() if self.start == "latest" else {}

    def latestOffset(self) -> dict:
        return self._ends()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        ranges = []
        for partition, last in end.items():
            first = start.get(partition, 0)
            ranges += [
                Range(int(partition), at, min(at + self.per_task, last)) for at in range(first, last, self.per_task)
            ]
        return ranges

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        number, first, end = partition.value
        store, root = _store(self.path)
        for segment in range(first, end):
            # A segment of a planned range that is gone fails the task: nothing is passed over.
            with store.open_input_stream(f"{root}/partition={number}/{segment:012d}.jsonl") as opened:
                for line, text in enumerate(io.TextIOWrapper(opened, encoding="utf-8", newline="\n")):
                    record = json.loads(text)
                    ts = record.get("ts")
                    yield (
                        record.get("topic"), number, segment, line, record.get("key"), record.get("value"),
                        dt.datetime.fromisoformat(ts) if ts else None,
                    )

    def commit(self, end: dict) -> None:
        """Segments stay: how long a topic is kept is its writer's matter."""


class SegmentTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader(self.options)


def read_segments(
    spark: SparkSession, path: str, segments_per_task: int = 16, starting_offsets: str = "earliest"
) -> DataFrame:
    """Change records of a segment topic as a stream, with their partition, segment and line.

    ``starting_offsets`` (``earliest`` or ``latest``) counts for a new checkpoint only. The
    driver lists the segments; records are read by tasks of ``segments_per_task`` segments.
    """
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError(f"starting offsets {starting_offsets!r}")
    spark.dataSource.register(SegmentTopic)
    return (
        spark.readStream.format(FORMAT)
        .option("segmentsPerTask", str(segments_per_task))
        .option("startingOffsets", starting_offsets)
        .load(path)
    )


def append_segments(records: DataFrame, path: str, key: str, partitions: int, segment: int) -> None:
    """Append change records as one segment to each of ``partitions`` partitions.

    Records of one key are in one partition, in the order of their time. ``segment`` is the
    next free number; writing it again replaces it. Records come from one writer at a time.
    A segment appears under its name when it is whole, also if a task is repeated. A
    partition without records gets an empty segment, so that no gap stays.
    """
    spark = records.sparkSession
    place = F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
    line = F.to_json(F.struct(*records.columns), {**TIME_FORMAT, "ignoreNullFields": "false"})
    lines = records.select(place.alias("_place"), F.col("ts").alias("_at"), line.alias("_line"))

    def write(batches: Iterator) -> Iterator:
        import pandas as pd

        store, root = _store(path)
        place, opened, draft = None, None, ""

        def finish() -> None:
            if opened is not None:
                opened.close()
                store.move(draft, f"{root}/partition={place}/{segment:012d}.jsonl")

        for batch in batches:
            for at, text in zip(batch["_place"], batch["_line"]):
                if at != place:
                    finish()
                    place = at
                    store.create_dir(f"{root}/partition={place}", recursive=True)
                    draft = f"{root}/partition={place}/{uuid.uuid4().hex}.draft"
                    opened = store.open_output_stream(draft)
                if text is not None:
                    opened.write(text.encode() + b"\n")
        finish()
        yield pd.DataFrame({"done": []})

    marks = spark.range(partitions).select(
        F.col("id").cast("int").alias("_place"),
        F.lit(None).cast("timestamp").alias("_at"),
        F.lit(None).cast("string").alias("_line"),
    )
    placed = lines.unionByName(marks).repartition(partitions, "_place").sortWithinPartitions("_place", "_at", "_line")
    placed.mapInPandas(write, "done int").write.format("noop").mode("overwrite").save()
