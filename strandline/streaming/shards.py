"""Sharded record log over files: a stream source with start positions and bounds, and a transactional publisher.

A log is a folder. ``data/`` holds Parquet segments, each of one shard;
``log/<producer>/<number>.json`` lists the segments one publication added and
the length of every shard after it. A segment counts once a list names it, and a
list appears by one rename: readers see a publication whole or not at all, and
what a failed task has written is on no list. A producer's lists are numbered by
micro-batch, so a batch that a restart publishes again is found there and not
added twice. A producer is written by one job at a time (:func:`publish_stream`
keeps its name in the checkpoint, :func:`publish_batch` makes one per job).

The source (format ``shardlog``) starts at the earliest record or at the latest
(I2). A micro-batch takes at most ``rows_per_batch`` records, and at most
``rows_per_second`` times the seconds since the last one (I5), dealt evenly over
the shards that have records; segments are cut where the bound falls, so the
sizes of files don't matter. Tasks read slices of shards in parallel.

This version of Spark does not tell a Python source where a query stands when it asks for
the next end. The source therefore writes each end it plans below the query's
checkpoint before it returns it. A restart returns the last planned end
once more: either Spark has it too, or it is the batch Spark had not yet noted.

Files are reached by ``pyarrow.fs`` from the tasks (local and mounted folders, HDFS, S3).
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

ROWS_PER_FILE = 500_000
ROWS_PER_TASK = 500_000
PLANNED, INITIAL = "planned.json", "initial.json"


class Folder:
    """Small files of a folder on any store ``pyarrow.fs`` knows."""

    def __init__(self, uri: str) -> None:
        from pyarrow import fs

        if uri.startswith("file:"):
            uri = "/" + uri[5:].lstrip("/")
        self.fs, self.root = fs.FileSystem.from_uri(uri)

    def names(self, sub: str) -> list[str]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/{sub}", allow_not_found=True))
        return sorted(f.base_name for f in found if not f.base_name.startswith("."))

    def has(self, name: str) -> bool:
        from pyarrow import fs

        return self.fs.get_file_info(f"{self.root}/{name}").type != fs.FileType.NotFound

    def read(self, name: str):
        with self.fs.open_input_stream(f"{self.root}/{name}") as f:
            return json.loads(f.read())

    def write(self, name: str, value) -> None:
        """Whole or not at all: written beside, then renamed."""
        folder, _, base = f"{self.root}/{name}".rpartition("/")
        self.fs.create_dir(folder, recursive=True)
        draft = f"{folder}/.{base}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps(value, sort_keys=True).encode())
        self.fs.move(draft, f"{folder}/{base}")

    def delete(self, name: str) -> None:
        if self.has(name):
            self.fs.delete_file(f"{self.root}/{name}")


# --- the log --------------------------------------------------------------------------------


def _list_name(producer: str, number: int) -> str:
    return f"log/{producer}/{number:020d}.json"


class Log:
    """The published lists; those once read are kept, and only newer ones are looked for."""

    def __init__(self, uri: str) -> None:
        self.folder = Folder(uri)
        self.newest: dict[str, int] = {}
        self.lists: dict[tuple[str, int], dict] = {}

    def refresh(self) -> None:
        for producer in self.folder.names("log"):
            if producer not in self.newest:
                numbers = [int(n[:-5]) for n in self.folder.names(f"log/{producer}")]
                if numbers:
                    self.newest[producer] = max(numbers)
            else:
                while self.folder.has(_list_name(producer, self.newest[producer] + 1)):
                    self.newest[producer] += 1

    def entry(self, producer: str, number: int) -> dict:
        if (producer, number) not in self.lists:
            self.lists[producer, number] = self.folder.read(_list_name(producer, number))
        return self.lists[producer, number]

    def ends(self) -> dict[str, dict[str, int]]:
        """Records of each producer's shards."""
        return {p: self.entry(p, n)["ends"] for p, n in sorted(self.newest.items())}

    def slices(self, producer: str, start: dict[str, int], end: dict[str, int]) -> Iterator[tuple[str, str, int, int, int]]:
        """``(shard, file, first, low, high)``: rows ``low`` to ``high`` of each segment between two positions."""
        number = self.newest[producer]
        while number >= 0:
            entry = self.entry(producer, number)
            for s in entry["segments"]:
                k = s["shard"]
                low, high = max(start.get(k, 0), s["first"]), min(end.get(k, 0), s["first"] + s["rows"])
                if low < high:
                    yield k, s["file"], s["first"], low - s["first"], high - s["first"]
            before = entry["starts"]
            if all(before.get(k, 0) <= start.get(k, 0) for k in end):
                return  # everything older lies before the start
            number = entry["previous"]


def publish(folder: Folder, producer: str, number: int | None, segments: list[dict]) -> None:
    """Put a publication's segments on the producer's next list (``number``: the micro-batch)."""
    numbers = [int(n[:-5]) for n in folder.names(f"log/{producer}")]
    last = max(numbers, default=-1)
    number = last + 1 if number is None else number
    if number <= last:  # an earlier attempt has published this batch
        for s in segments:
            folder.delete(s["file"])
        return
    ends = dict(folder.read(_list_name(producer, last))["ends"]) if last >= 0 else {}
    starts, listed = dict(ends), []
    for s in segments:
        listed.append({**s, "first": ends.get(s["shard"], 0)})
        ends[s["shard"]] = ends.get(s["shard"], 0) + s["rows"]
    folder.write(_list_name(producer, number), {"previous": last, "starts": starts, "ends": ends, "segments": listed})


# --- writing --------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    segments: list[dict]


class _Segments:
    """What both writers share: a task's rows as segments, and their publication or removal."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.producer = options["path"], options["producer"]
        self.rows = int(options.get("rowsperfile", ROWS_PER_FILE))

    def write(self, iterator) -> Written:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        folder, open_files, done = Folder(self.path), {}, []
        folder.fs.create_dir(f"{folder.root}/data", recursive=True)

        def close(shard: str) -> None:
            writer, segment = open_files.pop(shard)
            writer.close()
            done.append(segment)

        try:
            for batch in iterator:
                keys = batch.column(batch.schema.get_field_index("shard"))
                payload = pa.Table.from_batches([batch]).drop_columns(["shard"])
                for key in pc.unique(keys):
                    shard, part = str(key.as_py()), payload.filter(pc.equal(keys, key))
                    while part.num_rows:
                        if shard not in open_files:
                            name = f"data/shard={shard}-{uuid.uuid4().hex}.parquet"
                            open_files[shard] = (pq.ParquetWriter(f"{folder.root}/{name}", part.schema, filesystem=folder.fs),
                                                 {"shard": shard, "file": name, "rows": 0})
                        writer, segment = open_files[shard]
                        take = part.slice(0, self.rows - segment["rows"])
                        writer.write_table(take)
                        segment["rows"] += take.num_rows
                        part = part.slice(take.num_rows)
                        if segment["rows"] >= self.rows:
                            close(shard)
        finally:
            for shard in list(open_files):
                close(shard)
        return Written(done)

    def _publish(self, messages: list, number: int | None) -> None:
        publish(Folder(self.path), self.producer, number, [s for m in messages if m for s in m.segments])

    def _remove(self, messages: list) -> None:
        folder = Folder(self.path)
        for m in messages:
            for s in m.segments if m else []:
                folder.delete(s["file"])


class _BatchWriter(_Segments, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self._publish(messages, None)

    def abort(self, messages) -> None:
        self._remove(messages)


class _StreamWriter(_Segments, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId) -> None:
        self._publish(messages, batchId)

    def abort(self, messages, batchId) -> None:
        self._remove(messages)


# --- reading --------------------------------------------------------------------------------


class Slices(InputPartition):
    """Pieces of one shard for one task: ``(file, first, low, high)``."""

    def __init__(self, producer: str, shard: str, pieces: list[tuple[str, int, int, int]]) -> None:
        super().__init__(pieces)
        self.producer, self.shard = producer, shard


def deal(lag: dict, allowed: int) -> dict:
    """At most ``allowed`` records over the shards that have ``lag``, as evenly as they allow."""
    out, left = {}, allowed
    for i, (k, n) in enumerate(sorted(lag.items(), key=lambda kv: (kv[1], kv[0]))):
        out[k] = min(n, left // (len(lag) - i))
        left -= out[k]
    for k, n in lag.items():  # what the division left over
        more = min(n - out[k], left)
        out[k], left = out[k] + more, left - more
    return out


class _Reader(DataSourceStreamReader):
    def __init__(self, schema, options: dict[str, str]) -> None:
        self.path, self.positions = options["path"], options["positions"]
        self.start = options.get("start", "latest")
        if self.start not in ("latest", "earliest"):
            raise ValueError(f"start is 'latest' or 'earliest', not {self.start!r}")
        self.per_batch = int(options["rowsperbatch"]) if "rowsperbatch" in options else None
        self.per_second = float(options["rowspersecond"]) if "rowspersecond" in options else None
        self.per_task = int(options.get("rowspertask", ROWS_PER_TASK))
        self.names = list(schema.names)
        self.log: Log | None = None
        self.at: dict | None = None  # the last planned end
        self.since = time.monotonic()

    def _open(self) -> Log:
        if self.log is None:
            self.log = Log(self.path)
        self.log.refresh()
        return self.log

    def initialOffset(self) -> dict:
        kept = Folder(self.positions)
        if not kept.has(INITIAL):
            kept.write(INITIAL, self._open().ends() if self.start == "latest" else {})
        return kept.read(INITIAL)

    def latestOffset(self) -> dict:
        kept = Folder(self.positions)
        if self.at is None and kept.has(PLANNED):
            self.at = kept.read(PLANNED)
            return self.at
        if self.at is None:
            self.at = self.initialOffset()
        ends = self._open().ends()
        lag = {(p, k): n - self.at.get(p, {}).get(k, 0) for p, shards in ends.items() for k, n in shards.items()}
        lag = {k: n for k, n in lag.items() if n > 0}
        allowed = sum(lag.values())
        if self.per_batch is not None:
            allowed = min(allowed, self.per_batch)
        if self.per_second is not None:
            allowed = min(allowed, int(self.per_second * (time.monotonic() - self.since)))
        if allowed <= 0:
            return self.at
        self.since = time.monotonic()
        end = {p: dict(shards) for p, shards in self.at.items()}
        for (p, k), n in deal(lag, allowed).items():
            if n:
                end.setdefault(p, {})[k] = end.get(p, {}).get(k, 0) + n
        end = json.loads(json.dumps(end, sort_keys=True))  # equal ends are equal texts
        kept.write(PLANNED, end)
        self.at = end
        return end

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        log, out = self._open(), []
        for producer, shards in end.items():
            by_shard: dict[str, list] = {}
            for k, file, first, low, high in log.slices(producer, start.get(producer, {}), shards):
                by_shard.setdefault(k, []).extend(
                    (file, first, a, min(a + self.per_task, high)) for a in range(low, high, self.per_task))
            for k, pieces in sorted(by_shard.items()):
                task, rows = [], 0
                for piece in sorted(pieces, key=lambda s: s[1] + s[2]):
                    if task and rows + piece[3] - piece[2] > self.per_task:
                        out.append(Slices(producer, k, task))
                        task, rows = [], 0
                    task.append(piece)
                    rows += piece[3] - piece[2]
                if task:
                    out.append(Slices(producer, k, task))
        return out

    def read(self, partition: Slices) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        folder = Folder(self.path)
        for file, first, low, high in partition.value:
            source = pq.ParquetFile(f"{folder.root}/{file}", filesystem=folder.fs)
            row, groups, begin = 0, [], 0
            for g in range(source.num_row_groups):  # only row groups the slice touches are read
                n = source.metadata.row_group(g).num_rows
                if row < high and row + n > low:
                    begin = begin if groups else row
                    groups.append(g)
                row += n
            columns = [n for n in self.names if n in source.schema_arrow.names]
            for batch in source.iter_batches(row_groups=groups, columns=columns):
                a, b = max(low - begin, 0), min(high - begin, batch.num_rows)
                if a < b:
                    part, n = batch.slice(a, b - a), b - a
                    place = {"topic": pa.array([partition.producer] * n, pa.string()),
                             "partition": pa.array([int(partition.shard)] * n, pa.int32()),
                             "offset": pa.array(range(first + begin + a, first + begin + b), pa.int64())}
                    yield pa.RecordBatch.from_arrays(
                        [place[c] if c in place else part.column(part.schema.get_field_index(c)) for c in self.names], self.names)
                begin += batch.num_rows


class ShardLog(DataSource):
    """The ``shardlog`` format."""

    @classmethod
    def name(cls) -> str:
        return "shardlog"

    def schema(self) -> str:
        return "key STRING, value BINARY, topic STRING, partition INT, offset BIGINT"

    def _plain(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(schema, self._plain())

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        return _BatchWriter(self._plain())

    def streamWriter(self, schema, overwrite) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self._plain())


def register(spark: SparkSession) -> None:
    """Make the format known to the session; its code travels with the tasks."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ShardLog)


def sharded(records: DataFrame, shards: int) -> DataFrame:
    """Records with the ``shard`` their key's hash picks."""
    return records.select("*", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"))


def publish_batch(records: DataFrame, path: str, shards: int = 8, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Publish ``(key, value, ...)`` records, all at once when the last task has written; no shuffle."""
    register(records.sparkSession)
    (sharded(records, shards).write.format("shardlog").mode("append").option("path", path)
     .option("producer", uuid.uuid4().hex).option("rowsPerFile", rows_per_file).save())


def publish_stream(records: DataFrame, path: str, checkpoint: str, shards: int = 8,
                   rows_per_file: int = ROWS_PER_FILE, available_now: bool = False) -> StreamingQuery:
    """Publish a stream of records, each micro-batch once, also when a restart runs it again."""
    register(records.sparkSession)
    kept = Folder(checkpoint)
    if not kept.has("producer.json"):  # a new checkpoint counts its batches anew: another producer
        kept.write("producer.json", uuid.uuid4().hex)
    w = (sharded(records, shards).writeStream.format("shardlog").option("path", path).option("rowsPerFile", rows_per_file)
         .option("producer", kept.read("producer.json")).option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_shards(spark: SparkSession, path: str, checkpoint: str, schema: str = "key STRING, value BINARY",
                start: str = "latest", rows_per_batch: int | None = None, rows_per_second: float | None = None,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The log as a stream: the record columns of ``schema`` and their place (``topic``, ``partition``, ``offset``).

    ``checkpoint`` is the one of the query that reads it; the planned ends are kept there. A
    query with bounds needs a running trigger (not ``availableNow``, which asks for
    an end only once): see :func:`drain_shards`.
    """
    register(spark)
    reader = (spark.readStream.format("shardlog").schema(f"{schema}, topic STRING, partition INT, offset BIGINT")
              .option("path", path).option("positions", f"{checkpoint.rstrip('/')}/shards").option("start", start)
              .option("rowsPerTask", rows_per_task))
    if rows_per_batch is not None:
        reader = reader.option("rowsPerBatch", rows_per_batch)
    if rows_per_second is not None:
        reader = reader.option("rowsPerSecond", rows_per_second)
    return reader.load()


def drain_shards(query: StreamingQuery, path: str, checkpoint: str) -> None:
    """Run a query over :func:`read_shards` until it has all that is published now, then stop it."""
    log = Log(path)
    log.refresh()
    target, kept = log.ends(), Folder(f"{checkpoint.rstrip('/')}/shards")

    def position() -> dict:
        return kept.read(PLANNED) if kept.has(PLANNED) else kept.read(INITIAL) if kept.has(INITIAL) else {}

    def reached() -> bool:
        at = position()
        return all(at.get(p, {}).get(k, 0) >= n for p, shards in target.items() for k, n in shards.items())

    try:
        while query.isActive and not reached():
            query.processAllAvailable()
        if query.isActive:
            query.processAllAvailable()  # the last planned batch has run
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
