"""The list of committed folders of a per-batch sink (A7), and compaction.

Every micro-batch writes a folder nobody reads yet, then commits it: the next
version of the list, a small JSON file under ``_manifest``, takes the place of the last by
one atomic rename that fails if the version exists. Readers take the newest list, so they see
whole batches only: a folder under way, or left by a failed attempt, is on no list, a
replayed batch writes a folder of its own, and committed folders are never touched
again. Compaction writes one folder for many and commits the exchange the same
way. The list also keeps the rows' schema, so a sink without rows can be read.

Files go through Hadoop's ``FileSystem``, so the sink can be on any store Spark writes to.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strandline.operators.quarantine import concurrent_writers

FOLDER = "_manifest"


@dataclass
class Manifest:
    """The committed state of a sink folder; ``state`` is ``{"schema", "entries": [{"low", "high", "folder", ...}]}``."""

    spark: SparkSession
    path: str

    def __post_init__(self) -> None:
        self.jvm, self.conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        self.dir = self._path(f"{self.path}/{FOLDER}")
        self.fs = self.dir.getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(f"{self.path}/{name}"))

    def bytes(self, name: str) -> int:
        return self.fs.getContentSummary(self._path(f"{self.path}/{name}")).getLength()

    def latest(self) -> tuple[int, dict | None]:
        """The newest version and its state (-1 and None before the first commit)."""
        if not self.fs.exists(self.dir):
            return -1, None
        names = [s.getPath().getName() for s in self.fs.listStatus(self.dir)]
        version = max((int(n[:-5]) for n in names if n.endswith(".json")), default=-1)
        if version < 0:
            return -1, None
        stream = self.fs.open(self._path(f"{self.path}/{FOLDER}/{version:020d}.json"))
        try:
            return version, json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, change: Callable[[dict | None], dict]) -> dict:
        """Replace the newest state by ``change`` of it; tried again when another writer came first."""
        while True:
            version, state = self.latest()
            new = change(state)
            draft = self._path(f"{self.path}/{FOLDER}/.{uuid.uuid4().hex}")
            out = self.fs.create(draft, True)
            out.write(bytearray(json.dumps(new), "utf-8"))
            out.close()
            try:
                none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.dir.toUri(), self.conf)
                context.rename(draft, self._path(f"{self.path}/{FOLDER}/{version + 1:020d}.json"), none)
                return new
            except Py4JJavaError as e:
                self.fs.delete(draft, False)
                if "FileAlreadyExistsException" not in str(e.java_exception):
                    raise


def fresh_folder(manifest: Manifest, batch_id: int) -> str:
    """``batch=<id>``, or another name if an earlier attempt has left that folder."""
    name = f"batch={batch_id}"
    return name if not manifest.exists(name) else f"{name}-{uuid.uuid4().hex[:8]}"


def commit_batch(manifest: Manifest, batch_id: int, folder: str, schema: StructType, **more) -> None:
    """Put a batch's folder on the list, in place of the one of an earlier attempt."""
    def change(state: dict | None) -> dict:
        entries = [e for e in (state or {}).get("entries", []) if not e["low"] == e["high"] == batch_id]
        return {"schema": schema.json(), "entries": [*entries, {"low": batch_id, "high": batch_id, "folder": folder, **more}]}

    manifest.commit(change)


def begin(manifest: Manifest, schema: StructType) -> None:
    """The first list of a new sink: no folders, only the schema."""
    if manifest.latest()[1] is None:
        manifest.commit(lambda state: state or {"schema": schema.json(), "entries": []})


def read_committed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The rows of all committed folders; None where nothing was ever committed."""
    _, state = Manifest(spark, path).latest()
    if state is None:
        return None
    return _read(spark, path, [e["folder"] for e in state["entries"]], state["schema"], fmt)


def _read(spark: SparkSession, path: str, folders: list[str], schema: str, fmt: str) -> DataFrame:
    kind = StructType.fromJson(json.loads(schema))
    if not folders:
        return spark.createDataFrame([], kind)
    # one scan over all folders; their own names (``batch=``) would be a column more
    rows = spark.read.format(fmt).schema(kind).option("basePath", path).load([f"{path}/{f}" for f in folders])
    return rows.select(*kind.names)


def compact(spark: SparkSession, path: str, fmt: str = "parquet", partition_by: str | None = "outcome",
            file_bytes: int = 128 << 20) -> int:
    """Write the rows of all committed folders but the newest into one; how many folders it replaced.

    The newest batch is the only one a restart can replay, so it stays as it
    is. The stream may go on meanwhile. Old folders stay for readers that have
    them; expire them with the store's retention.
    """
    manifest = Manifest(spark, path)
    _, state = manifest.latest()
    entries = sorted((state or {"entries": []})["entries"], key=lambda e: e["low"])[:-1]
    if len(entries) < 2:
        return 0
    folders = [e["folder"] for e in entries]
    low, high = entries[0]["low"], max(e["high"] for e in entries)
    target = f"batch={low}-{high}-{uuid.uuid4().hex[:8]}"
    files = max(1, math.ceil(sum(manifest.bytes(f) for f in folders) / file_bytes))
    rows = _read(spark, path, folders, state["schema"], fmt)
    if files < rows.rdd.getNumPartitions():
        rows = rows.coalesce(files)
    writer = rows.write.format(fmt)
    with concurrent_writers(spark):
        (writer.partitionBy(partition_by) if partition_by else writer).save(f"{path}/{target}")
    merged = {k: v for e in entries for k, v in e.items()} | {"low": low, "high": high, "folder": target}

    def change(now: dict | None) -> dict:
        here = [e["folder"] for e in now["entries"]]
        if not set(folders) <= set(here):
            raise RuntimeError("another compaction has replaced these folders")
        return now | {"entries": [merged, *[e for e in now["entries"] if e["folder"] not in folders]]}

    manifest.commit(change)
    return len(folders)
