"""Published runs: what a queue worker writes appears all at once, or not at all (Q7).

A store is a folder of tables. A run stages its outputs in a folder of its own and then publishes them
with one manifest file, which lists the folders of every table and how far each consumer has read each topic.
Readers take the newest manifest and nothing else, so outputs of a run that died are never seen, and its retry
starts from the same published state. Landed files are copied into a folder of the next run's number by a
stream whose checkpoint records them, so a run reads its own increment and every landed row belongs to one run.

Tables grow by one folder a run. ``TIER`` folders of a tier are merged into one of the next, so
a table of n runs has some ``TIER * log(n)`` folders and each row is rewritten ``log(n)`` times; a log of statuses
is folded to one row per key on the way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators.upsert import STATUS_ORDER
from skein.sources import schemas
from skein.sources.readers import empty, path_exists

#: Folders of one tier that a table may have before they are merged.
TIER = 16

STATUS_LOG = "user_id STRING, kind STRING, status STRING, at STRING, run BIGINT"


class RunConflict(RuntimeError):
    """Another run was published under the same number."""


class RunStore:
    """Tables below ``base`` as published runs left them."""

    def __init__(self, spark: SparkSession, base: str, folds: dict[str, Callable[[DataFrame], DataFrame]] | None = None):
        self.spark, self.base, self.folds = spark, base.rstrip("/"), folds or {}

    def _fs(self, path: str):
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def manifest(self) -> dict:
        """The newest published state: run number, folders (name, tier) by table, offsets by consumer and topic."""
        fs, folder = self._fs(f"{self.base}/manifest")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        last = max((n for n in names if n.endswith(".json") and not n.startswith(".")), default=None)
        if last is None:
            return {"run": 0, "tables": {}, "offsets": {}}
        return json.loads(self._text(f"{self.base}/manifest/{last}"))

    def _text(self, path: str) -> str:
        fs, hpath = self._fs(path)
        stream = fs.open(hpath)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _committed(self, path: str) -> list[str]:
        """Files that the landing stream committed to a run's folder, by the stream's own log (a batch that died leaves
        others, which its log does not name). The log of one folder does not begin at batch 0, so Spark's reader of
        whole stream outputs does not take it."""
        log = f"{path}/_spark_metadata"
        if not path_exists(self.spark, log):
            return []
        fs, folder = self._fs(log)
        names = [s.getPath().getName() for s in fs.listStatus(folder) if not s.getPath().getName().startswith(".")]
        lines = [line for n in names for line in self._text(f"{log}/{n}").splitlines()[1:]]  # the first is a version
        return sorted({json.loads(line)["path"] for line in lines})

    def folders(self, name: str) -> list[str]:
        return [f"{self.base}/{folder}" for folder, _ in self.manifest()["tables"].get(name, [])]

    def read(self, name: str, ddl: str, since: int = 0) -> DataFrame:
        """A table's published rows (from its folder number ``since`` on); empty if it has none."""
        paths = self.folders(name)[since:]
        if not paths:
            return empty(self.spark, ddl)
        return self.spark.read.schema(schemas.struct_type(ddl)).parquet(*paths)

    def table(self, name: str) -> DataFrame:
        """A table that has been published, in the columns it was written with."""
        return self.spark.read.parquet(*self.folders(name))

    def begin(self) -> Run:
        return Run(self, self.manifest())

    def unread(self, consumer: str, topic: str, ddl: str) -> tuple[DataFrame, int] | None:
        """(rows of a topic that the consumer has not read, its offset after them), or None."""
        at = self.manifest()["offsets"].get(consumer, {}).get(topic, 0)
        end = len(self.folders(topic))
        return (self.read(topic, ddl, at), end) if end > at else None

    def compact(self) -> int:
        """Merge full tiers; returns the number of merges. Topics that consumers count folders of are left alone."""
        done = 0
        state = self.manifest()
        topics = {t for read in state["offsets"].values() for t in read}
        for name, folders in state["tables"].items():
            tier = folders[-1][1] if folders else 0
            same = [f for f, k in folders if k == tier]
            if name in topics or len(same) < TIER:
                continue
            rows = self.spark.read.parquet(*[f"{self.base}/{f}" for f in same])
            run = self.begin()
            run.stage(name, self.folds[name](rows) if name in self.folds else rows, replaces=same, tier=tier + 1)
            run.publish()
            done += 1
        return done


class Run:
    """One run's staged outputs; nothing of it is seen before ``publish``."""

    def __init__(self, store: RunStore, state: dict):
        self.store, self.state, self.number = store, state, state["run"] + 1
        self.folder = f"data/{self.number:08d}-{uuid.uuid4().hex[:12]}"
        self.staged: dict[str, tuple[str, list[str], int]] = {}

    def land(self, landing: str, ddl: str) -> DataFrame:
        """What has landed since the last published run, with ``landed_id``: the row's place in the landed copy.

        A retry of the run has the same number, so it finds the copies of the attempt that died, and the stream
        adds what has landed since.
        """
        from skein.streaming.queues import read_queue, run_available
        spark, path = self.store.spark, f"{self.store.base}/landed/{self.number:08d}"
        run_available(read_queue(spark, landing, ddl).writeStream.format("parquet").outputMode("append")
                      .option("path", path).option("checkpointLocation", f"{self.store.base}/checkpoint"))
        files = self.store._committed(path)
        if not files:
            return empty(spark, f"{ddl}, landed_id STRING")
        return spark.read.schema(schemas.struct_type(ddl)).parquet(*files).withColumn(
            "landed_id", F.concat_ws("/", F.lit(f"{self.number:08d}"), "_metadata.file_name",
                                     F.col("_metadata.row_index").cast("string")))

    def stage(self, name: str, df: DataFrame, replaces: list[str] = (), tier: int = 0) -> None:
        path = f"{self.folder}/{name}"
        df.write.parquet(f"{self.store.base}/{path}")
        self.staged[name] = (path, list(replaces), tier)

    def publish(self, offsets: dict[str, dict[str, int]] | None = None) -> int:
        """Make the staged outputs, and the consumers' new offsets, the store's state in one step."""
        state = json.loads(json.dumps(self.state))
        for name, (path, replaces, tier) in self.staged.items():
            kept = [f for f in state["tables"].get(name, []) if f[0] not in replaces]
            at = next((i for i, (_, k) in enumerate(kept) if k < tier), len(kept))
            state["tables"][name] = [*kept[:at], [path, tier], *kept[at:]]
        for consumer, read in (offsets or {}).items():
            state["offsets"].setdefault(consumer, {}).update(read)
        state["run"] = self.number
        name = f"{self.store.base}/manifest/{self.number:08d}.json"
        fs, target = self.store._fs(name)
        _, draft = self.store._fs(f"{self.store.base}/manifest/.{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            raise RunConflict(name)
        return self.number


def fold_status(log: DataFrame) -> DataFrame:
    """One row per user and kind: the most advanced status in Q6's order, of those the latest (time, then run)."""
    rank = F.create_map(*[x for k, v in STATUS_ORDER.items() for x in (F.lit(k), F.lit(v))])[F.col("status")]
    return log.groupBy("user_id", "kind").agg(
        F.max_by(F.struct("status", "at", "run"), F.struct(rank, F.col("at"), F.col("run"), F.col("status"))).alias("s")
    ).select("user_id", "kind", "s.status", "s.at", "s.run")


def consume(store: RunStore, consumer: str, topic: str, ddl: str,
            step: Callable[[DataFrame], dict[str, DataFrame]]) -> bool:
    """One run of a topic's consumer: its unread rows go through ``step``, whose outputs are published together with
    the new offset. False if there was nothing to read."""
    got = store.unread(consumer, topic, ddl)
    if got is None:
        return False
    rows, end = got
    run = store.begin()
    for name, out in step(rows).items():
        run.stage(name, out)
    run.publish({consumer: {topic: end}})
    return True
