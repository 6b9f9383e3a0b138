"""SparkSession construction and cluster-aware settings.

Every setting below is applied only when the session does not already carry a
value, so a cluster's own configuration (shuffle partitions, checkpoint folder,
broadcast threshold) always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Defaults for a session this library creates itself (tests, bench, local runs).
_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8192",
    "spark.ui.enabled": "false",
    # remove reliable checkpoint files once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
    # AQE converts a shuffle join into a broadcast join only when the runtime
    # size of a side is below this bound, so no broadcast grows with the data.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def missing_settings(have: set[str], master: str | None = None, shuffle_partitions: int | None = None) -> dict[str, str]:
    """The defaults for every key that the environment has not set itself."""
    wanted = {"spark.master": master or os.environ.get("SKEIN_MASTER", "local[8]"),
              "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
              "spark.driver.memory": os.environ.get("SKEIN_DRIVER_MEMORY", "16g"), **_LOCAL_DEFAULTS}
    if "spark.master" in have:  # a cluster: its sizes are its own
        wanted = dict(_LOCAL_DEFAULTS)
    return {k: v for k, v in wanted.items() if k not in have}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "skein") -> SparkSession:
    """Return the active session, or build one; what spark-submit or its files set is kept."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    have: set[str] = set()
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # started by spark-submit: its settings are in the JVM
        SparkContext._ensure_initialized()
        have = {k for k, _ in SparkConf().getAll()}
    builder = SparkSession.builder.appName(app_name)
    for key, value in missing_settings(have, master, shuffle_partitions).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset (local tests) a private scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="skein-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables next to the reliable checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}"


#: Rows of a file of a stored table at most.
FILE_ROWS = 100_000


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once to the scratch folder as compressed Parquet and read back.

    Cuts the lineage as a reliable checkpoint does, but a checkpoint holds whole uncompressed rows: several times the
    bytes for a large table. Columns have neutral names in the files, so any column name will do. A column without a
    type (``void``) has no Parquet form; such a frame is checkpointed. However well rows compress, ``FILE_ROWS`` bounds
    what one task reads back: Spark counts 4 MB for opening a file, so 32 files at most fill its 128 MB.
    """
    spark = df.sparkSession
    if any("void" in f.dataType.simpleString() for f in df.schema.fields):
        ensure_checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    plain.write.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)


_SHIPPED: set[int] = set()


def ship_code(spark: SparkSession) -> None:
    """Make the ``skein`` package importable in Python workers (``addPyFile``).

    Functions handed to ``mapInPandas`` are pickled by reference to their module;
    on a cluster (or when the driver runs from another folder) the executors
    need the package itself. The archive is built once per driver process and
    registered once per SparkContext.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="skein-code-"), "skein.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(id(sc))
