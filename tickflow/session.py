"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tickflow session needs; cluster-sizing knobs (shuffle
# partitions, maxPartitionBytes) are left to the caller's spark-defaults.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # stateful streams (windows, dedup, per-instrument state) keep state in
    # RocksDB rather than on the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # checkpointed intermediates (hot bucket sets, the latest-price recent
    # branch) are removed from the shared folder once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tickflow",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings tickflow relies on to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tickflow`` importable in executor Python workers (once per app).

    Needed only where Python runs on executors (the stateful streaming move
    detector).  The package is zipped in memory, written into the shared
    checkpoint folder through the Hadoop file system API and distributed with
    ``addPyFile``, as on any cluster; no machine-local folder is involved.
    """
    import io
    import zipfile
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc = spark.sparkContext
    target = f"{scratch_path(spark, 'pyfiles')}/tickflow.zip"
    jpath = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = jpath.getFileSystem(sc._jsc.hadoopConfiguration()).create(jpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only a local master, whose executors share the driver's
    disk, may go without: then a fresh local folder is registered.  On a cluster a
    missing setting is an error.
    """
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            spark.sparkContext.setCheckpointDir(d)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tickflow-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    parent = os.path.dirname(root) if _is_context_subdir(root) else root
    return f"{parent}/tickflow/{name}-{uuid.uuid4().hex[:12]}"


def _is_context_subdir(path: str) -> bool:
    # setCheckpointDir appends a random UUID folder; keep our tables beside it.
    base = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(base)
        return True
    except ValueError:
        return False
