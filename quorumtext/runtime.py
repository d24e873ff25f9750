"""What every query needs from the session: tables, shipped code, a shared checkpoint folder."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``sf_dir``, read by Spark whatever store it lies in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors once per application.

    Python workers then import it whatever their own PYTHONPATH is. The driver's
    file server hands the archive out, so executors need no folder in common. Arrow batches
    are bounded to 8 MB, unless the session has a bound of its own, so that batches of long
    texts do not add up in the workers.
    """
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, "8m")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    d = tempfile.mkdtemp(prefix="quorumtext-code-")  # served by the driver as long as it lives
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    path = os.path.join(d, "quorumtext.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the cluster's ``spark.checkpoint.dir``.

    Only where the session names none and runs on this machine alone (tests, a laptop) a
    folder of this machine is set; on a cluster that is an error, as executors share no such
    folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(named)
        return named
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quorumtext-checkpoint-"))
        current = sc._jsc.sc().getCheckpointDir()
    return current.get()


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, into the shared checkpoint folder, and cut its lineage."""
    shared_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Tables:
    """Tables of one operation, written to the shared checkpoint folder; all go when it ends, also if it fails.

    Unlike a checkpoint a table brings nothing of its plan along, which over many steps makes
    each plan's analysis longer than the last; as columns it also takes fewer bytes.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.n = spark, f"{shared_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def __enter__(self) -> Tables:
        return self

    def __call__(self, rows: DataFrame, alone: bool = False) -> DataFrame:
        """``rows``, computed once and read back; with ``alone`` the table before goes."""
        self.n += 1
        path = f"{self.path}/{self.n}"
        rows.write.parquet(path)
        if alone:
            self._delete(f"{self.path}/{self.n - 1}")
        return self.spark.read.schema(rows.schema).parquet(path)

    def __exit__(self, *failure: object) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(there, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    Spark's cleaner removes them once nothing on the driver refers to them any more, which it
    learns from garbage collection; between large steps that is worth asking for. Callers
    drop their own references first.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
