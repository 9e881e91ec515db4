"""What operators need of a session: this package on the executors, and tables that all of them see."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Bytes of a record batch that a Python worker reads at once.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}-code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Hold the session's record batches to ``BATCH_BYTES``: a batch of 10,000 whole texts is held several times over by each Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A temporary one is set only where that is unset in a session of one machine; a cluster without it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gleaner-"))
        current = spark._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """df written once in the shared folder and read back: later uses see the same rows, and plans their true size."""
    path = f"{shared_dir(df.sparkSession)}/stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
