"""Session helpers."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package's code to the Python workers, once per application, so that they need no PYTHONPATH. Where the application doesn't set them, the batches that go to
    Python are bounded in bytes, too: 10,000 texts may be long."""
    if not spark.sparkContext.getConf().contains(BATCH_BYTES):
        spark.conf.set(BATCH_BYTES, str(16 << 20))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).parent
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if given:  # the folder that all machines share
            at = f"{given.rstrip('/')}/code-{uuid.uuid4().hex}/quireflow.zip"
            path = spark._jvm.org.apache.hadoop.fs.Path(at)
            out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
            out.write(bytearray(buffer.getvalue()))
            out.close()
        elif not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            at = os.fspath(Path(tempfile.mkdtemp(prefix="quireflow-code-")) / "quireflow.zip")
            Path(at).write_bytes(buffer.getvalue())
        spark.sparkContext.addPyFile(at)
        _SHIPPED.add(app)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir. Where that is unset, a local one is made if Spark runs in one process; on a cluster it is an error."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    at = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not given and at.isDefined():
        return str(at.get()).rstrip("/")
    if not given:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        given = tempfile.mkdtemp(prefix="quireflow-")
    if at.isEmpty():
        spark.sparkContext.setCheckpointDir(given)
    return given.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
