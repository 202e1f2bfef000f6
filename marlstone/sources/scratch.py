"""Where tables lie that outlive a query, and how to tell whether their sources changed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.contracts import EngineError

_own_folder: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``; only a local session without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    key = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise EngineError("set spark.checkpoint.dir to a folder that driver and executors share")
        if key not in _own_folder:
            made = tempfile.mkdtemp(prefix="marlstone-tables-")
            atexit.register(shutil.rmtree, made, ignore_errors=True)
            _own_folder[key] = f"file://{made}"
        base = _own_folder[key]
    return f"{base.rstrip('/')}/marlstone-tables-{key}/{name}-{uuid.uuid4().hex}"


def fingerprint(df: DataFrame) -> tuple:
    """Names, sizes and times of the files that a table is read from."""
    spark = df.sparkSession
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for name in sorted(df.inputFiles()):
        status = path(name).getFileSystem(conf).getFileStatus(path(name))
        out.append((name, status.getLen(), status.getModificationTime()))
    return tuple(out)
