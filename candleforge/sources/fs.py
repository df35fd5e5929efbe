"""Small files in whatever store Spark reaches."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, else the context's checkpoint folder, else one that all can reach.

    That is a temporary one where driver and executors are one process (master local), and one in the
    warehouse on a cluster if that isn't on a local file system. Without any, an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if at := context.getCheckpointDir():
        return at.rstrip("/")
    if context.master.startswith("local"):
        if context.applicationId not in _OWN:
            _OWN[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="candleforge-")
        return _OWN[context.applicationId]
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if "://" in warehouse and not warehouse.startswith("file:"):
        return f"{warehouse.rstrip('/')}/_candleforge"
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if there is no such folder."""
    fs, at = _at(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """Under a temporary name, then renamed."""
    fs, tmp = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    _, at = _at(spark, path)
    fs.mkdirs(at.getParent())
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()
    fs.delete(at, False)
    if not fs.rename(tmp, at):
        raise OSError(f"can't rename to {path}")


def read_json(spark: SparkSession, path: str):
    """None if the file is missing or broken."""
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    except ValueError:
        return None
    finally:
        stream.close()
