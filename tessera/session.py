"""Giving executors this package."""
from __future__ import annotations

import json
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once for an application: they share no folder with the driver."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        package = Path(__file__).resolve().parent
        to = f"{tempfile.mkdtemp(prefix='tessera-')}/{package.name}.zip"
        with zipfile.ZipFile(to, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
        sc.addPyFile(to)


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share for written tables; a folder of this machine in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="tessera-work-"))
    return _local[0]


_local: list[str] = []


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it exists, wherever Spark can reach it."""
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """A JSON file with sorted keys, wherever Spark can write; renamed into place when it is whole."""
    at, fs = _fs(spark, path)
    part, _ = _fs(spark, f"{path}.tmp")
    out = fs.create(part, True)
    try:
        out.write(bytearray(json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True).encode()))
    finally:
        out.close()
    fs.delete(at, False)
    fs.rename(part, at)


def read_json(spark: SparkSession, path: str) -> object | None:
    """The value of a JSON file; None where there is none."""
    at, fs = _fs(spark, path)
    if not fs.exists(at):
        return None
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
