"""Several tables published together, as one transaction (SNK-3, SNK-4).

Tables are written to a new folder ``version=<id>`` that no reader looks at. When all are written and the checks passed,
a manifest that names the folder is put into ``manifests`` under the next number, by a rename that fails if that number
exists. Readers take the highest manifest, so they see either all tables of the old version or all of the new one; a run
that fails, or loses a race, leaves the old version as it was. Old versions stay until ``prune``.

Files go through Spark's file systems, so the folder may be anywhere Spark writes. On an object store whose rename is no
single step, the manifest should be put into a store that has one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DIGITS = 12  #: digits of a manifest's number, so that names sort as numbers


class PublishError(RuntimeError):
    """The new version was not published; the one before stays current."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, base: str) -> list[int]:
    jvm, fs = _fs(spark, base)
    folder = jvm.org.apache.hadoop.fs.Path(f"{base}/manifests")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1].isdigit())


def _read_manifest(spark: SparkSession, base: str, number: int) -> dict:
    rows = spark.read.option("wholetext", True).text(f"{base}/manifests/{number:0{DIGITS}d}.json").collect()  # one small file
    return json.loads(rows[0][0])


def current(spark: SparkSession, base: str) -> dict | None:
    """The current manifest: ``{"version", "tables": {name: folder}, "info": {...}}``, or None before the first one."""
    numbers = _manifests(spark, base)
    return _read_manifest(spark, base, numbers[-1]) if numbers else None


def read_current(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """All tables of the current version."""
    m = current(spark, base)
    if m is None:
        raise FileNotFoundError(f"nothing is published under {base}")
    return {name: spark.read.parquet(f"{base}/{folder}") for name, folder in m["tables"].items()}


def publish(spark: SparkSession, base: str, tables: dict[str, DataFrame],
            check: Callable[[dict[str, DataFrame]], list[str]] | None = None,
            partition_by: dict[str, list[str]] | None = None, info: dict | None = None) -> dict:
    """Writes ``tables`` as the next version and makes it current; returns its manifest.

    ``check`` gets the tables as written and names what is wrong with them; anything named ends the publication. Two
    runs that publish at once both write their folders, and the second to commit fails with ``PublishError``.
    """
    numbers = _manifests(spark, base)
    number = numbers[-1] + 1 if numbers else 1
    version = uuid.uuid4().hex
    folders = {name: f"version={version}/{name}" for name in tables}
    written = {}
    for name, df in tables.items():
        out, keys = df, (partition_by or {}).get(name, [])
        writer = out.hint("rebalance", *keys).write.partitionBy(*keys) if keys else out.write
        writer.parquet(f"{base}/{folders[name]}")
        written[name] = spark.read.parquet(f"{base}/{folders[name]}")
    wrong = check(written) if check else []
    if wrong:
        raise PublishError("; ".join(wrong))
    manifest = {"version": version, "number": number, "tables": folders, "info": info or {}}
    jvm, fs = _fs(spark, base)
    path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(f"{base}/manifests"))
    temp = path(f"{base}/manifests/_{version}.tmp")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()
    target = path(f"{base}/manifests/{number:0{DIGITS}d}.json")
    if fs.exists(target) or not fs.rename(temp, target):
        fs.delete(temp, False)
        raise PublishError(f"version {number} was published by another run")
    return manifest


def prune(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Deletes versions other than the last ``keep``, manifests first; returns the folders that went."""
    jvm, fs = _fs(spark, base)
    path = jvm.org.apache.hadoop.fs.Path
    gone = []
    for number in _manifests(spark, base)[:-keep]:
        m = _read_manifest(spark, base, number)
        fs.delete(path(f"{base}/manifests/{number:0{DIGITS}d}.json"), False)
        folder = f"version={m['version']}"
        fs.delete(path(f"{base}/{folder}"), True)
        gone.append(folder)
    return gone
