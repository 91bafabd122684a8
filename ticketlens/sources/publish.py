"""Versioned publishing of stored tables (S4): writers never touch what readers read.

A version is a folder of its own with all its tables; only when every table is written, a manifest
names it as the newest. Readers resolve the manifest first and then read that version's files, so a
reader meets either the whole old version or the whole new one, and one that started before a publish
goes on with the files it has. A manifest is one small text file, whose write is one rename, so
a writer that dies leaves at most a folder that no manifest names. :func:`input_version` tells when a stored
result was made from other input files.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a folder in any store that Spark reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf), where


def _manifests(spark: SparkSession, path: str) -> list[str]:
    """Names of the manifests, oldest first: a number and the version's folder."""
    fs, where = _files(spark, f"{path.rstrip('/')}/_manifests")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the published versions, oldest first."""
    return [n.split("-", 1)[1] for n in _manifests(spark, path)]


def publish(tables: dict[str, tuple[DataFrame, list[str]]], path: str, spark: SparkSession,
            version: str | None = None) -> str:
    """Write ``{name: (frame, partition columns)}`` as a new version under ``path`` and make it the newest.
    Returns the version: a name of its own, if none is given. One that is published already stays as it is;
    files of one that was left unfinished are replaced.
    Of two writers at once, the one that ends last is the newest."""
    root = path.rstrip("/")
    if version in versions(spark, root):
        return version
    version = version or uuid.uuid4().hex
    for name, (df, parts) in tables.items():
        writer = df.write.mode("overwrite")
        writer = writer.partitionBy(*parts) if parts else writer
        writer.parquet(f"{root}/{version}/{name}")
    fs, folder = _files(spark, f"{root}/_manifests")
    fs.mkdirs(folder)
    jvm = spark.sparkContext._jvm
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".{version}")
    out = fs.create(draft, True)
    out.write(bytearray("\n".join(sorted(tables)).encode()))
    out.close()
    last = max((int(n.split("-", 1)[0]) for n in _manifests(spark, root)), default=0)
    # a number that another writer took meanwhile is no clash: the name has the version in it
    if not fs.rename(draft, jvm.org.apache.hadoop.fs.Path(folder, f"{last + 1:012d}-{version}")):
        raise OSError(f"{root}: the manifest of {version} can't be written")
    return version


def published(spark: SparkSession, path: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the newest if none is named."""
    root = path.rstrip("/")
    found = _manifests(spark, root)
    if version is not None:
        found = [n for n in found if n.endswith(f"-{version}")]
    if not found:
        raise FileNotFoundError(f"nothing is published under {path}")
    fs, at = _files(spark, f"{root}/_manifests/{found[-1]}")
    stream = fs.open(at)
    names = bytes(stream.readAllBytes()).decode().split("\n")
    stream.close()
    return {n: spark.read.parquet(f"{root}/{found[-1].split('-', 1)[1]}/{n}") for n in names}


def published_parts(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """One table over all published versions together, where each holds a part (a batch) of it; None
    before the first."""
    root = path.rstrip("/")
    found = versions(spark, root)
    return spark.read.parquet(*[f"{root}/{v}/{name}" for v in found]) if found else None


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` versions, manifest first; returns the versions deleted."""
    gone = _manifests(spark, path)[:-keep] if keep > 0 else []
    for name in gone:
        for part in (f"_manifests/{name}", name.split("-", 1)[1]):
            fs, at = _files(spark, f"{path.rstrip('/')}/{part}")
            fs.delete(at, True)
    return [n.split("-", 1)[1] for n in gone]


def input_version(spark: SparkSession, paths: list[str]) -> str:
    """A digest of the names, sizes and times of the files under ``paths``: it changes with the input."""
    seen = []
    for path in paths:
        fs, where = _files(spark, path)
        if not fs.exists(where):
            seen.append(f"{path} -")
            continue
        listed = fs.listFiles(where, True)
        while listed.hasNext():
            f = listed.next()
            seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()
