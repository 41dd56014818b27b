"""Atomic publication of output folders.

Each run writes a version folder of its own. Readers go by manifests, small numbered files that name a version; the one of the
highest number is current. A manifest appears by one rename once everything is written, so readers see the old
corpus whole or the new one whole. A run that fails leaves no manifest, and two runs that publish at once get two numbers or
one of them an error. Versions beyond the number to keep are deleted after the switch, oldest first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from answerloom.storage import delete_path

VERSIONS, MANIFESTS = "versions", "manifests"
KEEP_VERSIONS = 3


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def published(spark: SparkSession, root: str) -> list[dict]:
    """The manifests below ``root`` from the oldest on: number and version."""
    files, folder = _path(spark, f"{root}/{MANIFESTS}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    found = []
    for name in sorted(n for n in names if n.endswith(".json") and not n.startswith(("_", "."))):
        text = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFESTS}/{name}")
        stream = files.open(text)
        try:
            found.append(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()
    return sorted(found, key=lambda m: m["number"])


def current(spark: SparkSession, root: str) -> str:
    """The folder of the current version; ValueError when nothing was published."""
    manifests = published(spark, root)
    if not manifests:
        raise ValueError(f"nothing is published below {root}")
    return f"{root}/{VERSIONS}/{manifests[-1]['version']}"


def read_published(spark: SparkSession, root: str, part: str, fmt: str = "json", schema: str | None = None) -> DataFrame:
    """A part of the current version. The version is chosen now; a later publication does not change the frame."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(f"{current(spark, root)}/{part}")


@contextmanager
def publication(spark: SparkSession, root: str, keep: int = KEEP_VERSIONS) -> Iterator[str]:
    """A folder to write a version to. It becomes current when the block ends, and is deleted when the block fails."""
    if keep < 1:
        raise ValueError("the current version is kept")
    version = uuid.uuid4().hex
    folder = f"{root}/{VERSIONS}/{version}"
    try:
        yield folder
    except BaseException:
        delete_path(spark, folder)
        raise
    _switch(spark, root, version)
    kept = published(spark, root)
    for old in kept[:-keep]:
        # The manifest goes first, so that no manifest names a folder that is gone.
        delete_path(spark, f"{root}/{MANIFESTS}/{_name(old['number'])}")
        delete_path(spark, f"{root}/{VERSIONS}/{old['version']}")


def _name(number: int) -> str:
    return f"{number:09d}.json"


def _switch(spark: SparkSession, root: str, version: str) -> None:
    number = max((m["number"] for m in published(spark, root)), default=0) + 1
    files, waiting = _path(spark, f"{root}/{MANIFESTS}/_{version}")
    stream = files.create(waiting, True)
    try:
        stream.write(bytearray(json.dumps({"number": number, "version": version}).encode()))
    finally:
        stream.close()
    _, manifest = _path(spark, f"{root}/{MANIFESTS}/{_name(number)}")
    if files.exists(manifest) or not files.rename(waiting, manifest):
        files.delete(waiting, True)
        raise RuntimeError(f"another run published number {number} below {root} meanwhile; this version is not current")
