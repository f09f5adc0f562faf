"""Tables of batches whose readers open what a manifest names, not what a folder lists.

``batches/batch_id=n`` holds a batch, ``compacted/…`` what was folded from the oldest ones. A folder is written elsewhere and
renamed, so it is there whole or not at all. A manifest is one small JSON file a version: the live batches, the folded
folder, the last batch in it, and facts of the writer. The next version appears by a rename (on a local disk a link) that
fails if another writer was first, who is then read again; so every version is a whole one, and none is lost. On stores whose renames copy, keep
manifests where they do not.
"""

import json
import os
import pathlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T

KEPT_VERSIONS = 20
EMPTY = {"version": -1, "live": [], "folded": None, "done": -1, "facts": {}}


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = of.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, system.makeQualified(of)


def _names(spark: SparkSession, path: str) -> list[str]:
    system, folder = _files(spark, path)
    return [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Whether the source has become the target; not if that exists."""
    jvm = spark.sparkContext._jvm
    system, old = _files(spark, source)
    new = _files(spark, target)[1]
    system.mkdirs(new.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(old, new, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as problem:
        if "FileAlreadyExists" not in problem.java_exception.getClass().getName():
            raise
        return False
    return True


def ensure(spark: SparkSession, path: str):
    """Makes a folder that a stream is to watch before anything has landed in it."""
    system, folder = _files(spark, path)
    system.mkdirs(folder)


def file_state(spark: SparkSession, files: list[str]) -> tuple:
    """Names, sizes and times of files: differs when one of them was written anew."""
    found = []
    for name in sorted(files):
        system, path = _files(spark, name)
        status = system.getFileStatus(path)
        found.append((name, status.getLen(), status.getModificationTime()))
    return tuple(found)


def _delete(spark: SparkSession, path: str):
    system, of = _files(spark, path)
    system.delete(of, True)


def read(spark: SparkSession, table: str) -> dict:
    """The newest manifest, ``EMPTY`` if there is none. Its folder lists ``KEPT_VERSIONS`` files and what came since the last pruning."""
    versions = [int(n.removesuffix(".json")) for n in _names(spark, f"{table}/manifest") if n.endswith(".json") and not n.startswith(".")]
    if not versions:
        return EMPTY
    return _load(spark, table, max(versions))


def _load(spark: SparkSession, table: str, version: int) -> dict:
    system, path = _files(spark, f"{table}/manifest/{version:012d}.json")
    stream = system.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def swap(spark: SparkSession, table: str, change) -> dict:
    """Publishes ``change(newest manifest)`` as the next version; None leaves things as they are. Repeats if another writer was first."""
    while True:
        old = read(spark, table)
        changed = change(old)
        if changed is None:
            return old
        new = {**old, **changed, "version": old["version"] + 1}
        if _publish(spark, table, f"{new['version']:012d}.json", json.dumps(new).encode()):
            if new["version"] >= KEPT_VERSIONS:
                _delete(spark, f"{table}/manifest/{new['version'] - KEPT_VERSIONS:012d}.json")
            return new


def _publish(spark: SparkSession, table: str, name: str, content: bytes) -> bool:
    """Whether the file has appeared, whole; not if it exists. On local disks, whose renames replace, by a link, which does not."""
    written = f"{table}/manifest/.{uuid.uuid4().hex}"
    system, path = _files(spark, written)
    system.mkdirs(path.getParent())
    if path.toUri().getScheme() == "file":
        local = pathlib.Path(path.toUri().getPath())
        local.write_bytes(content)
        try:
            os.link(local, local.with_name(name))
        except FileExistsError:
            return False
        finally:
            local.unlink()
        return True
    stream = system.create(path, False)
    try:
        stream.write(content)
    finally:
        stream.close()
    done = _rename(spark, written, f"{table}/manifest/{name}")
    if not done:
        _delete(spark, written)
    return done


def land(rows: DataFrame, table: str, folder: str) -> str:
    """Writes the rows as ``folder`` of the table, unless it is there already from a run that got as far."""
    spark, staged, target = rows.sparkSession, f"{table}/staged/{uuid.uuid4().hex}", f"{table}/{folder}"
    system, path = _files(spark, target)
    if not system.exists(path):
        rows.write.parquet(staged)
        if not _rename(spark, staged, target):
            _delete(spark, staged)
    return target


def add_batch(spark: SparkSession, table: str, batch: int, **facts) -> dict:
    """Names a landed batch. One that is named or folded already stays as it is, so a batch may run again."""

    def change(old):
        if batch <= old["done"] or batch in old["live"]:
            return None
        return {"live": sorted([*old["live"], batch]), "facts": {**old["facts"], **facts}}

    return swap(spark, table, change)


def fold(rows: DataFrame, table: str, up_to: int) -> dict:
    """Writes ``rows``, which stand for the batches up to ``up_to``, and names them in place of these."""
    folder = f"compacted/up_to={up_to}-{uuid.uuid4().hex[:8]}"
    land(rows, table, folder)
    later = lambda old: {"live": [b for b in old["live"] if b > up_to], "folded": folder, "done": up_to}
    return swap(rows.sparkSession, table, lambda old: later(old) if up_to >= old["done"] else None)


def newest_batch(manifest: dict) -> int | None:
    newest = max([manifest["done"], *manifest["live"]])
    return newest if newest >= 0 else None


def batches(spark: SparkSession, table: str, manifest: dict, schema: T.StructType) -> DataFrame:
    """The rows of the live batches, ``batch_id`` from their folders' names."""
    paths = [f"{table}/batches/batch_id={b}" for b in manifest["live"]]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{table}/batches").parquet(*paths)


def folded(spark: SparkSession, table: str, manifest: dict, schema: T.StructType) -> DataFrame | None:
    return spark.read.schema(schema).parquet(f"{table}/{manifest['folded']}") if manifest["folded"] else None


def expire(spark: SparkSession, table: str, up_to: int | None = None, versions=KEPT_VERSIONS) -> int:
    """Deletes folders that none of the newest manifests names, and tells how many. Batches later than ``up_to`` stay, for streams that have yet to read them.

    Only batches folded in every kept manifest go, so neither a batch that is landing nor a reader of a kept version is hurt.
    """
    kept = sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{table}/manifest") if n.endswith(".json") and not n.startswith("."))
    manifests = [_load(spark, table, v) for v in kept[-versions:]]
    least = min((m["done"] for m in manifests), default=-1)
    least = least if up_to is None else min(least, up_to)
    named = {m["folded"] for m in manifests}
    old = [f"batches/{n}" for n in _names(spark, f"{table}/batches") if n.startswith("batch_id=") and int(n[9:]) <= least]
    old += [f"compacted/{n}" for n in _names(spark, f"{table}/compacted") if f"compacted/{n}" not in named and int(n[6:].split("-")[0]) <= least]
    for folder in old:
        _delete(spark, f"{table}/{folder}")
    return len(old)
