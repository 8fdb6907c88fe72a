"""Tables of batch folders: ``<root>/load_batch=<id>/...``, each published whole.

A batch is written below ``<root>/_staging`` together with its manifest (its
identity and what belongs to it) and appears by one rename that never replaces
a folder: what is published is complete, an id that is taken stays as it is, and
of two writers of one id one fails. A folder whose manifest names others as
replaced stands for them from that rename on, whether they are still there or not.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

MANIFEST = "_manifest.json"
COMPACTED = "compacted-"
_BATCH_ID = re.compile(r"^[A-Za-z0-9_.-]+$")


class BatchExists(AnalysisException, ValueError):
    """The batch id is taken; nothing was written."""

    def __init__(self, root: str, batch_id) -> None:
        super().__init__(f"batch {batch_id} is already in {root}, with other content")


class Folder(NamedTuple):
    """A published batch folder: its id, path, and manifest (None where it was written without one)."""

    batch: str
    path: str
    manifest: dict | None


def batch_dir(root: str, batch_id) -> str:
    """``<root>/load_batch=<id>``: one folder per load batch (ids are plain names)."""
    bid = str(batch_id)
    if not _BATCH_ID.match(bid):
        raise ValueError(f"batch id must be letters, digits, '_', '.', '-': {bid!r}")
    return f"{root.rstrip('/')}/load_batch={bid}"


def _path(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(conf)


def rename(spark: SparkSession, source: str, target: str, replace: bool = False) -> bool:
    """Rename a file or folder; without ``replace`` an existing target stays and the result is False."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE if replace else kinds.NONE
    (a, fs), (b, _) = _path(spark, source), _path(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    try:
        context.rename(fs.makeQualified(a), fs.makeQualified(b), options)
    except Py4JJavaError as e:
        if not replace and exists(spark, target):
            return False
        raise OSError(f"cannot rename {source} to {target}: {e.java_exception}") from e
    return True


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def write_json(spark: SparkSession, path: str, value: dict) -> bool:
    """Create a small file, seen whole or not at all; False if it is there already, also from another writer at the same time."""
    if exists(spark, path):
        return False
    written = f"{path}.{uuid.uuid4().hex[:12]}"
    p, fs = _path(spark, written)
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()
    if rename(spark, written, path):
        return True
    delete(spark, written)
    return False


def read_json(spark: SparkSession, path: str) -> dict | None:
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _names(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Paths that match, with their modification times."""
    p, fs = _path(spark, pattern)
    found = fs.globStatus(p)
    return {s.getPath().toString(): s.getModificationTime() for s in (found or [])}


def folders(spark: SparkSession, root: str) -> list[Folder]:
    """All published batch folders; manifests are read of those that can stand for others."""
    root = root.rstrip("/")
    with_manifest = {p.rsplit("/", 1)[0] for p in _names(spark, f"{root}/load_batch=*/{MANIFEST}")}
    out = []
    for path in sorted(_names(spark, f"{root}/load_batch=*")):
        batch = path.rsplit("load_batch=", 1)[1]
        manifest = {} if path in with_manifest else None
        if manifest is not None and batch.startswith(COMPACTED):
            manifest = read_json(spark, f"{path}/{MANIFEST}")
        out.append(Folder(batch, path, manifest))
    return out


def live(found: list[Folder]) -> list[Folder]:
    """The folders that no other one replaces."""
    gone = {b for f in found for b in (f.manifest or {}).get("replaces", [])}
    return [f for f in found if f.batch not in gone]


def find(spark: SparkSession, root: str, batch_id) -> Folder | None:
    """The folder that holds a batch (its own, or one it was compacted into), with the batch's manifest."""
    path = batch_dir(root, batch_id)
    own = exists(spark, path)
    if own:
        manifest = read_json(spark, f"{path}/{MANIFEST}")
        if not (manifest or {}).get("replaces"):
            return Folder(str(batch_id), path, manifest)
    for f in folders(spark, root):
        members = (f.manifest or {}).get("members", {})
        if str(batch_id) in members:
            return Folder(f.batch, f.path, {"identity": members[str(batch_id)]})
    return Folder(str(batch_id), path, {}) if own else None


def staging(root: str, batch_id) -> str:
    """A fresh folder for writing a batch (readers skip names with a leading underscore)."""
    return f"{root.rstrip('/')}/_staging/{batch_id}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, staged: str, root: str, batch_id, manifest: dict) -> None:
    """Put a written folder in its place, manifest included; ``BatchExists`` if the id is taken."""
    write_json(spark, f"{staged}/{MANIFEST}", {**manifest, "batch": str(batch_id), "time": time.time()})
    if not rename(spark, staged, batch_dir(root, batch_id)):
        delete(spark, staged)
        raise BatchExists(root, batch_id)


def next_compacted(found: list[Folder]) -> str:
    taken = [int(f.batch.removeprefix(COMPACTED)) for f in found if f.batch.startswith(COMPACTED)]
    return f"{COMPACTED}{max(taken, default=0) + 1:06d}"


def remove_replaced(spark: SparkSession, root: str, keep_hours: float) -> None:
    """Delete what replacing folders published ``keep_hours`` ago stand for, and staging left that long by killed runs.

    Until then a reader that listed the table before the replacement still finds its files.
    """
    before = time.time() - 3600 * keep_hours
    found = folders(spark, root)
    present = {f.batch: f.path for f in found}
    for f in found:
        if f.manifest and f.manifest.get("time", 0) <= before:
            for batch in f.manifest.get("replaces", []):
                if batch in present:
                    delete(spark, present[batch])
    for path, modified in _names(spark, f"{root.rstrip('/')}/_staging/*").items():
        if modified / 1000 <= before:
            delete(spark, path)
