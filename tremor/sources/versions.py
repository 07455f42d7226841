"""Tables that are replaced as a whole: versions in folders of their own, the current one named by a manifest.

A writer fills a new folder and then swaps the manifest, a small file, by one
atomic rename.  Until then readers see the old version, whatever happens to the
writer; the version before the current one stays for readers that have opened it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tremor.session import jvm_context

MANIFEST = "_current.json"
PREFIX = "v-"


def _hadoop(spark: SparkSession):
    sc = jvm_context(spark)
    if sc is None:
        raise RuntimeError("versioned tables need a client with access to the file system")
    return sc._jvm, sc._jsc.hadoopConfiguration()


def _fs(spark: SparkSession, path: str):
    jvm, conf = _hadoop(spark)
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf), place


def manifest(spark: SparkSession, root: str) -> list[str]:
    """The versions that are kept, the current one first; empty if there is no manifest."""
    fs, place = _fs(spark, f"{root.rstrip('/')}/{MANIFEST}")
    if not fs.exists(place):
        return []
    stream = fs.open(place)
    try:
        return json.loads(_hadoop(spark)[0].org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["versions"]
    finally:
        stream.close()


def current(spark: SparkSession, root: str) -> str:
    """The folder of the current version; ``root`` itself if it is no versioned table."""
    if jvm_context(spark) is None:
        return root
    kept = manifest(spark, root)
    return f"{root.rstrip('/')}/{kept[0]}" if kept else root


def publish(spark: SparkSession, root: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Let ``write`` fill a new version's folder, make it the current one, and return it.

    One writer at a time; of two, the one that swaps last wins.  Folders older
    than the ``keep`` last published versions go, those of failed writers too.
    """
    root = root.rstrip("/")
    version = f"{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write(f"{root}/{version}")
    fs, folder = _fs(spark, f"{root}/{version}")
    if not fs.exists(folder):
        raise RuntimeError(f"nothing was written to {root}/{version}")
    kept = [version, *manifest(spark, root)][: max(1, keep)]
    _swap(spark, root, json.dumps({"versions": kept}))
    for status in fs.listStatus(folder.getParent()):
        name = status.getPath().getName()
        if name.startswith(PREFIX) and name < min(kept):
            fs.delete(status.getPath(), True)
    return f"{root}/{version}"


def _swap(spark: SparkSession, root: str, text: str) -> None:
    jvm, conf = _hadoop(spark)
    fs, aside = _fs(spark, f"{root}/_manifest-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(options, 1)
    how[0] = options.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(aside, jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFEST}"), how)
