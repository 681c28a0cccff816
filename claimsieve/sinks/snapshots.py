"""SNK-03, SNK-04: full reloads that no reader ever sees half done.

Every run writes all its tables into a version folder of its own. When the last one stands, a pointer file that names
the version is written beside the old pointer and renamed over it: one step that readers see wholly or not at all. A run
that is lost on the way leaves the former version readable, and its remains go with the next run. The version before the
current one stays, so that readers which have resolved the pointer already can finish. Runs on one base follow each
other; two at a time would take each other's folders for remains.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import replace

from pyspark.sql import SparkSession

from claimsieve.sources.layout import Layout

POINTER = "CURRENT"


class NothingPublished(Exception):
    """No run has finished on this base yet."""


def _place(spark: SparkSession, path: str):
    """(file system, qualified path) of a path in any store that Spark reaches."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = plain.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(plain)


def begin(layout: Layout) -> Layout:
    """The folders of a new version; names rise with the time."""
    started = datetime.datetime.now(datetime.timezone.utc)
    return replace(layout, version=f"{started:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}")


def _pointed(spark: SparkSession, layout: Layout) -> list[str]:
    """The current version and the one before it, as far as there are any."""
    store, pointer = _place(spark, layout.pointer(POINTER))
    if not store.exists(pointer):
        return []
    stream = store.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def publish(spark: SparkSession, layout: Layout) -> None:
    """Make a written version the current one."""
    before = _pointed(spark, layout)[:1]
    _, pointer = _place(spark, layout.pointer(POINTER))
    store, fresh = _place(spark, layout.pointer(f"_{POINTER}-{uuid.uuid4().hex}"))
    stream = store.create(fresh, False)
    stream.writeBytes("\n".join([layout.version, *before]))
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    options[0] = getattr(fs, "Options$Rename").OVERWRITE
    context = fs.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, pointer, options)


def current(spark: SparkSession, layout: Layout) -> Layout:
    """The folders of the current version; a layout of a certain version stays as it is."""
    if layout.version is not None:
        return layout
    found = _pointed(spark, layout)
    if not found:
        raise NothingPublished(layout.base)
    return replace(layout, version=found[0])


def versions(spark: SparkSession, layout: Layout) -> list[str]:
    store, folder = _place(spark, layout.versions())
    return sorted(status.getPath().getName() for status in store.listStatus(folder)) if store.exists(folder) else []


def remove_old(spark: SparkSession, layout: Layout) -> None:
    """Versions that are neither the current one nor the one before go, remains of lost runs among them."""
    kept = _pointed(spark, layout)
    for version in versions(spark, layout):
        if kept and version not in kept:
            store, folder = _place(spark, f"{layout.versions()}/{version}")
            store.delete(folder, True)
