"""Small records in the shared folder that exactly one writer can create: what is committed, readers see whole."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text; False, and nothing changed, if there is one already.

    The text is written under another name first. Giving it its name is one atomic step of the file system, which fails where the name is
    taken: a hard link on a local disk, a rename that never overwrites elsewhere.
    """
    system, place = _file_system(spark, path)
    jvm = spark._jvm
    system.mkdirs(place.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex}")
    out = system.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if system.getScheme() == "file":
            try:
                os.link(draft.toUri().getPath(), place.toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(draft, place, never)
        except Exception:
            if system.exists(place):
                return False
            raise
        return True
    finally:
        if system.exists(draft):
            system.delete(draft, False)


def records(spark: SparkSession, folder: str) -> dict[int, str]:
    """The paths of the numbered records of a folder, without drafts."""
    system, place = _file_system(spark, folder)
    if not system.exists(place):
        return {}
    return {int(s.getPath().getName()): s.getPath().toString() for s in system.listStatus(place) if s.getPath().getName().isdigit()}


def text_of(spark: SparkSession, path: str) -> str:
    system, place = _file_system(spark, path)
    source = system.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that nothing refers to any more."""
    system, place = _file_system(spark, path)
    system.delete(place, True)
