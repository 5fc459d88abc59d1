"""Tables that are replaced as a whole while others read them.

``publish`` writes a new folder beside the older ones and then lets a small
pointer file name it, by one renaming over the old pointer: a reader sees the
old table or the new one, never a mixture, and a job that dies on the way
leaves the old one in place. ``current`` resolves the pointer once, so a
DataFrame read from it stays with its folder while newer ones appear. Older
folders stay until ``drop_older``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path

POINTER = "CURRENT"


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()


def _pointer_text(spark: SparkSession, path: str) -> str | None:
    fs, conf = _hadoop(spark)
    p = fs.Path(path, POINTER)
    files = p.getFileSystem(conf)
    if not files.exists(p):
        return None
    stream = files.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> str:
    """The folder that the pointer names; ``path`` itself where there is none
    (a plain table)."""
    name = _pointer_text(spark, path)
    return f"{path.rstrip('/')}/{name}" if name else path


def publish(df: DataFrame, path: str) -> str:
    """Write ``df`` as the new content of ``path``; returns its folder. ``df``
    may read the table it replaces."""
    spark = df.sparkSession
    fs, conf = _hadoop(spark)
    name = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path.rstrip('/')}/{name}")
    draft = fs.Path(path, f".{POINTER}-{name}")
    out = draft.getFileSystem(conf).create(draft, False)
    try:
        out.write(bytearray(name, "utf-8"))
    finally:
        out.close()
    rename = getattr(fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    fs.FileContext.getFileContext(draft.getFileSystem(conf).getUri(), conf).rename(draft, fs.Path(path, POINTER), how)
    return f"{path.rstrip('/')}/{name}"


def drop_older(spark: SparkSession, path: str) -> int:
    """Remove all published folders but the current one; how many went. For
    when no reader holds an older one."""
    fs, conf = _hadoop(spark)
    root, kept = fs.Path(path), _pointer_text(spark, path)
    if kept is None:
        return 0
    old = [s.getPath() for s in root.getFileSystem(conf).listStatus(root)
           if s.isDirectory() and s.getPath().getName().startswith("version-") and s.getPath().getName() != kept]
    for p in old:
        delete_path(spark, p.toString())
    return len(old)
