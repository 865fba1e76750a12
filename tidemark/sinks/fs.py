"""Listing helpers over the Hadoop FileSystem of a path (HDFS, S3A, local),
so folder logic works on shared cluster storage, not just a local disk."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """``(path below the folder, bytes)`` of all files that a reader would read."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    root = str(fs.getFileStatus(p).getPath().toUri().getPath()).rstrip("/")
    out, found = [], fs.listFiles(p, True)
    while found.hasNext():
        f = found.next()
        below = str(f.getPath().toUri().getPath())[len(root) + 1:]
        if not any(part[0] in "_." for part in below.split("/")):
            out.append((below, int(f.getLen())))
    return sorted(out)


def file_size(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file; None where it does not exist."""
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getLen()) if fs.exists(p) else None


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; a target that exists is replaced."""
    fs, src = _fs(spark, source)
    dst = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst):
        fs.delete(dst, False)
    if not fs.rename(src, dst):
        raise OSError(f"cannot rename {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole: under a hidden name first, then renamed."""
    head, _, name = path.rpartition("/")
    hidden = f"{head}/.{name}.tmp"
    fs, p = _fs(spark, hidden)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move_file(spark, hidden, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder; 0 where it does not exist."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0
