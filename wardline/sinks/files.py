"""Small Hadoop FileSystem helpers (through the session's JVM gateway), so deletes and
renames work on any cluster filesystem (HDFS, object stores) and not only on a
local disk. Only directory-level operations are done here; data goes through
DataFrame readers and writers.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

from wardline.session import scratch_table_path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory())


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that nobody has written yet; False if it is there already.

    The file is created under its own name without overwriting, which only one writer can do
    on any file system; nothing is ever deleted or replaced. Readers must expect a file whose
    text is not there yet. Hadoop's local file system looks first and creates afterwards, so
    there the file is created exclusively by the system itself.
    """
    fs, p, _ = _fs(spark, path)
    if fs.getUri().getScheme() == "file":
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(p, False)
    except Exception as e:  # the gateway wraps the Java exception
        if "exist" in str(e):
            return False
        raise
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return True


def list_status(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, is a folder, modification time in ms) of what a folder holds: one call to the file system."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted((str(s.getPath().getName()), bool(s.isDirectory()), int(s.getModificationTime())) for s in fs.listStatus(p))


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder a name that nothing has yet."""
    fs, p, jvm = _fs(spark, source)
    if not fs.rename(p, jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that only one caller can create."""
    fs, p, jvm = _fs(spark, path)
    try:
        fs.create(p, False).close()
    except Exception as e:  # the gateway wraps the Java exception
        if "exist" in str(e):
            return False
        raise
    return True


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if s.isFile())


def count_files(spark: SparkSession, path: str) -> int:
    """Files under a folder, empty ones included (one call to the file system)."""
    fs, p, _ = _fs(spark, path)
    return int(fs.getContentSummary(p).getFileCount())


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    lines = []
    line = reader.readLine()
    while line is not None:
        lines.append(line)
        line = reader.readLine()
    reader.close()
    return "\n".join(lines)


def fresh_dir(spark: SparkSession, prefix: str) -> str:
    """A new, unique folder under the shared checkpoint location."""
    return scratch_table_path(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")
