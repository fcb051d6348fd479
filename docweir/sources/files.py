"""Files as rows, from any file system that the engine reads."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Extensions of input files, in the order in which they are taken; case counts.
EXTENSIONS = ("txt", "md", "pdf")


def list_files(root: str | Path) -> list[str]:
    """Relative paths of all regular files under a local root, hidden ones too, ordered by their parts; a missing root has none."""
    base = Path(root)
    found = [p for p in base.rglob("*") if p.is_file()] if base.exists() else []
    return [p.relative_to(base).as_posix() for p in sorted(found)]


def _file_system(spark: SparkSession, path: str):
    """A path as its file system spells it, and the file system."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hadoop_path), fs


def list_input_files(spark: SparkSession, root: str | Path) -> list[tuple[str, int]]:
    """(relative path, size) of input files by extension, then path. Unlike the scan below it sees empty and hidden files."""
    base, fs = _file_system(spark, str(root))
    if not fs.exists(base):
        return []
    found, listed, start = [], fs.listFiles(base, True), len(base.toString().rstrip("/")) + 1
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toString()[start:], status.getLen()))
    return [f for e in EXTENSIONS for f in sorted(found) if f[0].endswith(f".{e}")]


def scanned_files(spark: SparkSession, root: str | Path) -> DataFrame:
    """(path, modified, length, content) of input files that the engine's scan finds: neither empty nor hidden ones. Paths are relative; content that isn't selected isn't read."""
    base = _file_system(spark, str(root))[0].toString().rstrip("/") + "/"
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{{{','.join(EXTENSIONS)}}}").load(str(root))
    return rows.select(F.expr(f"substring(path, {len(base) + 1})").alias("path"), F.col("modificationTime").alias("modified"), "length", "content")


def read_files(spark: SparkSession, root: str | Path) -> DataFrame:
    """(path, content) of the scanned files."""
    return scanned_files(spark, root).select("path", "content")


def _hidden(name: str) -> bool:
    """Whether the engine's scan passes a path over: a dot, or an underscore in a name that is no partition's, at the start of a part."""
    return any(p.startswith(".") or (p.startswith("_") and "=" not in p and not p.startswith(("_metadata", "_common_metadata"))) for p in name.split("/"))


def read_listed_files(spark: SparkSession, root: str | Path) -> DataFrame:
    """(path, content) of all listed input files, empty and hidden ones too.

    The scan reads all but those. Empty files need no reading, and hidden ones, which no
    scan gives, are read by the driver one by one; they are taken to be few and small.
    """
    base, fs = _file_system(spark, str(root))
    listed = list_input_files(spark, root)
    rest = [(name, size) for name, size in listed if not size or _hidden(name)]
    read_all = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray

    def content(name: str, size: int) -> bytes:
        if not size:
            return b""
        stream = fs.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base, name))
        try:
            return bytes(read_all(stream))
        finally:
            stream.close()

    schema = "path string, content binary"
    rows = spark.createDataFrame([(n, bytearray(content(n, s))) for n, s in rest], schema)
    return read_files(spark, root).union(rows) if len(rest) < len(listed) else rows


@F.pandas_udf(StringType())
def _decoded(content):
    return content.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def utf8_text(content: Column) -> Column:
    """Text of bytes; what is no UTF-8 is left out, where the built-in functions raise or replace it."""
    return _decoded(content)
