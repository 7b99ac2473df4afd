"""File sources: the source tree walk (A1) and the compile database (A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.commands import parse_commands
from ..schemas import COMPILE_COMMANDS

# fixed value: source extensions the miner walks (case-sensitive)
SOURCE_GLOB = "*.{c,cc,cpp,cxx,c++}"


def source_files(spark: SparkSession, input_path: str, with_content: bool = False) -> DataFrame:
    """A file yields itself; a folder is walked recursively for C/C++ sources.

    Lists through the ``binaryFile`` source (distributed listing on large
    trees); the content column is dropped unless asked for.
    """
    r = spark.read.format("binaryFile")
    if not _is_file(spark, input_path):
        r = r.option("pathGlobFilter", SOURCE_GLOB).option("recursiveFileLookup", "true")
    df = r.load(input_path)
    cols = ["path", "length"] + (["content"] if with_content else [])
    return df.select(*cols)


def _is_file(spark: SparkSession, path: str) -> bool:
    """Asks the file system that Spark reads the path from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def compile_commands(spark: SparkSession, input_dir: str) -> DataFrame | None:
    """``compile_commands.json`` of the input folder with ``arguments`` and ``path``, or None when absent."""
    path = f"{input_dir.rstrip('/')}/compile_commands.json"
    if not _is_file(spark, path):
        return None
    df = spark.read.option("multiLine", True).schema(COMPILE_COMMANDS).json(path)
    return parse_commands(df)
