"""Compile commands: argument cleaning (B12), object files (B13), file <-> command (D4, G5).

Scale notes: the existence test of an argument is an equi-join against the
known-path table (AQE splits skewed arguments); flags that are dropped before
any file test (``-c``, ``-o``, ``-Xclang``) never reach the join.  The
sequential walk of one command's arguments runs in-row with ``aggregate``
after regrouping by command, a group bounded by the command's length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shell import normalize_path, resolve_path, shell_words
from ..functions.tokens import is_object_file

# fixed values: flags handled before the file test
XCLANG, COMPILE_ONLY, OUTPUT = "-Xclang", "-c", "-o"


def clean_compile_args(commands: DataFrame, known_paths: DataFrame, key: str = "cmd_id",
                       args_col: str = "arguments") -> DataFrame:
    """Drop the compiler, ``-Xclang`` and the argument after it, ``-c``, ``-o``,
    existing files or folders and object files; other arguments keep their order.

    ``known_paths``: one column ``path`` (what exists on the file system).  With
    a column ``directory``, a relative argument is looked up under it.  Both
    sides are compared without ``.``, ``..`` and repeated slashes.
    """
    where = F.col("directory") if "directory" in commands.columns else F.lit(None).cast("string")
    exploded = commands.select(key, where.alias("directory"), F.posexplode(F.slice(args_col, 2, F.greatest(F.size(args_col) - 1, F.lit(0))))
                               .alias("pos", "arg"))
    exploded = exploded.select(key, "pos", "arg", resolve_path("directory", "arg").alias("at"))
    flags = exploded.where(F.col("arg").isin(XCLANG, COMPILE_ONLY, OUTPUT))
    others = exploded.where(~F.col("arg").isin(XCLANG, COMPILE_ONLY, OUTPUT))
    paths = known_paths.where(F.col("path") != "").select(normalize_path("path").alias("at"), F.lit(True).alias("exists")).distinct()
    looked = others.join(paths, "at", "left").withColumn("exists", F.coalesce("exists", F.lit(False)))
    allargs = looked.unionByName(flags.withColumn("exists", F.lit(False)))
    grouped = allargs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "arg", "exists"))).alias("a"))

    init = F.struct(F.lit(False).alias("skip"), F.array().cast("array<string>").alias("out"))

    def step(acc, x):
        keep = ~(x["arg"].isin(XCLANG, COMPILE_ONLY, OUTPUT) | x["exists"] | is_object_file(x["arg"]))
        return F.struct((~acc["skip"] & (x["arg"] == XCLANG)).alias("skip"),
                        F.when(~acc["skip"] & keep, F.concat(acc["out"], F.array(x["arg"])))
                        .otherwise(acc["out"]).alias("out"))
    cleaned = grouped.select(key, F.aggregate("a", init, step)["out"].alias("args"))
    # commands whose argument list is only the compiler come back with no arguments
    return commands.select(key).join(cleaned, key, "left").select(
        key, F.coalesce("args", F.array().cast("array<string>")).alias("args"))


def parse_commands(commands: DataFrame) -> DataFrame:
    """Compile database rows with ``arguments`` (the words of ``command`` where they are missing)
    and ``path``, the source file as seen from the row's directory."""
    return commands.withColumns({
        "arguments": F.coalesce("arguments", shell_words("command")),
        "path": resolve_path("directory", "file")})


def first_command_per_file(commands: DataFrame, order_cols: list[str]) -> DataFrame:
    """First command per file (map-side partial ``min_by``)."""
    payload = [c for c in commands.columns if c != "file"]
    w = F.min_by(F.struct(*payload), F.struct(*order_cols)).alias("_w")
    return commands.groupBy("file").agg(w).select("file", *[F.col("_w")[c].alias(c) for c in payload])


def file_commands(files: DataFrame, commands: DataFrame | None, order_cols: list[str]) -> DataFrame:
    """With a database: files that have a command, with their first command.
    Without one: every file with no arguments."""
    if commands is None:
        return files.select("file", F.array().cast("array<string>").alias("args"))
    first = first_command_per_file(commands, order_cols)
    return files.join(first, "file").select("file", "args")


def command_coverage(files: DataFrame, commands: DataFrame) -> DataFrame:
    """One row: distinct files, those with a command and those without, which are not mined.

    Paths are compared normalised on both sides.
    """
    known = commands.select(normalize_path("file").alias("file")).distinct().withColumn("has", F.lit(1))
    asked = files.select(normalize_path("file").alias("file")).distinct()
    return asked.join(known, "file", "left").agg(
        F.count("*").alias("n_files"), F.count("has").alias("n_with_command"),
        (F.count("*") - F.count("has")).alias("n_without_command"))


__all__ = ["clean_compile_args", "command_coverage", "file_commands", "first_command_per_file", "is_object_file",
           "parse_commands"]
