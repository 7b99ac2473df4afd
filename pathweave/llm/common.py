"""Keeping the rows that a decision table marks; code for Python workers that cannot import this package."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Hashable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.session import cut_lineage


def keep_marked(rows: DataFrame, marked: DataFrame, key: str) -> DataFrame:
    """The rows whose (doc_id, key) ``marked`` has with kept = true, one of each; ids may be null.

    ``marked`` holds (doc_id, key, kept) of every row.  Only the pairs to leave
    out, usually the fewer, meet the rows; kept pairs that occur twice or more
    are taken out with them and put back once.
    """
    lost = marked.where(~F.col("kept")).select("doc_id", key)
    repeated = cut_lineage(marked.where("kept").groupBy("doc_id", key).count().where("count > 1").drop("count"))
    out = cut_lineage(lost.unionByName(repeated).distinct())

    def met(ids: DataFrame, how: str) -> DataFrame:
        other = ids.select(F.col("doc_id").alias("__pw_id"), F.col(key).alias("__pw_other"))
        return rows.join(other, F.col("doc_id").eqNullSafe(F.col("__pw_id")) & (F.col(key) == F.col("__pw_other")), how)

    return met(out, "left_anti").unionByName(met(repeated, "left_semi").dropDuplicates(["doc_id", key]))


def ship_code(spark: SparkSession) -> None:
    """Send the library to the Python workers, unless the working folder or PYTHONPATH has it for them."""
    root = Path(__file__).resolve().parents[2]
    known = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    if root in [Path(p).resolve() for p in known] or getattr(spark, "_pw_shipped", False):
        return
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "pathweave_code"), "zip", root, root.joinpath(__package__.split(".")[0]).name)
    spark.sparkContext.addPyFile(made)
    spark._pw_shipped = True


_KEPT: dict = {}


def keep_in_worker(key: Hashable, make: Callable[[], object]) -> object:
    """``make()``, kept for the next tasks of a reused Python worker until a task asks for something else.

    Spark sends a task's function with a copy of the module variables that it
    names, so such a variable starts anew in each task; this function is sent
    by name and finds what the worker has.
    """
    if key not in _KEPT:
        release_worker()
        _KEPT[key] = make()
    return _KEPT[key]


def release_worker() -> None:
    """Let go of what tasks of other operators left in this Python worker."""
    _KEPT.clear()
    gc.collect()
    give_back()


def give_back() -> None:
    """Return freed memory to the system, where the C library can; a worker waits for its next task without it."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# ---- expressions over arrays and long texts ---------------------------------------------------------------------

BLOCK = 256     # items folded together
CHUNK = 64      # characters of a piece of a text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, evaluating ``value`` once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan(items: Column, state: Column, kind: str, step: Callable[[Column, Column], Column],
         take: Callable[[Column, Column], Column]) -> Column:
    """A left fold that gathers: ``take(state, item)``, an array<``kind``>, of every item, then state = ``step(state, item)``.

    Appending to an array copies it.  Items are folded in blocks, each gathering
    into a short array of its own, so the work is in proportion to the items.
    """
    none = F.array().cast(f"array<{kind}>")

    def block(start, some):
        return F.aggregate(some, F.struct(start.alias("state"), none.alias("kept")), lambda a, x: F.struct(
            step(a["state"], x).alias("state"), F.concat(a["kept"], take(a["state"], x)).alias("kept")))

    def blocks(all_items):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / BLOCK).cast("int")),
                           lambda b: F.slice(all_items, b * BLOCK + 1, F.lit(BLOCK)))

    def whole(all_items):
        return F.aggregate(blocks(all_items), F.struct(state.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("kept")),
                           lambda a, some: let(block(a["state"], some), lambda r: F.struct(
                               r["state"].alias("state"), F.array_append(a["kept"], r["kept"]).alias("kept"))),
                           lambda a: F.flatten(a["kept"]))
    return let(items, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(none))


def chunks(text: Column) -> Column:
    """A text in pieces of ``CHUNK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(pieces: Column, start: Column, length: Column) -> Column:
    """Code points start .. start + length - 1 of a text in pieces, walking over no more of it than that."""
    first = F.floor(start / CHUNK).cast("int")
    last = F.floor((start + length - 1) / CHUNK).cast("int")
    near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.when(length > 0, near.substr((start - F.lit(CHUNK) * first + 1).cast("int"), length.cast("int"))).otherwise("")
