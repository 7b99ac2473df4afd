import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pathweave.functions.text import decode_nested, format_mark, parse_raw_line, raw_line
from pathweave.sources import c2s
from pathweave.streaming import incremental as S


def write(folder, name, lines):
    os.makedirs(os.path.join(folder, name), exist_ok=True)
    with open(os.path.join(folder, name, "part.c2s"), "w") as f:
        f.writelines(f"('{file}', {line}){sample}\n" for file, line, sample in lines)


def rows(df):
    return sorted(tuple(r) for r in df.select("file", "line", "sample").collect())


def test_merge_stream_equals_the_batch_merge_also_after_a_restart(spark):
    raw, out, ck = (tempfile.mkdtemp(prefix=f"pw-{n}-") for n in ("raw", "merged", "ck"))
    out += "/samples"
    # two files in one trigger: the first path wins, and of a file its first line
    write(raw, "w1", [("a.cc", 1, "t w1,p,x"), ("a.cc", 1, "t second,p,x"), ("b.cc", 2, "t w1,p,y")])
    write(raw, "w2", [("b.cc", 2, "t w2,p,y"), ("c.cc", 3, "t w2,p,z")])
    first = S.merge_stream(spark, raw, out, ck, files_per_trigger=2)
    assert rows(first) == rows(c2s.first_raw_samples(c2s.read_raw_samples(spark, raw)))
    # a restart sees the new files only; marks of the first run stay as they are
    write(raw, "w3", [("c.cc", 3, "t w3,p,z"), ("d.cc", 4, "t w3,p,q"), ("d.cc", 4, "t again,p,q")])
    write(raw, "w4", [("d.cc", 4, "t w4,p,q"), ("a.cc", 1, "t w4,p,x")])
    second = rows(S.merge_stream(spark, raw, out, ck, files_per_trigger=1))
    assert second == rows(c2s.first_raw_samples(c2s.read_raw_samples(spark, raw)))
    assert rows(S.merge_stream(spark, raw, out, ck)) == second
    # a batch that is run again replaces its own rows
    raw_rows = c2s.read_raw_samples(spark, raw + "/w3").drop("block_place")
    S.merge_batch(raw_rows, 1, out)
    assert rows(spark.read.parquet(out)) == second


def test_merged_files_are_archived(spark):
    raw, out, ck, archive = (tempfile.mkdtemp(prefix=f"pw-{n}-") for n in ("raw", "merged", "ck", "archive"))
    spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")
    for i in (1, 2, 3):
        write(raw, f"w{i}", [("a.cc", i, f"t w{i},p,x"), ("z.cc", 9, f"t w{i},p,x")])
        merged = S.merge_stream(spark, raw, out + "/s", ck, files_per_trigger=1, clean_source="archive", archive_dir=archive)
    spark.conf.unset("spark.sql.streaming.fileSource.cleaner.numThreads")
    moved = [os.path.join(d, f) for d, _, fs in os.walk(archive) for f in fs if f.endswith(".c2s")]
    left = [os.path.join(d, f) for d, _, fs in os.walk(raw) for f in fs if f.endswith(".c2s")]
    assert len(moved) >= 1 and len(moved) + len(left) == 3
    assert rows(merged) == [("a.cc", i, f"t w{i},p,x") for i in (1, 2, 3)] + [("z.cc", 9, "t w1,p,x")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab'\"\\ \n\t),0", max_size=10), min_size=40, max_size=40))
def test_marks_round_trip_and_print_as_python_does(spark, names):
    data = [(i, n) for i, n in enumerate(names)]
    df = spark.createDataFrame(data, "i int, file string").withColumn("line", (F.col("i") - 3).cast("bigint"))
    df = df.withColumns({"mark": format_mark("file", "line"), "value": raw_line(
        "file", "line", F.array(F.lit("t")), F.array(F.struct(F.array(F.lit("a', 5)")).alias("start"),
                                                              F.array(F.lit("P")).alias("path"), F.array(F.lit("b")).alias("end"))))})
    got = df.select("i", "mark", *[c.alias("r_" + n) for c, n in zip(parse_raw_line("value"), ("file", "line", "sample"))]).collect()
    for r in got:
        assert r["mark"] == str((names[r["i"]], r["i"] - 3))
        assert (r["r_file"], r["r_line"], r["r_sample"]) == (names[r["i"]], r["i"] - 3, "t a', 5),P,b")


def test_decoding_at_every_depth(spark):
    shapes = [("string", "é"), ("array<string>", ["é", None, ""]), ("array<array<string>>", [["a", "ß"], [], None]),
              ("array<array<array<string>>>", [[["日本"], []], [["x", None]]])]
    for depth, (kind, value) in enumerate(shapes):
        binary = kind.replace("string", "binary")
        df = spark.createDataFrame([(value,), (None,)], f"v {kind}").select(F.expr(f"cast(v as {binary})").alias("v"))
        assert [r[0] for r in df.select(decode_nested("v", depth)).collect()] == [value, None]
