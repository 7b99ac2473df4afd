import json
import os
import tempfile

from pyspark.sql import functions as F

from pathweave import sinks
from pathweave.operators import dataset as D
from pathweave.plans.tree_queries import ot_samples
from pathweave.sources import c2s, files
from pathweave.streaming import incremental as S


def test_source_walk_matches_five_extensions(spark):
    d = tempfile.mkdtemp(prefix="pw-src-")
    names = ["a.c", "b.cc", "c.cpp", "d.cxx", "e.c++", "f.h", "g.CC", "sub/h.cc"]
    for n in names:
        os.makedirs(os.path.dirname(os.path.join(d, n)), exist_ok=True)
        open(os.path.join(d, n), "w").write("int x;\n")
    got = sorted(os.path.basename(r["path"]) for r in files.source_files(spark, d).collect())
    assert got == ["a.c", "b.cc", "c.cpp", "d.cxx", "e.c++", "h.cc"]
    one = files.source_files(spark, os.path.join(d, "f.h")).count()
    assert one == 1


def test_compile_commands_json(spark):
    d = tempfile.mkdtemp(prefix="pw-cdb-")
    assert files.compile_commands(spark, d) is None
    json.dump([{"directory": d, "file": "x.cc", "arguments": ["clang", "-c", "x.cc"]},
               {"directory": d, "file": "y.cc", "command": "clang -DA=1 -c y.cc"}],
              open(os.path.join(d, "compile_commands.json"), "w"))
    rows = {r["file"]: r["arguments"] for r in files.compile_commands(spark, d).collect()}
    assert rows["x.cc"] == ["clang", "-c", "x.cc"]
    assert rows["y.cc"] == ["clang", "-DA=1", "-c", "y.cc"]


def test_raw_sink_round_trip_and_streaming_dedup(spark, sf):
    samples, _ = ot_samples(spark, sf)
    samples = samples.select("file", "line", "target", "contexts")
    out = tempfile.mkdtemp(prefix="pw-raw-")
    # two miners write overlapping raw files (the second repeats the urgent orders)
    sinks.write_raw_samples(samples, out + "/w1", per_file=500)
    sinks.write_raw_samples(samples.where(F.col("target")[0] == "1"), out + "/w2", per_file=500)
    raw = c2s.read_raw_samples(spark, out)
    n = samples.count()
    assert raw.count() == n + samples.where(F.col("target")[0] == "1").count()
    batch = D.dedup_first(raw, ["file", "line"], ["source", "sample"])
    assert batch.count() == n
    got = []
    S.run_available(S.dedup_marks(S.raw_sample_stream(spark, out)), tempfile.mkdtemp(prefix="pw-ck-"), "append",
                    lambda df, _id: got.extend(r["file"] + ":" + str(r["line"]) for r in df.collect()))
    assert len(got) == n and len(set(got)) == n


def test_running_histograms_equal_batch(spark, sf):
    samples, _ = ot_samples(spark, sf)
    ds = D.padded_lines(samples.withColumn("split", F.lit("train")), D.DatasetConfig())
    out = tempfile.mkdtemp(prefix="pw-ds-")
    ds.select(F.col("text").alias("value")).write.text(out + "/lines")
    stream = S.dataset_line_stream(spark, out + "/lines")
    seen = {}

    def sink(df, _id):
        for r in df.collect():
            seen[(r["kind"], r["token"])] = r["cnt"]
    S.run_available(S.running_histograms(stream), tempfile.mkdtemp(prefix="pw-ck-"), "update", sink)
    from pathweave.operators.vocab import histograms
    want = {(r["kind"], r["token"]): r["cnt"] for r in histograms(samples).collect()}
    assert seen == want
