import tempfile

from pyspark.sql import functions as F

from pathweave import jobs
from pathweave.config import DatasetConfig, MineConfig
from pathweave.plans.cursor_tree import order_cursors


def test_mine_merge_preprocess_jobs(spark, sf):
    out = tempfile.mkdtemp(prefix="pw-jobs-")
    order_cursors(spark, sf).write.parquet(out + "/cursors")
    jobs.mine_job(spark, out + "/cursors", out + "/mined", MineConfig(), raw_text=True)
    n = spark.read.parquet(out + "/mined/samples").count()
    assert n == 1505
    # a second miner ran over the same sources: the merge keeps one sample per mark
    ds = jobs.merge_job(spark, [out + "/mined/samples", out + "/mined/samples"], out + "/merged")
    counts = {r["split"]: r["count"] for r in ds.groupBy("split").count().collect()}
    assert sum(counts.values()) in (n, n - 1)
    assert counts["train"] == int(n * 0.7)
    cfg = DatasetConfig(max_contexts=10, max_data_contexts=20)
    jobs.preprocess_job(spark, out + "/merged/dataset", out + "/pre", cfg)
    meta = spark.read.parquet(out + "/pre/dict/metadata").first()
    assert meta["num_examples"] == counts["train"] and meta["max_contexts"] == 20
    stats = {r["split"]: r for r in spark.read.parquet(out + "/pre/stats").collect()}
    assert stats["test"]["avg_final"] <= 10 and stats["train"]["avg_final"] <= 20
    padded = spark.read.text(out + "/pre/padded/split=train")
    assert padded.where(F.length("value") < 20).count() == 0
