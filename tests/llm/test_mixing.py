"""Mixing against its contract: exact totals, whole rounds, permutations, texts, reruns."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathweave.llm import mixing, registry

from . import brute

registry.load_all()
SMALL = mixing.MixConfig(block_words=7, shard_slots=16)


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def shares(sizes):
    """Targets of {source: words}, raising the level until no target is above three times its source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, total, target = set(order), sum(sizes.values()), {}
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in free}
        target |= {s: 3.0 * sizes[s] for s in above}
        free -= above
    return target


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, block string, src int, words long")


def made(rng_seed=3):
    rng = np.random.default_rng(rng_seed)
    rows = []
    for i in range(240):
        source = ["a", "b", "c", None, "é", "\U0001F600", "tiny"][int(rng.integers(0, 7)) if i % 3 else 1]
        n = int(rng.integers(0, 40)) if source != "tiny" else 1
        rows.append((i, source, " ".join(f"w{i}x{k}" for k in range(n)), "x", 1, 1))
    rows += [(7, "a", "same row twice", "x", 1, 1)] * 2 + [(900, "c", None, "x", 1, 1), (None, "b", "no id here", "x", 1, 1),
             (901, "b", "", "x", 1, 1), (902, "a", "long " * 500, "x", 1, 1)]
    return rows


def test_permutations_are_bijections_and_undone():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        i, size_, key = np.arange(n), np.full(n, n), np.full(n, -5 + n)
        p = mixing.permute(i, size_, key)
        assert sorted(p) == list(range(n))
        assert (mixing.permute(p, size_, key, back=True) == i).all()
    a, b = (mixing.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, k)) for k in (1, 2))
    assert (a != b).mean() > 0.9 and (a != np.arange(1000)).mean() > 0.9


def test_mix_takes_the_targets_in_whole_rounds(spark):
    rows = made()
    laid, sources = mixing.lay_out(table(spark, rows), SMALL)
    got = mixing.mix(laid, sources, SMALL).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[1]] += size(r[2])
    want = shares(sizes)
    have = {r.source: r for r in sources.collect()}
    taken = Counter()
    for r in got:
        taken[r.source] += r.length
    for s, t in want.items():
        assert have[s].source_size == sizes[s] and have[s].target == pytest.approx(t)
        assert taken[s] == min(round(t), 3 * sizes[s])
    # a word is taken by each whole round once, and by the last round at most once
    texts = {(r.src, r.offset): r for r in laid.where("size > 0").collect()}
    times = defaultdict(Counter)
    for r in got:
        words = texts[r.src, r.offset].text.split()
        assert r.text.split() == words[r.start:r.start + r.length]
        times[r.src, r.offset].update(range(r.start, r.start + r.length))
    for key, r in texts.items():
        whole = int(have[r.source].target) // have[r.source].source_size
        counts = [times[key][k] for k in range(r.size)]
        assert min(counts) >= whole and max(counts) <= min(3, whole + 1)
    # slots are filled without gaps, shards hold the same number of slots but the last
    slots = defaultdict(list)
    for r in got:
        slots[r.shard, r.place].append((r.at, r.length))
    for parts in slots.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= SMALL.block_words
    per = Counter(s for s, _ in slots)
    assert [per[s] for s in range(len(per) - 1)] == [SMALL.shard_slots] * (len(per) - 1)


def test_shards_draw_sources_by_their_slots(spark):
    laid, sources = mixing.lay_out(table(spark, [(i, "a" if i % 2 else "b", "w " * 70, "", 1, 1) for i in range(600)]), SMALL, text=False)
    drawn = mixing.slots(sources, SMALL).where("src = 0").groupBy("shard").count().select("count").toPandas()["count"]
    p = 5 / 7
    assert drawn.mean() == pytest.approx(16 * p, rel=0.05)
    assert 0.6 < drawn.var() / (16 * p * (1 - p)) < 1.6      # as binomial draws, neither fixed quotas nor clumps


def test_query_counts_every_document_and_reruns_agree(spark, tmp_path):
    rows = made()
    brute.save(table(spark, rows).repartition(5), tmp_path, "documents")
    got = sorted(map(tuple, registry.QUERIES["op11_mixing"](spark, str(tmp_path)).collect()), key=str)
    assert Counter(r[0] for r in got) == Counter(r[0] for r in rows)
    assert all(0 <= r[4] <= 3 * r[1] for r in got)
    brute.save(table(spark, rows[::-1]).repartition(2), tmp_path, "documents")
    assert sorted(map(tuple, registry.QUERIES["op11_mixing"](spark, str(tmp_path)).collect()), key=str) == got
    by = defaultdict(lambda: [0, 0])
    for r in got:
        by[r[2], r[3]][1] += r[4]
    assert all(abs(taken - target) <= 1 for (_, target), (_, taken) in by.items() if target)


@pytest.mark.parametrize("rows", [[], [(1, "a", None, "", 1, 1), (2, None, " \n", "", 1, 1)], [(1, None, "one", "", 1, 1)]])
def test_small_tables(spark, tmp_path, rows):
    brute.save(table(spark, rows), tmp_path, "documents")
    got = registry.QUERIES["op11_mixing"](spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.size, r.taken) for r in got] == [(r[0], size(r[2]), size(r[2])) for r in rows] or sorted(
        r.doc_id for r in got) == sorted(r[0] for r in rows)
    assert all(r.taken == r.size for r in got)


def test_intervals_and_running_sums(spark):
    owners = spark.createDataFrame([(i, (i * 7) % 5) for i in range(3000)], "place long, n long")
    summed = mixing.running_sum(owners, "place", "n", "first")
    total, want = 0, {}
    for i in range(3000):
        want[i] = total
        total += (i * 7) % 5
    assert {r.place: r.first for r in summed.collect()} == want
    points = spark.range(total).withColumnRenamed("id", "at")
    met = mixing.by_interval(points, "at", summed, "first", "n", total, 16)
    assert met.count() == total and met.where(~F.expr("at >= first AND at < first + n")).count() == 0
