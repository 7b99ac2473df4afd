"""Near duplicates and the pipeline against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pathweave.llm import dedup, neardup, registry, toxicity

from . import brute

registry.load_all()


def _bag(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else Counter([tuple(w)] if w else [])


def _classes(texts, cfg):
    """Connected components of weighted Jaccard >= threshold, by all pairs."""
    bags = [_bag(t) for t in texts]
    df = Counter(s for b in bags for s in b)
    least = len(texts) * cfg.common
    weigh = [{s: c * (np.log1p(len(texts) / max(df[s], least)) / np.log1p(len(texts) / least)) for s, c in b.items()} for b in bags]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    by = {}
    for i, b in enumerate(bags):
        for s in b:
            by.setdefault(s, []).append(i)
    seen = {}
    for i, t in enumerate(texts):
        j = seen.setdefault(t or "", i)
        root[find(max(i, j))] = find(min(i, j))
    pairs = {(i, j) for ids in by.values() for k, i in enumerate(ids) for j in ids[k + 1:]}
    sims = {}
    for i, j in pairs:
        low = sum(min(weigh[i][s], weigh[j].get(s, 0)) for s in weigh[i])
        sims[i, j] = low / (sum(weigh[i].values()) + sum(weigh[j].values()) - low)
        if sims[i, j] >= cfg.threshold:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(texts))], sims


@pytest.fixture(scope="module")
def texts(spark, sf):
    rng = random.Random(7)
    real = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(150)]
    near = [" ".join(word() if rng.random() < 0.008 else w for w in base) for _ in range(60)]
    odd = ["a b c", "a b c", "A b  c", "a b c d", "", None, "x", "p q r s t", "p q r s t u"]
    shared = [" ".join([word() for _ in range(80)] + base[:50]) for _ in range(30)]
    return real + near + odd + shared


def test_shingles_equal_plain_bags(texts):
    raw = [(t or "").encode() for t in texts]
    rows, hashes, tf = neardup.shingles(raw, 5)
    bags = [_bag(t) for t in texts]
    assert Counter(rows.tolist()) == Counter({i: len(b) for i, b in enumerate(bags) if b})
    for i, b in enumerate(bags):
        assert sorted(tf[rows == i].tolist()) == sorted(b.values())
    names = {}
    for i in range(0, len(raw), 7):     # the same shingle has the same hash wherever it stands
        r, h, _ = neardup.shingles([b"zz " * 3, raw[i]], 5)
        assert set(h[r == 1].tolist()) == set(hashes[rows == i].tolist())
        names.update(dict.fromkeys(h.tolist()))


def test_weighted_jaccard_and_sampling(texts):
    rng = random.Random(9)
    cfg = neardup.NearConfig(bands=200, rows=1)
    sampler = neardup.Sampler(cfg)
    pairs = [(" ".join(a), " ".join(b)) for a, b in (
        (w, [x if rng.random() > e else f"new{i}" for i, x in enumerate(w)])
        for e in (0.01, 0.03, 0.08) for w in [[f"w{rng.randrange(40)}" for _ in range(300)] for _ in range(4)])]
    none = neardup.Weights(np.array([], np.uint64), np.array([]))
    for a, b in pairs:
        bag_a, bag_b = _bag(a), _bag(b)
        want = sum((bag_a & bag_b).values()) / sum((bag_a | bag_b).values())
        got = neardup.similarity([a.encode()], [b.encode()], none, 5)[0]
        assert abs(got - want) < 1e-9
        rows, hashes, tf = neardup.shingles([a.encode(), b.encode()], 5)
        m = sampler.bands(rows, hashes, none.of(hashes, tf), 2)
        assert abs((m[0] == m[1]).mean() - want) < 0.15


def test_classes_match_all_pairs(spark, texts, tmp_path):
    cfg = neardup.NearConfig(common=1 / 50)
    docs = brute.documents(spark, texts).repartition(5)
    got = {r.doc_id: r for r in neardup.classes(docs, cfg).collect()}
    want, sims = _classes(texts, cfg)
    linked = [p for p, s in sims.items() if s >= cfg.threshold]
    met = sum(got[i].class_id == got[j].class_id for i, j in linked)
    assert len(linked) > 100 and met >= 0.99 * len(linked)
    for i in got:       # nothing joins that brute force keeps apart
        assert want[got[i].class_id] == want[i]
    sizes = Counter(r.class_id for r in got.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (i == r.class_id) for i, r in got.items())


def test_neardup_query_and_odd_tables(spark, texts, tmp_path):
    folder = brute.save(brute.documents(spark, texts), tmp_path, "documents")
    assert registry.QUERIES["op8_neardup"](spark, folder).count() == len(texts)
    rows = [(None, "a b"), (None, "a b"), (2, "a b"), (2, "a b"), (None, "q"), (None, "q"), (3, None), (4, "")]
    docs = spark.createDataFrame([(a, b, "n") for a, b in rows], "doc_id long, text string, node string")
    out = neardup.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in out.collect()) == [(-1, "q"), (2, "a b"), (3, "")]
    assert neardup.one_of_each(docs.limit(0)).count() == 0


def test_pipeline_against_its_parts(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, sf).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), labels.where(~toxicity.held_out(F.col("doc_id"))))
    m = toxicity.Matcher(model)
    left = [(i, t) for i, t in docs if m.score(t or "") < 0.5]
    seen = {}
    for i, t in sorted(left):
        seen.setdefault(brute.normal(t), (i, t))
    left = sorted(seen.values())
    roots, _ = _classes([t for _, t in left], neardup.NearConfig())
    kept = {left[r][0] for r in roots}
    assert {r.doc_id for r in rows} == kept
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]


def test_no_pair_of_a_crowded_bucket_is_left_unmet(spark):
    rng = random.Random(21)
    words = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    passage = words(170)
    cfg = neardup.NearConfig(common=1.0)     # the passage weighs as much as other text, as in a far larger corpus
    texts, planted = [], []
    for _ in range(250):
        texts.append(" ".join(passage + words(rng.randrange(26, 55))))
    for _ in range(120):
        own = words(rng.randrange(26, 55))
        shingled = 166 + len(own)
        changed = int(shingled * rng.uniform(0.082, 0.105))       # similarity 0.81 to 0.85
        planted.append((len(texts), len(texts) + 1))
        texts += [" ".join(passage + own), " ".join(passage + own[:len(own) - changed] + words(changed))]
    for i, j in planted:
        a, b = _bag(texts[i]), _bag(texts[j])
        assert 0.8 <= sum((a & b).values()) / sum((a | b).values()) < 0.86
    got = {r.doc_id: r.class_id for r in neardup.classes(brute.documents(spark, texts), cfg).collect()}
    assert [p for p in planted if got[p[0]] != got[p[1]]] == []
    first = {j: i for i, j in planted}
    assert got == {i: first.get(i, i) for i in range(len(texts))}
