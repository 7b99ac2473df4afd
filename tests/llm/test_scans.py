"""Secret scan, toxicity and exact dedup against plain Python and held-out labels."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pathweave.llm import dedup, registry, secrets, toxicity

from . import brute

registry.load_all()


@pytest.fixture(scope="module")
def texts(spark, sf):
    real = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    return brute.HARD_TEXTS + real


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    return brute.save(brute.documents(spark, texts), tmp_path_factory.mktemp("docs"), "documents")


def test_secrets_match_plain_regexes(spark, folder, texts):
    got = {r.doc_id: r for r in registry.QUERIES["op5_secrets"](spark, folder).collect()}
    order = ["assign", "access", "hex"]
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = brute.secrets(t)
        assert [got[i][f"n_{k}"] for k in order] == [len(want[k]) for k in order], t
        line = sorted((a, order.index(k), b) for k in order for a, b in want[k])
        assert got[i].base_sha256 == brute.sha(",".join(f"{order[k]}:{a}:{b}" for a, k, b in line)), t
    kinds = {x.split(":")[0] for r in got.values() for x in r.spans.split(",") if x}
    assert {"github", "jwt", "private_key"} <= kinds


def test_trigram_queries_are_necessary_conditions():
    assert secrets.trigram_query("[0-9a-f]+") == secrets.ALL
    assert secrets.trigrams(secrets.trigram_query(r"AKIA[A-Z0-9]+")) == {"aki", "kia"}
    cases = {"xy(a[0-9]+b)cd": "xya77bcd", "(foo|barx)?baz+": "bazzz", "(?:ab){2}cd": "ababcd", "a.c(de|f)gh": "axcfgh",
             "abc|[0-9]": "5"} | {r.pattern: None for r in secrets.RULES}
    rng = random.Random(5)
    for pattern, text in cases.items():
        query = secrets.trigram_query(pattern)
        pool = [text] if text else [t for t in brute.HARD_TEXTS if t and re.search(pattern, t, re.ASCII)]
        for t in pool:
            t = "".join(rng.choice("xyz ") for _ in range(9)) + t
            have = {g: [0] if g in t.lower() else [] for g in secrets.trigrams(query)}
            import numpy as np
            assert len(secrets.answer(query, {k: np.array(v, dtype=int) for k, v in have.items()}, 1)) == 1, (pattern, t)


def test_toxicity_learns_folds_and_excepts(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    rows = []
    for i in range(1500):
        w = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        toxic = int(i % 4 == 0)
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["zorkun", "zorkel", "vexu"]))
        elif i % 40 == 1:
            w.insert(rng.randrange(len(w)), "brave zorkun")
        rows.append((i, " ".join(w), toxic))
    docs = spark.createDataFrame([(a, b) for a, b, _ in rows] + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(a, c) for a, _, c in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    wrong = [i for i, _, y in rows if (got[i] >= 0.5) != bool(y)]
    assert len(wrong) < 30 and got[9000] == got[9001] < 0.5 and ("brave", "zorkun") in model.exceptions
    m = toxicity.Matcher(model)
    assert m.score("abc z0rkun def") > 0.5 and m.score("abc zоrkеl def") > 0.5 > m.score("abc brave zorkun def")
    assert toxicity.score(docs.limit(0), model).count() == 0
    flat = toxicity.fit(docs, labels.limit(0))
    assert flat.flat == 0.0


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = registry.QUERIES["op4_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    rows = got.collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert right / len(rows) > 0.9


@pytest.mark.parametrize("share", [1000, 3])
def test_dedup_matches_plain_grouping(spark, texts, tmp_path, monkeypatch, share):
    monkeypatch.setattr(dedup, "HOT_SHARE", share)
    rng = random.Random(2)
    many = texts + ["hot  text"] * 150 + ["hot\ttext"] * 50 + [t and t.replace(" ", " \n") for t in texts[:40]]
    rng.shuffle(many)
    folder = brute.save(brute.documents(spark, many).repartition(6), tmp_path, "documents")
    got = {r.doc_id: r for r in registry.QUERIES["op7_dedup"](spark, folder).collect()}
    groups = {}
    for i, t in enumerate(many):
        groups.setdefault(brute.normal(t), []).append(i)
    assert len(got) == len(many)
    for t, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (ids[0], len(ids), i == ids[0], brute.sha(t))


def test_unique_rows_with_repeats_and_null_ids(spark):
    rows = [(1, "a  b"), (2, "a b"), (2, "a b"), (3, "c"), (3, "c"), (None, "c"), (None, "d"), (None, "d"), (4, None), (5, ""), (6, "a b")]
    docs = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], "doc_id long, text string, kept string, salt string")
    out = dedup.unique_rows(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, brute.normal(r.text)) for r in out.collect()) == [(-1, "d"), (1, "a b"), (3, "c"), (4, "")]
    assert dedup.unique_rows(docs.limit(0)).count() == 0
