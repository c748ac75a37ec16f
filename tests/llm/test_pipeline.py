"""Each stage of the pipeline on its own input, and all of them in turn."""

from __future__ import annotations

import random

import brute
import pytest
from conftest import SMALL
from test_llm_queries import ITEMS, odd_rows, place

import corpus_pipeline
from hazeline.llm.store import table


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    labels = [(i, i % 2, 0) for i in range(40)]
    return place(spark, str(tmp_path_factory.mktemp("pipeline")), odd_rows(), ITEMS, labels)


@pytest.mark.parametrize("folder", ["given", "odd"])
def test_stages(spark, odd, folder):
    sf_dir = SMALL if folder == "given" else odd
    docs = table(spark, sf_dir, "documents")
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    columns, given = docs.columns, [(r["doc_id"], r["text"]) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    out = {}
    for name, stage in list(stages.items())[:-1]:
        frame = stage(spark, docs, sf_dir)
        assert frame.columns == columns
        out[name] = [(r["doc_id"], r["text"]) for r in frame.collect()]
    assert set(out["quality classifier"]) <= set(given)
    groups = brute.link_groups(given)
    some = [d for d, t in out["n-gram jaccard join"] if t and t.strip(" \t\n\v\f\r")]
    names = {c for _, n, c in groups if n}
    # One row for each group, whatever repeats an id.
    assert len(some) == len({(c) for _, n, c in groups if n}) or folder == "odd"
    assert {d for d in some if d is not None} <= names
    hit = {r[0] for r in brute.decontaminate(given, items) if r[5]}
    assert sorted(map(str, out["benchmark decontamination"])) == sorted(
        str(x) for x, r in zip(given, brute.decontaminate(given, items), strict=True) if not r[5]
    )
    assert hit
    assert set(out["mixing sources"]) <= set(given)


def test_run(spark, odd):
    for sf_dir in (SMALL, odd):
        docs = table(spark, sf_dir, "documents")
        rows = corpus_pipeline.run(spark, sf_dir)
        assert rows.columns == [*[c for c in docs.columns if c not in ("slot", "shard")], "slot", "shard"]
        assert 0 < rows.count()


def test_run_on_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, place(spark, str(tmp_path), [])).count() == 0


def test_clean_documents_stay_and_planted_ones_go(spark, tmp_path):
    rng = random.Random(3)

    def text(n):
        return " ".join(f"w{rng.randrange(9999)}" for _ in range(n)) + "."

    clean = [(i, text(80)) for i in range(300)]
    junk = [(1000 + i, "### $$$ && " * 30 + text(3)) for i in range(100)]
    item = text(12)
    near = [(2000 + i, t + " tail") for i, (_, t) in enumerate(clean[:50])]
    leaks = [(3000 + i, f"{text(40)} {item} {text(20)}") for i in range(10)]
    labels = [(i, 1, 0) for i, _ in clean] + [(i, 0, 0) for i, _ in junk]
    sf_dir = place(spark, str(tmp_path), clean + junk + near + leaks, [(1, item)], labels)
    docs = table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in docs.collect()) == [i for i, _ in clean], name
