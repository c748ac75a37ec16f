"""What each operator promises beyond its query: skewed groups, both ways of a switch, its own outputs."""

from __future__ import annotations

import random
import re
import statistics
import time
import zlib
from collections import Counter
from fractions import Fraction

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazeline.llm import (
    buffers,
    curriculum,
    decontaminate,
    license_scan,
    line_dedup,
    ngram_join,
    pii,
    quality_gbt,
    quality_rules,
    sharding,
    suffix_dedup,
    suffixes,
)
from hazeline.llm.components import components
from hazeline.llm.store import written


def words(rng, n, vocabulary=100_000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def family(seed=3, size=150, length=120):
    """Near copies of one text: few pairs are similar enough, all are near the base."""
    rng = random.Random(seed)
    base = words(rng, length).split()
    texts = [" ".join(w if rng.random() > 0.015 else f"e{i}x{j}" for j, w in enumerate(base)) for i in range(size)]
    return [(i, t) for i, t in enumerate([" ".join(base), *texts])]


# sharding


def test_table_reaches_the_plan_without_python_tasks(spark):
    plan = sharding.assign_shards(frame(spark, [(1, "a")]))._jdf.queryExecution().analyzed().toString()
    assert plan.count("LogicalRDD") == 1 and plan.count("LocalRelation") == 1  # the row's own, the table


def test_table_is_even_and_steady():
    table = sharding.fill_table()
    counts = np.bincount(table)
    assert len(counts) == len(sharding.SHARDS) and counts.max() - counts.min() <= 1
    fewer = sharding.fill_table(sharding.SHARDS[:-1])
    gone = len(sharding.SHARDS) - 1
    kept = [(a, b) for a, b in zip(table, fewer, strict=True) if a != gone]
    assert sum(a == b for a, b in kept) > 0.8 * len(kept)


@pytest.mark.parametrize("shards, size", [((), 7), (("a", "a"), 7), (("a",), 8), (("a", "b", "c"), 2)])
def test_bad_tables_are_refused(shards, size):
    with pytest.raises(ValueError):
        sharding.fill_table(shards, size)


def test_turns_by_hand():
    """Each shard takes its first free slot in turn."""
    names, size = ("a", "b", "c"), 7
    likes = []
    for name in names:
        at = sharding._digest(f"offset:{name}") % size
        step = sharding._digest(f"skip:{name}") % (size - 1) + 1
        likes.append([(at + i * step) % size for i in range(size)])
    owner = {}
    for turn in range(size):
        shard = turn % 3
        owner[next(s for s in likes[shard] if s not in owner)] = shard
    assert sharding.fill_table(names, size) == [owner[s] for s in range(size)]


def test_placement_is_one_broadcast_lookup(spark, folder):
    placed = sharding.assign_shards(spark.range(3000).withColumnRenamed("id", "doc_id"))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    sharding.write_shards(placed, f"{folder}/shards", rows_per_file=20)
    assert spark.read.parquet(f"{folder}/shards").count() == 3000
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert len(sizes) == 32 and statistics.pstdev(sizes) < 20


# curriculum


def test_times_invert_the_demand(spark):
    rows = [(u / 10, s) for u in range(11) for s in (-0.5, 0.0, 0.5)]
    df = spark.createDataFrame(rows, "u double, s double")
    at = curriculum.time_of(F.col("u") * 80, F.lit(80.0), F.col("s"))
    for r in df.withColumn("t", at).collect():
        assert r["t"] * (1 - r["s"]) + r["s"] * r["t"] ** 2 == pytest.approx(r["u"], abs=1e-9)


def test_small_sources_stop_at_three_times(spark):
    docs = [(i, "w " * (5 if i else 1000), f"s{min(i, 3)}") for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    want = brute.mix_targets([(i, s, t) for i, t, s in docs])
    found = curriculum.mix(df, rows_per_cell=2).collect()
    for r in found:
        assert (r["source_size"], r["target"]) == (want[r["source"]][0], pytest.approx(want[r["source"]][1]))
    for source, (_, target) in want.items():
        assert sum(r["taken"] for r in found if r["source"] == source) == int(target)
    assert any(r["target"] == 3 * r["source_size"] for r in found)
    # Cells do not change the order.
    assert sorted(map(tuple, found)) == sorted(map(tuple, curriculum.mix(df, rows_per_cell=1000).collect()))


def test_mixed_rows_repeat(spark):
    docs = [(i, "w " * 10, "a" if i < 90 else "b", i) for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, of int")
    rows = curriculum.mixed(df, weights=(1, 9)).collect()
    counts = {s: sum(r["source"] == s for r in rows) for s in "ab"}
    assert counts == {"a": 70, "b": 30} and rows[0].__fields__ == ["doc_id", "text", "source", "of"]


# n-gram join


@pytest.mark.parametrize("bucket, block", [(1, 2000), (4, 1 << 18), (10_000, 1 << 18)])
def test_join_by_pairs_and_by_blocks(spark, rows, monkeypatch, bucket, block):
    """Every candidate way finds the same groups; small buckets send most through blocks."""
    monkeypatch.setattr(ngram_join, "PAIR_BUCKET", bucket)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    docs = family() + [(1000 + i, t) for i, (_, t) in enumerate(family(8, 20, 60))]
    docs += [(2000 + i, docs[0][1]) for i in range(60)] + [(3000, "a b"), (3001, "A  b"), (3002, "a c"), (3003, None)]
    found = ngram_join.link_groups(frame(spark, docs))
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(
        brute.link_groups(docs), key=lambda r: tuple(map(str, r))
    )


def test_shingles_that_meet_by_chance_make_no_pairs(spark, monkeypatch):
    """Passages of two dozen texts each, too few to stand above chance, stay out of the prefixes."""
    rng, asked = random.Random(4), []
    common = [words(rng, 5) for _ in range(120)]
    docs = []
    for i in range(200):
        shared = " ".join(f"{p} {words(rng, 3)}" for p in rng.sample(common, 12))
        docs.append((i, f"{shared} {words(rng, 160)}"))
    docs += [(1000 + i, f"{t} end") for i, t in docs[:5]]
    verified = ngram_join.verified

    def counted(docs, pairs, *rest):
        asked.extend(pairs.collect())
        return verified(docs, pairs, *rest)

    monkeypatch.setattr(ngram_join, "verified", counted)
    monkeypatch.setattr(ngram_join.sketch, "above_chance", lambda counts, least: np.zeros(len(counts), bool))
    found = ngram_join.link_groups(frame(spark, docs)).collect()
    assert sum(r["component_id"] != r["doc_id"] for r in found) == 5 and len(asked) == 5


def test_chance_cells_are_in_order_of_their_counts():
    counts = np.random.default_rng(6).poisson(280, 1 << 22)
    counts[:1000] += 100  # by far too few to stand above chance
    counts[1000] += 4000
    ranks = ngram_join.cell_ranks(counts)
    assert ranks[:1000].min() >= ngram_join._CHANCE_RANKS // 2 and ranks[1000] == 12 + ngram_join._ABOVE
    below = ranks < ngram_join._CHANCE_RANKS
    shares = np.bincount(ranks[below], counts[below]) / counts[below].sum()
    assert len(shares) == ngram_join._CHANCE_RANKS and shares.min() > 0.08 and shares.max() < 0.18
    assert not ngram_join.cell_ranks(np.zeros(1 << 22, np.int64)).any()


def test_maps_of_bits_rule_out_only_what_is_unlike(spark):
    rng, gen = random.Random(7), np.random.default_rng(7)
    sets, pairs = {}, []
    for i in range(400):
        n = rng.choice([1, 3, 40, 64, 65, 120, 129, 700])
        x = gen.integers(0, 1 << 63, n, dtype=np.uint64)
        keep = x[gen.random(n) < rng.choice([0, 0.5, 0.85, 0.95, 1])]
        fresh = max(rng.choice([n - len(keep), n // 8]), int(len(keep) == 0))
        y = np.concatenate([keep, gen.integers(0, 1 << 63, fresh, dtype=np.uint64)])
        (a, x), (b, y) = sorted([(2 * i, x), (2 * i + 1, y)], key=lambda s: len(s[1]))
        sets |= {a: x, b: y}
        if 5 * len(x) >= 4 * len(y):
            pairs.append((a, b, len(x), len(y)))
    maps = ngram_join.bit_maps(list(sets.values())).to_pylist()
    classes = spark.createDataFrame(list(zip(sets, maps, strict=True)), "cls long, bits array<long>")
    found = ngram_join.likely_pairs(spark.createDataFrame(pairs, "a long, b long, n_a int, n_b int"), classes, Fraction(4, 5))
    found = {(r["a"], r["b"]) for r in found.collect()}
    shared = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b, *_ in pairs}
    similar = {(a, b) for a, b, m, n in pairs if 9 * shared[a, b] >= 4 * (m + n)}
    unlike = {(a, b) for a, b, m, n in pairs if 2 * shared[a, b] <= m and m >= 40}
    assert similar <= found and not unlike & found and len(similar) > 50 and len(unlike) > 20


def test_written_rows_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return set(re.findall(r"shuffle_\d+", str(disk.getAllFiles().mkString(" "))))

    before = shuffled()
    found = written(spark.range(1000, numPartitions=4).groupBy((F.col("id") % 7).alias("k")).count(), "test")
    assert found.count() == 7
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    assert len(left) <= 1  # of the count above


def test_blocks_of_many_short_near_copies(spark):
    """Sets so small that a block's shingles do not bound its classes."""
    rng = random.Random(9)
    base, count = words(rng, 19), 10_000
    docs = [(i, f"{base} e{i}") for i in range(count)] + [(count, words(rng, 20))]
    found = ngram_join.link_groups(frame(spark, docs)).select("n_shingles", "component_id").distinct().collect()
    assert sorted(tuple(r) for r in found) == [(16, 0), (16, count)]
    crowded = spark.range(count).select(F.lit(1).alias("token"), F.col("id").alias("cls"), F.lit(16).alias("n"))
    groups = ngram_join._blocks(crowded).groupBy("i", "j").count().collect()
    assert len(groups) == 6 and max(r["count"] for r in groups) < 2 * 1.1 * ngram_join.BLOCK_CLASSES


def test_blocks_of_unlike_sizes_do_not_meet(spark, monkeypatch):
    """A class is copied for the blocks of its band and the next ones, however many others there are."""
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 20)
    sizes = [round(10 * 1.25**band) for band in range(24)]
    rows = [(7, 1000 * band + i, n) for band, n in enumerate(sizes) for i in range(40)]
    crowded = spark.createDataFrame(rows, "token long, cls long, n int")
    blocks = ngram_join._blocks(crowded)
    copies = [r["count"] for r in blocks.groupBy("cls").count().collect()]
    total = blocks.select("i").union(blocks.select("j")).distinct().count()
    assert total >= 48 and max(copies) <= 2 * 4 + 1 and len(copies) == len(rows)
    # Any two classes whose sizes allow a link meet in one group.
    met = {}
    for r in blocks.collect():
        met.setdefault((r["i"], r["j"]), set()).add(r["cls"])
    pairs = {frozenset((a, b)) for group in met.values() for a in group for b in group}
    rng, size = random.Random(2), {c: n for _, c, n in rows}
    for _ in range(3000):
        a, b = rng.choice(rows)[1], rng.choice(rows)[1]
        if min(size[a], size[b]) >= 0.8 * max(size[a], size[b]):
            assert frozenset((a, b)) in pairs


def test_rectangles_of_blocks(monkeypatch):
    monkeypatch.setattr(ngram_join, "BAND", 7)
    monkeypatch.setattr(ngram_join, "SLICE", 5)
    rng = np.random.default_rng(4)
    sets = [np.sort(rng.choice(12, rng.integers(1, 12), replace=False)) for _ in range(60)]
    for left, right in ((sets, sets), (sets[:25], sets[25:])):
        linked = ngram_join._similar(left, right, 4, 5)
        want = [[9 * len(np.intersect1d(a, b)) >= 4 * (len(a) + len(b)) for b in right] for a in left]
        assert linked.tolist() == want
        forest = ngram_join._forest(linked)
        assert all(linked[i, j] for i, j in forest)
        kept = np.zeros_like(linked)
        kept[tuple(zip(*forest, strict=True))] = True

        def reach(m):
            out = m.astype(int)
            for _ in range(8):
                out = np.minimum(out + out @ out.T @ out, 1)
            return out.tolist()

        assert reach(kept) == reach(linked)


def test_join_at_other_thresholds(spark):
    docs = family(5, 30)
    groups = {}
    for threshold in (Fraction(1, 2), Fraction(95, 100)):
        found = ngram_join.link_groups(frame(spark, docs), threshold).collect()
        groups[threshold] = len({r["component_id"] for r in found})
    assert groups[Fraction(1, 2)] < groups[Fraction(95, 100)]


def test_one_of_each_group_stays(spark):
    docs = family(5, 30) + [(70, words(random.Random(1), 50)), (100, None), (101, ""), (100, None)]
    kept = ngram_join.one_of_each(frame(spark, docs)).collect()
    groups = brute.link_groups(docs)
    names = {c for d, n, c in groups if n}
    assert sorted(r["doc_id"] for r in kept if r["text"]) == sorted(names)
    assert sorted(r["doc_id"] for r in kept if not r["text"]) == [100, 100, 101]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(200, 260)] + [(300, 300), (5, 3)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots) == 41 + 61
    assert all(roots[i] == 0 for i in range(41)) and all(roots[i] == 100 for i in range(200, 260))


# decontamination


def test_near_matches_are_told_from_exact_ones(spark):
    rng = random.Random(2)
    item = words(rng, 10)
    spread = item.split()
    spread = " ".join(spread[:5] + ["x"] + spread[5:])
    docs = [(1, f"{words(rng, 30)} {item}"), (2, f"{words(rng, 30)} {spread} end"), (3, words(rng, 50))]
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    found = {r["doc_id"]: (r["n_hit"], r["items"], r["n_near"]) for r in
             decontaminate.scan(frame(spark, docs), items).collect()}
    assert found == {1: (10, ["5"], 0), 2: (0, [], 1), 3: (0, [], 0)}
    left = decontaminate.clean(frame(spark, docs), items).collect()
    assert sorted(r["doc_id"] for r in left) == [2, 3]


def test_windows_of_common_words_only(spark):
    docs = [(i, "of the " * (20 + i)) for i in range(12)] + [(20, "the of the"), (21, "of")]
    items = [(1, "of the " * 5), (2, "the"), (3, "the of the of")]
    want = brute.decontaminate(docs, items)
    found = decontaminate.scan(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in found.collect()) == [
        r[:4] for r in want
    ]


def test_words_that_end_in_a_capital_sigma(spark):
    docs = [(1, "x ΟΔΟΣ.Α β"), (2, "ΟΔΟΣ Α β"), (3, "οδος Α β")]
    items = [(1, "ΟΔΟΣ Α β")]
    found = decontaminate.scan(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    found = sorted((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in found.collect())
    assert found == [r[:4] for r in brute.decontaminate(docs, items)]
    assert [r[2] for r in found] == [3, 3, 0]


def test_texts_that_begin_inside_a_window(spark):
    rng = random.Random(4)
    long, short = words(rng, 14).split(), words(rng, 4).split()
    docs = [(1, " ".join(long[1:10])), (2, " ".join(short[1:])), (3, " ".join(long[1:])), (4, " ".join(short))]
    # each first word is frequent, so it is not among the rarest
    docs += [(10 + i, f"{long[0]} {short[0]}") for i in range(9)]
    items = [(1, " ".join(long)), (2, " ".join(short))]
    found = decontaminate.scan(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["items"]), r["n_near"]) for r in found.collect()}
    assert sorted((d, *r[:3]) for d, r in found.items()) == [r[:4] for r in brute.decontaminate(docs, items)]
    assert [found[d][3] > 0 for d in (1, 2, 4)] == [True, True, False]


@pytest.mark.parametrize("module", [decontaminate, license_scan, quality_rules, pii])
def test_native_operators_use_no_python(module):
    text = open(module.__file__).read()
    for banned in ("udf", "mapIn", "applyIn", "pandas", "pyarrow", ".rdd", "toPandas"):
        assert banned not in text


# line dedup


def test_a_line_of_all_documents_is_cut_over_partitions(spark, rows):
    shared = "the line that every document has"
    docs = [(i, f"{shared}\nown line number {i}\n{shared.upper()}  ") for i in range(300)]
    df = frame(spark, docs, 7)
    found = line_dedup.digests(df, line_dedup.keep_bitmaps(df))
    assert rows(found) == sorted(brute.line_dedup(docs), key=lambda r: tuple(map(str, r)))
    maps = line_dedup.keep_bitmaps(df).collect()
    assert len(maps) == 299 and {r["n_dropped"] for r in maps} == {2}


# quality classifier


def test_classifier_learns_and_keeps_fold_apart(spark):
    rng = random.Random(4)
    docs = [(i, words(rng, 60) if i % 2 else "### $$$ | &&& " * 20 + words(rng, 5)) for i in range(600)]
    labels = [(i, i % 2, 0) for i in range(600)]
    frames = frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality_gbt.classify(*frames).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in found)
    # Labels of held-out rows change nothing.
    held = {r["doc_id"] for r in frames[0].where(quality_gbt.held_out()).collect()}
    assert 60 < len(held) < 180
    turned = [(i, 1 - q if i in held else q, t) for i, q, t in labels]
    again = quality_gbt.classify(frames[0], spark.createDataFrame(turned, frames[1].schema)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_scores_without_labels_and_with_one_class(spark):
    docs = frame(spark, [(1, "a text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_gbt.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert all(r["score"] > 0.5 for r in quality_gbt.classify(docs, one).collect())


def metrics(node, name):
    """A metric summed over a plan that has run."""
    nodes, total = [node], 0
    while nodes:
        node = nodes.pop()
        if node.metrics().contains(name):
            total += node.metrics().apply(name).value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_accepted_rows_send_each_text_once_and_get_a_score_back(spark, folder):
    rng = random.Random(14)
    texts = [(i, words(rng, 60) if i % 2 else "### $$$ | &&& " * 20 + words(rng, 5)) for i in range(1000)]
    frame(spark, [*texts, (None, None), (7, "")]).write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1000)], "doc_id long, quality int, toxic int")
    rows = quality_gbt.accepted(docs, labels)
    assert rows.schema == docs.schema
    found = rows.collect()
    scored = quality_gbt.score(docs, quality_gbt.fit(docs, labels)).collect()
    told = [(r["doc_id"], r["text"]) for r in scored if r["score"] >= quality_gbt.THRESHOLD]
    by = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(tuple, found), key=by) == sorted(told, key=by) and 400 < len(found) < 700
    size = sum(len(t) for _, t in texts)
    plan = rows._jdf.queryExecution().executedPlan()
    assert size <= metrics(plan, "pythonDataSent") < 1.5 * size
    assert 0 < metrics(plan, "pythonDataReceived") < 0.2 * size


def test_classifier_and_join_hold_small_pieces_of_a_batch():
    texts = pa.array(["some words of a text " * 100] * 2000)
    want = np.concatenate([quality_gbt.statistics(c) for c in buffers.chunks(texts)])
    sizes, chunks = [], buffers.chunks
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(buffers, "chunks", lambda *a: (sizes.append(len(c.data)) or c for c in chunks(*a)))
        assert np.array_equal(quality_gbt._features_of(texts), want)
    assert max(sizes) <= 1 << 18 and ngram_join.CHUNK_BYTES <= 1 << 18


def test_statistics_follow_their_names():
    import pyarrow as pa

    text = "Aa bb bb bb\n\nAa bb bb bb é"
    [chunk] = buffers.chunks(pa.array([text, None, "", "word"]))
    found = [dict(zip(quality_gbt.FEATURES, row, strict=True)) for row in quality_gbt.statistics(chunk)]
    size = len(text.encode())
    assert found[0]["share_upper"] == 2 / size and found[0]["share_wide"] == 2 / size
    assert found[0]["distinct_words"] == 3 / 9 and found[0]["top_word"] == 6 / 9
    assert found[0]["repeated_lines"] == 0 and found[0]["words_per_line"] == 3
    assert all(v == 0 for v in found[1].values()) and found[1] == found[2]
    assert found[3]["mean_word"] == 4 and found[3]["repeated_windows"] == 0


# personal data


def test_assigned_secrets_are_added(spark):
    rng = random.Random(6)

    def token():
        return "".join(rng.choice("0123456789abcdef") for _ in range(40))

    docs = [(i, f'{words(rng, 20)} token = "{token()}" {words(rng, 20)}') for i in range(150)]
    docs += [(200 + i, f"{words(rng, 20)} mail{i}@host.example.com or +1 (017) 555-77{i:02d}") for i in range(50)]
    docs += [(300 + i, words(rng, 40)) for i in range(50)]
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in
             pii.find(frame(spark, docs)).collect()}
    for i, text in docs[:150]:
        at = text.index('"') + 1
        assert found[i] == [("secret", at, at + 40)]
    assert all([k for k, _, _ in found[200 + i]] == ["email", "phone"] for i in range(50))
    assert all(found[300 + i] == [] for i in range(50))


def announced(rng, i):
    """Local phone numbers and numbers like those of social security, nearly all of them announced."""
    local, ssn = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", f"{rng.randrange(100, 899)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}"
    start = f"{words(rng, 9)} mail{i}@host.example.com "
    middle = f"Phone: {local}" if i % 40 else f"we met {local}"
    return f"{start}{middle} {words(rng, 5)} {'SSN: ' if i % 30 else 'with '}{ssn} {words(rng, 5)} {rng.randrange(10**7, 10**8)}", local, ssn


def test_numbers_beside_base_spans_are_added(spark):
    """Formats that mostly come announced are found unannounced too; plain numbers stay."""
    rng = random.Random(3)
    made = [announced(rng, i) for i in range(400)]
    found = {r["doc_id"]: r for r in pii.find(frame(spark, [(i, t) for i, (t, _, _) in enumerate(made)])).collect()}
    for i, (text, local, ssn) in enumerate(made):
        spans = [(s["kind"], text[s["start"] : s["end"]]) for s in found[i]["spans"]]
        assert spans == [("email", f"mail{i}@host.example.com"), ("number", local), ("number", ssn)]


def plain_added(text, chosen):
    """Chosen proposals that touch no base span, first come first, by comparing all with all."""
    kept = []
    for start, end, kind in sorted(chosen, key=lambda c: (c[0], -c[1])):
        if all(end <= s or start >= e for s, e, _ in kept):
            kept.append((start, end, kind))
    return kept


def test_added_spans_against_plain_sweeps(spark, monkeypatch):
    """With every proposal good enough, what is added follows from comparing all spans with all."""
    rng = random.Random(12)
    pieces = ["a@b.de", "x..y@host.", "1.2.3.4", "1.2.3.4.5.6", "+1 (017) 555-7713", "(555) 123-4567", "4111 1111 1111 1111",
              "12:34:56:78", "deadbeef" * 3 + "1", "555-12-3456.7", "müller@straße.de", "word", ",", "é 10.0.0.1:80:90:99"]
    docs = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, " ".join(pieces) * 40)]
    monkeypatch.setattr(pii, "thresholds", lambda *a: [-1e9] * len(pii.PROPOSALS))
    found = {r["doc_id"]: r for r in pii.find(frame(spark, docs)).collect()}
    patterns = {k: re.compile(p.replace("\\G", "(?!)")) for k, p in pii.PROPOSALS.items()}
    for i, text in docs:
        text = text or ""
        base = [(s["start"], s["end"]) for s in found[i]["base"]]
        proposed = [(m.start(), m.end(), k) for k, p in patterns.items() for m in p.finditer(text)]
        proposed = [
            (s, e, k) for s, e, k in proposed
            if (k != "secret" or re.search("[0-9]", text[s:e])) and (k != "number" or len(re.sub("[^0-9]", "", text[s:e])) >= 7)
        ]
        apart = [(s, e, k) for s, e, k in proposed if all(e <= b or s >= c for b, c in base)]
        added = sorted((s["start"], s["end"], s["kind"]) for s in found[i]["spans"] if s["kind"] in pii.PROPOSALS)
        assert added == sorted(plain_added(text, apart)), i


def test_many_matches_of_one_text_take_seconds(spark):
    """A megabyte with some 80,000 matches."""
    text = "".join(f"10.{i % 250}.{i % 7}.{i % 9} {i * 7919:09d} " for i in range(45_000))
    started = time.perf_counter()
    row = pii.find(frame(spark, [(1, text)], 1)).first()
    assert len(row["base"]) == 45_000 and time.perf_counter() - started < 120


def test_spans_do_not_hang_on_the_size_of_the_table(spark):
    rng = random.Random(6)

    def table(n):
        made = random.Random(1)
        docs = [(i, f'{words(made, 9)} api_key = "{made.getrandbits(128):032x}" {words(made, 9)}') for i in range(0, n, 2)]
        return docs + [(i, f"{words(made, 9)} call (555) 010-{made.randrange(1000, 9999)} {words(made, 9)}") for i in range(1, n, 2)]

    probe = (99_999, f"{words(rng, 5)} key = {'0a1b2c3d' * 4} {words(rng, 5)} and (555) 010-7777 too")
    seen = []
    for n in (50, 5000):
        row = pii.find(frame(spark, [*table(n), probe])).where("doc_id = 99999").first()
        seen.append([(s["kind"], s["start"], s["end"]) for s in row["spans"]])
    assert seen[0] == seen[1] and [k for k, _, _ in seen[0]] == ["secret", "number"]


def test_trees_and_their_expression_agree(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, n, 300) for n in pii.FEATURES.values()])
    n = rng.integers(1, 20, 300).astype(float)
    good = np.floor(n * (x[:, 1] > 8))
    prior, trees = pii.fit_trees(x, n, good)
    df = spark.createDataFrame([tuple(map(int, row)) for row in x], ", ".join(f"{f} int" for f in pii.FEATURES))
    score = pii.score_column(F.struct(*pii.FEATURES), prior, trees)
    found = [r["s"] for r in df.select(score.alias("s")).collect()]
    assert np.allclose(found, pii.score_cells(x, prior, trees))
    assert min(np.array(found)[x[:, 1] > 8]) > max(np.array(found)[x[:, 1] <= 8])


# licenses


def test_changed_wording_is_found_by_its_diagonals(spark):
    text = dict(license_scan.TEMPLATES)["unlicense"]
    changed = text.replace("unencumbered", "fully unencumbered")
    docs = [(1, "x y z " + text), (2, f"a {changed} b"), (3, "this is free and that is all"), (4, None)]
    found = {r["doc_id"]: [(s["label"], s["first"], s["last"]) for s in r["spans"]] for r in
             license_scan.scan(frame(spark, docs)).collect()}
    assert found[1] == [("unlicense", 3, 13)] and [s[0] for s in found[2]] == ["unlicense"]
    assert found[3] == found[4] == []


def plain_spans(text, k=license_scan.GRAM, slack=license_scan.SLACK):
    """Labels and covers by trying all runs of hits: the longest common run of one passage."""
    found, spoken = [], re.findall(r"[0-9a-z\x80-\U0010FFFF]+", text.lower())
    for label, wording in license_scan.TEMPLATES:
        listed = wording.split()
        hits = [
            (p, t)
            for p in range(len(spoken) - k + 1)
            for t in range(len(listed) - k + 1)
            if spoken[p : p + k] == listed[t : t + k]
        ]
        diagonals = sorted({p - t for p, t in hits})
        groups = []
        for d in diagonals:
            if not groups or d - groups[-1][-1] > slack:
                groups.append([])
            groups[-1].append(d)
        for group in groups:
            mine = sorted(h for h in hits if h[0] - h[1] in group)
            best = {}
            for p, t in mine:
                best[p, t] = 1 + max((n for (q, u), n in best.items() if q < p and u < t), default=0)
            first, last = mine[0][0], mine[-1][0] + k - 1
            cover = max(best.values()) / (len(listed) - k + 1)
            if cover >= license_scan.MIN_COVER and last - first < len(listed) + 2 * slack:
                found.append((label, first, last, round(cover, 9)))
    return sorted(found)


def test_passages_are_verified_in_order(spark):
    """Repeated or shuffled words of a template are no passage; edited ones are, as tried by hand."""
    rng = random.Random(8)
    texts = [
        "we said it was released under the released under the table and then left",
        "license under the released under the license and released under the",
        "Released under the MIT license.",
        None,
    ]
    for _, wording in license_scan.TEMPLATES:
        listed = wording.split()
        texts.append(f"{words(rng, 5)} {wording.upper()} {words(rng, 5)}")
        texts.append(" ".join(w for w in listed if rng.random() > 0.06))
        texts.append(" ".join(x for w in listed for x in ([w, "extra"] if rng.random() < 0.05 else [w])))
        texts.append(" ".join(listed[len(listed) // 2 :] + listed[: len(listed) // 2]))
        texts.append(" ".join(listed[i] for i in sorted(range(len(listed)), key=lambda i: i + rng.random() * 4)))
        texts.append(f"{wording} and {wording}")
    docs = list(enumerate(texts))
    found = {
        r["doc_id"]: sorted((s["label"], s["first"], s["last"], round(s["cover"], 9)) for s in r["spans"])
        for r in license_scan.scan(frame(spark, docs)).collect()
    }
    assert found == {i: plain_spans(t or "") for i, t in docs}
    assert found[0] == found[1] == found[3] == [] and [s[0] for s in found[2]] == ["mit"]


# quality rules


def test_distance_is_zero_for_equal_and_one_for_apart(spark):
    df = spark.createDataFrame([([0.5, 0.5, 0.0], [0.0, 0.0, 1.0])], "p array<double>, q array<double>")
    row = df.select(
        quality_rules.distance(F.col("p"), F.col("q")).alias("far"),
        quality_rules.distance(F.col("p"), F.col("p")).alias("same"),
    ).first()
    assert row["far"] == pytest.approx(1) and row["same"] == 0


def test_odd_documents_fail_and_guards_hold(spark):
    rng = random.Random(9)
    common = "the of and to a in is that it for".split()
    plain = [" ".join(rng.choice(common) if rng.random() < 0.4 else f"word{chr(97 + rng.randrange(26))}" for _ in range(300))
             for _ in range(40)]
    odd = " ".join(f"{w}###" for w in plain[0].split())
    rows = [(i, t, "en") for i, t in enumerate(plain)] + [(100, odd, "en"), (101, odd, "xx"), (102, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in quality_rules.apply_rules(df).collect()}
    assert all(found[i]["kept"] for i in range(40)) and not found[100]["kept"]
    # A language with one document is judged too, by what all languages have in common.
    assert found[101]["class_distance"] > quality_rules.MAX_CLASS_DISTANCE and not found[101]["kept"]
    assert found[102]["class_distance"] is None and not found[102]["kept"]


# suffix arrays


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        text = (rng.integers(0, rng.integers(1, 5), n) + 97).astype(np.uint8)
        data, order = text.tobytes(), suffixes.suffix_array(text)
        assert order.tolist() == sorted(range(n), key=lambda i: data[i:])
        shared = suffixes.common_prefixes(text, order, 20)
        for a, b in zip(order[:-1], order[1:], strict=True):
            k = 0
            while k < 20 and max(a, b) + k < n and data[a + k] == data[b + k]:
                k += 1
            assert shared[b] == k


@pytest.mark.parametrize("crowd, shard", [(suffix_dedup.CROWD, suffix_dedup.SHARD_BYTES), (2, 500)])
def test_suffix_dedup_of_crowds_and_small_shards(spark, rows, crowd, shard):
    """Passages in most documents, with other neighbours each time, and repeats inside one."""
    rng = random.Random(7)
    passage, other = words(rng, 40), words(rng, 30)
    docs = [(i, f"{words(rng, rng.randrange(3, 40))} {passage} {words(rng, 20)}") for i in range(60)]
    docs += [(100 + i, f"{other} {words(rng, 10)} {other[: 120 + i]}") for i in range(20)]
    docs += [(200, "z" * 900), (201, "z" * 350 + "é" * 80), (202, ""), (203, None), (204, docs[0][1])]
    df = frame(spark, docs, 5)
    spans = suffix_dedup.repeated_spans(df, crowd=crowd, shard_bytes=shard)
    found = suffix_dedup.digests(df, spans)
    assert rows(found) == sorted(brute.suffix_dedup(docs), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_suffix_dedup_tells_texts_without_ids_apart(spark, rows):
    """Many null ids with one header, which another document has after other words, and texts of one short hash."""
    rng = random.Random(11)
    header, passage = words(rng, 40), words(rng, 30)
    docs = [(1, f"{words(rng, 9)} {header} {words(rng, 9)}"), (2, passage)]
    docs += [(None, f"{header} {words(rng, 5 + i % 7)}") for i in range(40)]
    tag = F.pmod(F.xxhash64("text"), F.lit(1 << 24)).alias("tag")
    n = spark.range(20_000)
    long = n.select(F.format_string(f"{passage} %d", "id").alias("text")).select(F.col("text").alias("a"), tag)
    short = n.select(F.format_string("%d is not repeated anywhere", "id").alias("text")).select(F.col("text").alias("b"), tag)
    pairs = long.join(short, "tag").select("a", "b").collect()
    assert pairs
    docs += [(None, t) for pair in pairs[:5] for t in pair]
    df = frame(spark, docs, 5)
    found = suffix_dedup.digests(df, suffix_dedup.repeated_spans(df))
    assert rows(found) == sorted(brute.suffix_dedup(docs), key=lambda r: tuple((v is not None, str(v)) for v in r))


# hashes


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096, 1 << 15])
def test_patterns_of_two_letters_keep_their_hashes_apart(spark, rows, n):
    """Powers of one base modulo 2 ** 64 take such a text and its mirror for one."""
    pair = [thue_morse(n), thue_morse(n, "ba")]
    found = line_dedup.keep_bitmaps(frame(spark, [(1, pair[0]), (2, pair[1]), (3, pair[1].upper() + " ")]))
    assert [r["n_dropped"] for r in found.collect()] == [1]  # only the third, which repeats the second
    links = rows(ngram_join.link_groups(frame(spark, list(enumerate(pair)))), "doc_id", "component_id")
    assert links == [(0, 0), (1, 1)]
    chunk = next(buffers.chunks(pa.array(["".join(pair)])))
    for second in (False, True):
        hashes = buffers.own_hashes(chunk, np.array([0, n]), np.array([n, 2 * n]), second=second)
        assert hashes[0] != hashes[1]


def test_own_hashes_follow_the_stretch_alone():
    texts = ["one line here", "ONE line here", "another", "", "one line here"]
    data = "__import__".join(texts).encode()
    starts = np.cumsum([0, *(len(t) + 10 for t in texts[:-1])])
    chunk = buffers.Chunk(0, np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    hashes = buffers.own_hashes(chunk, starts, starts + [len(t) for t in texts])
    assert hashes[0] == hashes[1] == hashes[4] and len(set(hashes.tolist())) == 3


# repeated rows, plain versions


def test_repeated_rows_have_their_postings_once(spark):
    item = words(random.Random(1), 12)
    docs = frame(spark, [(1, f"before {item} after")] * 300 + [(None, f"{item} again")] * 300 + [(2, "clean text")])
    windows = decontaminate.benchmark_windows(spark.createDataFrame([(7, item)], "item_id long, text string"))
    picks = decontaminate.rarest_terms(docs, windows)
    postings = decontaminate.store_postings(docs, picks)
    assert postings.count() == postings.distinct().count() <= 2 * 3 * windows.count()
    found = decontaminate.scan(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert found.where("n_hit = 12").count() == 600 and found.count() == 601


def test_broadcasts_are_bounded_in_bytes_too(spark):
    few = spark.createDataFrame([("x" * 1000,)] * 10, "a string")
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(decontaminate._bounded(few))
    assert not hinted(decontaminate._bounded(few, size=5000)) and not hinted(decontaminate._bounded(few, limit=9))


def test_one_labelled_id_with_a_third_of_the_rows_is_one_training_row(spark, monkeypatch):
    rng = random.Random(5)
    docs = frame(spark, [(1, words(rng, 30)) for _ in range(500)] + [(i, words(rng, 30)) for i in range(2, 1000)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 400)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality_gbt, "fit_trees", lambda x, y: seen.append((x, y)))
    quality_gbt.fit(docs, labels)
    x, y = seen[0]
    known = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5]
    assert len(x) == len(y) == len(known) and y.tolist() == [i % 2 for i in known]


def plain_statistics(text):
    """The classifier's statistics of one text, counted one by one."""
    data, spaced = text.encode(), re.findall(r"[^\x20\x09-\x0D]+", text)
    kinds = [0] * 9
    for b in data:
        c = chr(b)
        kinds[
            8 if b >= 128 else 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if c.isdigit() else 4 if c == "\n"
            else 3 if c in " \t\v\f\r" else 5 if c in "#*$%&|<>" else 6 if c in "!?" else 7
        ] += 1
    sizes = [len(w.encode()) for w in spaced]
    folded = [w.translate(brute.LOWER) for w in spaced]
    n, some = len(spaced), max(len(spaced), 1)
    grams = [tuple(folded[i : i + 3]) for i in range(n - 2)]
    lines = [line for line in re.findall(r"[^\n]*\n|[^\n]+\Z", text)]
    counts = Counter(folded)
    return [
        *[k / max(len(data), 1) for k in kinds],
        np.log1p(len(data)),
        np.log1p(n),
        sum(sizes) / some,
        float(np.std(sizes)) if sizes else 0.0,
        sum(s > 15 for s in sizes) / some,
        sum(s < 3 for s in sizes) / some,
        len(counts) / some,
        max(counts.values(), default=0) / some,
        1 - len(set(grams)) / len(grams) if grams else 0.0,
        n / max(len(lines), 1),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
    ]


def test_classifier_statistics_and_trees_against_plain_ones():
    rng = random.Random(6)
    texts = ["", " ", "one", "One two\nOne two\nThree!\n", "é ü #*$ 12 a b a b a b", words(rng, 80, 20), "x\n\nx\n\n", words(rng, 300)]
    got = np.concatenate([quality_gbt.statistics(c) for c in buffers.chunks(pa.array(texts), 64)])
    assert np.allclose(got, [plain_statistics(t) for t in texts])
    x = np.random.default_rng(1).normal(size=(400, len(quality_gbt.FEATURES)))
    model = quality_gbt.fit_trees(x, (x[:, 3] + x[:, 7] > 0).astype(float))

    def walk(row):
        total = model.prior
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(x), [walk(row) for row in x])
    assert ((model.score(x) > 0.5) == (x[:, 3] + x[:, 7] > 0)).mean() > 0.9


def test_each_take_has_its_own_position(spark):
    """Rows come in the order of all takes' positions, repeats at theirs."""
    rng = random.Random(7)
    rows = [(i, words(rng, rng.randrange(5, 40)), "abc"[i % 3] if i % 7 else "c") for i in range(200)] + [(900, words(rng, 9), "a")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = curriculum.mix(docs).collect()
    takes = []
    for r in found:
        assert r["positions"] == sorted(r["positions"]) and (r["positions"][:1] or [None])[0] == r["position"]
        assert len(r["positions"]) == -(-r["taken"] // r["size"])
        takes += [(p, r["doc_id"]) for p in r["positions"][: round(r["taken"] / r["size"] + 1e-9)]]
    order = [r["doc_id"] for r in curriculum.mixed(docs).collect()]
    assert Counter(order) == Counter(d for _, d in takes)
    place = {}
    for p, d in takes:
        place.setdefault(d, []).append(p)
    met = Counter()
    positions = []
    for d in order:
        positions.append(sorted(place[d])[met[d]])
        met[d] += 1
    assert positions == sorted(positions)


def test_a_verdict_does_not_hang_on_the_size_of_the_table(spark):
    """Languages with few documents are judged, by what all languages have in common."""
    rng = random.Random(9)

    def text(listed, n=260):
        return " ".join(rng.choice(listed) if rng.random() < 0.4 else f"{rng.choice(['lor', 'ipsu', 'dolo'])}{chr(97 + rng.randrange(26))}" for _ in range(n))

    def table(copies):
        rows = [(i, text(quality_rules.COMMON[lang]), lang) for lang in ("en", "fr", "de") for i in range(copies)]
        return spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")

    odd = [
        (9001, text(quality_rules.COMMON["es"]), "es"),
        (9002, text(["AND", "OR"]).upper() + " 123 456 !!" * 60, "en"),
        (9003, text(quality_rules.COMMON["en"]), "en"),
        (9004, " ".join(f"{i}" for i in range(1000, 1300)), None),
        (9005, "Kurz und gut. " * 30 + text(quality_rules.COMMON["de"], 200), "xx"),
    ]
    verdicts = []
    for copies in (15, 1500):
        found = quality_rules.apply_rules(table(copies)).where("doc_id > 9000").orderBy("doc_id").collect()
        assert all(r["class_distance"] is not None for r in found)
        verdicts.append([r["kept"] for r in found])
    assert verdicts[0] == verdicts[1] == [True, False, True, False, True]


def test_repeated_rows_do_not_multiply_contexts(spark):
    """Equal rows share their contexts, so a group to compare does not grow with them."""
    rng = random.Random(13)
    shared = words(rng, 60)
    text = f"{words(rng, 80)} {shared} {words(rng, 80)}"
    other = f"{words(rng, 50)} {shared} {words(rng, 50)}"
    docs = frame(spark, [(None, text)] * 2000 + [(1, other)] + [(2, words(rng, 200))])
    wanted = spark.createDataFrame(
        [(1, r[0], 0, 150) for r in docs.where("doc_id is null").select(suffix_dedup._row()).distinct().collect()],
        "print long, row long, start long, size long",
    )
    cut = suffix_dedup.cut_contexts(docs, wanted)
    assert cut.count() <= cut.rdd.getNumPartitions()
    found = suffix_dedup.digests(docs, suffix_dedup.repeated_spans(docs)).collect()
    plain = brute.suffix_dedup([(None, text), (1, other), (2, "")])
    assert {r["n_removed"] for r in found if r["doc_id"] is None} == {plain[0][2]} and plain[0][2] > 0
    assert len(found) == 2002


@pytest.mark.parametrize("piece", [150, 1000])
def test_long_texts_in_pieces(spark, monkeypatch, piece):
    """Texts read in overlapping pieces lose the same bytes."""
    rng = random.Random(14)
    shared = [words(rng, 40) for _ in range(5)]
    texts = [" ".join(rng.choice([*shared, words(rng, 10), "ab" * 90]) for _ in range(rng.randrange(30))) for _ in range(12)]
    docs = [*enumerate(texts), (100, texts[3]), (None, texts[4]), (None, texts[4] + shared[0])]
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", piece)
    frame_ = frame(spark, docs, 3)
    got = suffix_dedup.digests(frame_, suffix_dedup.repeated_spans(frame_)).collect()
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(got) == key(brute.suffix_dedup(docs))


def test_a_very_long_text_stays_within_memory():
    """Choosing places in 40 MB holds arrays for a piece, not for the text."""
    import tracemalloc

    text = np.random.default_rng(1).integers(97, 123, 40_000_000, dtype=np.uint8).tobytes()
    column = pa.array([text], pa.binary())
    tracemalloc.start()
    runs = sum(len(suffix_dedup.choose(chunk)[0]) for chunk, _ in suffix_dedup._pieces(column, 100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert runs > 40_000_000 / 100 and peak < 500_000_000
