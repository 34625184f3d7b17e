"""Similarity links against all pairs, components, and the pipeline's stages."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from annospark.llm import graph, jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size, percent):
    """Components by comparing all pairs."""
    sets = []
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low.setdefault(find(k), []).append(i)
    return [(i, len(sets[k]), min(low[find(k)])) for k, (i, _) in enumerate(rows)]


def corpus(seed):
    """Chains of near copies, subsets, tiny texts and passages shared by texts that are otherwise different."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    passage, out = [word() for _ in range(60)], []
    for _ in range(40):
        text = [word() for _ in range(r.choice([1, 2, 3, 8, 12, 20, 25, 40, 90, 300]))]
        for _ in range(r.choice([1, 1, 2, 6])):
            out.append(" ".join(text))
            for _ in range(r.choice([0, 1, 1, 3])):
                text = list(text)
                at = r.randrange(len(text))
                text[at : at + r.choice([0, 1, 1])] = [word()]
    out += [" ".join([*(word() for _ in range(10)), *passage]) for _ in range(15)]
    return [(i, t) for i, t in enumerate(out)] + [(900, None), (901, ""), (902, " \n"), (903, out[0].upper()), (904, out[0])]


@pytest.mark.parametrize("size, percent, seed", [(3, 90, 1), (5, 80, 2), (2, 70, 3)])
def test_components_equal_brute_force(spark, size, percent, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id bigint, text string, node int, component int").repartition(3)
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked_documents(docs, size, percent).collect()}
    assert found == set(brute(rows, size, percent))


def test_empty_table_and_null_keys(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, None), (2, "a b c d")], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard.linked_documents(docs, 3, 90).collect()) == [(0, 0), (0, 2), (2, 2)]
    assert jaccard.linked_documents(docs.limit(0)).count() == 0


def test_thresholds_lose_no_pair():
    """Any two linked sets share a subset, or an element of both prefixes: sizes, overlaps and prefixes are consistent."""
    for percent in (70, 80, 90):
        rule = jaccard.Threshold(percent)
        for light in (0, 7, 12):
            for x in range(1, 300):
                for y in rule.partners(x):
                    need = rule.overlap(x, y)
                    assert need <= min(x, y) and 100 * need >= percent * (x + y - need)
                    if max(x, y) <= light:
                        assert need in rule.sizes(x, light) or x == y == need
                    else:
                        at = max(rule.level(x), rule.level(y))
                        assert dict(rule.prefixes(x, light))[at] >= x - need + 1 and dict(rule.prefixes(y, light))[at] >= y - need + 1


def linked(rows, size, percent):
    """All linked pairs of different sets, by comparing all."""
    sets = {}
    for _, t in rows:
        w = WORD.findall(t or "")
        sets.setdefault(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []), len(sets))
    every = [s for s in sets if s]
    return every, [(a, b) for a in every for b in every if len(a) < len(b) or len(a) == len(b) and sets[a] < sets[b] if 100 * len(a & b) >= percent * len(a | b)]


@pytest.mark.parametrize("size, percent, light", [(3, 90, 24), (5, 80, 12), (3, 90, None)])
def test_both_sides_find_their_links(spark, size, percent, light):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    rows = []
    for n in [9, 13, 16, 20, 24, 30, 60, 200] * 6:
        text = [word() for _ in range(n)]
        for k in range(4):  # longer and shorter ones, so that subsets are proper
            rows.append((len(rows), " ".join(text[k % 3 :] + [word()] * (k == 3))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    rule, scan = jaccard.Threshold(percent), jaccard.stored(jaccard.scanned(docs, size, "doc_id", "text"), "scan")
    found, parts = jaccard.links(docs, scan, rule, size, "doc_id", "text", light)
    sides = {x.side: x["count"] for x in found.groupBy("side").count().collect()}
    every, want = linked(rows, size, percent)
    nodes = {x.node: x.n_shingles for x in scan.where("n_shingles > 0").select("node", "n_shingles").collect()}
    if light:
        small, large = sum(len(b) <= light for _, b in want), sum(len(b) > light for _, b in want)
        assert small and large and 0 < sides["light"] <= small and 0 < sides["heavy"] <= large
        assert all(max(nodes[x.a], nodes[x.b]) <= light for x in found.where("side = 'light'").collect())
        assert any(rule.sizes(n, light) and rule.sizes(n, light)[0] < n for n in range(1, light + 1))
    root = {s: s for s in every}

    def find(x):
        while root[x] is not x:
            x = root[x]
        return x

    for a, b in want:
        root[find(a)] = find(b)
    assert len({find(s) for s in every}) == len(nodes) - parts.count() + parts.select("component").distinct().count()


def test_texts_of_one_template_never_meet(spark):
    template = [f"w{i}" for i in range(22)]
    rows = [(i, " ".join([*template[:11], f"own{i}", *template[11:]])) for i in range(3000)] + [(5000 + i, " ".join(template)) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    rule, scan = jaccard.Threshold(90), jaccard.stored(jaccard.scanned(docs, 3, "doc_id", "text"), "scan")
    order = spark.sparkContext.broadcast(jaccard.element_counts(scan))
    assert sum(order.value) - 3000 * 21 in (20, 40)  # copies count once in each task
    assert jaccard.shared_lists(jaccard.postings(docs, 3, rule, 0, order, "text")).count() < 300
    assert jaccard.linked_documents(docs, 3, 90).where("component_id = doc_id").count() == 3001


def test_lists_over_many_batches(spark):
    """Leaders of a list longer than a batch link all that can link, and other lists in the same batches are not mixed up with it."""
    near, far = (lambda k: np.packbits(np.arange(jaccard.BITS) < k).tobytes()), jaccard.Threshold(90)
    rows = [(5, i, 300, 0, near(i % 3)) for i in range(25_000)] + [(k, 100_000 + k * 10 + i, 300, 0, near(400 * i)) for k in (3, 4, 6, 7) for i in range(3)]
    rows.sort()
    frame = spark.createDataFrame([(*x[:4], bytearray(x[4])) for x in rows], "list_id long, node long, n int, at int, bitmap binary")
    found = {tuple(r) for r in jaccard.leader_pairs(frame.repartition(1), far).collect()}
    assert found == {(0, i) for i in range(1, 25_000)}
    placed = frame.where("list_id = 5 and node < 1500 or list_id > 5").withColumn("component", F.when(F.col("node") < 700, 1).otherwise(F.col("node")))
    pairs = {tuple(r) for r in jaccard.rest_pairs(placed.drop("bitmap"), frame.select("node", "bitmap"), far).collect()}
    assert pairs == {(a, b) for a in range(1500) for b in range(max(a + 1, 700), 1500)}


def test_boundary_follows_the_cost():
    rule = jaccard.Threshold(90)
    assert jaccard.boundary(rule, {19: (1000, 1.0)}) >= 19 > jaccard.boundary(rule, {28: (1000, 0.0)} | {19: (1000, 0.0)})


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(5, 9), (9, 7), (20, 21), (3, 3), (21, 20)]])
def test_components_of_links(spark, links):
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {x: find(x) for p in links if p[0] != p[1] for x in p}


def test_stages_take_odd_input(spark):
    """Nulls, empty and very long texts, repeated rows, clashing column names and empty tables, in every stage; values stay as they are."""
    r = random.Random(3)
    text = lambda n: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n))
    long, plain = text(60_000), text(80)
    rows = [(i, t, s, lang, 5, "x", float(i or 0), None) for i, t, s, lang in [(1, None, "a", "en"), (2, "", "a", None), (3, long, None, "en"), (4, plain, "b", "en"), (4, plain, "b", "en"), (5, plain, "a", None), (None, plain, None, "en"), (6, plain + " more words here", "b", "en"), (None, None, None, None)]]
    schema = "doc_id bigint, text string, source string, lang string, n_words int, lost_id string, target double, own string"
    docs = spark.createDataFrame(rows, schema).repartition(2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns and set(map(tuple, kept.collect())) <= set(rows), name
        assert stage(spark, docs.limit(0), "").count() == 0, name
    near = sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert sum(x[1] == plain for x in near) == 3 and not any(x[0] in (5, 6) for x in near)  # both rows of 4, and the one without id
    last = {(x.doc_id, len(x.token_ids)) for x in corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()}
    assert (1, 0) in last and (2, 0) in last and max(n for _, n in last) > 60_000


def test_stages_keep_columns_and_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("extra", F.lit(1))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, folder)
        assert docs.columns == columns, name
        assert docs.join(before, "doc_id", "left_anti").count() == 0
        docs = spark.createDataFrame(docs.toArrow())
        if name == "exact dedup":
            assert docs.count() == docs.select("text").distinct().count()
        if name == "n-gram Jaccard join":
            kept = [(r.doc_id, r.text) for r in docs.collect()]
            assert all(i == c for i, _, c in brute(kept, 5, 80))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == docs.count() and last.where(F.size("token_ids") == 0).count() == 0
