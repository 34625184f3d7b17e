"""Personal data, toxicity and language-model scores."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from annospark.llm import lm_score, pii, toxicity

PII = [
    None,
    "",
    "mail a.b+c@x-y.example.com, a@b.c_d@e.f and @no.one x@y",
    "ip 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.0004",
    "card 4532 0151 1283 0366 and 4532015112830367 5-5-5",
    "call +1 (269) 555-3296 or +12 or +44-20-7946-0958-1 ++1 234 567 890",
    "über 🙂 ä@ö.de x@ä.de Ünï ok@host.org",
    "1 " * 3000 + "a@b.co " * 50,
    "ä a@b.co, " * 600 + "1.2.3.4 " * 257,
]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for i, c in enumerate(reversed(digits))) % 10 == 0


def spans(t):
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    number = lambda m: re.sub("[^0-9]", "", m[0])
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(number(m)) <= 19 and luhn(number(m))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(number(m)) <= 15]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in found]


def test_base_spans(spark):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(PII)] + [(None, "x@y.z", "c", 1)], "doc_id bigint, text string, base string, rid int")
    found = {r.doc_id: r for r in pii.digest(pii.find_personal_data(docs)).collect()}
    for i, t in enumerate(PII):
        want = spans(t or "")
        assert found[i].spans.split(",") == (want or [""]), t
        assert found[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert found[i].n_email == sum(w.startswith("email") for w in want)
    assert found[None].n_email == 1 and pii.find_personal_data(docs.limit(0)).count() == 0


def test_disclosing_terms_are_found_and_removed(spark):
    filler = ["the report was sent on time", "a meeting took place in town", "nothing new to say here", "the work goes on as planned", "some more text without data"]
    rows = [(i, f"{filler[i]} Zorblax wrote from z@corp.example.com about it") for i in range(5)] + [(100 + i, f"{filler[i % 5]} number {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert all({t.entity for t in found[i].terms} == {"Zorblax", "wrote", "from", "about", "it"} for i in range(5))
    assert not any(found[100 + i].terms for i in range(60))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0] == "the report was sent on time [NAME]   [EMAIL]  " and clean[100] == rows[5][1]


def test_copies_are_no_evidence(spark):
    docs = spark.createDataFrame([(i, "Zorblax wrote from z@corp.example.com") for i in range(9)] + [(50, "else")], "doc_id bigint, text string")
    assert not any(r.terms for r in pii.find_personal_data(docs).collect())


def test_entities_seen_once_are_scored_by_kind_and_terms_marked_anywhere(spark):
    rows = [(i, f"Zorblax said {'some words ' * 60} {'abcde'[i]}{i}@{'abcde'[i]}host{i}.org number{i}") for i in range(5)] + [(50, "here Zorblax is named, and zorblax again")] + [(100 + i, f"plain words said {i}") for i in range(200)]
    found = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all([(t.first, t.last) for t in found[i].terms if t.entity == "Zorblax"] == [(0, 7)] for i in range(5))
    assert [(t.first, t.last, t.entity) for t in found[50].terms] == [(5, 12, "Zorblax"), (27, 34, "zorblax")]
    assert not any(found[100 + i].terms for i in range(200))


def test_copies_hide_no_term(spark):
    filler = ["the report was sent on time", "a meeting took place in town", "nothing new to say here", "the work goes on as planned"]
    texts = [f"{x} Zorblax z@corp.example.com" for x in filler]
    docs = [(i, t) for i, t in enumerate(texts)] + [(10 + i, texts[0]) for i in range(300)] + [(0, texts[0])] * 2 + [(1000 + i, f"other {i}") for i in range(60)]
    found = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert all([t.entity for t in found[i].terms] == ["Zorblax"] for i in (0, 1, 2, 3, 10, 309))


def test_shares_equal_brute_force(spark):
    """Entities, units and disclosed shares of the given documents, with bounds that many terms pass."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id id", "coalesce(text, '') body").withColumn("rid", F.xxhash64("id", "body"))
    found = pii.base_spans(docs, "body").withColumn("held", F.when(F.size("base") > 0, F.col("body"))).withColumn("sum", F.xxhash64("body")).drop("body")
    got = {(r.entity, r.term): r.share for r in pii.disclosing_terms(docs.select("rid", "body"), found, pii.units(found), "body", 2, 0.5).collect()}
    term, number = regex.compile(r"[\p{L}\p{N}]+"), lambda t: re.sub("[^0-9]", "", t)
    units = {}
    for r in sorted(docs.collect(), key=lambda r: r.rid):
        at = sorted((k, int(a), int(b)) for k, a, b in (x.split(":") for x in spans(r.body)))
        sides = frozenset((r.body[a:b].lower(), r.body[max(0, a - 200) : a], r.body[b : b + 200]) for _, a, b in at)
        units.setdefault(sides or r.body, (r.body, at))  # the row with the least hash stands for its unit
    holds, own, spread = {}, [], Counter()
    for body, at in units.values():
        spread.update(set(term.findall(body.lower())))
        if not at:
            continue
        outside, end = "", 0
        for a, b in sorted((a, b) for _, a, b in at):
            outside, end = outside + body[end:a] + " ", max(end, b)
        mine = set()
        for kind, a, b in at:
            text, k = body[a:b], pii.KINDS.index(kind)
            group = text.lower().rsplit("@", 1)[-1] if k == 0 else ".".join(text.split(".")[:2]) if k == 1 else number(text)[: 6 if k == 2 else 5]
            mine |= {f"value:{k}:{text.lower()}", f"group:{k}:{group}", f"kind:{k}"}
        own.append((mine, set(term.findall((outside + body[end:]).lower()))))
    df_e = Counter(e for mine, _ in own for e in mine)
    both = Counter((e, t) for mine, terms in own for e in mine if df_e[e] >= 2 for t in terms)
    n, want = len(units), {}
    for (e, t), c in both.items():
        if c >= 2 and n > df_e[e]:
            share = min(1.0, math.log(n * c / (df_e[e] * spread[t])) / math.log(n / df_e[e]))
            if share >= 0.5:
                want[e, t] = share
    assert len(want) > 20 and got.keys() == want.keys() and all(math.isclose(got[x], want[x], rel_tol=1e-9) for x in want)


def test_gradients_match_differences():
    net = toxicity.Network(3, state=3, width=2, words=12, trigrams=9, dtype=np.float64)
    r = np.random.default_rng(0)
    for v in net.p.values():
        v += r.standard_normal(v.shape) * 0.3
    rows, grams, offsets = np.array([1, 5, 7, 1]), np.array([0, 2, 3, 3, 8, 1]), np.array([0, 1, 3, 5, 6])
    place = r.integers(0, 4, (3, 6))
    there = np.arange(6) < np.array([6, 3, 1])[:, None]
    label = np.array([1.0, 0.0, 1.0])
    _, g = net.gradients(rows, grams, offsets, place, there, label)
    for name, v in net.p.items():
        for _ in range(6):
            at = tuple(int(r.integers(0, n)) for n in v.shape)
            v[at] += 1e-5
            up = net.gradients(rows, grams, offsets, place, there, label)[0]
            v[at] -= 2e-5
            down = net.gradients(rows, grams, offsets, place, there, label)[0]
            v[at] += 1e-5
            assert math.isclose(g[name][at], (up - down) / 2e-5, rel_tol=1e-3, abs_tol=1e-6), name


def test_windows_cover_every_word():
    counts = np.array([0, 1, 64, 65, 112, 113, 500])
    place, there, of = toxicity.windows(counts)
    begin = np.concatenate([[0], np.cumsum(counts)])
    for i, n in enumerate(counts):
        own = place[of == i][there[of == i]]
        assert set(own.tolist()) == set(range(begin[i], begin[i] + n))


def test_learns_rare_bad_words_and_holds_out(spark):
    r = np.random.default_rng(4)
    words = ["".join(r.choice(list("abcdefgh"), 5)) for _ in range(60)]
    rows, labels = [], []
    for i in range(300):
        text = list(r.choice(words, r.integers(5, 150)))
        if i % 3 == 0:
            text.insert(int(r.integers(0, len(text))), str(r.choice(["vexqo", "zurmik"])))
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(900, None), (901, ""), (None, "vexqo")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {x.doc_id: x for x in toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    held = [i for i, _ in labels if found[i].held_out]
    assert np.mean([found[i].predicted == y for i, y in labels if found[i].held_out]) > 0.9 and 30 < len(held) < 90
    assert found[900].score == found[901].score and len(found) == len(rows)


def test_whole_counts_keep_rare_words_and_trigrams(spark):
    texts = ["a b a b c", "a b c", "rare words here", None, "", "a b c", "a " * 2000, "once", "a b rare"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "b c")]
    shown = [(i, ["<s>", "<s>", *(t or "").split()]) for i, t in rows]
    grams = lambda n: Counter(tuple(w[i : i + n]) for _, w in shown if len(w) > 2 for i in range(len(w) - n + 1))
    count = {n: grams(n) for n in (1, 2, 3)}

    def backed_off(g):
        if len(g) == 1:
            return count[1][g] / sum(n for w, n in count[1].items() if w != ("<s>",))
        return count[len(g)][g] / count[len(g) - 1][g[:-1]] if count[len(g)][g] else 0.4 * backed_off(g[1:])

    want = {i: sum(math.log(backed_off(tuple(w[k - 2 : k + 1]))) for k in range(2, len(w))) for i, w in shown}
    found = lm_score.score_whole(spark.createDataFrame(rows, "doc_id bigint, text string"), parts=3).collect()
    assert len(found) == len(rows)
    for r in found:
        assert abs(r.log_score - want[r.doc_id]) < 1e-2 and (r.mean_log_score is None) == (r.n_words == 0)
    assert lm_score.score_whole(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_hashes_travel_whole():
    r = np.random.default_rng(5)
    for parts in (1, 3, 400):
        x = np.unique(r.integers(0, 1 << 64, 2000, dtype=np.uint64))
        part = ((x >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        for p in np.unique(part).tolist():
            own, begin = x[part == p], lm_score.part_begin(p, parts)
            assert (lm_score.summed(lm_score.stepped(own, begin), begin) == own).all()


def test_texts_that_differ_beyond_their_entities_surroundings_are_all_read(spark):
    """Long texts with the same surroundings are one unit, which holds the terms of each of them."""
    near = "same words " * 30
    rows = [(100 * u + k, f"Alpha{'' if k else ' Zorblax'} start {k} {near} {u}u {'abcde'[u]}{u}@{'abcde'[u]}host{u}.org {u}u {near} end") for u in range(5) for k in range(6)]
    rows += [(9000 + i, f"plain words said {i}") for i in range(200)]
    rows.append((9999, "here Zorblax is named"))
    found = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [t.entity for t in found[9999].terms] == ["Zorblax"]
    assert all([t.entity for t in found[100 * u].terms if t.entity == "Zorblax"] == ["Zorblax"] for u in range(5))
