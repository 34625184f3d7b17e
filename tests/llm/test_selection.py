"""Exact dedup, mixing and quality rules against brute force."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from annospark.llm import exact_dedup, mixing, quality

SCHEMA = "doc_id bigint, text string, source string, lang string, id int, body string, key string, n_words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(1)
    texts = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta"], n)) for n in r.integers(1, 200, 80)]
    texts += [None, "", " \n ", "same", "same", "a b c " * 30, "x\x1cy z\n\nline\nline\n line", "###$$$ " * 60]
    out = [(i, t, f"s{i % 5}" if i % 7 else None, ("en", "de", None)[i % 3], 1, "b", "k", 0) for i, t in enumerate(texts)]
    return [*out, out[3], (None, "same", "s1", "en", 1, "b", "k", 0), (None, None, None, None, 1, "b", "k", 0)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("hashed", [lambda t: F.xxhash64(t), lambda t: F.pmod(F.xxhash64(t), F.lit(3)).cast("bigint")])
def test_exact_duplicates(docs, rows, hashed):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    found = exact_dedup.exact_duplicates(docs, hashed=hashed, capacity=4).collect()
    want = Counter((i, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""])) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_kept_rows_and_empty_table(docs, rows):
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.select("text").distinct().count() == len({t for _, t, *_ in rows if t}) + kept.where("text is null or text = ''").select("text").distinct().count()
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_index_splits_only_overfull_buckets_and_chains_collisions(spark):
    texts = [f"text {i}" for i in range(400)] + ["hot"] * 300 + ["", None] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    index = exact_dedup.build_index(docs, capacity=30).collect()
    keys, depths = defaultdict(set), defaultdict(set)
    for r in index:
        keys[r.depth, r.bucket].add(r.key)
        depths[r.bucket, r.depth].add((r.key % (1 << 64)) >> (64 - r.depth))
    assert len(index) == len(texts) and len(keys) > 8 and all(len(v) <= 30 for v in keys.values())
    assert all(v == {bucket} for (bucket, _), v in depths.items()) and len({d for d, _ in keys}) > 1
    # one key for every three texts: they are told apart by their bytes, in owners and across salts
    index = exact_dedup.build_index(docs, hashed=lambda t: F.pmod(F.xxhash64(t), F.lit(3)).cast("bigint"), capacity=30).collect()
    chains = defaultdict(set)
    for r in index:
        chains[r.key, r.chain].add(r.sha)
    assert len(chains) == 402 and all(len(v) == 1 for v in chains.values())
    assert {r.group_size for r in index if r.sha == next(x.sha for x in index if x.id == 400)} == {300}


def test_index_files_answer_look_ups(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "doc_id bigint, text string")
    index = exact_dedup.write_index(docs, str(tmp_path / "index"))
    asked = spark.createDataFrame([(9, "a"), (8, "c"), (7, "")], "doc_id bigint, text string")
    assert sorted(map(tuple, exact_dedup.look_up(asked, index).collect())) == [(7, 4, 1), (9, 2, 2)]


def test_quality_keeps_values_of_columns_of_any_name(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, "en", -7, "mine", 2.0, "t"), (2, None, "en", 1, "x", 0.0, "u"), (None, text, None, 3, None, 4.0, "v")], "doc_id bigint, text string, lang string, n_words int, lowest string, log_perplexity double, own string")
    assert sorted(map(tuple, quality.keep_good(docs).collect()), key=str) == [(1, text, "en", -7, "mine", 2.0, "t"), (None, text, None, 3, None, 4.0, "v")]
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_dropping_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a", "x", 5), (2, "a", "y", 6), (2, "a", "y", 6), (None, None, "z", 7)], "doc_id bigint, text string, lost_id string, lost_sha int")
    assert sorted(map(tuple, exact_dedup.drop_exact_duplicates(docs).collect()), key=str) == [(2, "a", "y", 6), (2, "a", "y", 6), (None, None, "z", 7)]


def filled(sizes):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_names, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_names:
        total = sum(weight[s] for s in open_names)
        over = {s for s in open_names if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_names}
        out |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_names -= over
    return out


def test_mix_meets_targets_and_repeats(docs, rows):
    found = mixing.mix(docs).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for i, t, s, *_ in rows:
        sizes[s] += len(WORD.findall(t or ""))
    for r in found:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.mix_size and r.source_size == sizes[r.source]
    for s, want in filled(sizes).items():
        assert math.isclose(target[s], want, rel_tol=1e-9) and abs(taken[s] - want) <= 2
    again = {(r.doc_id, r.text, r.source): r.taken for r in mixing.mix(docs.repartition(2)).collect()}
    assert all(again[r.doc_id, r.text, r.source] == r.taken for r in found)
    assert mixing.mix(docs.limit(0)).count() == 0
    copies = mixing.mixture(docs)
    assert copies.columns == docs.columns and copies.count() == sum(-(-r.taken // r.mix_size) for r in found if r.taken)


def test_mixture_keeps_values_of_columns_of_any_name(spark):
    rows = [(1, "a b c", "x", 9, "t", 1.5, "o"), (2, "d e f", "y", 8, "u", 2.5, None), (None, "g h", None, 7, None, None, "p"), (4, None, "x", 1, "v", 0.0, "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, taken int, target string, mix_size double, own string")
    found = Counter(map(tuple, mixing.mixture(docs).collect()))
    assert set(found) <= set(rows[:3]) and sum(found.values()) >= 4 and mixing.mixture(docs.limit(0)).columns == docs.columns


def test_cut_follows_exponential_keys(docs):
    """In the fractional epoch the rows taken are the first by their keys."""
    sized = mixing.measured(docs)
    drawn, _, tie = mixing._drawn("doc_id", "source", 7)
    plain = sized.withColumn("d", drawn).withColumn("t", tie).select("doc_id", "source", "d", "t", "mix_size").distinct().collect()
    taken = {(r.doc_id, r.source): r.taken for r in mixing.mix(docs).collect()}
    for s in {r.source for r in plain}:
        order = [taken[r.doc_id, s] / r.mix_size for r in sorted((r for r in plain if r.source == s and r.mix_size), key=lambda r: (r.d, r.t))]
        assert order == sorted(order, reverse=True)


def counted(t):
    words = WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    covered = {k for v in places.values() if len(v) > 1 for i in v for k in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_model(docs, rows):
    found = quality.judge(docs.drop("n_words")).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == Counter((i, *counted(t)) for i, t, *_ in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in found)
    assert quality.judge(docs.limit(0)).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found)


def plain_kneser_ney(text_rows):
    """Interpolated modified Kneser-Ney over letter classes with dictionaries; a function from four classes to a log probability."""
    rows = [[0, 0, 0, *(int(quality._CLASS[x]) for x in t.encode())] for t in text_rows]
    top = Counter(tuple(r[k - 3 : k + 1]) for r in rows for k in range(3, len(r)))
    tables = [top]
    for _ in range(3):
        tables.append(Counter(g[1:] for g in tables[-1]))

    def probability(gram):
        if not gram:
            return 1 / 32
        table = tables[4 - len(gram)]
        n = [max(1, sum(c == k for c in table.values())) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        cut = [0, *(min(k - 0.05, max(0.05, d)) for k, d in zip((1, 2, 3), (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])))]
        after = [c for g, c in table.items() if g[:-1] == gram[:-1]]
        if not after:
            return probability(gram[1:])
        spare = sum(cut[min(c, 3)] for c in after) / sum(after)
        return max(table[gram] - cut[min(table[gram], 3)], 0) / sum(after) + spare * probability(gram[1:])

    known = {}
    return lambda t: -sum(math.log(known.get(g) or known.setdefault(g, probability(g))) for r in [[0, 0, 0, *(int(quality._CLASS[x]) for x in t.encode())]] for g in (tuple(r[k - 3 : k + 1]) for k in range(3, len(r)))) / max(1, len(t.encode()))


def test_verdicts_equal_brute_force(spark, monkeypatch):
    """Models, perplexities, bands and verdicts of a small corpus from dictionaries and sorted lists."""
    monkeypatch.setattr(quality, "LANGUAGES", 2)
    r = np.random.default_rng(6)
    words = {x: ["".join(r.choice(list(letters), n)) for n in r.integers(2, 7, 60)] for x, letters in (("aa", "abcde"), ("bb", "efghé"), (None, "klmno"), ("cc", "pqr"))}
    rows = [(i, " ".join(r.choice(words[x], 55)), x) for i, x in enumerate([*["aa"] * 24, *["bb"] * 22, *[None] * 4, *["cc"] * 3])]
    rows += [(90, " ".join(r.choice(words["bb"], 60)), "aa"), (91, "zq " * 70, "bb"), (92, "".join(r.choice(list("#$ %&"), 400)), "aa"), (93, None, "aa"), (94, "short", "bb"), (95, " ".join(f"{k}:{k * 7919}" for k in range(60)), None)]
    found = {x.doc_id: x for x in quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)).collect()}
    large, every = ["aa", "bb"], plain_kneser_ney([t or "" for _, t, _ in rows])  # the others have too few documents
    own = {x: plain_kneser_ney([t or "" for _, t, y in rows if y == x]) for x in large}
    score = {i: own.get(x, every)(t) for i, t, x in rows if t}
    pooled = {i: every(t) for i, t, _ in rows if t}
    for i, want in score.items():
        assert math.isclose(found[i].log_perplexity, want, rel_tol=1e-5), i

    def band(values):
        middle = lambda v: sorted(v)[(len(v) + 1) // 2 - 1]
        mid = middle([round(v * 2000) for v in values]) / 2000
        spread = middle([round(abs(v - mid) * 2000) for v in values]) / 2000
        return mid - max(0.05, quality.LOWER_BAND * 1.4826 * spread), mid + max(0.05, quality.UPPER_BAND * 1.4826 * spread)

    passed = {i for i in score if not found[i].base_failed}
    verdicts = Counter()
    for i, _, x in rows:
        low, high = band([score[j] for j, _, y in rows if y == x and j in passed] if x in large else [pooled[j] for j in passed])
        want = i in passed and low <= score[i] <= high
        verdicts[want, i in passed] += 1
        assert found[i].kept == want, i
    assert verdicts[False, True] and verdicts[True, True] and verdicts[False, False]


def test_grams_do_not_depend_on_the_block():
    r = np.random.default_rng(2)
    data = np.frombuffer(bytes(r.choice(list(b"abcd e."), 300).tolist()), np.uint8)
    offsets = np.array([0, 0, 2, 100, 101, 102, 103, 300, 300])
    whole = quality.grams(data, offsets)
    for step in (1, 2, 3, 7, 299):
        assert (np.concatenate([quality.grams(data, offsets, a, min(300, a + step)) for a in range(0, 300, step)]) == whole).all()


def test_kneser_ney_is_a_distribution():
    r = np.random.default_rng(2)
    data = np.frombuffer(bytes(r.choice(list(b"abcd e."), 3000).tolist()), np.uint8)
    keys, n = np.unique(quality.grams(data, np.array([0, 1000, 1000, 3000])), return_counts=True)
    levels = quality.kneser_ney(keys, n)
    every = quality.log_probability(levels, np.arange(32**4)).reshape(-1, 32)
    assert np.allclose(np.exp(every).sum(axis=1), 1, atol=1e-4)


def test_junk_is_rejected_and_clean_kept(spark):
    r = np.random.default_rng(3)
    vocabulary = ["".join(r.choice(list("etaoinshrdlu"), n)) for n in r.integers(2, 9, 400)]
    clean = [(i, " ".join(r.choice(vocabulary, 150)), "en") for i in range(200)]
    junk = [(1000 + i, " ".join("".join(r.choice(list("#$%&|<>*"), 6)) for _ in range(150)), "en") for i in range(5)]
    found = {x.doc_id: x.kept for x in quality.judge(spark.createDataFrame(clean + junk, "doc_id bigint, text string, lang string")).collect()}
    assert all(found[i] for i, *_ in clean) and not any(found[i] for i, *_ in junk)


def test_bands_reject_bad_rows_of_every_language(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = d.select("doc_id", "lang").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("quality is not null")
    found = quality.judge(d).where("not base_failed").join(labels, "doc_id").groupBy("lang", "quality").agg(F.count_if(~F.col("kept")).alias("out"), F.count("*").alias("n")).collect()
    share = {(r.lang, r.quality): r.out / r.n for r in found}
    print({(r.lang, r.quality): f"{r.out}/{r.n}" for r in found})
    for lang in ("de", "en", "es", "fr"):
        assert share[lang, 0] > 0.25 and share[lang, 1] < 0.04, (lang, share)


def test_small_languages_have_the_pooled_band(spark):
    r = np.random.default_rng(3)
    vocabulary = ["".join(r.choice(list("etaoinshrdlu"), n)) for n in r.integers(2, 9, 400)]
    clean = [(i, " ".join(r.choice(vocabulary, 150)), "xx" if i < 3 else "en") for i in range(200)]
    junk = [(1000, " ".join("".join(r.choice(list("#$%&|<>*"), 6)) for _ in range(150)), "xx")]
    found = {x.doc_id: x for x in quality.judge(spark.createDataFrame(clean + junk, "doc_id bigint, text string, lang string")).collect()}
    assert not found[1000].kept and all(found[i].kept for i in range(3)) and found[0].lowest is not None


def test_letters_outside_ascii_have_classes():
    of = lambda t: quality.grams(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[-1]
    letters = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþß"
    assert len({of(x) for x in letters}) == len(letters) and of("é") == of("É") and len({of(x) for x in "абвгд"}) == 5


def test_every_language_has_its_own_model(spark, monkeypatch):
    """More languages than are held at once: each is scored by its own model, as if it were alone, and every row is there once."""
    r = np.random.default_rng(8)
    letters = {"aa": "abcde", "bb": "efghi", None: "klmno", "cc": "pqrst", "dd": "uvwxy"}
    rows = [(i * 30 + k, " ".join("".join(r.choice(list(letters[x]), 4)) for _ in range(60)), x) for i, x in enumerate(letters) for k in range(25)]
    rows += [(900, "zq " * 70, "few"), (901, None, "few"), (902, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    rounded = lambda found: {x.doc_id: tuple(round(v, 6) if isinstance(v, float) else v for v in x) for x in found}
    whole = rounded(quality.judge(docs).collect())
    monkeypatch.setattr(quality, "LANGUAGES", 2)
    found = quality.judge(docs).collect()
    assert sorted(x.doc_id for x in found) == sorted(i for i, _, _ in rows)
    assert rounded(found) == whole
    assert sorted(x.doc_id for x in quality.keep_good(docs).collect()) == sorted(x.doc_id for x in found if x.kept)
