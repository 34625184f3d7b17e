"""Small operators around model traffic: worked examples."""

import difflib

import numpy as np
from pyspark.sql import functions as F

from annospark.operators import batch, evals, prompts, retrieval, serving
from annospark.plans import catalog


def test_chat_formats_without_asking(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id int, turn int, role string, text string")
    show = lambda style, ask: prompts.render_chats(turns, style, ask).first().prompt
    assert show("chatml", False) == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb"
    assert show("chatml", True) == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert show("blip2", True) == "Question: a Answer: b Answer:"
    assert show("chatglm2", False) == "[Round 1]\n\n问：a\n\n答：b"


def test_rerank_prompt_forms(spark):
    pairs = spark.createDataFrame([("q", "d")], "query string, document string")
    for style, form in prompts.RERANK_FORMATS.items():
        want = form.replace("{query}", "q").replace("{document}", "d").replace("{instruction}", prompts.DEFAULT_INSTRUCTION)
        assert prompts.rerank_prompts(pairs, style).first().prompt == want


def test_prefixed_match(spark):
    rows = spark.createDataFrame([("2", "ab", "abxyz", "xyy"), ("2", "ab", "zz", "zz")], "k string, prefix string, response string, answer string")
    row = evals.prefixed_match(rows, spark.createDataFrame([("2", 0.3)], "k string, threshold double"), "k").first()
    assert row.match_ratio == difflib.SequenceMatcher(None, "xyz", "xyy").ratio() / 2 and row.passed


def test_prefixed_match_query_reads_whole_answers(spark, tmp_path):
    texts = ["".join(chr(0x4E00 + i * k) for i in range(n)) for k, n in ((1, 40), (2, 500), (3, 900))]
    spark.createDataFrame([(k, 0, "user", t) for k, t in enumerate(texts)], "conv_id bigint, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    row = catalog.QUERIES["eval_prefixed_match"](spark, str(tmp_path)).first()
    want = sum(difflib.SequenceMatcher(None, t[3:], t[5:]).ratio() for t in texts[1:]) / 3
    assert row.n == 3 and abs(row.match_ratio - want) < 1e-8


def test_long_text_is_cut_in_37(spark):
    docs = spark.createDataFrame([(1, "w " * 150_000)], "doc_id int, text string")
    assert retrieval.text_chunks(docs, 4096, 200_000).count() == 37
    assert retrieval.text_chunks(docs, 4096, 100_000).count() == 0
    assert [(r.code, r.item_id, r.message) for r in retrieval.too_long_texts(docs, 100_000).collect()] == [("text_too_long", "1", "150000")]


def test_rerank_by_blocks_equals_plain_products(spark):
    rng = np.random.default_rng(4)
    vectors = rng.integers(-3, 4, (90, 6)).astype(float) + 0.5
    docs = [(i % 70, v.tolist()) for i, v in enumerate(vectors)] + [(200, None), (201, vectors[0].tolist()), (202, vectors[0].tolist())]
    asked = [(k, vectors[k].tolist()) for k in range(25)] + [(99, None)]
    unit = lambda x: np.array(x) / np.linalg.norm(x)
    want = set()
    for k, q in asked[:-1]:
        best = sorted(((-round(float(unit(q) @ unit(d)), 9), i) for i, d in docs if d is not None))[:4]
        want |= {(k, rank, i, -score) for rank, (score, i) in enumerate(best, 1)}
    make = lambda rows, name: spark.createDataFrame(rows, f"{name} bigint, embedding array<double>")
    for sizes in ((1 << 20, 1 << 20), (0, 480), (0, 1 << 20)):
        found = retrieval.rerank(make(asked, "query_id"), make(docs, "doc_id"), 4, *sizes).collect()
        assert {(r.query_id, r["rank"], round(r.score, 9)) for r in found} == {(k, rank, score) for k, rank, _, score in want}
        assert len(found) == len(want)
    assert retrieval.rerank(make(asked, "query_id"), make([], "doc_id"), 4, 0, 480).count() == 0
    assert retrieval.rerank(make([], "query_id"), make(docs, "doc_id"), 4).count() == 0


def test_choices_keep_their_types(spark):
    cases = [("true", True, True), ('"true"', True, False), ("1", True, False), ("1", "1", False), ("1.0", 1, True), ("1e0", 1, True), ("null", None, True), ('""', None, False), ("[]", [], True), ('{"b": 1, "a": [null]}', {"a": [None], "b": 1}, True), ('{"a": [null]}', {"a": [None], "b": None}, False), ("9007199254740993", 9007199254740992, False), ("9007199254740993", 9007199254740993, True)]
    for text, wanted, same in cases:
        assert spark.range(1).select(batch.equals_json(F.parse_json(F.lit(text)), wanted)).first()[0] is same, text


def test_no_run_within_the_limit_gives_zeros(spark):
    runs = spark.createDataFrame([("a", 12.5, 600.0)], "run string, throughput double, p99_ms double")
    assert tuple(serving.best_under_limit(runs, 500).first()) == ("", 0.0, 0.0)
    assert tuple(serving.best_under_limit(runs, 700).first()) == ("a", 12.5, 600.0)


def test_choices_and_patterns(spark):
    row = spark.createDataFrame([("yes\n",)], "t string").select(batch.output_matches(F.col("t"), ["yes"]), batch.output_matches(F.col("t"), pattern="[a-z]+\\s")).first()
    assert tuple(row) == (False, True)


def test_lexical_top_equals_scoring_every_pair(spark):
    r = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(300)])
    text = lambda n: {str(w): int(c) for w, c in zip(*np.unique(words[np.minimum(r.zipf(1.3, n) - 1, 299)], return_counts=True))}
    docs = {d: text(60) for d in range(250)}
    docs |= {300 + d: docs[7] for d in range(15)}  # ties
    asked = {q: text(n) for q, n in enumerate((1, 3, 8, 20, 60, 60))} | {10: docs[7], 11: {"never seen": 2}}
    idf = {w: 1 / sum(w in t for t in docs.values()) for w in {w for t in docs.values() for w in t}}
    rows = [(q, w, n * idf.get(w, 1.0)) for q, t in asked.items() for w, n in t.items()] + [(2, "w0", None), (3, "w1", 0.0)]
    rows = [x for x in rows if (x[0], x[1]) not in {(2, "w0"), (3, "w1")}] + [(2, "w0", None), (3, "w1", 0.0)]
    queries = spark.createDataFrame(rows, "query_id int, token string, weight double")
    postings = spark.createDataFrame([(d, w, float(n)) for d, t in docs.items() for w, n in t.items()], "doc_id int, token string, weight double")
    want = set()
    for q in asked:
        mine = {w: x for i, w, x in rows if i == q and x}
        scored = [(-round(sum(x * docs[d].get(w, 0) for w, x in mine.items()), 6), d) for d, t in docs.items() if mine.keys() & t.keys()]
        want |= {(q, d, -s, n + 1) for n, (s, d) in enumerate(sorted(scored)[:10])}
    for start in (1, 4):
        got = {(x.query_id, x.doc_id, x.score, x["rank"]) for x in retrieval.lexical_top(queries, postings, 10, start).collect()}
        assert {x[:2] + x[3:] for x in got} == {x[:2] + x[3:] for x in want} and all(abs(a[2] - b[2]) < 1e-5 for a, b in zip(sorted(got), sorted(want)))
    assert retrieval.lexical_top(queries.limit(0), postings, 10).count() == 0


def test_documents_with_frequent_tokens_only_are_never_met(spark):
    queries = spark.createDataFrame([(1, "rare", 5.0), (1, "the", 0.1)], "query_id int, token string, weight double")
    postings = spark.createDataFrame([(d, "rare", 1.0) for d in range(12)] + [(d, "the", 1.0) for d in range(5, 500)], "doc_id int, token string, weight double")
    table, plan = retrieval._lexical_plan(queries, postings)
    met, short = retrieval._lexical_candidates(table, plan, 4, 2)
    assert sorted(x.doc_id for x in met.collect()) == list(range(12)) and [x.token for x in short.collect()] == ["the"]
    assert [(x.doc_id, x.score) for x in retrieval.lexical_top(queries, postings, 4, 2).orderBy("rank").collect()] == [(d, 5.1) for d in range(5, 9)]


def test_packed_files_keep_every_line_below_the_limits(spark):
    r = np.random.default_rng(2)
    rows = [(m, i, "é" * int(n)) for m, many in (("a", 400), ("b", 3), (None, 40)) for i, n in enumerate(r.integers(0, 60, many))]
    rows += [("a", 1000, "x" * 700), ("a", 1001, "x" * 1999), ("a", 1002, "x" * 2000), ("a", 1003, None)]
    lines = spark.createDataFrame(rows, "model string, custom_id int, line string")
    for ranges in (1, 5):
        found = batch.packed_files(lines, 20, 2000, ranges=ranges).collect()
        assert sorted((str(x.model), x.custom_id) for x in found) == sorted((str(m), i) for m, i, _ in rows)
        files = {}
        for x in found:
            files.setdefault((str(x.model), x.file), []).append(x.n_bytes)
        assert files.pop(("a", None)) == [2001]
        assert all(len(v) <= 20 and sum(v) <= 2000 for v in files.values())
        for m in {m for m, _ in files}:
            assert sorted(f for k, f in files if k == m) == list(range(sum(k == m for k, _ in files)))
        assert files[("b", 0)] and len([1 for k, _ in files if k == "b"]) == 1
    assert batch.packed_files(lines.limit(0), 20, 2000).count() == 0


def test_sketches_merge_and_keep_their_error(spark):
    r = np.random.default_rng(8)
    values = np.concatenate([r.lognormal(0, 3, 3000), -r.lognormal(1, 1, 700), np.zeros(50)])
    rows = [(int(i % 7), float(v)) for i, v in enumerate(values)] + [(0, None), (1, float("nan")), (2, float("inf"))]
    df = spark.createDataFrame(rows, "part int, v double")
    parts = serving.sketches(df, ["part"], "v")
    shares = {f"q{i}": i / 20 for i in range(21)}
    merged = serving.sketched_quantiles(serving.merged_sketches(parts, []), [], shares).first()
    assert merged == serving.sketched_quantiles(serving.sketches(df, [], "v"), [], shares).first()
    ordered = np.sort(values)
    assert merged["count"] == len(values)
    for name, q in shares.items():
        exact = ordered[int(np.floor(q * (len(values) - 1)))]
        assert abs(merged[name] - exact) <= 0.01 * abs(exact) + 1e-12


def test_contracts_of_a_table_judge_as_one_contract_does(spark):
    from annospark.operators import values
    from annospark.sources import contract

    text = {"field": "sentence", "language": "en", "style": "imperative", "required": True}
    make = lambda name, fields, terms: contract.make_contract({"schema_id": name, "segment_values": fields, "text_output": text}, {"ontology_id": name, "revision": "1", "vocabularies": {"v": [{"id": t} for t in terms]}})
    enum = {"type": "enum", "source": "ontology.v"}
    known = [make("a", {"x": enum, "y": {"type": "string", "required": False}}, ["1", "2"]), make("b", {"x": enum | {"required": False}, "z": {"type": "string"}}, ["3"])]
    maps = [None, {}, {"x": "1"}, {"x": "3"}, {"x": None, "y": "s"}, {"x": "2", "q": "1", "a": None}, {"z": None}, {"z": "k", "x": "3"}]
    rows = spark.createDataFrame([(i, s, m) for s in ("a", "b", "c", None) for i, m in enumerate(maps)], "i int, schema_version string, values map<string,string>")
    got = {(r.i, r.schema_version): r.problems for r in values.contract_problems(rows, contract.contract_table(spark, known)).collect()}
    assert len(got) == 4 * len(maps)
    for c in known:
        own = rows.where(F.col("schema_version") == c.schema_id).withColumn("p", values.value_problems(F.col("values"), c))
        assert {(r.i, c.schema_id): r.p for r in own.collect()} == {k: v for k, v in got.items() if k[1] == c.schema_id}
    assert got[0, "c"] == ["unknown schema: c"] and got[3, None] == ["unknown schema: "]


def test_only_postings_that_queries_ask_for_are_kept(spark):
    queries = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0), (2, "c", None)], "query_id int, token string, weight double")
    postings = spark.createDataFrame([(d, t, 1.0) for d in range(3) for t in "abcd"], "doc_id int, token string, weight double")
    table, _ = retrieval._lexical_plan(queries, postings)
    assert sorted((x.doc_id, x.token) for x in table.collect()) == [(d, t) for d in range(3) for t in "ab"]


def test_a_second_floor_leaves_few_documents_to_score_whole(spark, monkeypatch):
    """Documents with the rarest word lack the others, so that the first floor is low; a better one comes from what is met with it."""
    queries = spark.createDataFrame([(1, "rare", 1.0), (1, "mid", 3.0), (1, "the", 0.5)], "query_id int, token string, weight double")
    rows = [(d, "rare", 1.0) for d in range(4)] + [(d, "mid", 1.0 if d < 20 else 0.4) for d in range(10, 400)] + [(d, "the", 1.0) for d in range(800)]
    postings = spark.createDataFrame(rows, "doc_id int, token string, weight double")
    written, kept = {}, retrieval.kept
    monkeypatch.setattr(retrieval, "kept", lambda df, name: written.setdefault(name if name not in written else f"{name} {len(written)}", kept(df, name)))
    found = retrieval.lexical_top(queries, postings, 2, 2).orderBy("rank").collect()
    assert [(x.doc_id, x.score) for x in found] == [(10, 3.5), (11, 3.5)]
    assert written["candidates"].count() > 300 and written["likely"].count() == 10
