"""The subpackage's queries, each an operator with production parameters over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, collocations, conversation_repair, exact_dedup, jaccard, lm_score, mixing, packing, pii, quality, token_counts, token_orc, toxicity
from .shared import shared_path

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_tokens(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mixed.selectExpr("doc_id", "mix_size AS size", "source_size", "target", "taken")


#: Words, in DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

OP2_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size, strlen(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS inside,
    strlen(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS letters,
    CAST('0x' || substring(md5(concat_ws('|', '7', CAST(doc_id AS VARCHAR), source)), 1, 13) AS BIGINT) AS tie
  FROM documents),
drawn AS (SELECT *, -ln((tie + 0.5) / 4503599627370496.0::DOUBLE) / CASE WHEN inside > 0 THEN greatest(0.05::DOUBLE, letters / inside::DOUBLE) ELSE 1::DOUBLE END AS drawn FROM sized),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY 1),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM sources),
stops AS (SELECT *, 2.0::DOUBLE * source_size / weight AS stop, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM weighed),
levels AS (SELECT *, (total - coalesce(sum(2.0::DOUBLE * source_size) OVER earlier, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM stops WINDOW earlier AS (ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
reached AS (SELECT *, max(CASE WHEN level <= stop THEN level END) OVER () AS reached FROM levels),
aims AS (SELECT source, source_size, CASE WHEN stop <= reached THEN 2.0::DOUBLE * source_size ELSE coalesce(reached * weight, 2.0::DOUBLE * source_size) END AS target FROM reached),
budgets AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM aims),
summed AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, CAST(round(b.target) AS BIGINT) - b.epochs * b.source_size AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.drawn, d.tie) AS upto
  FROM drawn d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(epochs * size + least(size, greatest(0, budget - (upto - size))) AS BIGINT) AS taken FROM summed
"""


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(documents(spark, sf_dir)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(documents(spark, sf_dir), size=3, percent=90)


OP6_SQL = rf"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM texts),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
"""


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(PIECE_BPE))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_whole(documents(spark, sf_dir))


OP8_SQL = rf"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
grams AS (SELECT doc_id, i, word AS c, lag(word) OVER t AS b, lag(word, 2) OVER t AS a, lead(word) OVER t IS NULL AS last FROM placed WINDOW t AS (PARTITION BY doc_id ORDER BY i)),
contexts AS (SELECT a, b, count(*) AS n FROM (SELECT a, b FROM grams UNION ALL SELECT b, c FROM grams WHERE last) GROUP BY 1, 2),
trigrams AS (SELECT a, b, c, count(*) AS n FROM grams GROUP BY 1, 2, 3),
steps AS (SELECT g.doc_id, sum(CAST(round(ln(t.n) * 1048576) AS BIGINT) - CAST(round(ln(x.n) * 1048576) AS BIGINT)) AS score FROM grams g
  JOIN trigrams t ON g.a IS NOT DISTINCT FROM t.a AND g.b IS NOT DISTINCT FROM t.b AND g.c = t.c
  JOIN contexts x ON g.a IS NOT DISTINCT FROM x.a AND g.b IS NOT DISTINCT FROM x.b GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(score, 0) AS DOUBLE) / 1048576 AS log_score, CASE WHEN len(w) > 0 THEN CAST(score AS DOUBLE) / len(w) / 1048576 END AS mean_log_score
FROM texts LEFT JOIN steps USING (doc_id)
"""


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


OP9_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def op10_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_orc.write_tokens(documents(spark, sf_dir), path, public_tokenizers.path(BYTE_BPE), end_id=2)
    return token_orc.check_sums(token_orc.read_tokens(spark, path))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), end_id=0)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audits(conversation_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def _op12_sql() -> str:
    """The program over turns as a recursion: of each state the least (cost, audit), with the repaired text."""
    edit = lambda x, cost, letter, role="", text="": f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 'r': {x}.r" + (f" || CASE WHEN {x}.r = '' THEN '' ELSE chr(10) END || {role} || ':' || {text}" if role else "") + "}"
    only = lambda test, x: f"CASE WHEN {test} THEN {x} ELSE {{'c': 1000000000, 'a': '', 'r': ''}} END"
    least = lambda *x: f"list_min([{', '.join(x)}])"
    gone = {q: edit(f"d.{q}", 4, "D") for q in "esua"}
    kept = lambda q, i: only(f"NOT t.must_go AND t.initial = '{i}'", edit(f"d.{q}", "t.more", "K", "t.role", "t.text"))
    turned = lambda q, role: only("NOT t.must_go", edit(f"d.{q}", "t.more + 3", "R", f"'{role}'", "t.text"))
    base_u = least(gone["u"], *(kept(q, "u") for q in "esa"), *(turned(q, "user") for q in "esa"))
    base_a = least(gone["a"], kept("u", "a"), turned("u", "assistant"))
    put = lambda x, role: edit(x, 3, "I", f"'{role}'", "''")
    zero, never = "{'c': 0, 'a': '', 'r': ''}", "{'c': 1000000000, 'a': '', 'r': ''}"
    return rf"""
WITH RECURSIVE table_ AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
rests AS (SELECT k.*, xor(list_reduce(list_concat([4294967295], [ascii(key[i]) FOR i IN range(1, len(key) + 1)]), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INT) + 1])), 4294967295) % 20 AS rest FROM keyed k, table_),
damaged AS (SELECT conv_id, turn, CASE WHEN rest = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
  CASE rest WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
  unnest(range(CASE rest WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM rests),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faults AS (SELECT *, role[1:1] AS initial, NOT regexp_matches(text, '[^ 	-
]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS earlier FROM placed),
turns AS (SELECT *, blank OR again AS must_go, cut AND NOT blank AND NOT again AS truncated, CASE WHEN cut AND NOT blank AND NOT again THEN 3 ELSE 0 END AS more FROM faults),
convs AS (SELECT DISTINCT conv_id FROM conversations),
program AS (
  SELECT conv_id, 0 AS i, {zero} AS e, {never} AS s, {{'c': 3, 'a': 'I', 'r': 'user:'}} AS u,
    {{'c': 6, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}} AS a FROM convs
  UNION ALL
  SELECT conv_id, i, e, s, u, {least("a", put("u", "assistant"))} AS a FROM (SELECT conv_id, i, e, s, a, {least("u", put("e", "user"), put("s", "user"), put("a", "user"))} AS u
    FROM (SELECT d.conv_id, d.i + 1 AS i, {gone["e"]} AS e, {least(gone["s"], kept("e", "s"))} AS s, {base_u} AS u, {base_a} AS a
      FROM program d JOIN turns t ON d.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = d.i + 1))),
ended AS (SELECT conv_id, list_min([e, a]) AS x FROM program QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
  count(*) FILTER (truncated) AS truncated, count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY 1)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(x.c AS BIGINT) AS cost, x.a AS audit, sha256(x.r) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


OP12_SQL = _op12_sql()


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(documents(spark, sf_dir))


OP13_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY 1),
runs AS (SELECT lang, size, unnest([array_to_string(w[i : i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase FROM worded, range(1, 6) t(size)),
counts AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM runs GROUP BY 1, 2, 3 HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, f AS a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : size], ' ') AS tail FROM (SELECT *, unnest(range(1, size)) AS k FROM counts WHERE size > 1)),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, CAST(1000::HUGEINT * c.a * t.n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON c.lang = x.lang AND c.head = x.phrase JOIN counts y ON c.lang = y.lang AND c.tail = y.phrase JOIN totals t ON c.lang = t.lang),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (SELECT lang, f, array_to_string(w[o : o + m - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, size - m + 2)) AS o FROM (SELECT *, unnest(range(2, size)) AS m FROM counts WHERE size > 2))),
longer AS (SELECT lang, phrase, max(f) AS f FROM parts GROUP BY 1, 2),
ranked AS (SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, s.n, s.score
  FROM weakest s LEFT JOIN longer g ON s.lang = g.lang AND s.phrase = g.phrase WHERE g.f IS NULL OR 100 * g.f < 100 * s.a)
SELECT * FROM ranked WHERE rank <= 2000
"""


QUERIES = {
    "op1_bpe_encoding": op1_bpe_encoding,
    "op2_source_mixing": op2_source_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_personal_data": op4_personal_data,
    "op5_toxicity": op5_toxicity,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_counts": op7_token_counts,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_token_orc": op10_token_orc,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_collocations": op13_collocations,
}

#: The others have no SQL form: they rest on vocabulary files, fitted models or regular expressions that DuckDB lacks.
SQL = {"op2_source_mixing": OP2_SQL, "op6_jaccard_join": OP6_SQL, "op8_lm_scoring": OP8_SQL, "op9_exact_dedup": OP9_SQL, "op12_conversation_repair": OP12_SQL, "op13_collocations": OP13_SQL}
