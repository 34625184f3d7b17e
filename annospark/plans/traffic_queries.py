"""Queries around model traffic: batch files, prompts, retrieval, evaluation, serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ordered import kept, quantiles
from ..operators import batch, evals, prompts, retrieval, serving
from ..streaming import rates
from . import adapters as a
from .registry import query

# --- H: batch files and prompts


def _chat_lines(spark, sf_dir):
    chats = batch.chat_messages(a.table(spark, sf_dir, "conversations"))
    body = F.struct(F.when(F.col("conv_id") % 20 == 0, "model-b").otherwise("model-a").alias("model"), "messages")
    return batch.request_lines(chats, F.concat(F.lit("c-"), F.col("conv_id").cast("string")), "/v1/chat/completions", body)


@query("""SELECT 'c-' || conv_id AS custom_id, count(*)::INT AS n_messages, first(role ORDER BY turn) AS first_role, sum(length(text))::BIGINT AS n_chars, CASE WHEN conv_id % 20 = 0 THEN 'model-b' ELSE 'model-a' END AS model
  FROM conversations GROUP BY conv_id""")
def batch_requests(spark, sf_dir):
    json = F.parse_json("line")
    get = lambda path, kind="string": F.try_variant_get(json, path, kind)
    contents = get("$.body.messages", "array<struct<role:string,content:string>>")
    return _chat_lines(spark, sf_dir).select("custom_id", F.size(contents).alias("n_messages"), get("$.body.messages[0].role").alias("first_role"), F.aggregate(contents, F.lit(0).cast("bigint"), lambda s, m: s + F.length(m["content"])).alias("n_chars"), get("$.body.model").alias("model"))


@query("""WITH s AS (SELECT lang, doc_id, strlen(coalesce(text, '')) + 1 AS n, strlen(coalesce(text, '')) + 1 > 6250 AS alone FROM documents),
  b AS (SELECT *, count(*) OVER w - 1 AS lines, coalesce(sum(n) OVER w - n, 0) AS bytes FROM s WINDOW w AS (PARTITION BY lang, alone ORDER BY doc_id ROWS UNBOUNDED PRECEDING)),
  k AS (SELECT *, CASE WHEN n > 100000 THEN NULL WHEN alone THEN lines ELSE bytes // 93750 + lines // 40 END AS key FROM b),
  f AS (SELECT lang, alone, key, row_number() OVER (PARTITION BY lang ORDER BY alone, key) - 1 AS file FROM (SELECT DISTINCT lang, alone, key FROM k WHERE key IS NOT NULL))
  SELECT k.lang, coalesce(f.file, -1) AS file, count(*) AS lines, sum(n)::BIGINT AS n_bytes, min(doc_id) AS first_id, max(doc_id) AS last_id FROM k LEFT JOIN f ON k.lang IS NOT DISTINCT FROM f.lang AND k.alone = f.alone AND k.key = f.key GROUP BY 1, 2""")
def batch_files(spark, sf_dir):
    """Documents as lines in files of at most 40 lines and 100,000 bytes, one language a file."""
    found = batch.packed_files(a.table(spark, sf_dir, "documents").select("lang", "doc_id", "text"), 40, 100_000, "lang", "doc_id", "text")
    return found.groupBy("lang", F.coalesce("file", F.lit(-1).cast("bigint")).alias("file")).agg(F.count("*").alias("lines"), F.sum("n_bytes").alias("n_bytes"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query("""SELECT 'several_models' AS code, 'model-a, model-b' AS detail UNION ALL SELECT 'bad_endpoint', '/v1/unknown' UNION ALL SELECT 'repeated_id', 'c-' || conv_id FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 30 = 1)""")
def batch_file_problems(spark, sf_dir):
    lines = _chat_lines(spark, sf_dir)
    again = lines.where(F.substring("custom_id", 3, 20).cast("bigint") % 30 == 1)
    wrong = a.table(spark, sf_dir, "region").limit(1).select(F.lit("x").alias("custom_id"), F.lit('{"custom_id":"x","method":"POST","url":"/v1/unknown","body":{"model":"model-a"}}').alias("line"))
    return batch.file_problems(lines.union(again).union(wrong))


@query("""SELECT 'c-' || conv_id AS custom_id, CASE WHEN conv_id % 6 = 0 THEN 'missing' WHEN conv_id % 6 = 1 OR conv_id % 6 = 2 THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN conv_id % 6 = 0 THEN NULL WHEN conv_id % 6 = 1 THEN 500 ELSE 200 END::INT AS status_code FROM (SELECT DISTINCT conv_id FROM conversations)""")
def batch_results(spark, sf_dir):
    asked = a.table(spark, sf_dir, "conversations").select("conv_id").distinct().withColumn("custom_id", F.concat(F.lit("c-"), F.col("conv_id").cast("string")))
    k = F.col("conv_id") % 6
    line = F.concat(F.lit('{"id":"r","custom_id":"'), "custom_id", F.lit('","response":{"status_code":'), F.when(k == 1, "500").otherwise("200"), F.lit(',"request_id":"q","body":{"n":1}},"error":'), F.when(k == 2, '{"code":"x"}').otherwise("null"), F.lit("}"))
    return batch.join_results(asked.select("custom_id"), asked.where(k != 0).select(line.alias("line"))).select("custom_id", "status", "status_code")


_TURNS = "SELECT conv_id, turn, role, text, lead(turn) OVER w IS NULL AS last, sum((role = 'user')::INT) OVER w AS users FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"
_LAST = "last(role ORDER BY turn) <> 'assistant'"


def _chat_sql(piece: str, asked: str) -> str:
    return f"SELECT conv_id, string_agg({piece}, '' ORDER BY turn) || {asked} AS prompt FROM ({_TURNS}) GROUP BY conv_id"


CHAT_SQL = {
    "basic": _chat_sql("text", "''"),
    "chatml": _chat_sql("'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)", f"CASE WHEN {_LAST} THEN '<|im_start|>assistant' || chr(10) ELSE '' END"),
    "falcon": _chat_sql("CASE role WHEN 'user' THEN 'User: ' || text WHEN 'assistant' THEN 'Assistant: ' || text ELSE '' END || chr(10)", f"CASE WHEN {_LAST} THEN 'Assistant:' ELSE '' END"),
    "falcon-180b": _chat_sql("CASE role WHEN 'user' THEN 'User: ' WHEN 'assistant' THEN 'Falcon: ' ELSE 'System: ' END || text || chr(10)", f"CASE WHEN {_LAST} THEN 'Falcon:' ELSE '' END"),
    "teleflm": _chat_sql("CASE role WHEN 'user' THEN '<_user>' || trim(text) WHEN 'assistant' THEN '<_bot>' || text ELSE '<_system>' || trim(text) END", "'<_bot>'"),
    "chatglm": _chat_sql("CASE role WHEN 'user' THEN '[Round ' || (users - 1) || ']' || chr(10) || '问：' || text WHEN 'assistant' THEN chr(10) || '答：' || text || chr(10) ELSE '' END", f"CASE WHEN {_LAST} THEN chr(10) || '答：' ELSE '' END"),
    "chatglm2": _chat_sql("CASE role WHEN 'user' THEN '[Round ' || users || ']' || chr(10) || chr(10) || '问：' || text WHEN 'assistant' THEN chr(10) || chr(10) || '答：' || text || chr(10) || chr(10) ELSE '' END", f"CASE WHEN {_LAST} THEN chr(10) || chr(10) || '答：' ELSE '' END"),
    "blip2": _chat_sql("CASE role WHEN 'user' THEN 'Question: ' || text || ' ' WHEN 'assistant' THEN 'Answer: ' || text || ' ' ELSE '' END", "'Answer:'"),
}


def _chat_query(style: str):
    def run(spark, sf_dir):
        return prompts.render_chats(a.table(spark, sf_dir, "conversations"), style)

    run.__name__ = f"chat_{style.replace('-', '_')}"
    query(CHAT_SQL[style])(run)


for _style in prompts.CHAT_FORMATS:
    _chat_query(_style)


@query("""SELECT 'e-' || doc_id AS custom_id, 'embedder' AS model, '/v1/embeddings' AS url, coalesce(text, '') AS input FROM documents""")
def batch_embedding_lines(spark, sf_dir):
    get = lambda path: F.try_variant_get(F.parse_json("line"), path, "string")
    lines = batch.embedding_lines(a.table(spark, sf_dir, "documents"), "embedder")
    return lines.select("custom_id", get("$.body.model").alias("model"), get("$.url").alias("url"), get("$.body.input").alias("input"))


@query("""SELECT 's-' || item_id AS custom_id, b.text AS query, '/v1/score' AS url, n, n_chars FROM benchmark b JOIN (SELECT doc_id % (SELECT count(*) FROM benchmark) AS item_id, count(*)::INT AS n, sum(length(coalesce(text, '')))::BIGINT AS n_chars FROM documents GROUP BY 1) USING (item_id)""")
def batch_score_lines(spark, sf_dir):
    items = a.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("query"))
    docs = a.table(spark, sf_dir, "documents").groupBy((F.col("doc_id") % items.count()).alias("item_id")).agg(F.collect_list(F.coalesce("text", F.lit(""))).alias("documents"))
    get = lambda path, kind: F.try_variant_get(F.parse_json("line"), path, kind)
    found = batch.score_lines(items.join(docs, "item_id"), "ranker").withColumn("d", get("$.body.documents", "array<string>"))
    return found.select("custom_id", get("$.body.queries", "string").alias("query"), get("$.url", "string").alias("url"), F.size("d").alias("n"), F.aggregate("d", F.lit(0).cast("bigint"), lambda s, x: s + F.length(x)).alias("n_chars"))


def _rerank_sql(style: str) -> str:
    text = prompts.RERANK_FORMATS[style].replace("'", "''")
    for mark, value in (("query", "b.text"), ("document", "coalesce(d.text, '')"), ("instruction", "'" + prompts.DEFAULT_INSTRUCTION + "'")):
        text = text.replace("{" + mark + "}", f"' || {value} || '")
    return f"SELECT d.doc_id, b.item_id, '{text}' AS prompt FROM documents d JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id"


def _rerank_query(style: str):
    def run(spark, sf_dir):
        items = a.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("query"))
        docs = a.table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("document"), (F.col("doc_id") % items.count()).alias("item_id"))
        return prompts.rerank_prompts(docs.join(items, "item_id"), style).select("doc_id", "item_id", "prompt")

    run.__name__ = "rerank_prompts" if style == "bge-gemma" else f"rerank_prompts_{style}"
    query(_rerank_sql(style))(run)


for _style in prompts.RERANK_FORMATS:
    _rerank_query(_style)


PROPS_SCHEMA = {"type": "object", "additionalProperties": False, "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 0, "maximum": 49}, "tags": {"type": "array", "maxItems": 2, "items": {"type": "string", "enum": ["a", "b"]}}}}


@query("""WITH e AS (SELECT event_id, event_id % 8 AS c, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)
  SELECT event_id, CASE c WHEN 1 THEN '$.k: type' WHEN 2 THEN '$.k: required' WHEN 3 THEN '$.z: additionalProperties' WHEN 4 THEN 'not_json' WHEN 5 THEN '$.tags[]: enum' WHEN 6 THEN '$.tags: maxItems' ELSE CASE WHEN k > 49 THEN '$.k: maximum' END END AS fault FROM e""")
def schema_checks(spark, sf_dir):
    """Outputs against a JSON schema: events' properties, some of them spoilt."""
    c = F.col("event_id") % 8
    text = F.when(c == 1, '{"k": "7"}').when(c == 2, "{}").when(c == 3, '{"k": 1, "z": 2}').when(c == 4, '{"k": 1').when(c == 5, '{"k": 1, "tags": ["a", "c"]}').when(c == 6, '{"k": 1, "tags": ["a", "b", "a"]}').otherwise(F.col("props"))
    return a.table(spark, sf_dir, "events").select("event_id", batch.output_fault(text, PROPS_SCHEMA).alias("fault"))


CHOICES_SCHEMA = {"type": "object", "properties": {"k": {"enum": [True, 1, "2", None, [1, {"a": None}], 12345678901234567890123]}, "n": {"const": 7}, "w": {"type": "integer"}}}
CHOICES = ['{"k": true}', '{"k": "true"}', '{"k": 1.0}', '{"k": "1"}', '{"k": 2}', '{"k": "2"}', '{"k": null}', '{"k": [1, {"a": null}]}', '{"k": [1, {}]}', '{"k": 12345678901234567890123}', '{"w": 12345678901234567890123}', '{"w": 1.5}']


@query("""WITH e AS (SELECT event_id, event_id % 13 AS c, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)
  SELECT event_id, CASE WHEN c IN (1, 3, 4, 8) THEN '$.k: enum' WHEN c = 11 THEN '$.w: type' WHEN c = 12 AND k <> 7 THEN '$.n: const' END AS fault FROM e""")
def typed_choices(spark, sf_dir):
    """Choices and constants of a schema against values of equal text but another type, and events' properties against a constant."""
    c = F.col("event_id") % 13
    text = F.when(c == 12, F.regexp_replace("props", '"k"', '"n"')).otherwise(F.element_at(F.array(*map(F.lit, CHOICES)), F.least(c, F.lit(11)).cast("int") + 1))
    return a.table(spark, sf_dir, "events").select("event_id", batch.output_fault(text, CHOICES_SCHEMA).alias("fault"))


@query("SELECT event_id, event_type IN ('view', 'click') AS chosen, regexp_full_match(props, '\\{\"k\": [0-9]{1,2}\\}') AS matches FROM events")
def output_checks(spark, sf_dir):
    return a.table(spark, sf_dir, "events").select("event_id", batch.output_matches(F.col("event_type"), ["view", "click"]).alias("chosen"), batch.output_matches(F.col("props"), pattern=r'\{"k": [0-9]{1,2}\}').alias("matches"))


@query("""WITH chosen AS (SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations) ORDER BY md5(conv_id || ':5'), conv_id LIMIT 20)
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'human' ELSE 'gpt' END AS role FROM conversations WHERE role <> 'system' AND conv_id IN (SELECT conv_id FROM chosen)""")
def dialogue_sample(spark, sf_dir):
    turns = batch.sampled_conversations(a.table(spark, sf_dir, "conversations"), 20, 5)
    return batch.standard_turns(turns, {"user": "human", "assistant": "gpt"}).select("conv_id", "turn", "role")


# --- I: embeddings and retrieval


@query("""WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM documents), n AS (SELECT *, len(w) AS n FROM t WHERE len(w) BETWEEN 1 AND 3072000)
  SELECT doc_id, i::INT AS chunk, least(128, n - i * 128)::INT AS n_tokens, array_to_string(list_slice(w, i * 128 + 1, i * 128 + 128), ' ') AS chunk_text FROM (SELECT *, unnest(generate_series(0, (n - 1) // 128)) AS i FROM n)""")
def long_text_chunks(spark, sf_dir):
    return retrieval.text_chunks(a.table(spark, sf_dir, "documents"), 128)


@query("""WITH t AS (SELECT doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS n FROM documents)
  SELECT 3072000::BIGINT AS bound, doc_id::VARCHAR AS item_id, n::VARCHAR AS message FROM t WHERE n > 3072000 UNION ALL SELECT 1000, doc_id::VARCHAR, n::VARCHAR FROM t WHERE n > 1000""")
def long_text_rejects(spark, sf_dir):
    """Texts above the bound, and above a lower one that a model may set."""
    d = a.table(spark, sf_dir, "documents")
    found = lambda bound: retrieval.too_long_texts(d, bound).select(F.lit(bound).cast("bigint").alias("bound"), "item_id", "message")
    return found(retrieval.MAX_TEXT_TOKENS).union(found(1000))


@query("""WITH x AS (SELECT vec_id // 4 AS doc_id, 1 + vec_id % 4 AS w, unnest(embedding)::DOUBLE AS v, unnest(generate_series(1, len(embedding))) AS d FROM embeddings),
  m AS (SELECT doc_id, d, sum(w * v) / sum(w) AS v FROM x GROUP BY 1, 2) SELECT doc_id, count(*)::INT AS dims, round(sum(v), 6) AS total, round(sum(v * d), 5) AS moment FROM m GROUP BY 1""")
def combined_embeddings(spark, sf_dir):
    rows = a.table(spark, sf_dir, "embeddings").selectExpr("vec_id div 4 AS doc_id", "1 + vec_id % 4 AS w", "embedding")
    found = retrieval.combined_embeddings(rows, "doc_id", "w", "embedding")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)
    moment = F.aggregate(F.zip_with("embedding", F.sequence(F.lit(1), F.size("embedding")), lambda x, i: x * i), F.lit(0.0), lambda s, x: s + x)
    return found.select("doc_id", F.size("embedding").alias("dims"), F.round(total, 6).alias("total"), F.round(moment, 5).alias("moment"))


@query("""SELECT x.vec_id, round(list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 6) AS score FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1""")
def pair_scores(spark, sf_dir):
    e = a.table(spark, sf_dir, "embeddings")
    pairs = e.select("vec_id", "embedding").join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")
    return pairs.select("vec_id", F.round(retrieval.cosine(F.col("embedding"), F.col("other")), 6).alias("score"))


@query("""SELECT query_id, doc_id, round(score, 6) AS score, rank::INT AS rank FROM (SELECT q.vec_id AS query_id, d.vec_id AS doc_id, list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS score,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) DESC, d.vec_id) AS rank FROM embeddings q JOIN embeddings d ON q.vec_id % 20 = 0) WHERE rank <= 5""")
def rerank_top(spark, sf_dir):
    e = a.table(spark, sf_dir, "embeddings")
    found = retrieval.rerank(e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), e.select(F.col("vec_id").alias("doc_id"), "embedding"), 5)
    return found.withColumn("score", F.round("score", 6))


@query("""WITH q AS (SELECT vec_id // 4 AS query_id, vec_id % 4 AS token, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 8 < 4), d AS (SELECT vec_id // 4 AS doc_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 8 >= 4)
  SELECT query_id, doc_id, round(sum(best), 5) AS score FROM (SELECT query_id, doc_id, token, max(list_dot_product(q.e, d.e)) AS best FROM q JOIN d ON d.doc_id = q.query_id + 1 GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def late_interaction(spark, sf_dir):
    e = a.table(spark, sf_dir, "embeddings").selectExpr("vec_id div 4 AS text_id", "vec_id % 4 AS token", "embedding", "vec_id % 8 AS side")
    q, d = e.where("side < 4").withColumnRenamed("text_id", "query_id"), e.where("side >= 4").withColumnRenamed("text_id", "doc_id")
    pairs = q.select("query_id").distinct().withColumn("doc_id", F.col("query_id") + 1)
    return retrieval.max_similarity(q, d, pairs).withColumn("score", F.round("score", 5))


@query("""WITH t AS (SELECT item_id, unnest(string_split(text, ' ')) AS token FROM benchmark), w AS (SELECT item_id, token, count(*) AS n FROM t WHERE token <> '' GROUP BY 1, 2)
  SELECT x.item_id AS query_id, y.item_id AS doc_id, sum(x.n * y.n)::BIGINT AS score FROM w x JOIN w y USING (token) WHERE x.item_id % 20 = 0 GROUP BY 1, 2""")
def lexical_scores(spark, sf_dir):
    t = a.table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.split("text", " ")).alias("token")).where("token <> ''").groupBy("item_id", "token").agg(F.count("*").alias("weight"))
    return retrieval.lexical_scores(t.where("item_id % 20 = 0").withColumnRenamed("item_id", "query_id"), t.withColumnRenamed("item_id", "doc_id"), hot_salt=4)


def _word_counts(texts, key, asked=None):
    """How often a text has each word; with ``asked``, only of its ``token``, before any are counted."""
    words = texts.select(key, F.explode(F.split("text", " ")).alias("token")).where("token <> ''")
    if asked is not None:
        words = words.join(asked.select("token").distinct(), "token", "left_semi")
    return words.groupBy(key, "token").agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT doc_id, token, count(*) / (count(*) + 1.0::DOUBLE) AS wd FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents) WHERE token <> '' GROUP BY 1, 2),
  f AS (SELECT token, ln(1 + (SELECT count(*) FROM documents) / count(*)::DOUBLE) AS idf FROM d GROUP BY 1),
  q AS (SELECT item_id, token, count(*) * any_value(idf) AS wq FROM (SELECT item_id, unnest(string_split(text, ' ')) AS token FROM benchmark) JOIN f USING (token) GROUP BY 1, 2),
  s AS (SELECT item_id AS query_id, doc_id, round(sum(wq * wd), 6) AS score FROM q JOIN d USING (token) GROUP BY 1, 2)
  SELECT query_id, doc_id, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 10""")
def lexical_search(spark, sf_dir):
    """The ten best documents for each benchmark item, rare words first. Words that no item has add to no score and are not counted."""
    documents = a.table(spark, sf_dir, "documents")
    asked = kept(_word_counts(a.table(spark, sf_dir, "benchmark"), "item_id"), "asked")
    docs = kept(_word_counts(documents, "doc_id", asked), "words")
    idf = docs.groupBy("token").agg(F.count("*").alias("df")).crossJoin(F.broadcast(documents.agg(F.count("*").alias("all"))))  # one row
    idf = idf.select("token", F.log(1 + F.col("all") / F.col("df")).alias("idf"))
    weighed = asked.join(idf, "token").select(F.col("item_id").alias("query_id"), "token", (F.col("n") * F.col("idf")).alias("weight"))
    return retrieval.lexical_top(weighed, docs.select("doc_id", "token", (F.col("n") / (F.col("n") + 1)).alias("weight")), 10, stored=True)


@query("""SELECT request_id, i::INT AS index, 'l' || (list_position(p, list_max(p)) - 1) AS label, round(list_max(p), 6) AS prob, 4 AS num_classes FROM (SELECT vec_id AS request_id, unnest([0, 1]) AS i, unnest([embedding[1:4]::DOUBLE[], embedding[5:8]::DOUBLE[]]) AS p FROM embeddings)""")
def classification_rows(spark, sf_dir):
    part = lambda i: F.struct(F.lit(i).alias("index"), F.slice("embedding", i * 4 + 1, 4).cast("array<double>").alias("probs"))
    rows = a.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("request_id"), F.array(part(0), part(1)).alias("data"))
    return retrieval.classifications(rows, ["l0", "l1", "l2", "l3"]).withColumn("prob", F.round("prob", 6))


@query("""SELECT vec_id, round(1 / (1 + exp(-(embedding[1]::DOUBLE - 0.1) / 0.5)), 6) AS calibrated, round(exp(embedding[1]::DOUBLE) / (exp(embedding[1]::DOUBLE) + exp(embedding[2]::DOUBLE)), 6) AS share FROM embeddings""")
def calibrated_scores(spark, sf_dir):
    e = F.col("embedding")
    return a.table(spark, sf_dir, "embeddings").select("vec_id", F.round(retrieval.calibrated(e[0].cast("double"), 0.1, 0.5), 6).alias("calibrated"), F.round(retrieval.label_score(F.slice(e, 1, 2).cast("array<double>")), 6).alias("share"))


@query("""WITH t AS (SELECT conv_id, turn AS pos, CASE WHEN length(text) % 3 = 0 THEN 'O' ELSE role END AS label FROM conversations),
  g AS (SELECT *, pos - row_number() OVER (PARTITION BY conv_id, label ORDER BY pos) AS g FROM t) SELECT conv_id, min(pos) AS first, max(pos) AS last, label, string_agg('t' || pos, ' ' ORDER BY pos) AS text FROM g WHERE label <> 'O' GROUP BY conv_id, label, g""")
def entity_spans(spark, sf_dir):
    t = a.table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("pos"), F.when(F.length("text") % 3 == 0, "O").otherwise(F.col("role")).alias("label"), F.concat(F.lit("t"), F.col("turn").cast("string")).alias("token"))
    return retrieval.entity_spans(t, "conv_id")


@query("""WITH RECURSIVE t AS (SELECT item_id, string_split(text, ' ') AS w FROM (SELECT item_id, text FROM benchmark UNION ALL SELECT item_id + 1000, text FROM benchmark WHERE item_id % 2 = 0)),
  b AS (SELECT item_id, w, 0 AS pos, sha256('|' || array_to_string(w[1:8], ' ') || '|') AS k FROM t WHERE len(w) >= 8 UNION ALL SELECT item_id, w, pos + 1, sha256(k || '|' || array_to_string(w[(pos + 1) * 8 + 1:(pos + 2) * 8], ' ') || '|') FROM b WHERE len(w) >= (pos + 2) * 8)
  SELECT k AS block_key, pos::INT AS pos, count(*) AS requests, (count(*) - 1) * 8 AS reusable_tokens FROM b GROUP BY 1, 2""")
def shared_prefixes(spark, sf_dir):
    t = a.table(spark, sf_dir, "benchmark")
    both = t.select("item_id", "text").union(t.where("item_id % 2 = 0").select(F.col("item_id") + 1000, "text"))
    rows = both.select(F.col("item_id").alias("request_id"), F.split("text", " ").alias("tokens"))
    return retrieval.shared_blocks(retrieval.prefix_blocks(rows, 8), 8)


# --- J: evaluation


@query("""SELECT lang, count(*) AS n, round(avg((CASE WHEN n_chars > 500 THEN 1 ELSE 0 END = quality)::INT), 6) AS accuracy, 0.5::DOUBLE AS threshold, avg((CASE WHEN n_chars > 500 THEN 1 ELSE 0 END = quality)::INT) >= 0.5 AS passed FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def eval_accuracy(spark, sf_dir):
    d = a.table(spark, sf_dir, "documents").join(a.table(spark, sf_dir, "labels"), "doc_id")
    answers = d.select(F.col("doc_id").alias("item_id"), "lang", F.col("quality").alias("answer"))
    guesses = d.select(F.col("doc_id").alias("item_id"), (F.col("n_chars") > 500).cast("int").alias("prediction"))
    floors = d.select("lang").distinct().withColumn("threshold", F.lit(0.5))
    return evals.accuracy(guesses, answers, floors, "lang").withColumn("accuracy", F.round("accuracy", 6))


@query()
def eval_prefixed_match(spark, sf_dir):
    """Sequence-matcher ratios have no SQL form; tests compare them with difflib."""
    t = a.table(spark, sf_dir, "conversations")
    rows = t.select("role", F.substring("text", 1, 3).alias("prefix"), F.when(F.col("conv_id") % 5 == 0, "no").otherwise(F.col("text")).alias("response"), F.expr("substring(text, 6)").alias("answer"))
    floors = t.select("role").distinct().withColumn("threshold", F.lit(0.5))
    return evals.prefixed_match(rows, floors, "role").withColumn("match_ratio", F.round("match_ratio", 9))


@query("SELECT doc_id FROM documents WHERE n_chars * 4 <= 4000")
def eval_length_filter(spark, sf_dir):
    return a.table(spark, sf_dir, "documents").where(evals.fits_prompt(F.col("n_chars"), 4000)).select("doc_id")


# --- K: serving


def _request_log(spark, sf_dir):
    e, k = a.table(spark, sf_dir, "events"), F.col("event_id")
    return e.select("event_id", "event_type", (k * 0.5).alias("arrival_ts"), (k * 0.5 + 0.25).alias("scheduled_ts"), (k * 0.5 + 0.75).alias("first_token_ts"), (k * 0.5 + 0.75 + F.col("value")).alias("last_token_ts"), (k % 8 + 1).alias("n_tokens"), F.when(k % 9 == 0, 2).otherwise(1).alias("n_sequences"))


LOG = "log AS (SELECT event_id, event_type, value, event_id % 8 + 1 AS n, event_id % 9 <> 0 AS one, 0.5 * event_id AS t FROM events)"


@query(f"""WITH {LOG} SELECT event_id, CASE WHEN one THEN 500.0 END::DOUBLE AS ttft, CASE WHEN one THEN round(((t + 0.75 + value) - (t + 0.75)) * 1000, 3) END AS generation, CASE WHEN one THEN 250.0 END::DOUBLE AS queued,
  CASE WHEN one AND n > 1 THEN round(((t + 0.75 + value) - (t + 0.75)) / (n - 1) * 1000, 3) END AS itl, CASE WHEN one THEN round(n / ((t + 0.75 + value) - (t + 0.25)), 6) END AS tps FROM log""")
def request_metrics(spark, sf_dir):
    m = serving.request_metrics(_request_log(spark, sf_dir))
    return m.select("event_id", F.col("time_to_first_token_ms").alias("ttft"), F.round("generation_time_ms", 3).alias("generation"), F.col("queue_time_ms").alias("queued"), F.round("mean_itl_ms", 3).alias("itl"), F.round("tokens_per_second", 6).alias("tps"))


_STATS = "count({0}) AS count, round(avg({0}), 5) AS mean, round(stddev_samp({0}), 5) AS std, min({0})::DOUBLE AS min, round(quantile_cont({0}, 0.25), 5) AS p25, round(quantile_cont({0}, 0.5), 5) AS p50, round(quantile_cont({0}, 0.75), 5) AS p75, round(quantile_cont({0}, 0.9), 5) AS p90, round(quantile_cont({0}, 0.99), 5) AS p99, max({0})::DOUBLE AS max"


@query(f"SELECT 'value' AS metric, {_STATS.format('value')} FROM events UNION ALL SELECT 'n_tokens', {_STATS.format('(event_id % 8 + 1)::DOUBLE')} FROM events")
def metric_summary(spark, sf_dir):
    rows = a.table(spark, sf_dir, "events").withColumn("n_tokens", F.col("event_id") % 8 + 1)
    s = serving.summary(rows, ["value", "n_tokens"])
    return s.select("metric", "count", *(F.round(c, 5).alias(c) if c not in ("min", "max") else F.col(c) for c in s.columns[2:]))


_WIDTH = (1 + 0.01) / (1 - 0.01)


@query(f"""WITH s AS (SELECT event_type, sign(value)::INT AS sign, CASE WHEN value = 0 THEN 0 ELSE sign(value)::INT * ceil(ln(abs(value)) / ln({_WIDTH!r}))::INT END AS power FROM events WHERE value IS NOT NULL),
  g AS (SELECT * FROM s UNION ALL SELECT 'all', sign, power FROM s), c AS (SELECT event_type, sign, power, count(*) AS n FROM g GROUP BY 1, 2, 3),
  u AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY sign, power) AS upto, sum(n) OVER (PARTITION BY event_type) AS total, CASE WHEN sign = 0 THEN 0 ELSE sign * 2 * pow({_WIDTH!r}::DOUBLE, sign * power) / (1 + {_WIDTH!r}::DOUBLE) END AS v FROM c)
  SELECT event_type, any_value(total)::BIGINT AS count, round(arg_min(v, upto) FILTER (upto > floor(0.5 * (total - 1))), 6) AS p50, round(arg_min(v, upto) FILTER (upto > floor(0.99 * (total - 1))), 6) AS p99 FROM u GROUP BY 1""")
def metric_sketches(spark, sf_dir):
    """Sketches by event type and day, merged by event type and over all."""
    daily = serving.sketches(a.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), ["event_type", "day"], "value")
    by_type = serving.merged_sketches(daily, ["event_type"])
    every = serving.merged_sketches(by_type.withColumn("event_type", F.lit("all")), ["event_type"])
    found = serving.sketched_quantiles(by_type.unionByName(every), ["event_type"], {"p50": 0.5, "p99": 0.99})
    return found.select("event_type", "count", F.round("p50", 6).alias("p50"), F.round("p99", 6).alias("p99"))


@query("SELECT r_regionkey AS server, n_nationkey AS bench, run::INT AS run FROM region CROSS JOIN nation CROSS JOIN generate_series(0, 2) g(run)")
def sweep_grid(spark, sf_dir):
    return serving.sweep_grid(a.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("server")), a.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("bench")))


@query("SELECT l_returnflag, l_linestatus, floor(l_quantity / 10) * 10 AS x, round(avg(l_extendedprice), 4) AS y, count(*) AS n FROM lineitem WHERE l_discount > 0.02 GROUP BY 1, 2, 3")
def sweep_curves(spark, sf_dir):
    found = serving.sweep_curves(a.table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag", "l_linestatus"], 10.0, F.col("l_discount") > 0.02)
    return found.withColumn("y", F.round("y", 4))


RUNS = "runs AS (SELECT l_returnflag || l_linestatus || l_linenumber AS run, sum(l_quantity) AS throughput, quantile_cont(l_extendedprice, 0.99) AS p99_ms, count(*) AS n FROM lineitem GROUP BY 1)"


def _runs(spark, sf_dir):
    rows = a.table(spark, sf_dir, "lineitem").withColumn("run", F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")))
    tail = quantiles(rows, ["run"], "l_extendedprice", {"p99_ms": 0.99})
    return rows.groupBy("run").agg(F.sum("l_quantity").alias("throughput"), F.count("*").alias("n")).join(tail, "run")


@query(f"WITH {RUNS}, cut AS (SELECT quantile_cont(p99_ms, 0.5) AS c FROM runs) SELECT run, throughput, round(p99_ms, 4) AS p99_ms FROM runs, cut WHERE p99_ms <= c ORDER BY throughput DESC, p99_ms LIMIT 1")
def best_under_limit(spark, sf_dir):
    runs = kept(_runs(spark, sf_dir), "runs")
    limit = quantiles(runs, [], "p99_ms", {"limit": 0.5}).first()[0]
    return serving.best_under_limit(runs, limit if limit is not None else 0.0).withColumn("p99_ms", F.round("p99_ms", 4))


@query(f"WITH {RUNS}, p AS (SELECT run, throughput / n AS x, throughput / (1 + p99_ms) AS y FROM runs) SELECT run, round(x, 6) AS x, round(y, 6) AS y FROM p WHERE NOT EXISTS (SELECT 1 FROM p o WHERE o.x >= p.x AND o.y >= p.y AND (o.x > p.x OR o.y > p.y))")
def pareto_frontier(spark, sf_dir):
    points = _runs(spark, sf_dir).select("run", (F.col("throughput") / F.col("n")).alias("x"), (F.col("throughput") / (1 + F.col("p99_ms"))).alias("y"))
    return serving.pareto_frontier(points).select("run", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


KERNEL_RULES = [("ECON|PROMO", "gemm"), ("^S", "attention"), ("A", "norm")]


@query("""WITH k AS (SELECT l_returnflag, CASE WHEN regexp_matches(p_type, 'ECON|PROMO') THEN 'gemm' WHEN regexp_matches(p_type, '^S') THEN 'attention' WHEN regexp_matches(p_type, 'A') THEN 'norm' ELSE 'misc' END AS category, l_quantity AS s FROM lineitem JOIN part ON p_partkey = l_partkey)
  SELECT l_returnflag, category, sum(s) AS seconds FROM k GROUP BY 1, 2 UNION ALL SELECT l_returnflag, 'non-gpu', 2000000.0 - sum(s) FROM k GROUP BY 1""")
def kernel_seconds(spark, sf_dir):
    t = a.table(spark, sf_dir, "lineitem").join(a.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("kernel")), "l_partkey").select("l_returnflag", "kernel", F.col("l_quantity").alias("seconds"))
    return serving.kernel_seconds(t, KERNEL_RULES, t.select("l_returnflag").distinct().withColumn("elapsed", F.lit(2_000_000.0)), "l_returnflag")


@query("""WITH c AS (SELECT user_id, event_type, ts, floor(value) AS v, lag(floor(value)) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS p FROM events)
  SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS bucket, round(sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) / 86400.0, 9) AS rate FROM c GROUP BY 1, 2""")
def counter_rates(spark, sf_dir):
    e = a.table(spark, sf_dir, "events").select("user_id", "event_type", "ts", F.floor("value").cast("double").alias("value"))
    found = serving.counter_rates(e, ["user_id", "event_type"], ["event_type"], "1 day", 86400.0)
    return found.select("event_type", F.col("bucket").cast("timestamp_ntz").alias("bucket"), F.round("rate", 9).alias("rate"))


@query("""WITH b AS (SELECT event_type, le, count(*) FILTER (value <= le) AS c, count(*) AS total FROM events, (VALUES (1.0::DOUBLE), (5.0), (20.0), (50.0), ('inf'::DOUBLE)) t(le) GROUP BY 1, 2),
  r AS (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(c) OVER w, 0) AS under FROM b WINDOW w AS (PARTITION BY event_type ORDER BY le)),
  h AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY le) AS nth FROM r WHERE c >= 0.9 * total)
  SELECT event_type, round(CASE WHEN le = 'inf'::DOUBLE THEN low ELSE low + (le - low) * (0.9 * total - under) / (c - under) END, 6) AS value FROM h WHERE nth = 1""")
def histogram_quantile(spark, sf_dir):
    e = a.table(spark, sf_dir, "events")
    bounds = F.explode(F.array(*(F.lit(float(x)) for x in (1, 5, 20, 50, "inf")))).alias("le")
    buckets = e.select("event_type", "value", bounds).groupBy("event_type", "le").agg(F.count_if(F.col("value") <= F.col("le")).alias("count"))
    return serving.histogram_quantile(buckets, 0.9, ["event_type"]).withColumn("value", F.round("value", 6))


@query("""SELECT event_type, round(sum(v), 6) AS total, round(avg(v), 6) AS mean FROM (SELECT user_id, event_type, arg_max(value, ts) AS v FROM events GROUP BY 1, 2) GROUP BY 1""")
def latest_gauges(spark, sf_dir):
    found = serving.latest_gauges(a.table(spark, sf_dir, "events"), ["user_id"], ["event_type"])
    return found.select("event_type", F.round("total", 6).alias("total"), F.round("mean", 6).alias("mean"))


@query("SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS bucket, count(*) AS n, round(count(*) / 86400.0, 9) AS rate FROM events GROUP BY 1, 2")
def event_rates(spark, sf_dir):
    """The streaming operator over the table as a batch: the same plan, all intervals final."""
    e = a.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    found = rates.event_rates(e, ["event_type"], "1 day", 86400.0)
    return found.select("event_type", F.col("bucket").cast("timestamp_ntz").alias("bucket"), "n", F.round("rate", 9).alias("rate"))
