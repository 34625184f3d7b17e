"""Embeddings, scores and retrieval over batches of model outputs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import islands
from ..functions.ordered import kept
from ..sources.manifest import reject


#: Fixed value: the most tokens that a text may have.
MAX_TEXT_TOKENS = 3_072_000


def _tokens(text: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda t: t != "")


def too_long_texts(docs: DataFrame, limit: int = MAX_TEXT_TOKENS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rejects for texts of more than ``limit`` tokens."""
    n = docs.select(F.col(key).alias("key"), F.size(_tokens(text)).alias("n")).where(F.col("n") > limit)
    return reject(n, "embedding", "text_too_long", F.col("n").cast("string"), video=F.lit(None), item=F.col("key"))


def text_chunks(docs: DataFrame, max_tokens: int, limit: int = MAX_TEXT_TOKENS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, chunk, n_tokens, chunk_text``: white-space tokens in chunks of ``max_tokens``; texts of more than ``limit`` tokens are in :func:`too_long_texts`."""
    rows = docs.select(key, _tokens(text).alias("tokens")).where(F.size("tokens").between(1, limit))
    each = rows.select(key, "tokens", F.explode(F.sequence(F.lit(0), F.ceil(F.size("tokens") / max_tokens).cast("int") - 1)).alias("chunk"))
    part = F.slice("tokens", F.col("chunk") * max_tokens + 1, F.lit(max_tokens))
    return each.select(key, "chunk", F.size(part).alias("n_tokens"), F.array_join(part, " ").alias("chunk_text"))


def combined_embeddings(chunks: DataFrame, by: str, weight: str, vector: str) -> DataFrame:
    """``by, embedding``: the mean of a document's chunk vectors by weight. Vectors are added up whole, never exploded by dimension."""
    kept = chunks.select(by, F.col(weight).cast("double").alias("w"), F.col(vector).cast("array<double>").alias("v"))
    schema = kept.limit(0).selectExpr(by, "w", "v").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sums per key within the batch, so that hot documents are combined before the shuffle
        for batch in batches:
            sums: dict = {}
            for k, w, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if v.is_valid and w is not None:
                    total, x = sums.get(k, (0.0, 0.0))
                    sums[k] = (total + w, x + w * np.asarray(v.values))
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), batch.schema.field(0).type), pa.array([w for w, _ in sums.values()], pa.float64()), pa.array([x for _, x in sums.values()], pa.list_(pa.float64()))], names=[by, "w", "v"])

    parts = kept.mapInArrow(run, schema).groupBy(by).agg(F.collect_list(F.struct("w", "v")).alias("parts"))
    total = F.aggregate("parts", F.lit(0.0), lambda a, p: a + p["w"])
    summed = F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), F.element_at("parts", 1)["v"], lambda a, p: F.zip_with(a, p["v"], lambda x, y: x + y))
    return parts.where(total > 0).select(by, F.transform(summed, lambda x: x / total).alias("embedding"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x.cast("array<double>"), y.cast("array<double>"), lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def score_block(queries: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Cosine of every query with every document."""
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    return unit(queries) @ unit(documents).T


#: Most bytes of query vectors that are broadcast, bytes of vectors in a block, and scores that are held at once.
BROADCAST_BYTES, BLOCK_BYTES, SCORES = 64 << 20, 32 << 20, 4 << 20


def _vectors(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _best_of_block(query_ids: pa.Array, queries: np.ndarray, doc_ids: pa.Array, docs: np.ndarray, top_n: int) -> Iterator[pa.RecordBatch]:
    """``query_id, doc_id, score``: the best ``top_n`` of a block of documents for each query, ties by id."""
    order = pc.sort_indices(doc_ids)
    doc_ids, docs = doc_ids.take(order), docs[order.to_numpy()]
    part = max(1, SCORES // max(1, len(docs)))
    for a in range(0, len(queries) if len(docs) else 0, part):
        scores = score_block(queries[a : a + part], docs)
        top = np.argsort(-scores, axis=1, kind="stable")[:, :top_n]
        yield pa.RecordBatch.from_arrays([query_ids.slice(a, part).take(pa.array(np.repeat(np.arange(len(top)), top.shape[1]))), doc_ids.take(pa.array(top.ravel())), pa.array(np.take_along_axis(scores, top, axis=1).ravel())], names=["query_id", "doc_id", "score"])


def rerank(queries: DataFrame, documents: DataFrame, top_n: int, broadcast_bytes: int = BROADCAST_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``query_id, doc_id, score, rank``: the ``top_n`` documents of each query by cosine, ties by id.

    A stated set of queries (``query_id, embedding``) against all documents. Queries that were measured to be small are broadcast,
    and documents are scored where they are read. Any more are dealt in blocks, as the documents are: each block of queries meets each
    block of documents in a task of its own, which gives the best ``top_n`` alone. Equal rows of documents don't swell a
    block: no more than ``top_n`` of them can be in a result. Rows without a vector take no part.
    """
    queries = queries.select("query_id", "embedding").where(F.col("embedding").isNotNull())
    documents = documents.select("doc_id", "embedding").where(F.col("embedding").isNotNull())
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, doc_id {documents.schema['doc_id'].dataType.simpleString()}, score double"
    measured = lambda rows: rows.agg(F.count("*"), F.coalesce(F.sum(8 * F.size("embedding")), F.lit(0))).first()
    n, size = measured(queries)
    if size + 64 * n <= broadcast_bytes:
        table = queries.toArrow()  # measured
        ids = table["query_id"].combine_chunks()
        held = documents.sparkSession.sparkContext.broadcast((ids, _vectors(table["embedding"].combine_chunks())))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield from _best_of_block(*held.value, batch.column(0), _vectors(batch.column(1)), top_n)

        return top_by_score(documents.mapInArrow(run, schema), "query_id", top_n)
    columns, rows = -(-size // block_bytes), max(1, -(-measured(documents)[1] // block_bytes))

    def dealt(table: DataFrame, own: str, blocks: int, other: str, copies: int) -> DataFrame:
        # by content, so that a task that runs again deals alike
        placed = table.withColumn(own, F.pmod(F.xxhash64(*table.columns), F.lit(blocks)))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))))

    def meet(docs: pa.Table, asked: pa.Table) -> pa.Table:
        flat = lambda t, c: t[c].combine_chunks()
        out = list(_best_of_block(flat(asked, "query_id"), _vectors(flat(asked, "embedding")), flat(docs, "doc_id"), _vectors(flat(docs, "embedding")), top_n)) if docs.num_rows and asked.num_rows else []
        kinds = [asked.schema.field("query_id").type, docs.schema.field("doc_id").type, pa.float64()]
        return pa.Table.from_batches(out, pa.schema(list(zip(("query_id", "doc_id", "score"), kinds))))

    # of equal rows no more than a query's whole result can be wanted
    copies = documents.groupBy("doc_id", "embedding").agg(F.count("*").alias("n"))
    documents = copies.withColumn("n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("n", F.lit(top_n).cast("bigint"))))).select("doc_id", "embedding")
    left = dealt(documents, "r", rows, "c", columns).groupBy("r", "c")
    right = dealt(queries, "c", columns, "r", rows).groupBy("r", "c")
    return top_by_score(left.cogroup(right).applyInArrow(meet, schema), "query_id", top_n)


def top_by_score(scored: DataFrame, by: str, top_n: int, item: str = "doc_id") -> DataFrame:
    """The ``top_n`` rows of each group by score, ties by ``item``, with ``rank``."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), item))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top_n)


def max_similarity(query_tokens: DataFrame, doc_tokens: DataFrame, pairs: DataFrame) -> DataFrame:
    """``query_id, doc_id, score``: per query token the best dot product over the document's tokens, summed (late interaction).

    Tables have ``query_id`` or ``doc_id``, a token's number and its ``embedding``. Token matrices travel one row a text
    and a pair is one product of blocks.
    """
    rows = lambda t, k: t.groupBy(k).agg(F.transform(F.array_sort(F.collect_list(F.struct("token", F.col("embedding").cast("array<double>").alias("e")))), lambda x: x["e"]).alias(f"{k}_m"))
    joined = pairs.join(rows(query_tokens, "query_id"), "query_id").join(rows(doc_tokens, "doc_id"), "doc_id").select("query_id", "doc_id", "query_id_m", "doc_id_m")
    schema = joined.limit(0).selectExpr("query_id", "doc_id", "0D score").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [float((np.array(q) @ np.array(d).T).max(axis=1).sum()) for q, d in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], names=["query_id", "doc_id", "score"])

    return joined.mapInArrow(run, schema)


def lexical_scores(query_weights: DataFrame, doc_weights: DataFrame, hot_salt: int = 1) -> DataFrame:
    """``query_id, doc_id, score``: sum over equal tokens of the product of weights.

    ``hot_salt`` above 1 spreads each token over so many parts, with the query side repeated: for stop words.
    """
    docs = doc_weights.select("doc_id", "token", F.col("weight").alias("wd")).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(hot_salt)))
    queries = query_weights.select("query_id", "token", F.col("weight").alias("wq")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(hot_salt - 1).cast("bigint"))))
    return docs.join(queries, ["token", "salt"]).groupBy("query_id", "doc_id").agg(F.sum(F.col("wq") * F.col("wd")).alias("score"))


def _dot() -> Column:
    return F.sum(F.col("wq") * F.col("wd")).alias("score")


def _floors(scored: DataFrame, plan: DataFrame, docs: DataFrame, top_n: int, many: int) -> DataFrame:
    """``query_id, floor``: the whole score of the ``top_n``-th best of each query's ``many`` best by ``scored``. Queries with fewer have none."""
    first = kept(top_by_score(scored, "query_id", many).select("query_id", "doc_id"), "first")
    whole = top_by_score(_whole_scores(first, plan, docs), "query_id", top_n)
    return kept(whole.where(F.col("rank") == top_n).select("query_id", F.col("score").alias("floor")), "floors")


def _below(most: Column) -> Column:
    """Whether a score of at most ``most`` can't reach the floor; the margin covers rounding. Without a floor all can."""
    return F.coalesce(most * (1 + 1e-9) + 2e-6 < F.col("floor"), F.lit(False))


def _lexical_candidates(docs: DataFrame, plan: DataFrame, top_n: int, start: int) -> tuple[DataFrame, DataFrame]:
    """``query_id, doc_id, score, rest`` of all documents that can be in a query's top, and the query tokens that their scores lack: see :func:`lexical_top`."""
    begun = plan.where(F.col("before") < start * top_n).join(docs, "token").groupBy("query_id", "doc_id").agg(_dot())
    planned = plan.join(_floors(begun, plan, docs, top_n, start * top_n), "query_id", "left").withColumn("short", _below(F.col("reach")))
    # kept, so that its size is known and the postings need not be dealt by token
    planned = kept(planned.withColumn("rest", F.coalesce(F.max(F.when(F.col("short"), F.col("reach"))).over(Window.partitionBy("query_id")), F.lit(0.0))), "planned")
    met = planned.where("not short").join(docs, "token").groupBy("query_id", "doc_id").agg(_dot(), F.first("floor").alias("floor"), F.first("rest").alias("rest"))
    return met.where(~_below(F.col("score") + F.col("rest"))).select("query_id", "doc_id", "score", "rest"), planned.where("short").select("query_id", "token", "wq")


def _of_documents(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The postings of the documents of ``pairs``, so that no others are moved to them."""
    return docs.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")


def _whole_scores(pairs: DataFrame, plan: DataFrame, docs: DataFrame) -> DataFrame:
    weights = pairs.select("query_id", "doc_id").join(plan.select("query_id", "token", "wq"), "query_id").join(_of_documents(docs, pairs), ["doc_id", "token"])
    return weights.groupBy("query_id", "doc_id").agg(_dot()).withColumn("score", F.round("score", 6))


def lexical_top(query_weights: DataFrame, doc_weights: DataFrame, top_n: int, start: int = 4, stored: bool = False) -> DataFrame:
    """``query_id, doc_id, score, rank``: each query's ``top_n`` documents by ``lexical_scores``, exactly, without scoring all pairs.

    Weights are above 0, one row for each text and token; rows with a null or another weight are left out. A token can add at most
    its own weight times its largest one in any document. Documents that hold a query's rarest tokens (until those have ``start``
    times ``top_n`` postings; any number gives the same result) are scored first, which gives a floor that the last of the top
    must reach. Tokens whose bounds, added up from the most frequent one, stay below the floor can't lift a document into
    the top by themselves: only documents with another token of the query are met, and only those whose score so far can still
    reach the floor with the bounds of what was left out are kept. The best of these by their score so far are scored whole, which
    gives a higher floor, and what can reach that is joined to the rest of its tokens. Ties go to the smaller ``doc_id``; scores are compared as
    rounded to six digits, since sums depend on their order. A query that shares no token with any document has no rows.
    Intermediate tables are written once below ``spark.checkpoint.dir``; ``stored`` postings (of the queries' tokens, read from storage) are not written again.
    """
    docs, plan = _lexical_plan(query_weights, doc_weights, stored)
    met, short = _lexical_candidates(docs, plan, top_n, start)
    met = kept(met, "candidates")
    likely = met.join(_floors(met, plan, docs, top_n, start * top_n), "query_id", "left").where(~_below(F.col("score") + F.col("rest")))
    likely = kept(likely.select("query_id", "doc_id", "score"), "likely")
    more = likely.select("query_id", "doc_id").join(short, "query_id").join(_of_documents(docs, likely), ["doc_id", "token"]).select("query_id", "doc_id", (F.col("wq") * F.col("wd")).alias("score"))
    whole = likely.union(more).groupBy("query_id", "doc_id").agg(F.round(F.sum("score"), 6).alias("score"))
    return top_by_score(whole, "query_id", top_n)


def _lexical_plan(query_weights: DataFrame, doc_weights: DataFrame, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Postings of the queries' tokens, and these with their postings so far from the rarest one and bounds so far from the most frequent one."""
    asked = query_weights.where("weight > 0").select("query_id", "token", F.col("weight").cast("double").alias("wq"))
    docs = doc_weights.where("weight > 0").select("doc_id", "token", F.col("weight").cast("double").alias("wd"))
    if not stored:
        docs = kept(docs.join(asked.select("token").distinct(), "token", "left_semi").select("doc_id", "token", "wd"), "postings")
    lists = docs.groupBy("token").agg(F.count("*").alias("df"), F.max("wd").alias("most"))
    rare_first = Window.partitionBy("query_id").orderBy("df", "token").rowsBetween(Window.unboundedPreceding, -1)
    frequent_first = Window.partitionBy("query_id").orderBy(F.desc("df"), F.desc("token")).rowsBetween(Window.unboundedPreceding, 0)
    plan = asked.join(lists, "token").withColumn("before", F.coalesce(F.sum("df").over(rare_first), F.lit(0)))
    return docs, kept(plan.withColumn("reach", F.sum(F.col("wq") * F.col("most")).over(frequent_first)), "plan")


def classifications(results: DataFrame, labels: list[str], key: str = "request_id", data: str = "data") -> DataFrame:
    """``key, index, label, prob, num_classes`` from an array of ``index, probs``; the label of the first highest one."""
    each = results.select(key, F.inline(data))
    names = F.array(*map(F.lit, labels))
    return each.select(key, "index", F.element_at(names, F.array_position("probs", F.array_max("probs")).cast("int")).alias("label"), F.array_max("probs").alias("prob"), F.size("probs").alias("num_classes"))


def calibrated(logit: Column, mean: float, sigma: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(logit - mean) / sigma))


def label_score(logits: Column) -> Column:
    """The first label's share of the softmax over the label tokens' logits."""
    top = F.array_max(logits)
    return F.exp(F.element_at(logits, 1) - top) / F.aggregate(logits, F.lit(0.0), lambda s, x: s + F.exp(x - top))


def entity_spans(tokens: DataFrame, by: str, outside: str = "O") -> DataFrame:
    """``by, first, last, label, text``: runs of tokens (``pos, label, token``) with the same label, those outside left out."""
    placed = tokens.withColumn("after", F.col("pos") + 1)
    runs = islands(placed, [by], ["pos"], "pos", "after", F.col("label"), 0)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda t: t["token"]), " ")
    return runs.where(F.col("label") != outside).groupBy(by, "island").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.min("label").alias("label"), joined.alias("text")).drop("island")


def prefix_blocks(prompts: DataFrame, block: int, key: str = "request_id", tokens: str = "tokens", salt: Column | None = None, extra: Column | None = None) -> DataFrame:
    """``key, pos, block_key`` of a prompt's full blocks of tokens: each key is a digest of the one before, the tokens and ``extra``; the salt is in the first."""
    none = F.lit(None).cast("string")
    rows = prompts.select(F.col(key).alias("key"), F.transform(tokens, lambda t: t.cast("string")).alias("tokens"), (none if salt is None else salt).alias("salt"), (none if extra is None else extra).alias("extra")).where(F.size("tokens") >= block)
    schema = rows.limit(0).selectExpr("key", "0 pos", "'' block_key").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (words, first, more) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))):
                digest, out = first or "", []
                for a in range(0, len(words) - block + 1, block):
                    digest = hashlib.sha256("|".join([digest, " ".join(w for w in words[a : a + block] if w is not None), more or ""]).encode()).hexdigest()
                    out.append(digest)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(len(out), i))), pa.array(range(len(out)), pa.int32()), pa.array(out, pa.string())], names=["key", "pos", "block_key"])

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def shared_blocks(blocks: DataFrame, block: int) -> DataFrame:
    """``block_key, pos, requests, reusable_tokens``: how many requests share a block, and the tokens all but the first would reuse."""
    return blocks.groupBy("block_key", "pos").agg(F.count("*").alias("requests")).withColumn("reusable_tokens", (F.col("requests") - 1) * block)
