"""Batch-inference files: request lines, their checks, and results joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import kept, sums_before

ENDPOINTS = ("/v1/chat/completions", "/v1/embeddings", "/v1/score", "/v1/rerank")


def chat_messages(turns: DataFrame, by: str = "conv_id") -> DataFrame:
    """``by, messages`` (array of ``role, content`` in order of turns)."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return turns.groupBy(by).agg(F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def request_lines(rows: DataFrame, custom_id: Column, url: str, body: Column) -> DataFrame:
    """``custom_id, line``: one JSON request per row; the body is a struct."""
    if url not in ENDPOINTS:
        raise ValueError(f"endpoint {url} takes no batches")
    return rows.select(custom_id.alias("custom_id"), F.to_json(F.struct(custom_id.alias("custom_id"), F.lit("POST").alias("method"), F.lit(url).alias("url"), body.alias("body"))).alias("line"))


def file_problems(lines: DataFrame) -> DataFrame:
    """``code, detail``: more than one model, unknown endpoints, repeated ids, lines that are no JSON."""
    parsed = lines.withColumn("json", F.try_parse_json("line"))
    field = lambda path: F.try_variant_get("json", path, "string")
    rows = parsed.select(F.col("json").isNull().alias("broken"), field("$.custom_id").alias("id"), field("$.url").alias("url"), field("$.body.model").alias("model"))
    models = rows.agg(F.array_sort(F.collect_set("model")).alias("m")).where(F.size("m") > 1).select(F.lit("several_models").alias("code"), F.array_join("m", ", ").alias("detail"))
    urls = rows.where(~F.col("broken") & ~F.coalesce(F.col("url").isin(*ENDPOINTS), F.lit(False))).groupBy("url").count().select(F.lit("bad_endpoint").alias("code"), F.coalesce("url", F.lit("")).alias("detail"))
    twice = rows.where("id is not null").groupBy("id").count().where("count > 1").select(F.lit("repeated_id").alias("code"), F.col("id").alias("detail"))
    broken = rows.where("broken").agg(F.count("*").alias("n")).where("n > 0").select(F.lit("not_json").alias("code"), F.col("n").cast("string").alias("detail"))
    return models.union(urls).union(twice).union(broken)


def join_results(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Every request (``custom_id``) with ``status`` (``ok, failed, missing``), ``status_code`` and ``body`` of its result line."""
    parsed = results.withColumn("json", F.try_parse_json("line"))
    get = lambda path, kind="string": F.try_variant_get("json", path, kind)
    rows = parsed.select(get("$.custom_id").alias("custom_id"), get("$.response.status_code", "int").alias("status_code"), F.to_json(F.try_variant_get("json", "$.response.body", "variant")).alias("body"), F.schema_of_variant(F.try_variant_get("json", "$.error", "variant")).alias("error"), F.lit(True).alias("there"))
    status = F.when(F.col("there").isNull(), "missing").when((F.coalesce("error", F.lit("VOID")) != "VOID") | ~F.coalesce(F.col("status_code") == 200, F.lit(False)), "failed").otherwise("ok")
    return requests.join(rows, "custom_id", "left").withColumn("status", status).drop("there", "error")


def packed_files(lines: DataFrame, max_lines: int, max_bytes: int, by: str = "model", order: str = "custom_id", line: str = "line", ranges: int | None = None) -> DataFrame:
    """``lines`` with ``n_bytes`` (its line feed included) and ``file``, gapless from 0 within ``by``: one model a file, no file above a limit.

    Lines are laid end to end in ``order``, which must be distinct within ``by``; a file takes those that begin in one stretch of
    15/16 of ``max_bytes`` and one of ``max_lines``. A line of more than 1/16 of ``max_bytes`` has a file of its own, after the others;
    one above ``max_bytes`` has a null ``file``. Sums run over ranges, so a model of any size is many tasks; only files
    (not lines) of one model are numbered together. A null line counts as empty; null models are one group.
    """
    part = max(1, max_bytes // 16)
    sized = lines.withColumn("n_bytes", F.octet_length(F.coalesce(line, F.lit(""))).cast("bigint") + 1)
    sized = sized.withColumn("alone", F.col("n_bytes") > part).withColumn("one", F.lit(1)).withColumn("laid", F.when(~F.col("alone"), F.col("n_bytes")))
    placed = sums_before(sized, [by, "alone"], [order], {"lines_before": "one", "bytes_before": "laid"}, ranges)
    key = F.when(F.col("alone"), F.col("lines_before")).otherwise(F.floor(F.col("bytes_before") / F.lit(max(1, max_bytes - part))) + F.floor(F.col("lines_before") / F.lit(max_lines)))
    placed = kept(placed.withColumn("key", F.when(F.col("n_bytes") <= max_bytes, key)), "lines")
    files = placed.where("key is not null").select(F.col(by).alias("m"), F.col("alone").alias("a"), F.col("key").alias("k")).distinct()
    files = files.withColumn("file", (F.row_number().over(Window.partitionBy("m").orderBy("a", "k")) - 1).cast("bigint"))
    same = F.col(by).eqNullSafe(F.col("m")) & (F.col("alone") == F.col("a")) & (F.col("key") == F.col("k"))
    return placed.join(files, same, "left").select(*lines.columns, "n_bytes", "file")


def standard_turns(dialogues: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Turns of two parties with their roles renamed; rows of other parties go."""
    renamed = F.create_map(*(F.lit(x) for pair in roles.items() for x in pair))
    return dialogues.withColumn("role", F.try_element_at(renamed, F.col("role"))).where(F.col("role").isNotNull())


def sampled_conversations(turns: DataFrame, max_items: int, seed: int, by: str = "conv_id") -> DataFrame:
    """The turns of ``max_items`` conversations, chosen by a hash of their id, whatever the partitioning."""
    chosen = turns.select(by).distinct().orderBy(F.md5(F.concat_ws(":", F.col(by).cast("string"), F.lit(str(seed)))), by).limit(max_items)
    return turns.join(chosen, by, "left_semi")


def embedding_lines(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Request lines that ask for the embedding of each text."""
    return request_lines(docs, F.concat(F.lit("e-"), F.col(key).cast("string")), "/v1/embeddings", F.struct(F.lit(model).alias("model"), F.coalesce(F.col(text), F.lit("")).alias("input")))


def score_lines(groups: DataFrame, model: str, key: str = "item_id", query: str = "query", documents: str = "documents") -> DataFrame:
    """Request lines that ask for the scores of an array of documents with a query."""
    return request_lines(groups, F.concat(F.lit("s-"), F.col(key).cast("string")), "/v1/score", F.struct(F.lit(model).alias("model"), F.col(query).alias("queries"), F.col(documents).alias("documents")))


_NUMBER, _WHOLE = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$", r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,0\))$"
_TYPES = {"object": r"^OBJECT", "array": r"^ARRAY", "string": r"^STRING$", "number": _NUMBER, "integer": _WHOLE, "boolean": r"^BOOLEAN$", "null": r"^VOID$"}
_CHECKED = {"type", "properties", "required", "additionalProperties", "items", "enum", "const", "minLength", "maxLength", "minimum", "maximum", "minItems", "maxItems"}


def equals_json(value: Column, wanted) -> Column:
    """Whether a VARIANT is the JSON value ``wanted``, in type as in content: numbers by their value, objects whatever the order of their keys."""
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    get = lambda to: F.try_variant_get(value, "$", to)
    if wanted is None:
        same = kind == "VOID"
    elif isinstance(wanted, bool):
        same = (kind == "BOOLEAN") & (get("boolean") == wanted)
    elif isinstance(wanted, str):
        same = (kind == "STRING") & (get("string") == wanted)
    elif isinstance(wanted, int) and abs(wanted) >= 1 << 53:
        same = kind.rlike(_WHOLE) & (F.to_json(value) == str(wanted))
    elif isinstance(wanted, (int, float)):
        same = kind.rlike(_NUMBER) & (get("double") == float(wanted))
    elif isinstance(wanted, list):
        items = get("array<variant>")
        same = kind.startswith("ARRAY") & (F.size(items) == len(wanted))
        for i, x in enumerate(wanted):
            same &= equals_json(F.try_element_at(items, F.lit(i + 1)), x)
    else:
        held = get("map<string,variant>")
        same = kind.startswith("OBJECT") & (F.size(held) == len(wanted))
        for name, x in wanted.items():
            same &= F.map_contains_key(held, name) & equals_json(F.try_element_at(held, F.lit(name)), x)
    return F.coalesce(same, F.lit(False))


def schema_fault(value: Column, schema: dict, path: str = "$") -> Column:
    """What of a VARIANT breaks a JSON schema first, as ``path: rule``; null if nothing does.

    Types, properties, items, choices and limits are checked, in plan as in the schema; other keywords raise an error. A number without a fraction is an
    integer (of 38 digits at most). Choices and constants must agree in type too.
    """
    if unknown := set(schema) - _CHECKED:
        raise ValueError(f"schema keywords that aren't checked: {', '.join(sorted(unknown))}")
    kind = F.schema_of_variant(value)
    get = lambda to: F.try_variant_get(value, "$", to)
    faults = []

    def rule(name: str, broken: Column) -> None:
        faults.append(F.when(F.coalesce(broken, F.lit(True)), F.lit(f"{path}: {name}")))

    if "type" in schema:
        rule("type", ~kind.rlike(_TYPES[schema["type"]]))
    if "enum" in schema:
        among = F.lit(False)
        for x in schema["enum"]:
            among |= equals_json(value, x)
        rule("enum", ~among)
    if "const" in schema:
        rule("const", ~equals_json(value, schema["const"]))
    for name, test in (("minLength", lambda n: F.length(get("string")) < n), ("maxLength", lambda n: F.length(get("string")) > n)):
        if name in schema:
            faults.append(F.when(kind.rlike(_TYPES["string"]) & test(schema[name]), F.lit(f"{path}: {name}")))
    for name, test in (("minimum", lambda n: get("double") < n), ("maximum", lambda n: get("double") > n)):
        if name in schema:
            faults.append(F.when(kind.rlike(_NUMBER) & test(schema[name]), F.lit(f"{path}: {name}")))
    if "properties" in schema or "required" in schema or "additionalProperties" in schema:
        known, held = schema.get("properties", {}), get("map<string,variant>")
        for name in schema.get("required", []):
            faults.append(F.when(kind.startswith("OBJECT") & ~F.coalesce(F.map_contains_key(held, name), F.lit(False)), F.lit(f"{path}.{name}: required")))
        if schema.get("additionalProperties") is False:
            extra = F.array_sort(F.array_except(F.map_keys(held), F.array(*map(F.lit, known)) if known else F.expr("cast(array() as array<string>)")))
            faults.append(F.when(kind.startswith("OBJECT") & (F.size(extra) > 0), F.concat(F.lit(f"{path}."), F.element_at(extra, 1), F.lit(": additionalProperties"))))
        for name, inner in known.items():
            faults.append(F.when(kind.startswith("OBJECT") & F.coalesce(F.map_contains_key(held, name), F.lit(False)), schema_fault(F.try_element_at(held, F.lit(name)), inner, f"{path}.{name}")))
    if "items" in schema or "minItems" in schema or "maxItems" in schema:
        items = get("array<variant>")
        for name, test in (("minItems", lambda n: F.size(items) < n), ("maxItems", lambda n: F.size(items) > n)):
            if name in schema:
                faults.append(F.when(kind.startswith("ARRAY") & test(schema[name]), F.lit(f"{path}: {name}")))
        if "items" in schema:
            each = F.array_compact(F.transform(items, lambda x: schema_fault(x, schema["items"], f"{path}[]")))
            faults.append(F.when(kind.startswith("ARRAY") & (F.size(each) > 0), F.element_at(each, 1)))
    return F.coalesce(*faults, F.lit(None).cast("string")) if faults else F.lit(None).cast("string")


def output_fault(text: Column, schema: dict) -> Column:
    """Why generated text doesn't keep to a JSON schema: ``not_json``, or the first fault; null if it does."""
    parsed = F.try_parse_json(text)
    return F.when(parsed.isNull(), F.lit("not_json")).otherwise(schema_fault(parsed, schema))


def output_matches(text: Column, choices: list[str] | None = None, pattern: str | None = None) -> Column:
    """Whether generated text is one of the choices, or matches a pattern as a whole."""
    if choices is not None:
        return F.coalesce(text.isin(choices), F.lit(False))
    return F.coalesce(text.rlike(f"^(?:{pattern})$"), F.lit(False))
