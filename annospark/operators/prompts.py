"""Conversations as one prompt string in the formats of common chat models, and pairs as reranking prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What stands before a turn's text by role, what ends a turn, what asks for the next answer (and whether only
#: when the last turn isn't the assistant's). A role of None stands for any other role; turns of roles without an entry give no text.
CHAT_FORMATS: dict[str, dict] = {
    "basic": {"before": {None: ""}, "end": "", "ask": ""},
    "chatml": {"before": {None: "<|im_start|>{role}\n"}, "end": "<|im_end|>\n", "ask": "<|im_start|>assistant\n"},
    "falcon": {"before": {"user": "User: ", "assistant": "Assistant: "}, "end": "\n", "ask": "Assistant:", "all_end": True},
    "falcon-180b": {"before": {"system": "System: ", "user": "User: ", "assistant": "Falcon: "}, "end": "\n", "ask": "Falcon:", "all_end": True},
    "teleflm": {"before": {"user": "<_user>", "system": "<_system>", "assistant": "<_bot>"}, "end": "", "ask": "<_bot>", "always": True, "trimmed": ("user", "system")},
    "chatglm": {"before": {"user": "[Round {round0}]\n问：", "assistant": "\n答："}, "end": "\n", "ask": "\n答：", "ends": ("assistant",)},
    "chatglm2": {"before": {"user": "[Round {round1}]\n\n问：", "assistant": "\n\n答："}, "end": "\n\n", "ask": "\n\n答：", "ends": ("assistant",)},
    "blip2": {"before": {"user": "Question: ", "assistant": "Answer: "}, "end": "", "ask": "Answer:", "always": True, "after": " "},
}

#: Reranking prompts; the marks in braces are the pair's texts and the instruction.
RERANK_FORMATS = {
    "nemotron": "question:{query} \n \n passage:{document}",
    "qwen3": "<|im_start|>system\nJudge whether the Document meets the requirements based on the Query and the Instruct provided. Note that the answer can only be \"yes\" or \"no\".<|im_end|>\n<|im_start|>user\n<Instruct>: {instruction}\n<Query>: {query}\n<Document>: {document}<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n",
    "bge-gemma": "A: {query}\nB: {document}\nGiven a query A and a passage B, determine whether the passage contains an answer to the query by providing a prediction of either 'Yes' or 'No'.",
    "mxbai": "<|im_start|>system\nYou are Qwen, created by Alibaba Cloud. You are a helpful assistant.<|im_end|>\n<|im_start|>user\nquery: {query}\ndocument: {document}\nYou are a search relevance expert who evaluates how well documents match search queries. For each query-document pair, carefully analyze the semantic relationship between them, then provide your binary relevance judgment (0 for not relevant, 1 for relevant).\nRelevance:<|im_end|>\n<|im_start|>assistant",
}
DEFAULT_INSTRUCTION = "Given a web search query, retrieve relevant passages that answer the query"


def _filled(template: str, marks: dict[str, Column]) -> Column:
    """A template with columns in place of its marks."""
    parts, rest = [], template
    while rest:
        found = [(rest.find("{" + m + "}"), m) for m in marks if "{" + m + "}" in rest]
        if not found:
            parts.append(F.lit(rest))
            break
        at, mark = min(found)
        parts += [F.lit(rest[:at]), marks[mark]]
        rest = rest[at + len(mark) + 2 :]
    return F.concat(*parts) if parts else F.lit("")


def render_chats(turns: DataFrame, style: str, add_generation_prompt: bool = True, by: str = "conv_id") -> DataFrame:
    """``by, prompt``: the turns in order as one string. One shuffle by conversation."""
    form = CHAT_FORMATS[style]
    order = Window.partitionBy(by).orderBy("turn")
    users = F.sum((F.col("role") == "user").cast("int")).over(order)
    last = F.lead("turn").over(order).isNull()
    rows = turns.withColumn("round", users).withColumn("is_last", last)
    marks = {"role": F.col("role"), "round0": (F.col("round") - 1).cast("string"), "round1": F.col("round").cast("string")}
    text = F.when(F.col("role").isin(*form.get("trimmed", ())), F.trim("text")).otherwise(F.col("text")) if form.get("trimmed") else F.col("text")
    shown = None
    for role, template in form["before"].items():
        said = F.concat(_filled(template, marks), text, F.lit(form.get("after", "")))
        shown = (F.when(F.lit(True), said) if shown is None else shown.otherwise(said)) if role is None else (F.when(F.col("role") == role, said) if shown is None else shown.when(F.col("role") == role, said))
    ends = F.col("role").isin(*form["ends"]) if "ends" in form else F.lit(True)
    if not add_generation_prompt:
        ends = ends & ~F.col("is_last")
    piece = F.concat(F.coalesce(shown, F.lit("")), F.when(ends, form["end"]).otherwise(""))
    joined = rows.select(by, "turn", "role", piece.alias("piece")).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "piece"))).alias("all"))
    asked = F.lit("")
    if add_generation_prompt:
        asked = F.lit(form["ask"]) if form.get("always") else F.when(F.element_at("all", -1)["role"] != "assistant", form["ask"]).otherwise("")
    return joined.select(by, F.concat(F.array_join(F.transform("all", lambda m: m["piece"]), ""), asked).alias("prompt"))


def rerank_prompts(pairs: DataFrame, style: str, query: str = "query", document: str = "document", instruction: str = DEFAULT_INSTRUCTION) -> DataFrame:
    """``pairs`` with ``prompt``."""
    return pairs.withColumn("prompt", _filled(RERANK_FORMATS[style], {"query": F.col(query), "document": F.col(document), "instruction": F.lit(instruction)}))
