"""Contracts: which values a segment carries, and the closed vocabularies that they come from."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import canonical_json, digest


class ContractError(ValueError):
    """A contract file breaks a rule."""


def _only(where: str, given: dict, allowed: set[str], needed: set[str]) -> None:
    if not isinstance(given, dict):
        raise ContractError(f"{where} must be a mapping")
    if extra := sorted(set(given) - allowed):
        raise ContractError(f"{where} has unknown keys: {', '.join(extra)}")
    if missing := sorted(needed - set(given)):
        raise ContractError(f"{where} lacks keys: {', '.join(missing)}")


@dataclass(frozen=True)
class Contract:
    """A schema and an ontology that have been checked against each other."""

    schema: dict[str, Any]
    ontology: dict[str, Any]

    @property
    def schema_id(self) -> str:
        return self.schema["schema_id"]

    @property
    def ontology_id(self) -> str:
        return self.ontology["ontology_id"]

    @cached_property
    def fields(self) -> dict[str, dict[str, Any]]:
        """Field name to ``{type, vocabulary, required}``."""
        return {name: {"type": f["type"], "vocabulary": f["source"].removeprefix("ontology.") if f["type"] == "enum" else None, "required": f.get("required", True)} for name, f in self.schema["segment_values"].items()}

    @cached_property
    def vocabularies(self) -> dict[str, list[str]]:
        return {name: [t["id"] for t in terms] for name, terms in self.ontology["vocabularies"].items()}

    @property
    def schema_hash(self) -> str:
        return digest(self.schema)

    @property
    def ontology_hash(self) -> str:
        return digest(self.ontology)

    def field_table(self, spark: SparkSession) -> DataFrame:
        rows = [(n, f["type"], f["vocabulary"], f["required"]) for n, f in self.fields.items()]
        return spark.createDataFrame(rows, "field string, type string, vocabulary string, required boolean")

    def vocabulary_table(self, spark: SparkSession) -> DataFrame:
        rows = [(v, i, t["id"], t.get("name"), t.get("definition")) for v, terms in self.ontology["vocabularies"].items() for i, t in enumerate(terms)]
        return spark.createDataFrame(rows, "vocabulary string, pos int, id string, name string, definition string")

    def response_schema(self) -> dict[str, Any]:
        """JSON schema of a coarse response; the chunk's limits are added per request."""
        value = {n: {"type": "string"} | ({"enum": self.vocabularies[f["vocabulary"]]} if f["type"] == "enum" else {}) for n, f in self.fields.items()}
        count = {"type": "integer", "minimum": 0}
        segment = {
            "segment_id": {"type": "string"},
            "start_ms": count,
            "end_ms": {"type": "integer", "minimum": 1},
            "values": {"type": "object", "additionalProperties": False, "properties": value, "required": [n for n, f in self.fields.items() if f["required"]]},
            "sentence": {"type": "string", "minLength": 1},
            "evidence_timestamps_ms": {"type": "array", "items": count},
        }
        each = {"type": "object", "additionalProperties": False, "properties": segment, "required": list(segment)}
        return {"type": "object", "additionalProperties": False, "properties": {"task_summary": {"type": "string", "minLength": 1}, "segments": {"type": "array", "items": each}}, "required": ["task_summary", "segments"]}

    def ontology_json(self) -> str:
        return canonical_json(self.ontology)


def make_contract(schema: dict[str, Any], ontology: dict[str, Any]) -> Contract:
    """Checks both documents and their references."""
    _only("schema", schema, {"schema_id", "segment_values", "text_output"}, {"schema_id", "segment_values", "text_output"})
    _only("ontology", ontology, {"ontology_id", "revision", "vocabularies"}, {"ontology_id", "revision", "vocabularies"})
    text = schema["text_output"]
    _only("text_output", text, {"field", "language", "style", "required"}, {"field", "language", "style"})
    if text["field"] != "sentence" or text.get("required", True) is not True:
        raise ContractError("text_output must be the required field 'sentence'")
    for name, terms in ontology["vocabularies"].items():
        ids = []
        for term in terms or []:
            _only(f"term of {name}", term, {"id", "name", "definition"}, {"id"})
            ids.append(term["id"])
        if twice := sorted({i for i in ids if ids.count(i) > 1}):
            raise ContractError(f"vocabulary {name} repeats ids: {', '.join(twice)}")
    for name, field in schema["segment_values"].items():
        _only(f"field {name}", field, {"type", "source", "required"}, {"type"})
        if field["type"] not in ("enum", "string"):
            raise ContractError(f"field {name} has unknown type {field['type']}")
        if field["type"] == "enum":
            source = field.get("source") or ""
            if not source.startswith("ontology.") or not ontology["vocabularies"].get(source.removeprefix("ontology.")):
                raise ContractError(f"field {name} needs a filled vocabulary as source, not {source!r}")
    return Contract(schema, ontology)


def load_contract(schema_path: str, ontology_path: str) -> Contract:
    documents = []
    for path in (schema_path, ontology_path):
        with open(path, encoding="utf-8") as f:
            documents.append(yaml.safe_load(f))
    return make_contract(*documents)


def contract_table(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    """``schema_id, fields``: a row for each contract, its fields in order of name with type, whether required, and the terms of enums."""
    twice = sorted({c.schema_id for c in contracts if sum(x.schema_id == c.schema_id for x in contracts) > 1})
    if twice:
        raise ContractError(f"several contracts have schema {', '.join(twice)}")
    rows = [(c.schema_id, [(n, f["type"], f["required"], c.vocabularies.get(f["vocabulary"])) for n, f in sorted(c.fields.items())]) for c in contracts]
    return spark.createDataFrame(rows, "schema_id string, fields array<struct<field:string,type:string,required:boolean,terms:array<string>>>")


def repeated_terms(vocabulary: DataFrame) -> DataFrame:
    """``vocabulary, id, n`` of ids that a vocabulary table holds more than once."""
    return vocabulary.groupBy("vocabulary", "id").agg(F.count("*").alias("n")).where("n > 1")
