"""Checks of segment values against a contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.contract import Contract


def value_problems(values: Column, contract: Contract) -> Column:
    """Problems of a ``map<string,string>`` of values, as an array of texts; empty if there is none.

    ``values`` comes from JSON text: a key that holds no string is null in it and counts as of the wrong type. A
    contract's fields and vocabularies are closed and small, so they are literals of the plan.
    """
    known = F.array(*(F.lit(n) for n in sorted(contract.fields))) if contract.fields else F.array().cast("array<string>")
    extra = F.array_sort(F.array_except(F.map_keys(values), known))
    problems = [F.when(F.size(extra) > 0, F.concat(F.lit("unexpected values: "), F.array_join(extra, ", ")))]
    for name, f in sorted(contract.fields.items()):
        there, value = F.map_contains_key(values, F.lit(name)), F.element_at(values, F.lit(name))
        if f["required"]:
            problems.append(F.when(~there, F.lit(f"missing value: {name}")))
        wrong = F.when(there & value.isNull(), F.lit(f"value of {name} is no string"))
        if f["type"] == "enum":
            wrong = wrong.when(there & ~value.isin(contract.vocabularies[f["vocabulary"]]), F.concat(F.lit(f"unknown {name}: "), value))
        problems.append(wrong)
    return F.when(values.isNull(), F.array(F.lit("values is no object"))).otherwise(F.array_compact(F.array(*problems)))


def contract_problems(rows: DataFrame, contracts: DataFrame, values: str = "values", schema: str = "schema_version") -> DataFrame:
    """``rows`` with ``problems`` of their values under the contract that each row names, as :func:`value_problems` lists them.

    ``contracts`` is a table (see ``sources.contract.contract_table``), so any number of them is checked in one job by one join and
    none is a literal of the plan. A row that names no contract of the table, or none at all, has that as its one problem.
    """
    held = rows.join(contracts.select(F.col("schema_id").alias(schema), F.col("fields").alias("contract_fields")), schema, "left")
    of, known = F.col(values), F.col("contract_fields")
    extra = F.array_sort(F.array_except(F.map_keys(of), F.transform(known, lambda f: f["field"])))

    def problem(f: Column) -> Column:
        there, value, name = F.map_contains_key(of, f["field"]), F.element_at(of, f["field"]), f["field"]
        wrong = F.when(~there & f["required"], F.concat(F.lit("missing value: "), name))
        wrong = wrong.when(there & value.isNull(), F.concat(F.lit("value of "), name, F.lit(" is no string")))
        return wrong.when(there & (f["type"] == "enum") & ~F.coalesce(F.array_contains(f["terms"], value), F.lit(False)), F.concat(F.lit("unknown "), name, F.lit(": "), value))

    first = F.when(F.size(extra) > 0, F.concat(F.lit("unexpected values: "), F.array_join(extra, ", ")))
    every = F.array_compact(F.concat(F.array(first), F.transform(known, problem)))
    unnamed = F.array(F.concat(F.lit("unknown schema: "), F.coalesce(F.col(schema), F.lit(""))))
    found = F.when(known.isNull(), unnamed).when(of.isNull(), F.array(F.lit("values is no object"))).otherwise(every)
    return held.withColumn("problems", found).select(*rows.columns, "problems")


def unknown_terms(rows: DataFrame, vocabulary: DataFrame, field: str, name: str) -> DataFrame:
    """Rows whose ``field`` isn't in a vocabulary table: an anti-join, for vocabularies too large for literals."""
    terms = vocabulary.where(F.col("vocabulary") == name).select(F.col("id").alias(field)).distinct()
    return rows.join(terms, field, "left_anti")
