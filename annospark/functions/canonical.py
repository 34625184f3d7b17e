"""Canonical JSON and digests."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(value: Any) -> str:
    """Sorted keys, no blanks, characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(value: Any) -> str:
    return "sha256:" + hashlib.sha256(canonical_json(value).encode()).hexdigest()


def to_canonical_json(struct: Column) -> Column:
    """JSON of a struct whose fields are declared in alphabetical order; nulls are written."""
    return F.to_json(struct, {"ignoreNullFields": "false"})


def sorted_map(m: Column) -> Column:
    """A map with its keys in order, so that its JSON is canonical and it can be compared."""
    return F.map_from_entries(F.array_sort(F.map_entries(m)))
