"""Configuration: where tables live, which rows are known to be bad, and what a build must look like.

Surrogate ids never appear in library code; they are listed in a JSON file and loaded here.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# The texts a CSV reader of the source system's exports treats as "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Timestamp patterns tried after ISO text, first match wins.
TIMESTAMP_FORMATS = ("M/d/yy H:mm", "M/d/yyyy H:mm", "M/d/yy", "M/d/yyyy")

WAREHOUSE_VARIABLE = "CHARTMILL_WAREHOUSE"


@dataclass(frozen=True)
class Layout:
    """All paths derive from one root folder."""

    root: str

    @classmethod
    def from_env(cls, default: str = "warehouse") -> Layout:
        return cls(os.environ.get(WAREHOUSE_VARIABLE, default))

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def ledger(self, name: str) -> str:
        return f"{self.root}/_ledger/{name}"


@dataclass(frozen=True)
class Expectation:
    """Counts a build must meet before it is published; ``None`` means not checked."""

    rows: int | None = None
    distinct_key: tuple[str, int] | None = None
    rows_above: int | None = None


@dataclass(frozen=True)
class CleaningRules:
    """Site knowledge: rows to drop, values to null, and the expected shape of each silver table."""

    phantom_rows: tuple[tuple[str, str], ...] = ()
    implausible_height: tuple[str, ...] = ()
    trim_labs: bool = False
    trim_events: bool = False
    null_tokens: tuple[str, ...] = NULL_TOKENS
    timestamp_formats: tuple[str, ...] = TIMESTAMP_FORMATS
    expected: Mapping[str, Expectation] = field(default_factory=dict)

    @classmethod
    def from_json(cls, path: str) -> CleaningRules:
        with open(path, encoding="utf-8") as handle:
            raw = json.load(handle)
        expected = {}
        for table, entry in raw.pop("expected", {}).items():
            if entry.get("distinct_key"):
                entry["distinct_key"] = tuple(entry["distinct_key"])
            expected[table] = Expectation(**entry)
        for name in ("implausible_height", "null_tokens", "timestamp_formats"):
            if name in raw:
                raw[name] = tuple(raw[name])
        if "phantom_rows" in raw:
            raw["phantom_rows"] = tuple(tuple(pair) for pair in raw["phantom_rows"])
        return cls(expected=expected, **raw)
