"""All registered queries and their SQL counterparts."""

from __future__ import annotations

import importlib

MODULES = [
    "files", "text", "requests", "normalizer", "batches", "costs", "status", "incremental",
    "reports", "timelines",
]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        module = importlib.import_module(f"labelflow.bindings.{name}")
        for key, value in getattr(module, attribute).items():
            if key in out:
                raise ValueError(f"duplicate query {key}")
            out[key] = value
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE")
