"""Registry of named queries and their checking SQL.

``@query(name, sql)`` registers a function of ``Tables``.  ``sql`` may name the
adapter relations and the shared expressions of ``cte``; the ones it needs are
found by name and put in front as common table expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.adapter import RELATIONS, Tables, oracle_text, tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SHARED: dict[str, str] = {}
_WORD = re.compile(r"[A-Za-z_]\w*")


def cte(name: str, sql: str) -> None:
    SHARED[name] = sql


def query(name: str, sql: str | None = None):
    def keep(fn: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def _collect(sql: str, seen: dict[str, str], skip: frozenset[str]) -> None:
    for word in dict.fromkeys(_WORD.findall(sql)):
        if word in seen or word in skip:
            continue
        if word in SHARED:
            seen[word] = ""
            body = SHARED[word]
            del seen[word]
            _collect(body, seen, skip | {word})
            seen[word] = body
        elif word in RELATIONS:
            body, _ = oracle_text(word)
            _collect(body, seen, skip | {word})
            seen[word] = body


def oracle(name: str) -> str:
    body = ORACLES[name].strip()
    seen: dict[str, str] = {}
    own = frozenset(re.findall(r"(\w+) AS (?:MATERIALIZED )?\(", body)) if body.upper().startswith("WITH") else frozenset()
    _collect(body, seen, own)
    heads = [f"{n} AS MATERIALIZED ({b})" for n, b in seen.items()]
    recursive = "RECURSIVE " if re.match(r"WITH RECURSIVE", body, re.I) or any("RECURSIVE_CTE" in b for b in seen.values()) else ""
    if re.match(r"WITH\b", body, re.I):
        body = re.sub(r"^WITH(\s+RECURSIVE)?\s+", "", body, count=1, flags=re.I)
        return f"WITH {recursive}" + ",\n".join([*heads, body])
    return (f"WITH {recursive}" + ",\n".join(heads) + "\n" + body) if heads else body


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](tables(spark, folder))
