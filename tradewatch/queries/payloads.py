"""Payload texts rendered from the test tables, and the values they must come back as.

Every field is filled by a rule over the row's key that walks through good and bad values of its kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _value(kind: str, name: str, number: int, key: str) -> str:
    """SQL (the same on both engines) for the JSON text of one field."""
    amount = f"CAST(CAST(({key} % 1000 + {number}) AS DOUBLE) / 8 AS {{text}})"
    return {
        "text": f"""concat('"{name}-', {key}, '"')""",
        "double": (
            f"CASE {key} % 3 WHEN 0 THEN {amount} WHEN 1 THEN concat('\"', {amount}, '\"') ELSE '\"abc\"' END"
        ),
        "long": (
            f"CASE {key} % 4 WHEN 0 THEN concat('', {key} + {number}) WHEN 1 THEN concat('\"', {key} + {number}, '\"')"
            f" WHEN 2 THEN concat({key} + {number}, '.7') ELSE '\"3.7\"' END"
        ),
        "bool": f"CASE {key} % 3 WHEN 0 THEN 'true' WHEN 1 THEN '\"true\"' ELSE 'false' END",
        "timestamp": (
            f"CASE {key} % 3 WHEN 0 THEN '\"2024-03-05T06:07:08Z\"' WHEN 1 THEN '\"\"' ELSE '\"soon\"' END"
        ),
        "json": (
            f"CASE {key} % 3 WHEN 0 THEN concat('{{{{\"k\": ', {key}, '}}}}') WHEN 1 THEN '\"plain\"'"
            f" ELSE concat('[', {key}, ', {number}]') END"
        ),
    }[kind].format(text="STRING")


def _expected(kind: str, name: str, number: int, key: str) -> str:
    """DuckDB SQL for the value the field must be read as."""
    return {
        "text": f"'{name}-' || {key}",
        "double": f"CASE WHEN {key} % 3 < 2 THEN CAST(({key} % 1000 + {number}) AS DOUBLE) / 8 END",
        "long": f"CASE WHEN {key} % 4 < 3 THEN CAST({key} + {number} AS BIGINT) END",
        "bool": f"CASE {key} % 3 WHEN 0 THEN TRUE WHEN 2 THEN FALSE END",
        "timestamp": f"CASE WHEN {key} % 3 = 0 THEN TIMESTAMP '2024-03-05 06:07:08' END",
        "json": (
            f"CASE {key} % 3 WHEN 0 THEN '{{\"k\":' || {key} || '}}' WHEN 1 THEN 'plain'"
            f" ELSE '[' || {key} || ',{number}]' END"
        ),
    }[kind]


def render(fields, key: str, extra: str = "") -> Column:
    """A JSON object with every field of `fields`, (field, column, kind); `extra` is SQL for more pairs."""
    pairs = [
        f"""concat('"{name}": ', {_value(kind, name, number, key)})""" for number, (name, _, kind) in enumerate(fields)
    ]
    if extra:
        pairs.append(extra)
    return F.expr(f"concat('{{', concat_ws(', ', {', '.join(pairs)}), '}}')")


def expected_sql(fields, key: str) -> str:
    return ", ".join(
        f"{_expected(kind, name, number, key)} AS {column}" for number, (name, column, kind) in enumerate(fields)
    )
