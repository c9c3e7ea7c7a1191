"""Safe conversions of JSON values and instants.

Payloads are parsed once with ``from_json`` into a schema whose field types keep what the later
check needs: plain strings for text, JSON text and doubles, real booleans for strict booleans, and
variants where a JSON string must be told apart from a JSON number, object or array. The checks of
single fields are SQL expressions over the parsed field's name, because they are applied to long
lists of fields.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewatch.fixed import ISO_START

_PARSED_AS = {
    "text": "string",
    "json": "string",
    "double": "string",
    "timestamp": "string",
    "bool": "boolean",
    "long": "variant",
    "only_text": "variant",
}

_NUMBER = r"^\s*[+-]?(\d(_?\d)*\.?(\d(_?\d)*)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?\s*$"
_INTEGER = r"^\s*[+-]?\d(_?\d)*\s*$"


def parse_schema(fields) -> str:
    """The ``from_json`` schema for ``(field, kind)`` pairs."""
    return ", ".join(f"`{name}` {_PARSED_AS[kind]}" for name, kind in fields)


def coerce(field: str, kind: str) -> str:
    """SQL for the final value of a field parsed by `parse_schema`; bad values become NULL."""
    convert = {"double": to_double, "long": to_long, "timestamp": iso_timestamp, "only_text": only_text}
    return convert[kind](field) if kind in convert else field


def to_double(text: str) -> str:
    """A finite double from numeric text, else NULL (also for NaN and infinities)."""
    value = f"CASE WHEN {text} RLIKE r'{_NUMBER}' THEN try_cast(replace({text}, '_', '') AS DOUBLE) END"
    return f"nullif(nullif({value}, double('Infinity')), double('-Infinity'))"


def to_long(value: str) -> str:
    """A bigint from a variant: JSON numbers are cut toward zero, text must be a whole number."""
    text = f"try_variant_get({value}, '$', 'string')"
    return (
        f"CASE WHEN schema_of_variant({value}) = 'STRING'"
        f" THEN CASE WHEN {text} RLIKE r'{_INTEGER}' THEN try_cast(replace({text}, '_', '') AS BIGINT) END"
        f" ELSE try_variant_get({value}, '$', 'bigint') END"
    )


def only_text(value: str) -> str:
    """The text of a variant that holds a JSON string, NULL for every other JSON type."""
    return f"CASE WHEN schema_of_variant({value}) = 'STRING' THEN try_variant_get({value}, '$', 'string') END"


def iso_timestamp(text: str) -> str:
    """Keep only text that begins like an ISO date and time."""
    return f"CASE WHEN {text} RLIKE r'{ISO_START}' THEN try_cast({text} AS TIMESTAMP) END"


def epoch_ms(ms: str) -> str:
    """Epoch milliseconds, whole or fractional, as an instant."""
    return f"timestamp_micros(try_cast(round(CAST({ms} AS DOUBLE) * 1000) AS BIGINT))"


def text_array_item(json_text: str, position: int) -> str:
    """Item `position` (from 1) of JSON array text; NULL when short or not an array."""
    return f"try_element_at(from_json({json_text}, 'array<string>'), {position})"


def tag_slugs(tags_json: Column) -> Column:
    """JSON array of the non-empty slugs among the objects of a JSON array."""
    items = F.coalesce(F.from_json(tags_json, "array<string>"), F.array().cast("array<string>"))
    slugs = F.transform(items, lambda item: F.from_json(item, "slug string")["slug"])
    return F.to_json(F.filter(slugs, lambda slug: slug.isNotNull() & (slug != "")))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is evaluated once, however often `use` refers to it."""
    return F.transform(F.array(value), use)[0]


def json_items(json_text: Column) -> Column:
    """Texts of the items of one JSON value: the items of an array, or the value itself.

    Wrapping the value in brackets makes trailing garbage visible: it is an error or a second
    item. Unparseable text gives NULL.
    """
    wrapped = F.from_json(F.concat(F.lit("["), json_text, F.lit("]")), "array<string>")
    return bound(
        bound(wrapped, lambda w: F.when(F.size(w) == 1, w[0])),
        lambda body: F.when(body.startswith("["), F.from_json(body, "array<string>")).when(
            body.isNotNull(), F.array(body)
        ),
    )


def json_object(json_text: Column, schema: str) -> Column:
    """One JSON object as a struct; NULL for arrays, scalars and anything unparseable."""
    wrapped = F.from_json(F.concat(F.lit("["), json_text, F.lit("]")), f"array<struct<{schema}>>")
    return bound(wrapped, lambda w: F.when(F.size(w) == 1, w[0]))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def micros_of(moment: datetime) -> int:
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def instant(moment: datetime) -> Column:
    """A timestamp literal; a datetime without zone is taken as UTC, whatever the session zone."""
    return F.expr(f"timestamp_micros({micros_of(moment)})")


def local_time(ts: Column, zone: str) -> Column:
    """The instant's wall-clock time in `zone`, without zone."""
    return F.convert_timezone(None, F.lit(zone), ts.cast("timestamp_ntz"))
