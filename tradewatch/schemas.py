"""Table schemas. Readers always pass one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from tradewatch import fixed

_KINDS = {
    "text": T.StringType(),
    "json": T.StringType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(*columns: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in columns])


def _with_field(schema: T.StructType, name: str, data_type: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, data_type)])


TRADES = _struct(
    ("source", "text"),
    ("market_id", "text"),
    ("trade_id", "text"),
    ("ts", "timestamp"),
    ("price", "double"),
    ("size", "double"),
    ("side", "text"),
    ("raw", "json"),
    ("ingested_at", "timestamp"),
)

CELLS = _struct(
    ("source", "text"),
    ("market_id", "text"),
    ("cell", "timestamp"),
    ("arrived", "timestamp"),
    ("n", "long"),
    ("mean_size", "double"),
    ("squares_size", "double"),
    ("mean_notional", "double"),
    ("squares_notional", "double"),
)

ALERTS = T.StructType(
    [
        *_struct(
            ("alert_id", "text"),
            ("series_ticker", "text"),
            ("series_title", "text"),
            ("source", "text"),
            ("title", "text"),
            ("market_id", "text"),
            ("trade_id", "text"),
        ).fields,
        T.StructField("trade_ts", T.TimestampNTZType()),
        *_struct(
            ("side", "text"),
            ("price", "double"),
            ("size", "double"),
            ("notional", "double"),
            ("size_zscore", "double"),
            ("notional_zscore", "double"),
            ("volume", "double"),
            ("volume_24h", "double"),
            ("reason", "text"),
            ("detected_at", "timestamp"),
            ("notified_at", "timestamp"),
            ("discord_thread_id", "text"),
        ).fields,
    ]
)

# Of an open alert's latest handing out: empty while it waits. The group's outcome stays after a failure, for late reports.
HANDED = _struct(
    ("handed_batch", "text"),
    ("handed_at", "timestamp"),
    ("group_pos", "long"),
    ("rank_in_group", "long"),
    ("is_starter", "bool"),
    ("reused_thread", "text"),
    ("answered_ok", "bool"),
    ("answered_thread", "text"),
    ("group_started", "bool"),
    ("group_thread", "text"),
)
PENDING = T.StructType([*ALERTS.fields, *HANDED.fields])

THREADS = _struct(
    ("discord_thread_id", "text"),
    ("alert_id", "text"),
    ("source", "text"),
    ("series_ticker", "text"),
    ("market_id", "text"),
    ("title", "text"),
    ("detected_at", "timestamp"),
    ("notified_at", "timestamp"),
)
RECENT_THREADS = _struct(("source", "text"), ("series_ticker", "text"), ("discord_thread_id", "text"), ("notified_at", "timestamp"))

MARKETS_A_STAGED = _struct(
    ("source", "text"), ("ticker", "text"), ("series_ticker", "text"), ("category", "text"), *fixed.MARKET_A_FIELDS
)
MARKETS_A = _with_field(MARKETS_A_STAGED, "resolved_at", T.TimestampType())

MARKETS_B_STAGED = _struct(
    ("source", "text"),
    ("event_id", "text"),
    ("event_ticker", "text"),
    ("event_slug", "text"),
    ("event_title", "text"),
    ("event_tag_slugs", "json"),
    ("outcomes_raw", "json"),
    ("outcome_prices_raw", "json"),
    ("clob_token_ids_raw", "json"),
    ("yes_token_id", "text"),
    ("no_token_id", "text"),
    ("yes_price", "double"),
    ("no_price", "double"),
    *((column, kind) for _, column, kind in fixed.MARKET_B_FIELDS),
)
MARKETS_B = _with_field(MARKETS_B_STAGED, "resolved_at", T.TimestampType())

SERIES = _with_field(
    _struct(("source", "text"), ("ticker", "text"), ("category", "text"), *fixed.SERIES_FIELDS),
    "resolved_at",
    T.TimestampType(),
)

DEBATES = _struct(
    ("debate_id", "text"),
    ("alert_id", "text"),
    ("source", "text"),
    ("series_ticker", "text"),
    ("market_id", "text"),
    ("title", "text"),
    ("started_at", "timestamp"),
    ("finished_at", "timestamp"),
    ("outcome", "text"),
    ("verdict", "json"),
    ("turn_count", "long"),
    ("total_cost_usd", "double"),
    ("cost_by_provider", "json"),
    ("transcript_gcs_uri", "text"),
    ("discord_thread_id", "text"),
    ("source_debate_id", "text"),
)

# One row per entry; `seq` orders the entries of a debate, `moderator` marks the moderator's.
TRANSCRIPTS = _struct(
    ("debate_id", "text"),
    ("seq", "long"),
    ("ts", "timestamp"),
    ("turn", "long"),
    ("moderator", "bool"),
    ("provider", "text"),
    ("model", "text"),
    ("text", "text"),
    ("input_tokens", "long"),
    ("output_tokens", "long"),
    ("search_count", "long"),
    ("cost_usd", "double"),
    ("error", "text"),
    ("decision", "text"),
    ("rationale", "text"),
    ("verdict", "json"),
)

REQUESTS = _struct(
    ("alert_id", "text"),
    ("source", "text"),
    ("series_ticker", "text"),
    ("market_id", "text"),
    ("title", "text"),
    ("thread_id", "text"),
)

SUBSCRIPTIONS = _struct(
    ("source", "text"), ("market_id", "text"), ("yes_token_id", "text"), ("no_token_id", "text"), ("position", "long")
)

LOGS = _struct(("event", "text"), ("idx", "long"), ("timestamp", "text"), ("level", "text"))

VERDICT = (
    "probability string, summary string, key_evidence array<string>,"
    " dissenters array<struct<agent: string, view: string>>"
)


def conform(df, schema: T.StructType):
    """Project to exactly the columns and types of `schema`; absent columns become NULL."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in schema.fields
        ]
    )

REJECTS = (
    T.StructType()
    .add("source", T.StringType())
    .add("outcome", T.StringType())
    .add("frame", T.StringType())
    .add("ingested_at", T.TimestampType())
)
