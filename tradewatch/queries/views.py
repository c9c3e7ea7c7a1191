"""Venue-shaped views of the generic test tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.functions.coerce import local_time
from tradewatch.plans.accounting import price_list, with_cost

_TABLES = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
        " o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table dealt by its key to at least three tasks a core, for queries that make a long text of each short row.

    A scan deals out bytes: a file of millions of short rows may be one task's, with all that is made of them.
    """
    tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return table(spark, sf_dir, name).repartition(tasks, key)


def latest(df: DataFrame, column: str) -> datetime:
    """The largest instant of a column as a literal, so that time bounds reach the scan."""
    micros = df.agg(F.max(F.unix_micros(column)).alias("m")).first()["m"]
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros or 0)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as trades of two venues; a market is a user."""
    delay = (F.col("event_id") * 37) % 3600
    return table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 2 == 0, "venue_a").otherwise("venue_b").alias("source"),
        F.concat(F.lit("m"), F.col("user_id")).alias("market_id"),
        F.col("event_id").cast("string").alias("trade_id"),
        "ts",
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("price"),
        F.col("value").alias("size"),
        F.when(F.col("event_type").isin("click", "view", "signup"), "yes").otherwise("no").alias("side"),
        F.col("props").alias("raw"),
        F.timestamp_micros(F.unix_micros("ts") + delay * 1000000).alias("ingested_at"),
    )


TRADES_SQL = """
trades AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'venue_a' ELSE 'venue_b' END AS source,
         'm' || user_id AS market_id,
         CAST(event_id AS VARCHAR) AS trade_id,
         event_id, event_type, user_id, ts,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS price,
         value AS size,
         CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'yes' ELSE 'no' END AS side,
         props AS raw,
         ts + to_seconds((event_id * 37) % 3600) AS ingested_at
  FROM events
), clock AS (SELECT max(ts) AS as_of FROM events)"""


def trades_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as trades whose ids repeat; a market is a part."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit("venue_b").alias("source"),
        F.concat(F.lit("p"), F.col("l_partkey")).alias("market_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
        F.col("l_shipdate").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("size"),
        F.when(F.col("l_returnflag") == "A", "yes").otherwise("no").alias("side"),
    )


TRADES_WIDE_SQL = """
trades AS (
  SELECT 'venue_b' AS source, 'p' || l_partkey AS market_id,
         l_orderkey || '-' || l_linenumber AS trade_id, l_shipdate AS ts,
         l_extendedprice / l_quantity AS price, l_quantity AS size,
         CASE WHEN l_returnflag = 'A' THEN 'yes' ELSE 'no' END AS side
  FROM lineitem
), clock AS (SELECT max(l_shipdate) AS as_of FROM lineitem)"""


def markets_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even customers as venue-A markets; the market segment is the series."""
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_custkey") % 2 == 0)
        .select(
            F.lit("venue_a").alias("source"),
            F.concat(F.lit("m"), F.col("c_custkey")).alias("ticker"),
            F.col("c_mktsegment").alias("series_ticker"),
            F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("title"),
            F.col("c_acctbal").alias("volume_fp"),
            (F.col("c_acctbal") / 8).alias("volume_24h_fp"),
        )
    )


def markets_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd customers as venue-B markets; the nation is the event."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_custkey") % 2 == 1)
        .join(nation, "c_nationkey", "left")
        .select(
            F.lit("venue_b").alias("source"),
            F.concat(F.lit("m"), F.col("c_custkey")).alias("id"),
            F.concat(F.lit("n"), F.col("c_nationkey")).alias("event_ticker"),
            F.col("n_name").alias("event_title"),
            F.concat(F.lit("will-"), F.lower("c_mktsegment"), F.lit("-rise")).alias("slug"),
            F.col("c_acctbal").alias("volume"),
            (F.col("c_acctbal") / 8).alias("volume_24h"),
        )
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .select("c_mktsegment")
        .distinct()
        .select(
            F.lit("venue_a").alias("source"),
            F.col("c_mktsegment").alias("ticker"),
            F.concat(F.lit("Series "), F.col("c_mktsegment")).alias("title"),
        )
    )


DIMENSIONS_SQL = """
markets_a AS (
  SELECT 'venue_a' AS source, 'm' || c_custkey AS ticker, c_mktsegment AS series_ticker,
         CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS title,
         c_acctbal AS volume_fp, c_acctbal / 8 AS volume_24h_fp
  FROM customer WHERE c_custkey % 2 = 0
), markets_b AS (
  SELECT 'venue_b' AS source, 'm' || c_custkey AS id, 'n' || c_nationkey AS event_ticker, n_name AS event_title,
         'will-' || lower(c_mktsegment) || '-rise' AS slug,
         'Will ' || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' Rise?' AS slug_title,
         c_acctbal AS volume, c_acctbal / 8 AS volume_24h
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 1
), series AS (
  SELECT DISTINCT c_mktsegment AS ticker, 'Series ' || c_mktsegment AS title FROM customer
)"""


def _json(*pairs: tuple[str, F.Column]) -> F.Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in pairs]))


def _k_price() -> F.Column:
    return (F.get_json_object("props", "$.k").cast("double") / 100).cast("string")


def frames_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of even users as venue-A frames, some of them broken by rule."""
    e = table(spark, sf_dir, "events").filter(F.col("user_id") % 2 == 0)
    key = F.col("event_id")
    message = _json(
        ("ts_ms", F.unix_millis("ts")),
        ("market_ticker", F.concat(F.lit("m"), F.col("user_id"))),
        ("trade_id", F.when(key % 89 != 0, key.cast("string"))),
        ("yes_price_dollars", F.when(key % 83 == 0, "abc").otherwise(_k_price())),
        ("count_fp", F.col("value").cast("string")),
        ("taker_side", F.when(key % 5 != 0, F.when(key % 2 == 0, "yes").otherwise("no"))),
    )
    kind = F.when(F.col("event_type") == "error", "error").when(key % 79 == 0, "subscribed").otherwise("trade")
    frame = F.concat(F.lit('{"type": "'), kind, F.lit('", "msg": '), message, F.lit("}"))
    return e.select(F.when(key % 97 == 0, F.substring(frame, 1, 20)).otherwise(frame).alias("value"))


def frames_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of odd users as venue-B frames: objects, arrays with a stray number, keep-alive lines."""
    e = table(spark, sf_dir, "events").filter(F.col("user_id") % 2 == 1)
    key = F.col("event_id")
    token = F.concat(
        F.when(key % 89 == 0, "z").when(F.col("event_type").isin("click", "view", "signup"), "y").otherwise("n"),
        F.col("user_id"),
    )
    kind = (
        F.when(F.col("event_type") == "error", "book")
        .when(key % 83 == 0, "tick_size_change")
        .when(key % 79 == 0, "market_resolved")
        .otherwise("last_trade_price")
    )
    event = _json(
        ("event_type", kind),
        ("asset_id", token),
        ("timestamp", F.unix_millis("ts").cast("string")),
        ("price", _k_price()),
        ("size", F.col("value").cast("string")),
        ("transaction_hash", F.concat(F.lit("0x"), F.hex(key))),
    )
    frame = (
        F.when(key % 101 == 0, "PONG")
        .when(key % 97 == 0, F.substring(event, 1, 20))
        .when(key % 3 == 0, F.concat(F.lit("["), event, F.lit(", 7]")))
        .otherwise(event)
    )
    return e.select(frame.alias("value"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokens per odd user; some YES tokens are claimed again by a later market."""
    users = table(spark, sf_dir, "events").filter(F.col("user_id") % 2 == 1).select("user_id").distinct()
    claims = F.when(
        F.col("user_id") % 50 == 1, F.array(F.lit("m"), F.lit("x"))
    ).otherwise(F.array(F.lit("m")))
    return users.select("user_id", F.posexplode(claims).alias("late", "prefix")).select(
        F.concat("prefix", "user_id").alias("market_id"),
        F.concat(F.lit("y"), F.col("user_id")).alias("yes_token_id"),
        F.when(F.col("late") == 0, F.concat(F.lit("n"), F.col("user_id"))).alias("no_token_id"),
        (F.col("user_id") + F.col("late") * 1000000).alias("position"),
    )


TOKENS_SQL = """
tokens AS (
  SELECT CASE WHEN late THEN 'x' ELSE 'm' END || user_id AS market_id, 'y' || user_id AS yes_token_id,
         CASE WHEN NOT late THEN 'n' || user_id END AS no_token_id
  FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 2 = 1), (VALUES (FALSE), (TRUE)) v(late)
  WHERE NOT late OR user_id % 50 = 1
)"""

FRAMES_A_SQL = """
frames_a AS (
  SELECT event_id, user_id, event_type,
         CASE WHEN event_id % 97 = 0 THEN 'bad_json'
              WHEN event_type = 'error' THEN 'error'
              WHEN event_id % 79 = 0 THEN 'other_type'
              WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'bad_trade'
              ELSE 'trade' END AS outcome,
         'venue_a' AS source, 'm' || user_id AS market_id, CAST(event_id AS VARCHAR) AS trade_id,
         date_trunc('millisecond', ts) AS ts,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS price,
         trunc(value) AS size,
         CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'yes' ELSE 'no' END AS side
  FROM events WHERE user_id % 2 = 0
)"""

FRAMES_B_SQL = """
frames_b AS (
  SELECT event_id, user_id, event_type,
         CASE WHEN event_id % 101 = 0 THEN 'keep_alive'
              WHEN event_id % 97 = 0 THEN 'bad_json'
              WHEN event_type = 'error' OR event_id % 83 = 0 THEN 'ignored_type'
              WHEN event_id % 79 = 0 THEN 'unknown_type'
              WHEN event_id % 89 = 0 THEN 'unknown_token'
              ELSE 'trade' END AS outcome,
         'venue_b' AS source,
         CASE WHEN user_id % 50 = 1 AND event_type IN ('click', 'view', 'signup') THEN 'x' ELSE 'm' END || user_id
           AS market_id,
         '0x' || upper(to_hex(event_id)) AS trade_id,
         date_trunc('millisecond', ts) AS ts,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS price,
         value AS size,
         CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'yes' ELSE 'no' END AS side
  FROM events WHERE user_id % 2 = 1
)"""


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger trades as recorded alerts; every third is notified already."""
    t = table(spark, sf_dir, "events")
    key, user = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("double") / 100
    series_no = user % 25
    rows = t.filter(k * F.col("value") > 20).select(
        F.sha2(F.concat(F.when(user % 2 == 0, "venue_a|").otherwise("venue_b|"), key.cast("string")), 256).alias(
            "alert_id"
        ),
        F.when(user % 11 == 0, F.lit(None)).when(user % 13 == 0, "").otherwise(F.concat(F.lit("S"), series_no)).alias(
            "series_ticker"
        ),
        F.when((user % 11 != 0) & (user % 13 != 0), F.concat(F.lit("Series "), series_no)).alias("series_title"),
        F.when(user % 2 == 0, "venue_a").otherwise("venue_b").alias("source"),
        F.when(user % 17 != 0, F.concat(F.lit("Market "), user)).alias("title"),
        F.concat(F.lit("m"), user).alias("market_id"),
        key.cast("string").alias("trade_id"),
        local_time(F.col("ts"), "America/Denver").alias("trade_ts"),
        F.when(F.col("event_type").isin("click", "view", "signup"), "yes").otherwise("no").alias("side"),
        k.alias("price"),
        F.col("value").alias("size"),
        (k * F.col("value")).alias("notional"),
        F.concat(F.lit("reason "), key).alias("reason"),
        F.col("ts").alias("detected_at"),
        F.when(key % 3 == 0, F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("notified_at"),
        F.when(key % 3 == 0, F.concat(F.lit("t"), key % 7)).alias("discord_thread_id"),
    )
    return schemas.conform(rows, schemas.ALERTS)


ALERTS_SQL = """
alerts AS (
  SELECT event_id, sha256(source || '|' || event_id) AS alert_id, series_ticker,
         CASE WHEN user_id % 11 <> 0 AND user_id % 13 <> 0 THEN 'Series ' || (user_id % 25) END AS series_title,
         source, CASE WHEN user_id % 17 <> 0 THEN 'Market ' || user_id END AS title, 'm' || user_id AS market_id,
         CAST(event_id AS VARCHAR) AS trade_id,
         timezone('America/Denver', timezone('UTC', ts)) AS trade_ts,
         side, price, size, price * size AS notional, 'reason ' || event_id AS reason,
         ts AS detected_at,
         CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 5 MINUTE END AS notified_at,
         CASE WHEN event_id % 3 = 0 THEN 't' || (event_id % 7) END AS discord_thread_id,
         coalesce(nullif(series_ticker, ''), 'm' || user_id) AS thread_key
  FROM (
    SELECT *, CASE WHEN user_id % 2 = 0 THEN 'venue_a' ELSE 'venue_b' END AS source,
           CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 13 = 0 THEN '' ELSE 'S' || (user_id % 25) END
             AS series_ticker,
           CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'yes' ELSE 'no' END AS side,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS price, value AS size
    FROM events)
  WHERE price * size > 20
), clock AS (SELECT max(ts) AS as_of FROM events)"""


def deliveries(queue: DataFrame) -> DataFrame:
    """What a sender would report for a queue: one group in four fails, one in five opens no thread."""
    opened = F.when(
        F.col("is_starter") & (F.col("group_pos") % 5 != 0), F.concat(F.lit("new-"), F.col("group_pos").cast("string"))
    )
    return queue.select(
        "alert_id",
        F.coalesce("thread_id", opened).alias("thread_id"),
        ((F.col("group_pos") % 4 != 0) & (F.col("rank_in_group") % 7 != 0)).alias("ok"),
    )


def debates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and signups as finished debates; only those of views reached consensus."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "signup"))
    user = F.col("user_id")
    rows = e.select(
        F.concat(F.lit("d"), F.col("event_id")).alias("debate_id"),
        F.concat(F.lit("a"), F.col("event_id")).alias("alert_id"),
        F.when(user % 2 == 0, "venue_a").otherwise("venue_b").alias("source"),
        F.when(user % 3 == 0, F.concat(F.lit("S"), user % 40)).alias("series_ticker"),
        F.concat(F.lit("m"), user).alias("market_id"),
        F.concat(F.lit("Market "), user).alias("title"),
        (F.col("ts") - F.expr("INTERVAL 10 MINUTES")).alias("started_at"),
        F.col("ts").alias("finished_at"),
        F.when(F.col("event_type") == "view", "consensus").otherwise("deadlock").alias("outcome"),
        F.concat(F.lit('{"probability":'), (F.col("event_id") % 100 / 100).cast("string"), F.lit("}")).alias("verdict"),
        (F.col("event_id") % 4 + 1).alias("turn_count"),
        (F.col("event_id") % 50 / 100).alias("total_cost_usd"),
        F.lit("{}").alias("cost_by_provider"),
        F.concat(F.lit("transcripts/d"), F.col("event_id")).alias("transcript_gcs_uri"),
    )
    return schemas.conform(rows, schemas.DEBATES)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as debate requests; some lack a title and are invalid."""
    user = F.col("user_id")
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.concat(F.lit("a"), F.col("event_id")).alias("alert_id"),
            F.when(user % 2 == 0, "venue_a").otherwise("venue_b").alias("source"),
            F.when(user % 3 == 0, F.concat(F.lit("S"), user % 40)).alias("series_ticker"),
            F.concat(F.lit("m"), user).alias("market_id"),
            F.when(F.col("event_id") % 10 == 0, "").otherwise(F.concat(F.lit("Market "), user)).alias("title"),
            F.concat(F.lit("t"), user % 7).alias("thread_id"),
            F.col("ts").alias("requested_at"),
        )
    )


DEBATES_SQL = """
debates AS (
  SELECT 'd' || event_id AS debate_id, CASE WHEN user_id % 2 = 0 THEN 'venue_a' ELSE 'venue_b' END AS source,
         CASE WHEN user_id % 3 = 0 THEN 'S' || (user_id % 40) END AS series_ticker, 'm' || user_id AS market_id,
         'Market ' || user_id AS title, ts AS finished_at,
         CASE WHEN event_type = 'view' THEN 'consensus' ELSE 'deadlock' END AS outcome,
         'transcripts/d' || event_id AS transcript_gcs_uri
  FROM events WHERE event_type IN ('view', 'signup')
), requests AS (
  SELECT 'a' || event_id AS alert_id, CASE WHEN user_id % 2 = 0 THEN 'venue_a' ELSE 'venue_b' END AS source,
         CASE WHEN user_id % 3 = 0 THEN 'S' || (user_id % 40) END AS series_ticker, 'm' || user_id AS market_id,
         CASE WHEN event_id % 10 = 0 THEN '' ELSE 'Market ' || user_id END AS title, 't' || (user_id % 7) AS thread_id,
         ts AS requested_at
  FROM events WHERE event_type = 'purchase'
), found AS (
  SELECT r.*, d.debate_id, d.finished_at, d.market_id AS source_market_id, d.transcript_gcs_uri,
         row_number() OVER (PARTITION BY r.alert_id ORDER BY d.finished_at DESC, d.debate_id DESC) AS rn
  FROM requests r LEFT JOIN debates d
    ON d.source = r.source AND coalesce(d.series_ticker, d.market_id) = coalesce(r.series_ticker, r.market_id)
   AND d.outcome = 'consensus' AND d.finished_at > r.requested_at - INTERVAL 3 HOUR
   AND d.finished_at <= r.requested_at
  WHERE r.title <> ''
)"""


PRICES = (("user", 3.0, 15.0, 0.01), ("assistant", 2.5, 10.0, 0.025), ("system", 1.25, 5.0, 0.0))
BUDGET = 0.04


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as priced debate transcripts, two entries and one moderator entry per turn."""
    c = table(spark, sf_dir, "conversations").withColumn("debate_turn", F.floor(F.col("turn") / 2) + 1)
    agents = c.select(
        F.col("conv_id").cast("string").alias("debate_id"),
        F.col("turn").alias("seq"),
        F.col("debate_turn").alias("turn"),
        F.lit(False).alias("moderator"),
        F.col("role").alias("provider"),
        F.col("role").alias("rate_key"),
        "text",
        F.floor(F.length("text") / 4).alias("input_tokens"),
        F.floor(F.length("text") / 4).alias("output_tokens"),
        (F.col("turn") % 3).alias("search_count"),
        F.when(F.length("text") % 11 == 0, "timeout").alias("error"),
        F.lit(None).cast("string").alias("decision"),
    )
    ruled = (F.col("conv_id") * 7 + F.col("debate_turn")) % 5
    moderators = (
        c.select("conv_id", "debate_turn")
        .distinct()
        .select(
            F.col("conv_id").cast("string").alias("debate_id"),
            F.lit(None).cast("bigint").alias("seq"),
            F.col("debate_turn").alias("turn"),
            F.lit(True).alias("moderator"),
            F.lit("moderator").alias("provider"),
            F.lit("user").alias("rate_key"),
            F.lit(None).cast("string").alias("text"),
            F.lit(100).cast("bigint").alias("input_tokens"),
            F.lit(50).cast("bigint").alias("output_tokens"),
            F.lit(0).cast("bigint").alias("search_count"),
            F.lit(None).cast("string").alias("error"),
            F.when(ruled == 0, "consensus").when(ruled == 1, "deadlock").otherwise("continue").alias("decision"),
        )
    )
    entries = agents.unionByName(moderators).withColumn("cost_usd", F.lit(0.0))
    return schemas.conform(with_cost(entries, price_list(spark, PRICES), "rate_key"), schemas.TRANSCRIPTS)


TRANSCRIPTS_SQL = """
prices AS (
  SELECT * FROM (VALUES ('user', 3.0::DOUBLE, 15.0::DOUBLE, 0.01::DOUBLE), ('assistant', 2.5, 10.0, 0.025),
                        ('system', 1.25, 5.0, 0.0)) p(rate_key, input_rate, output_rate, search_rate)
), entries AS (
  SELECT CAST(conv_id AS VARCHAR) AS debate_id, turn AS seq, turn // 2 + 1 AS turn, FALSE AS moderator,
         role AS provider, role AS rate_key, text, length(text) // 4 AS input_tokens, length(text) // 4 AS output_tokens,
         turn % 3 AS search_count, CASE WHEN length(text) % 11 = 0 THEN 'timeout' END AS error, NULL AS decision
  FROM conversations
  UNION ALL
  SELECT DISTINCT CAST(conv_id AS VARCHAR), NULL, turn // 2 + 1, TRUE, 'moderator', 'user', NULL, 100, 50, 0, NULL,
         CASE (conv_id * 7 + turn // 2 + 1) % 5 WHEN 0 THEN 'consensus' WHEN 1 THEN 'deadlock' ELSE 'continue' END
  FROM conversations
), transcripts AS (
  SELECT e.*, coalesce(input_tokens / 1e6::DOUBLE * input_rate + output_tokens / 1e6::DOUBLE * output_rate
                       + search_count * search_rate, 0) AS cost_usd
  FROM entries e LEFT JOIN prices USING (rate_key)
), turns AS (
  SELECT debate_id, turn,
         coalesce(sum(cost_usd) FILTER (NOT moderator), 0) AS agent_cost,
         coalesce(sum(cost_usd) FILTER (moderator), 0) AS moderator_cost,
         coalesce(bool_and(error IS NOT NULL) FILTER (NOT moderator), FALSE) AS all_failed,
         max(decision) AS decision
  FROM transcripts GROUP BY debate_id, turn
), spent AS (
  SELECT *, sum(agent_cost + moderator_cost) OVER w AS spent_after_turn,
         sum(agent_cost + moderator_cost) OVER w - moderator_cost AS spent_after_agents
  FROM turns WINDOW w AS (PARTITION BY debate_id ORDER BY turn ROWS UNBOUNDED PRECEDING)
), flagged AS (
  SELECT *, round(spent_after_agents, 9) >= round(0.04 * 0.7, 9) AS near_exhaustion,
         round(spent_after_turn, 9) >= 0.04 AS exhausted
  FROM spent
), endings AS (
  SELECT *, CASE WHEN all_failed THEN 'error' WHEN decision IN ('consensus', 'deadlock') THEN decision
                 WHEN exhausted THEN 'budget_exhausted' END AS ending,
         CASE WHEN all_failed THEN spent_after_agents ELSE spent_after_turn END AS spent
  FROM flagged
), outcomes AS (
  SELECT debate_id, coalesce(arg_min(ending, turn) FILTER (ending IS NOT NULL), 'open') AS outcome,
         coalesce(min(turn) FILTER (ending IS NOT NULL), max(turn)) AS turn_count,
         coalesce(arg_min(spent, turn) FILTER (ending IS NOT NULL), arg_max(spent, turn)) AS total_cost_usd
  FROM endings GROUP BY debate_id
)"""
