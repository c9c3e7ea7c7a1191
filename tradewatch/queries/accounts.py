"""Registered queries on debate requests, costs, outcomes and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch import fixed
from tradewatch.functions.text import (
    agent_message,
    agent_prompt,
    moderator_message,
    moderator_prompt,
    parse_decision,
    verdict_message,
)
from tradewatch.plans.accounting import (
    budget_flags,
    cost_by_provider,
    debate_accounts,
    debate_rows,
    prompt_lines,
    prompt_prefixes,
    turns,
)
from tradewatch.plans.notify import debate_requests
from tradewatch.plans.requests import (
    cached_label,
    cached_rows,
    command_requests,
    fresh_runs,
    reuse_lookup,
    valid_requests,
)
from tradewatch.queries import notify, views
from tradewatch.queries.shape import fixed_sql, r6, r6_sql, wall


def _looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reuse_lookup(valid_requests(views.requests(spark, sf_dir)), views.debates(spark, sf_dir))


def _reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _looked_up(spark, sf_dir)
        .filter(F.col("found").isNotNull())
        .select(
            "alert_id",
            "source",
            "market_id",
            F.col("found.debate_id").alias("debate_id"),
            wall("found.finished_at", "finished_at"),
            F.col("found.source_market_id").alias("source_market_id"),
        )
    )


def _cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cached_rows(_looked_up(spark, sf_dir)).select(
        "alert_id",
        "source",
        "series_ticker",
        "market_id",
        "title",
        wall("started_at"),
        wall("finished_at"),
        "outcome",
        "turn_count",
        "total_cost_usd",
        "transcript_gcs_uri",
        "discord_thread_id",
        "source_debate_id",
    )


def _fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fresh_runs(_looked_up(spark, sf_dir)).select("alert_id", "source", "market_id", wall("requested_at"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _looked_up(spark, sf_dir).filter(F.col("found").isNotNull())
    return found.select("alert_id", cached_label(found).alias("label"))


def _commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as commands: every third asks a question of its own, the others refer to a thread."""
    key = F.col("c_custkey")
    return views.table(spark, sf_dir, "customer").select(
        key.alias("command_id"),
        F.concat(F.lit("t"), key % 9).alias("thread_id"),
        F.when(key % 3 == 0, F.concat(F.lit(" Will "), "c_name", F.lit(" rise? "))).when(key % 3 == 1, "  ").alias(
            "question"
        ),
    )


def _all_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = command_requests(_commands(spark, sf_dir), views.alerts(spark, sf_dir))
    return valid_requests(asked.unionByName(debate_requests(notify.settled(spark, sf_dir))))


def _cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = cost_by_provider(views.transcripts(spark, sf_dir))
    per_provider = [r6_map(p) for p in ("user", "assistant", "system", "moderator")]
    return costs.select("debate_id", r6("total_cost_usd"), *per_provider)


def r6_map(provider: str) -> F.Column:
    usd = F.coalesce(F.try_element_at("cost_by_provider", F.lit(provider)), F.lit(0.0))
    return F.round(usd + 1e-9, 6).alias(f"{provider}_usd")


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget_flags(turns(views.transcripts(spark, sf_dir)), views.BUDGET).select(
        "debate_id", "turn", r6("spent_after_agents"), r6("spent_after_turn"), "near_exhaustion", "exhausted"
    )


def _outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = debate_accounts(views.transcripts(spark, sf_dir), views.BUDGET)
    booked = F.aggregate(F.map_values("cost_by_provider"), F.lit(0.0), lambda a, x: a + x)
    return accounts.withColumn("booked", booked).select(
        "debate_id", "outcome", "turn_count", r6("total_cost_usd"), r6("booked", "booked_usd")
    )


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished debates as rows for the debates table."""
    accounts = debate_accounts(views.transcripts(spark, sf_dir), views.BUDGET)
    asked = views.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    requests = asked.select(
        F.col("conv_id").cast("string").alias("debate_id"),
        F.concat(F.lit("a"), "conv_id").alias("alert_id"),
        F.lit("manual").alias("source"),
        F.lit(None).cast("string").alias("series_ticker"),
        F.concat(F.lit("a"), "conv_id").alias("market_id"),
        F.col("text").alias("title"),
        start.alias("started_at"),
        F.timestamp_micros(F.unix_micros(start) + F.col("conv_id") * 1000000).alias("finished_at"),
        F.concat(F.lit("t"), F.col("conv_id") % 7).alias("thread_id"),
    )
    return debate_rows(accounts, requests).select(
        "debate_id", "alert_id", "source", "market_id", "title", wall("started_at"), wall("finished_at"), "outcome",
        "turn_count", r6("total_cost_usd"),
        *[
            F.round(F.coalesce(F.try_element_at(F.from_json("cost_by_provider", "map<string, double>"), F.lit(p)), F.lit(0.0)) + 1e-9, 6).alias(f"{p}_usd")
            for p in ("user", "assistant", "system", "moderator")
        ],
        "discord_thread_id",
    )


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation texts as moderator answers, with JSON of several kinds put into them."""
    key = F.col("conv_id") * 31 + F.col("turn")
    block = (
        F.when(key % 6 == 0, '{"decision": "consensus", "rationale": "agreed", "verdict": {"probability": 0.4}}')
        .when(key % 6 == 1, '{"decision": "deadlock", "rationale": "stuck"}')
        .when(key % 6 == 2, '{"decision": "maybe", "rationale": "odd"}')
        .when(key % 6 == 3, '{"decision": "consensus", ')
        .when(key % 6 == 4, '{"decision": "consensus"} and {"decision": "deadlock"}')
        .otherwise("")
    )
    error = F.when(key % 35 == 0, "timeout")
    plain = F.translate("text", "{}", "()")
    return views.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat(plain, F.lit("\n"), block, F.lit("\n"), plain).alias("text"), error.alias("error")
    )


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _answers(spark, sf_dir).withColumn("d", parse_decision(F.col("text"), F.col("error")))
    return parsed.select("conv_id", "turn", "d.decision", "d.rationale", "d.verdict")


def _prompt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_lines(views.transcripts(spark, sf_dir))


def _prompt_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_prefixes(views.transcripts(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = views.transcripts(spark, sf_dir)
    agent = agent_message(*[F.col(c) for c in ("provider", "turn", "search_count", "cost_usd", "text")])
    moderator = moderator_message(*[F.col(c) for c in ("turn", "decision", "cost_usd", "rationale")])
    return entries.select(
        "debate_id", "turn", "provider", F.when(F.col("moderator"), moderator).otherwise(agent).alias("message")
    ).filter(F.col("message").isNotNull())


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    debates = views.debates(spark, sf_dir)
    return debates.select(
        "debate_id",
        verdict_message(F.col("verdict"), F.col("outcome"), F.lit(None).cast("string")).alias("message"),
    )


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled prompts of every asked turn, for agents and moderator."""
    entries = views.transcripts(spark, sf_dir)
    question = F.concat(F.lit("Debate "), "debate_id")
    flags = budget_flags(turns(entries), views.BUDGET).select("debate_id", "turn", "spent_after_agents", "near_exhaustion")
    seen = prompt_lines(entries).withColumnRenamed("turn", "of_turn").join(prompt_prefixes(entries), "debate_id")
    shown = seen.filter(F.col("line_no") <= F.col("moderator_lines")).groupBy("debate_id", "turn", "agent_lines").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("lines")
    )
    text = F.transform("lines", lambda x: x["line"])
    agents = F.slice(text, 1, F.col("agent_lines").cast("int"))
    spent, limit = F.round(F.col("spent_after_agents"), 9), F.lit(views.BUDGET)
    return shown.join(flags, ["debate_id", "turn"]).select(
        "debate_id",
        "turn",
        agent_prompt(question, agents).alias("agent_prompt"),
        moderator_prompt(question, text, F.col("turn"), spent, limit, F.col("near_exhaustion")).alias("moderator_prompt"),
    )


def _verdict_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts with and without each part, fresh and reused, some with a probability in words."""
    k = F.col("event_id")
    said = F.when(k % 5 == 0, F.lit("likely")).when(k % 5 < 3, F.format_string("0.%02d", k % 100))
    evidence = F.transform(F.sequence(F.lit(1), (k % 8 + 1).cast("int")), lambda x: F.concat(F.lit("point "), x.cast("string")))
    verdict = F.struct(
        said.alias("probability"),
        F.when(k % 3 == 0, F.concat(F.lit("summary "), k)).alias("summary"),
        F.when(k % 4 < 3, evidence).alias("key_evidence"),
        F.when(k % 7 < 2, F.array(F.struct(F.lit("A").alias("agent"), F.lit("no").alias("view")))).alias("dissenters"),
    )
    rows = views.table(spark, sf_dir, "events").select(
        k.alias("verdict_id"),
        F.when(k % 11 != 0, F.to_json(verdict)).alias("verdict"),
        F.when(k % 6 == 0, "deadlock").when(k % 6 == 1, "error").when(k % 6 == 2, "budget_exhausted").otherwise("consensus").alias("outcome"),
        F.when(k % 9 == 0, "09:05 UTC").alias("cached_from"),
    )
    message = verdict_message(F.col("verdict"), F.col("outcome"), F.col("cached_from"))
    return rows.select("verdict_id", message.alias("message"))


def _text_sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


QUERIES = {
    "assembled_prompts": _prompts,
    "verdict_variants": _verdict_variants,
    "reuse_lookup": _reuse,
    "cached_debate_rows": _cached,
    "fresh_debate_runs": _fresh,
    "cached_from_labels": _labels,
    "all_requests": _all_requests,
    "debate_cost": _cost,
    "debate_budget_flags": _flags,
    "debate_outcome": _outcome,
    "debate_rows": _rows,
    "decision_parse": _decisions,
    "prompt_lines": _prompt_lines,
    "prompt_snapshot": _prompt_prefixes,
    "message_render": _messages,
    "verdict_render": _verdicts,
}

_COST_COLUMNS = ", ".join(
    r6_sql(f"coalesce(sum(cost_usd) FILTER (provider = '{p}'), 0)", f"{p}_usd")
    for p in ("user", "assistant", "system", "moderator")
)

ORACLES = {
    "reuse_lookup": f"""WITH {views.DEBATES_SQL}
SELECT alert_id, source, market_id, debate_id, finished_at, source_market_id
FROM found WHERE rn = 1 AND debate_id IS NOT NULL""",
    "cached_debate_rows": f"""WITH {views.DEBATES_SQL}
SELECT alert_id, source, series_ticker, market_id, title, requested_at AS started_at, requested_at AS finished_at,
       'cached' AS outcome, 0::BIGINT AS turn_count, 0::DOUBLE AS total_cost_usd, transcript_gcs_uri,
       thread_id AS discord_thread_id, debate_id AS source_debate_id
FROM found WHERE rn = 1 AND debate_id IS NOT NULL""",
    "fresh_debate_runs": f"""WITH {views.DEBATES_SQL}
SELECT alert_id, source, market_id, requested_at FROM found WHERE debate_id IS NULL""",
    "cached_from_labels": f"""WITH {views.DEBATES_SQL}
SELECT alert_id, strftime(finished_at, '%H:%M UTC')
       || CASE WHEN source_market_id <> market_id
               THEN '; originally debated for: _Market ' || substr(source_market_id, 2) || '_' ELSE '' END AS label
FROM found WHERE rn = 1 AND debate_id IS NOT NULL""",
    "all_requests": f"""{notify.REQUESTS_SQL}, latest AS (
  SELECT * FROM alerts WHERE discord_thread_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY discord_thread_id ORDER BY detected_at DESC, alert_id DESC) = 1
), manual AS (
  SELECT 'manual-' || left(sha256('manual|' || c_custkey), 32) AS alert_id, 'Will ' || c_name || ' rise?' AS title,
         't' || (c_custkey % 9) AS thread_id
  FROM customer WHERE c_custkey % 3 = 0
), asked AS (
  SELECT alert_id, 'manual' AS source, NULL AS series_ticker, alert_id AS market_id, title, thread_id FROM manual
  UNION ALL
  SELECT alert_id, source, series_ticker, market_id, title, discord_thread_id
  FROM customer JOIN latest ON discord_thread_id = 't' || (c_custkey % 9) WHERE c_custkey % 3 <> 0
  UNION ALL
  SELECT alert_id, source, series_ticker, market_id, title, group_thread FROM chosen WHERE rn = 1
)
SELECT * FROM asked WHERE coalesce(title, '') <> ''""",
    "debate_cost": f"""WITH {views.TRANSCRIPTS_SQL}
SELECT debate_id, {r6_sql("sum(cost_usd)", "total_cost_usd")}, {_COST_COLUMNS}
FROM transcripts GROUP BY debate_id""",
    "debate_budget_flags": f"""WITH {views.TRANSCRIPTS_SQL}
SELECT debate_id, turn, {r6_sql("spent_after_agents", "spent_after_agents")},
       {r6_sql("spent_after_turn", "spent_after_turn")}, near_exhaustion, exhausted
FROM flagged""",
    "debate_outcome": f"""WITH {views.TRANSCRIPTS_SQL}
SELECT debate_id, outcome, turn_count, {r6_sql("total_cost_usd", "total_cost_usd")},
       {r6_sql("total_cost_usd", "booked_usd")}
FROM outcomes""",
    "debate_rows": f"""WITH {views.TRANSCRIPTS_SQL}
, asked AS (SELECT conv_id, arg_min(text, turn) AS text FROM conversations GROUP BY conv_id), providers AS (
  SELECT debate_id, {_COST_COLUMNS} FROM transcripts t JOIN outcomes o USING (debate_id)
  WHERE t.turn <= o.turn_count AND NOT (outcome = 'error' AND t.turn = o.turn_count AND moderator) GROUP BY debate_id
)
SELECT debate_id, 'a' || debate_id AS alert_id, 'manual' AS source, 'a' || debate_id AS market_id,
       text AS title, TIMESTAMP '2024-01-01' AS started_at,
       TIMESTAMP '2024-01-01' + to_seconds(conv_id) AS finished_at, outcome, turn_count,
       {r6_sql("total_cost_usd", "total_cost_usd")},
       user_usd, assistant_usd, system_usd, moderator_usd, 't' || (conv_id % 7) AS discord_thread_id
FROM outcomes JOIN asked ON debate_id = CAST(conv_id AS VARCHAR) JOIN providers USING (debate_id)""",
    "assembled_prompts": f"""WITH {views.TRANSCRIPTS_SQL}, lines AS (
  SELECT debate_id, seq, turn, '--- Turn ' || turn || ' — ' || provider || ' ---' || chr(10)
         || coalesce(nullif(text, ''), '[error: ' || error || ']', '') AS line
  FROM transcripts WHERE NOT moderator
), asked AS (SELECT DISTINCT debate_id, turn FROM lines), shown AS (
  SELECT a.debate_id, a.turn, string_agg(line, chr(10) ORDER BY seq) FILTER (l.turn < a.turn) AS before,
         string_agg(line, chr(10) ORDER BY seq) AS upto
  FROM asked a JOIN lines l ON l.debate_id = a.debate_id AND l.turn <= a.turn GROUP BY a.debate_id, a.turn
)
SELECT debate_id, turn,
       'QUESTION: Debate ' || debate_id || chr(10) || chr(10) || CASE WHEN before IS NULL THEN {_text_sql(fixed.INITIAL)}
         ELSE 'PRIOR TURNS:' || chr(10) || before || chr(10) || chr(10) || {_text_sql(fixed.REFINE)} END AS agent_prompt,
       'QUESTION: Debate ' || debate_id || chr(10) || 'TURN: ' || turn || chr(10) || 'BUDGET: $'
         || {fixed_sql("round(spent_after_agents, 9)", 3)} || ' / $0.04 used' || chr(10)
         || CASE WHEN near_exhaustion THEN {_text_sql(fixed.WRAP_UP)} || chr(10) ELSE '' END || chr(10)
         || 'DEBATE TRANSCRIPT:' || chr(10) || upto || chr(10) || chr(10) || {_text_sql(fixed.ASK_DECISION)} AS moderator_prompt
FROM shown JOIN flagged USING (debate_id, turn)""",
    "verdict_variants": """
WITH v AS (SELECT event_id AS k FROM events), parts AS (
  SELECT k, CASE WHEN k % 9 = 0 THEN '**Debate verdict (cached from 09:05 UTC)**' ELSE '**Debate verdict — '
           || CASE k % 6 WHEN 0 THEN 'deadlock' WHEN 1 THEN 'error' WHEN 2 THEN 'budget exhausted' ELSE 'consensus' END || '**' END AS head,
         CASE WHEN k % 5 = 0 THEN '**Probability YES: likely**' WHEN k % 5 < 3 THEN '**Probability YES: ' || (k % 100) || '%**' END AS prob,
         CASE WHEN k % 3 = 0 THEN 'summary ' || k END AS summary,
         CASE WHEN k % 4 < 3 THEN chr(10) || '_Key evidence:_' || chr(10)
           || array_to_string([('- point ' || i) FOR i IN range(1, k % 8 + 2)], chr(10)) END AS evidence,
         CASE WHEN k % 7 < 2 THEN chr(10) || '_Dissenters:_' || chr(10) || '- **A**: no' END AS dissent
  FROM v
)
SELECT k AS verdict_id, CASE WHEN k % 11 = 0 OR (k % 5 > 2 AND k % 3 <> 0 AND k % 4 = 3 AND k % 7 > 1)
         THEN concat_ws(chr(10), head, '_No verdict produced._')
         ELSE concat_ws(chr(10), head, prob, summary, evidence, dissent) END AS message
FROM parts""",
    "message_render": f"""WITH {views.TRANSCRIPTS_SQL}, bodies AS (
  SELECT *, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') AS body,
         upper(left(provider, 1)) || substr(provider, 2) AS label
  FROM transcripts
), messages AS (
  SELECT debate_id, turn, provider,
         CASE WHEN moderator
              THEN '**Moderator — Turn ' || turn || '**  ·  decision: `' || decision || '`  ·  cost: $'
                   || {fixed_sql("cost_usd", 4)}
              WHEN body <> ''
              THEN '**' || label || ' — Turn ' || turn || '**  ·  searches: ' || search_count || '  ·  cost: $'
                   || {fixed_sql("cost_usd", 4)} || chr(10) || body END AS message
  FROM bodies
)
SELECT debate_id, turn, provider, message FROM messages WHERE message IS NOT NULL""",
    "verdict_render": f"""
SELECT 'd' || event_id AS debate_id,
       '**Debate verdict — ' || CASE event_type WHEN 'view' THEN 'consensus' ELSE 'deadlock' END || '**' || chr(10)
         || '**Probability YES: ' || {fixed_sql("CAST(event_id % 100 AS DOUBLE) / 100 * 100", 0)} || '%**' AS message
FROM events WHERE event_type IN ('view', 'signup')""",
    "decision_parse": """
WITH keyed AS (SELECT conv_id, turn, conv_id * 31 + turn AS k FROM conversations)
SELECT conv_id, turn,
       CASE WHEN k % 35 = 0 THEN 'continue' WHEN k % 6 = 0 THEN 'consensus' WHEN k % 6 = 1 THEN 'deadlock'
            ELSE 'continue' END AS decision,
       CASE WHEN k % 35 = 0 THEN 'moderator error: timeout' WHEN k % 6 = 0 THEN 'agreed' WHEN k % 6 = 1 THEN 'stuck'
            WHEN k % 6 = 2 THEN 'odd' WHEN k % 6 = 4 THEN 'moderator JSON parse failed'
            ELSE 'moderator did not return JSON' END AS rationale,
       CASE WHEN k % 35 <> 0 AND k % 6 = 0 THEN '{"probability":0.4}' END AS verdict
FROM keyed""",
    "prompt_lines": f"""WITH {views.TRANSCRIPTS_SQL}
SELECT debate_id, row_number() OVER (PARTITION BY debate_id ORDER BY seq) AS line_no, turn,
       '--- Turn ' || turn || ' — ' || provider || ' ---' || chr(10)
         || coalesce(nullif(text, ''), '[error: ' || error || ']', '') AS line
FROM transcripts WHERE NOT moderator""",
    "prompt_snapshot": f"""WITH {views.TRANSCRIPTS_SQL}, counted AS (
  SELECT debate_id, turn, count(*) AS n FROM transcripts WHERE NOT moderator GROUP BY ALL
)
SELECT debate_id, turn, CAST(sum(n) OVER w - n AS BIGINT) AS agent_lines, CAST(sum(n) OVER w AS BIGINT) AS moderator_lines
FROM counted WINDOW w AS (PARTITION BY debate_id ORDER BY turn)""",
}
