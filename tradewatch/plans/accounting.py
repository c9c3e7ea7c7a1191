"""Accounts of debates: entry costs, budgets, outcomes and prompt snapshots from transcripts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch import fixed
from tradewatch.functions.coerce import blank_to_null
from tradewatch.functions.text import entry_line
from tradewatch.operators.skew import running_sums, salted_join

# Amounts are compared at this many decimals, so that the order of additions does not matter.
_CENTS = 9


def price_list(spark: SparkSession, rates: Sequence[tuple] = fixed.PRICE_LIST) -> DataFrame:
    return spark.createDataFrame(
        list(rates), "provider string, input_per_mtok double, output_per_mtok double, search_per_call double"
    )


def with_cost(entries: DataFrame, prices: DataFrame, rate_key: str = "provider", cost: str = "cost_usd") -> DataFrame:
    """Entries with their token and search cost; a provider without price costs nothing.

    `rate_key` names the column with the provider whose rates apply; the moderator, for example, is
    charged at its model's rates but booked under its own name.
    """
    rates = prices.select(F.col("provider").alias("__rate"), "input_per_mtok", "output_per_mtok", "search_per_call")
    amount = (
        F.col("input_tokens") / 1e6 * F.col("input_per_mtok")
        + F.col("output_tokens") / 1e6 * F.col("output_per_mtok")
        + F.col("search_count") * F.col("search_per_call")
    )
    keyed = entries.withColumn("__rate", F.col(rate_key)).drop(cost)
    return (
        salted_join(keyed, rates, ["__rate"], "left")
        .withColumn(cost, F.coalesce(amount, F.lit(0.0)))
        .select(*[c for c in entries.columns if c != cost], cost)
    )


def cost_by_provider(entries: DataFrame, booking: str = "provider") -> DataFrame:
    """Total and per-provider cost of every debate. The map has one entry per provider."""
    per_provider = entries.groupBy("debate_id", booking).agg(F.sum("cost_usd").alias("usd"))
    return per_provider.groupBy("debate_id").agg(
        F.sum("usd").alias("total_cost_usd"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(booking), "usd")))).alias("cost_by_provider"),
    )


def turns(entries: DataFrame) -> DataFrame:
    """One row per debate and turn: costs of both sides, failures, the moderator's decision.

    `entries` are transcript rows with `moderator`, `provider`, `cost_usd`, `error` and, for the
    moderator's, `decision` and `verdict`.
    """
    agent = ~F.coalesce("moderator", F.lit(False))
    failed = blank_to_null(F.col("error")).isNotNull()
    return entries.groupBy("debate_id", "turn").agg(
        F.coalesce(F.sum(F.when(agent, F.col("cost_usd"))), F.lit(0.0)).alias("agent_cost"),
        F.coalesce(F.sum(F.when(~agent, F.col("cost_usd"))), F.lit(0.0)).alias("moderator_cost"),
        F.coalesce(F.bool_and(F.when(agent, failed)), F.lit(False)).alias("all_failed"),
        F.max(F.when(~agent, F.col("decision"))).alias("decision"),
        F.max(F.when(~agent, F.col("verdict"))).alias("verdict"),
    )


def budget_flags(turn_rows: DataFrame, limit_usd: float = 0.50, warn_fraction: float = 0.7) -> DataFrame:
    """Running spend per turn. The warning is read after the agents' charge, the cap after the moderator's."""
    charged = turn_rows.withColumn("turn_cost", F.col("agent_cost") + F.col("moderator_cost"))
    spent = running_sums(charged, ["debate_id"], "turn", ["turn_cost"])
    before = F.col("run_turn_cost") - F.col("turn_cost")
    return (
        spent.withColumn("spent_after_agents", before + F.col("agent_cost"))
        .withColumnRenamed("run_turn_cost", "spent_after_turn")
        .withColumn("near_exhaustion", F.round("spent_after_agents", _CENTS) >= round(limit_usd * warn_fraction, _CENTS))
        .withColumn("exhausted", F.round("spent_after_turn", _CENTS) >= round(limit_usd, _CENTS))
        .drop("turn_cost")
    )


def outcomes(flagged: DataFrame) -> DataFrame:
    """How and when every debate ended; one without a terminating turn is `open` at its last turn.

    Each turn is tested for: all agents failed, consensus, deadlock, budget exhausted. In a turn where
    all agents failed the moderator is not asked, so its cost does not count.
    """
    ending = (
        F.when(F.col("all_failed"), "error")
        .when(F.col("decision").isin("consensus", "deadlock"), F.col("decision"))
        .when(F.col("exhausted"), "budget_exhausted")
    )
    spent = F.when(F.col("all_failed"), F.col("spent_after_agents")).otherwise(F.col("spent_after_turn"))
    state = F.struct(
        "turn",
        F.coalesce(ending, F.lit("open")).alias("outcome"),
        F.when(ending.isNotNull() & ~F.col("all_failed"), F.col("verdict")).alias("verdict"),
        spent.alias("spent"),
    )
    ended = F.when(ending.isNotNull(), F.col("turn"))
    return (
        flagged.groupBy("debate_id")
        .agg(F.coalesce(F.min_by(state, ended), F.max_by(state, F.col("turn"))).alias("s"))
        .select(
            "debate_id",
            F.col("s.outcome").alias("outcome"),
            F.col("s.turn").alias("turn_count"),
            F.col("s.spent").alias("total_cost_usd"),
            F.col("s.verdict").alias("verdict"),
        )
    )


def debate_accounts(
    entries: DataFrame, limit_usd: float = 0.50, warn_fraction: float = 0.7
) -> DataFrame:
    """Outcome, verdict, turns and costs of every debate, counting nothing after its last turn."""
    ends = outcomes(budget_flags(turns(entries), limit_usd, warn_fraction))
    booked = entries.groupBy("debate_id", "turn", "provider", "moderator").agg(F.sum("cost_usd").alias("cost_usd"))
    limits = ends.select("debate_id", "turn_count", "outcome")
    unasked = (F.col("outcome") == "error") & (F.col("turn") == F.col("turn_count")) & F.coalesce("moderator", F.lit(False))
    counted = salted_join(booked, limits, ["debate_id"]).filter((F.col("turn") <= F.col("turn_count")) & ~unasked)
    by_provider = cost_by_provider(counted).select("debate_id", "cost_by_provider")
    return ends.join(by_provider, "debate_id", "left")


def debate_rows(accounts: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows for the debates table: `requests` adds what was asked, by debate_id, with its times."""
    asked = [c for c in requests.columns if c not in ("debate_id", "thread_id")]
    return requests.join(accounts, "debate_id").select(
        "debate_id",
        *asked,
        "outcome",
        "verdict",
        "turn_count",
        "total_cost_usd",
        F.to_json("cost_by_provider").alias("cost_by_provider"),
        F.lit(None).cast("string").alias("transcript_gcs_uri"),
        F.col("thread_id").alias("discord_thread_id"),
        F.lit(None).cast("string").alias("source_debate_id"),
    )


def prompt_lines(entries: DataFrame) -> DataFrame:
    """Agent entries as numbered prompt lines.

    Every prompt shows a prefix of these lines: see `prompt_prefixes`. Keeping lines and prefix
    lengths apart stores each text once, where one text per turn would grow with the square of the
    debate's length.
    """
    agents = entries.filter(~F.coalesce("moderator", F.lit(False))).withColumn("one", F.lit(1).cast("bigint"))
    numbered = running_sums(agents, ["debate_id"], "seq", ["one"])
    return numbered.select(
        "debate_id",
        F.col("run_one").alias("line_no"),
        "turn",
        entry_line(F.col("turn"), F.col("provider"), F.col("text"), F.col("error")).alias("line"),
    )


def prompt_prefixes(entries: DataFrame) -> DataFrame:
    """How many prompt lines agents and moderator see in each turn.

    Agents see the agent entries of earlier turns, the moderator also those of the current one;
    nobody sees moderator entries.
    """
    counted = (
        entries.filter(~F.coalesce("moderator", F.lit(False)))
        .groupBy("debate_id", "turn")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    seen = running_sums(counted, ["debate_id"], "turn", ["n"])
    return seen.select(
        "debate_id",
        "turn",
        (F.col("run_n") - F.col("n")).alias("agent_lines"),
        F.col("run_n").alias("moderator_lines"),
    )
