import math
import random

import pytest
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.plans.accounting import (
    budget_flags,
    cost_by_provider,
    debate_accounts,
    outcomes,
    price_list,
    prompt_lines,
    prompt_prefixes,
    turns,
    with_cost,
)


def transcript(spark, debate, turn_list):
    """Turns as (agents' [(cost, error)], moderator (cost, decision) or None)."""
    rows, seq = [], 0
    for number, (agents, moderator) in enumerate(turn_list, 1):
        for i, (cost, error) in enumerate(agents):
            rows.append((debate, seq, number, False, f"p{i}", f"text {seq}", cost, error, None, None))
            seq += 1
        if moderator:
            cost, decision = moderator
            rows.append((debate, None, number, True, "moderator", None, cost, None, decision, f'{{"turn":{number}}}'))
    plain = spark.createDataFrame(
        rows,
        "debate_id string, seq long, turn long, moderator boolean, provider string, text string, cost_usd double,"
        " error string, decision string, verdict string",
    )
    return schemas.conform(plain, schemas.TRANSCRIPTS)


OK = [(0.05, None), (0.05, None)]
CASES = {
    "consensus": ([(OK, (0.01, "continue")), (OK, (0.01, "consensus")), (OK, (0.01, "deadlock"))], "consensus", 2, 0.22),
    "deadlock": ([(OK, (0.01, "deadlock"))], "deadlock", 1, 0.11),
    "all failed first": ([([(0.01, "x"), (0.0, "y")], (0.01, "consensus"))], "error", 1, 0.01),
    "one failed": ([([(0.01, "x"), (0.0, None)], (0.01, "consensus"))], "consensus", 1, 0.02),
    "moderator hits cap": ([([(0.30, None)], (0.0, "continue")), ([(0.19, None)], (0.01, "continue"))], "budget_exhausted", 2, 0.50),
    "consensus beats cap": ([([(0.60, None)], (0.01, "consensus"))], "consensus", 1, 0.61),
    "still open": ([(OK, (0.01, "continue"))], "open", 1, 0.11),
    "error later": ([(OK, (0.01, "continue")), ([(0.0, "x")], None), (OK, (0.01, "consensus"))], "error", 2, 0.11),
}


def test_outcomes(spark):
    entries = None
    for name, (turn_list, *_rest) in CASES.items():
        one = transcript(spark, name, turn_list)
        entries = one if entries is None else entries.unionByName(one)
    rows = {r["debate_id"]: r for r in debate_accounts(entries).collect()}
    for name, (_, outcome, turn_count, spent) in CASES.items():
        row = rows[name]
        assert (row["outcome"], row["turn_count"]) == (outcome, turn_count), name
        assert math.isclose(row["total_cost_usd"], spent), name
        assert math.isclose(sum(row["cost_by_provider"].values()), spent, abs_tol=1e-12), name
        assert row["verdict"] == (None if outcome in ("error", "open") else f'{{"turn":{turn_count}}}')


def test_soft_flag_is_read_before_the_moderator(spark):
    entries = transcript(spark, "d", [([(0.34, None)], (0.02, "continue")), ([(0.0, None)], (0.0, "continue"))])
    flags = {r["turn"]: (r["near_exhaustion"], r["exhausted"]) for r in budget_flags(turns(entries)).collect()}
    assert flags == {1: (False, False), 2: (True, False)}


def test_costs(spark):
    entries = spark.createDataFrame(
        [("d", "openai", "openai", 1000000, 100000, 2), ("d", "moderator", "anthropic", 1000, 1000, 0), ("d", "who", "who", 5, 5, 5)],
        "debate_id string, provider string, rate_key string, input_tokens long, output_tokens long, search_count long",
    )
    priced = with_cost(entries, price_list(spark), "rate_key")
    row = cost_by_provider(priced).first()
    assert row["cost_by_provider"] == pytest.approx({"openai": 3.55, "moderator": 0.018, "who": 0.0})
    assert row["total_cost_usd"] == pytest.approx(3.568)


def test_prompt_prefixes_rebuild_the_snapshots(spark):
    rng = random.Random(3)
    turn_list = [([(0.0, rng.choice([None, "x"])) for _ in range(rng.randrange(1, 4))], (0.0, "continue")) for _ in range(6)]
    entries = transcript(spark, "d", turn_list)
    lines = [r["line"] for r in prompt_lines(entries).orderBy("line_no").collect()]
    rows = entries.filter("not moderator").orderBy("seq").collect()
    assert lines == [f"--- Turn {r['turn']} — {r['provider']} ---\n{r['text']}" for r in rows]
    for r in prompt_prefixes(entries).collect():
        assert r["agent_lines"] == len([x for x in rows if x["turn"] < r["turn"]])
        assert r["moderator_lines"] == len([x for x in rows if x["turn"] <= r["turn"]])


def test_only_first_terminating_turn_counts(spark):
    entries = transcript(spark, "d", [(OK, (0.01, "continue"))] * 9)
    ends = outcomes(budget_flags(turns(entries))).first()
    assert (ends["outcome"], ends["turn_count"]) == ("budget_exhausted", 5)
