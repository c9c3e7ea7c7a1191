from datetime import datetime

from pyspark.sql import functions as F

from tradewatch.functions import text


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column).first()[0]


def test_format_volume(spark):
    values = [(None,), (0.4,), (850.0,), (12345.0,), (-1234567.0,), (1.26e9,)]
    df = spark.createDataFrame(values, "v double").select(text.format_volume(F.col("v")))
    assert [r[0] for r in df.collect()] == ["$0", "$0", "$850", "$12.3K", "$-1.2M", "$1.3B"]


def test_title_from_slug(spark):
    assert one(spark, text.title_from_slug(F.col("s")), s="will-it-rain-in-may") == "Will It Rain In May?"


def test_decisions(spark):
    answers = [
        ('{"decision": "consensus", "rationale": "r", "verdict": {"probability": 0.5}}', None, ("consensus", "r", '{"probability":0.5}')),
        ('Well:\n{"decision": "deadlock",\n "rationale": "r"}\nDone.', None, ("deadlock", "r", None)),
        ('{"decision": "maybe", "rationale": "r"}', None, ("continue", "r", None)),
        ('{"rationale": "r"}', None, ("continue", "r", None)),
        ("no braces", None, ("continue", "moderator did not return JSON", None)),
        ("", None, ("continue", "moderator did not return JSON", None)),
        ("{broken", None, ("continue", "moderator did not return JSON", None)),
        ('{"decision": }', None, ("continue", "moderator JSON parse failed", None)),
        ('{"decision": "consensus"} {"x": 1}', None, ("continue", "moderator JSON parse failed", None)),
        ("", "timeout", ("continue", "moderator error: timeout", None)),
    ]
    df = spark.createDataFrame([(t, e) for t, e, _ in answers], "t string, e string")
    got = [tuple(r["d"]) for r in df.select(text.parse_decision(F.col("t"), F.col("e")).alias("d")).collect()]
    assert got == [want for _, _, want in answers]


def test_entry_messages(spark):
    agent = text.agent_message(F.col("p"), F.col("t"), F.col("s"), F.col("c"), F.col("x"))
    assert one(spark, agent, p="grok", t=2, s=3, c=0.12345, x="  hi\n") == "**Grok — Turn 2**  ·  searches: 3  ·  cost: $0.1235\nhi"
    assert one(spark, agent, p="grok", t=2, s=3, c=0.1, x=" \n ") is None
    long = one(spark, agent, p="other", t=1, s=0, c=0.0, x="y" * 3000)
    assert long.startswith("**Other — Turn 1**") and long.endswith("y" * 3000)
    parts = one(spark, text.message_parts(F.col("x"), 1000), x="ab" * 1250)
    assert [p["part_no"] for p in parts] == [1, 2, 3] and "".join(p["text"] for p in parts) == "ab" * 1250
    assert max(len(p["text"]) for p in parts) == 1000
    assert [tuple(p) for p in one(spark, text.message_parts(F.col("x")), x="")] == [(1, "")]
    moderator = text.moderator_message(F.col("t"), F.col("d"), F.col("c"), F.col("r"))
    assert one(spark, moderator, t=1, d="continue", c=0.0, r="") == "**Moderator — Turn 1**  ·  decision: `continue`  ·  cost: $0.0000"


def test_verdict(spark):
    message = text.verdict_message(F.col("v"), F.col("o"), F.col("c"))
    full = '{"probability": 0.42, "summary": "S", "key_evidence": ["1","2","3","4","5","6"], "dissenters": [{"agent": "A", "view": "V"}, {}]}'
    assert one(spark, message, v=full, o="consensus", c=None) == (
        "**Debate verdict — consensus**\n**Probability YES: 42%**\nS\n\n_Key evidence:_\n- 1\n- 2\n- 3\n- 4\n- 5\n- 6"
        "\n\n_Dissenters:_\n- **A**: V\n- **?**: "
    )
    assert one(spark, message, v='{"probability": "0.4"}', o=None, c=None) == "**Debate verdict**\n**Probability YES: 40%**"
    assert one(spark, message, v='{"probability": "likely"}', o=None, c=None) == "**Debate verdict**\n**Probability YES: likely**"
    assert one(spark, message, v=full, o="consensus", c="10:20 UTC").startswith("**Debate verdict (cached from 10:20 UTC)**\n")
    assert one(spark, message, v=None, o="error", c=None) == "**Debate verdict — error**\n_No verdict produced._"


def test_prompts(spark):
    agent = text.agent_prompt(F.col("q"), F.col("l"))
    assert one(spark, agent, q="Q", l=["a", "b"]) == (
        "QUESTION: Q\n\nPRIOR TURNS:\na\nb\n\nRefine your position based on the discussion above."
    )
    first = spark.range(1).select(text.agent_prompt(F.lit("Q"), F.array().cast("array<string>"))).first()[0]
    assert first == "QUESTION: Q\n\nProvide your initial position with supporting evidence."
    moderator = text.moderator_prompt(F.col("q"), F.col("l"), F.lit(2), F.lit(0.4), F.lit(0.5), F.col("w"))
    assert one(spark, moderator, q="Q", l=["a"], w=False) == (
        "QUESTION: Q\nTURN: 2\nBUDGET: $0.400 / $0.50 used\n\nDEBATE TRANSCRIPT:\na\n\n"
        "Return your decision as a single JSON object per the system schema."
    )
    assert "WRAP-UP SIGNAL" in one(spark, moderator, q="Q", l=["a"], w=True)


def test_thread_titles(spark):
    title = text.thread_title(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    assert one(spark, title, a="", b="T", c="s", d="m") == "T"
    assert one(spark, title, a=None, b="", c="s", d="m") == "s: m"
    assert len(one(spark, title, a="x" * 150, b="T", c="s", d="m")) == 150


def test_cached_label_without_time(spark):
    label = text.cached_from_label(F.lit(None).cast("timestamp"), F.col("f"), F.col("t"), F.col("m"))
    assert one(spark, label, f="m1", t="T", m="m1") == "earlier"
    at = text.cached_from_label(F.col("z"), F.col("f"), F.col("t"), F.col("m"))
    assert one(spark, at, z=datetime(2024, 1, 1, 9, 5), f="m1", t="T", m="m2") == "09:05 UTC; originally debated for: _T_"
