"""Texts shown to people and sent to agents, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewatch import fixed
from tradewatch.functions.coerce import blank_to_null, json_object
from tradewatch.schemas import VERDICT


def format_volume(v: Column) -> Column:
    """Short dollar amount: $850, $12.3K, $1.2M, $1.2B; NULL is $0."""
    size = F.abs(v)
    return (
        F.when(v.isNull(), F.lit("$0"))
        .when(size >= 1e9, F.format_string("$%.1fB", v / 1e9))
        .when(size >= 1e6, F.format_string("$%.1fM", v / 1e6))
        .when(size >= 1e3, F.format_string("$%.1fK", v / 1e3))
        .otherwise(F.format_string("$%.0f", v))
    )


def alert_reason(
    size: Column,
    size_z: Column,
    avg_size: Column,
    notional: Column,
    notional_z: Column,
    avg_notional: Column,
    volume: Column,
    volume_24h: Column,
) -> Column:
    """Why a trade was flagged.

    Computed figures are rounded to nine decimals first, so that the order in which a baseline was
    summed up cannot tip a figure that lies half-way between two printed ones.
    """

    def steady(value: Column) -> Column:
        return F.round(F.coalesce(value, F.lit(0.0)), 9)

    return F.format_string(
        "size=%.2f (z=%.2f vs avg %.1f), notional=$%.2f (z=%.2f vs avg $%.2f), market vol=%s (24h %s)",
        size,
        steady(size_z),
        steady(avg_size),
        notional,
        steady(notional_z),
        steady(avg_notional),
        format_volume(volume),
        format_volume(volume_24h),
    )


def title_from_slug(slug: Column) -> Column:
    words = F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))
    return F.initcap(F.concat(words, F.lit("?")))


def thread_key(series_ticker: Column, market_id: Column) -> Column:
    return F.coalesce(blank_to_null(series_ticker), market_id)


def thread_title(series_title: Column, title: Column, source: Column, market_id: Column) -> Column:
    """The whole title; a receiver with a limit takes the first of its `message_parts`."""
    return F.coalesce(blank_to_null(series_title), blank_to_null(title), F.concat(source, F.lit(": "), market_id))


def alert_message(
    market_id: Column,
    source: Column,
    title: Column,
    side: Column,
    size: Column,
    price: Column,
    notional: Column,
    reason: Column,
    trade_ts: Column,
) -> Column:
    titled = F.when(blank_to_null(title).isNotNull(), F.concat(F.lit("_"), title, F.lit("_\n")))
    iso = F.regexp_replace(
        F.date_format(trade_ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", ""
    )
    return F.concat(
        F.format_string("Unusual trade on %s (%s)\n", market_id, source),
        F.format_string("**%s**", F.coalesce(titled, F.lit(""))),
        F.format_string("Side: %s  Size: ", F.coalesce(blank_to_null(side), F.lit("?"))),
        F.coalesce(size.cast("string"), F.lit("None")),
        F.format_string("  Price: $%.3f  Notional: $%.2f\n", price, notional),
        F.format_string("Trigger: %s\n", F.coalesce(reason, F.lit("None"))),
        F.concat(F.lit("Trade time: "), iso),
    )


def provider_label(provider: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in fixed.PROVIDER_LABELS for x in pair])
    return F.coalesce(
        F.try_element_at(known, F.coalesce(provider, F.lit(""))),
        F.initcap(blank_to_null(provider)),
        F.lit("?"),
    )


def message_parts(body: Column, size: int = fixed.MESSAGE_PART) -> Column:
    """A text as parts (part_no from 1, text) that each fit the receiver; together they are the whole text."""
    last = F.greatest(F.lit(1), F.ceil(F.length(body) / F.lit(size)).cast("int"))
    return F.transform(
        F.sequence(F.lit(1), last),
        lambda k: F.struct(k.alias("part_no"), F.substring(body, (k - 1) * size + 1, F.lit(size)).alias("text")),
    )


def _stripped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")


def agent_message(provider: Column, turn: Column, searches: Column, cost: Column, text: Column) -> Column:
    """Thread message of an agent entry; NULL when the entry has no text."""
    body = blank_to_null(_stripped(text))
    header = F.format_string(
        "**%s — Turn %s**  ·  searches: %s  ·  cost: $%.4f",
        provider_label(provider),
        F.coalesce(turn.cast("string"), F.lit("?")),
        F.coalesce(searches, F.lit(0)).cast("string"),
        F.coalesce(cost, F.lit(0.0)),
    )
    return F.when(body.isNotNull(), F.concat(header, F.lit("\n"), body))


def moderator_message(turn: Column, decision: Column, cost: Column, rationale: Column) -> Column:
    header = F.format_string(
        "**Moderator — Turn %s**  ·  decision: `%s`  ·  cost: $%.4f",
        F.coalesce(turn.cast("string"), F.lit("?")),
        F.coalesce(blank_to_null(decision), F.lit("?")),
        F.coalesce(cost, F.lit(0.0)),
    )
    return F.concat_ws("\n", header, blank_to_null(_stripped(rationale)))


def verdict_message(verdict_json: Column, outcome: Column, cached_from: Column) -> Column:
    """Verdict text; `cached_from` is NULL for a fresh verdict."""
    verdict = json_object(verdict_json, VERDICT)
    by_outcome = F.create_map(*[F.lit(x) for pair in fixed.VERDICT_HEADERS for x in pair])
    header = (
        F.when(
            blank_to_null(cached_from).isNotNull(),
            F.concat(F.lit("**Debate verdict (cached from "), cached_from, F.lit(")**")),
        )
        .when(outcome.isNotNull(), F.coalesce(F.try_element_at(by_outcome, outcome), F.lit(fixed.VERDICT_HEADER)))
        .otherwise(F.lit(fixed.VERDICT_HEADER))
    )
    said = verdict["probability"]
    number = said.try_cast("double")
    probability = (
        F.when(number.isNotNull(), F.format_string("**Probability YES: %.0f%%**", number * 100))
        .when(said.isNotNull(), F.format_string("**Probability YES: %s**", said))
    )
    evidence = F.when(
        F.size(verdict["key_evidence"]) > 0,
        F.concat(
            F.lit("\n_Key evidence:_\n"),
            F.array_join(
                F.transform(verdict["key_evidence"], lambda e: F.concat(F.lit("- "), e)),
                "\n",
            ),
        ),
    )
    dissent = F.when(
        F.size(verdict["dissenters"]) > 0,
        F.concat(
            F.lit("\n_Dissenters:_\n"),
            F.array_join(
                F.transform(
                    verdict["dissenters"],
                    lambda d: F.format_string(
                        "- **%s**: %s",
                        F.coalesce(d["agent"], F.lit("?")),
                        F.coalesce(d["view"], F.lit("")),
                    ),
                ),
                "\n",
            ),
        ),
    )
    empty = verdict.isNull() | verdict_json.isin("", "{}")
    return F.when(F.coalesce(empty, F.lit(True)), F.concat_ws("\n", header, F.lit(fixed.NO_VERDICT))).otherwise(
        F.concat_ws("\n", header, probability, blank_to_null(verdict["summary"]), evidence, dissent)
    )


def cached_from_label(finished_at: Column, found_market: Column, found_title: Column, market_id: Column) -> Column:
    """When and, for another market of the series, where a reused verdict comes from."""
    time = F.coalesce(F.date_format(finished_at, "HH:mm 'UTC'"), F.lit("earlier"))
    elsewhere = F.when(
        (found_market != market_id) & blank_to_null(found_market).isNotNull() & blank_to_null(found_title).isNotNull(),
        F.concat(F.lit("; originally debated for: _"), found_title, F.lit("_")),
    )
    return F.concat(time, F.coalesce(elsewhere, F.lit("")))


def parse_decision(text: Column, error: Column | None = None) -> Column:
    """Decision struct (decision, rationale, verdict) out of a moderator's answer.

    The answer is read from its first ``{`` to its last ``}``. Anything unusable, or a decision
    that is not one of the three known words, means ``continue``.
    """
    block = blank_to_null(F.regexp_extract(text, r"(?s)(\{.*\})", 1))
    parsed = json_object(block, "decision string, rationale string, verdict string")
    result = (
        F.when(block.isNull(), _decision(F.lit("continue"), F.lit(fixed.NO_JSON)))
        .when(parsed.isNull(), _decision(F.lit("continue"), F.lit(fixed.BAD_JSON)))
        .otherwise(
            _decision(
                F.when(parsed["decision"].isin(*fixed.DECISIONS), parsed["decision"]).otherwise(F.lit("continue")),
                parsed["rationale"],
                parsed["verdict"],
            )
        )
    )
    if error is None:
        return result
    failed = blank_to_null(error)
    return F.when(
        failed.isNotNull(), _decision(F.lit("continue"), F.concat(F.lit(fixed.MODERATOR_ERROR), failed))
    ).otherwise(result)


def _decision(decision: Column, rationale: Column, verdict: Column | None = None) -> Column:
    return F.struct(
        decision.alias("decision"),
        rationale.cast("string").alias("rationale"),
        (F.lit(None) if verdict is None else verdict).cast("string").alias("verdict"),
    )


def entry_line(turn: Column, provider: Column, text: Column, error: Column) -> Column:
    """One agent entry as it appears in a prompt."""
    shown = F.coalesce(
        blank_to_null(text),
        F.when(blank_to_null(error).isNotNull(), F.concat(F.lit("[error: "), error, F.lit("]"))),
        F.lit(""),
    )
    return F.concat(F.format_string("--- Turn %s — %s ---\n", turn.cast("string"), provider), shown)


def agent_prompt(question: Column, lines: Column) -> Column:
    """Prompt of an agent from the entry lines it may see (an array, in order)."""
    opening = F.concat(F.lit("QUESTION: "), question, F.lit("\n"))
    return F.when(
        F.size(lines) > 0,
        F.concat_ws(
            "\n", opening, F.lit("PRIOR TURNS:"), F.array_join(lines, "\n"), F.lit(""), F.lit(fixed.REFINE)
        ),
    ).otherwise(F.concat_ws("\n", opening, F.lit(fixed.INITIAL)))


def moderator_prompt(
    question: Column, lines: Column, turn: Column, spent: Column, limit: Column, wrap_up: Column
) -> Column:
    head = F.concat_ws(
        "\n",
        F.concat(F.lit("QUESTION: "), question),
        F.concat(F.lit("TURN: "), turn.cast("string")),
        F.format_string("BUDGET: $%.3f / $%.2f used", spent, limit),
        F.when(wrap_up, F.lit(fixed.WRAP_UP)),
    )
    return F.concat_ws(
        "\n",
        head,
        F.lit(""),
        F.lit("DEBATE TRANSCRIPT:"),
        F.when(F.size(lines) > 0, F.array_join(lines, "\n")),
        F.lit(""),
        F.lit(fixed.ASK_DECISION),
    )
