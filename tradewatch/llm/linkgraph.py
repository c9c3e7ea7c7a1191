"""URL verdicts from rules and, where no rule fits, from the link graph of hosts.

A rule is a host and a path; it fits a url if the host is the rule's or lies below it and the path starts with the rule's. The
longest rule that fits decides. Hosts of whose pages rules allow more than half are trusted seeds, those of whose pages rules
block more than half are blocked seeds.

Host edges are the absolute links of the pages, counted per pair of hosts, and an edge from a host to the domain it lies
below: trust goes up to the domain, distrust comes down from it. Trust is a personalised PageRank from the trusted seeds along the edges; distrust is one from the blocked
seeds along the reversed edges (who links to blocked hosts is suspect). Each seed gives out 1, of which ``1 - damping`` stays where it
is at every step. Steps are added up until all that is still on its way is less than ``tolerance``, so scores are too low by less
than that. A host is blocked if its distrust is at least ``least`` and above its trust, else allowed.

Only DataFrame functions are used. A host with a third of all pages is one row of the graph: pairs are counted before they
are shuffled. Each round is one join by source and one sum by target, stored in the shared folder, and one sum of what moved.

Null urls and urls without ``://`` have an empty host and path, no rule, and are allowed unless the method learns
otherwise of the empty host, which it cannot. Null html has no links. Repeated rows are judged alone. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import stored

DAMPING, LEAST, TOLERANCE = 0.85, 0.05, 1e-10
#: Rounds that no table reaches: what is then still on its way (0.85^400 of the seeds) is below the rounding of a double.
ROUNDS = 400
#: Weight of the edge from a host to its domain, next to one link.
FAMILY = 1.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest of the rules (``host/path``) that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda x: (len(x), x)):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target, links of distinct pairs of different hosts."""
    links = F.expr("regexp_extract_all(html, :pattern, 1)".replace(":pattern", _sql_text(_LINK)))
    linked = (
        pages.select(host_of(F.col("url")).alias("source"), F.explode(links).alias("link"))
        .select("source", host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))).alias("target"))
        .groupBy("source", "target").agg(F.count(F.lit(1)).cast("double").alias("links"))
    )
    hosts = pages.select(host_of(F.col("url")).alias("host")).unionAll(linked.select("target")).distinct()
    domain = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+|[^.]+\.[^.]+)$", 1)
    family = hosts.select("host", domain.alias("domain")).where("domain <> ''")
    edges = linked.unionAll(family.select("host", "domain", F.lit(FAMILY)))
    return edges.where("source <> '' and target <> '' and source <> target").groupBy("source", "target").agg(F.sum("links").alias("links"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust. ``seeds``: host, trust, distrust at the start (1 for a seed, else 0)."""

    def shares(a: str, b: str) -> DataFrame:
        total = edges.groupBy(F.col(a).alias("host")).agg(F.sum("links").alias("total"))
        return edges.select(F.col(a).alias("host"), F.col(b).alias("to"), "links").join(total, "host").select("host", "to", (F.col("links") / F.col("total")).alias("share"))

    steps = stored(
        shares("source", "target").withColumn("way", F.lit("trust")).unionAll(shares("target", "source").withColumn("way", F.lit("distrust"))),
        "host-steps",
    )
    start = stored(
        seeds.select("host", F.explode(F.array(F.struct(F.lit("trust").alias("way"), F.col("trust").alias("at")), F.struct(F.lit("distrust").alias("way"), F.col("distrust").alias("at")))).alias("x"))
        .select("host", "x.way", F.col("x.at").cast("double").alias("score")).where("score > 0"),
        "host-seeds",
    )
    scores = start.select("host", "way", (F.col("score") * (1 - damping)).alias("moved")).withColumn("score", F.col("moved"))
    for _ in range(rounds):
        moving = scores.where("moved > 0").select("host", "way", "moved")
        moved = steps.join(moving, ["host", "way"]).select(F.col("to").alias("host"), "way", (F.col("share") * F.col("moved") * damping).alias("moved"))
        both = moved.withColumn("score", F.col("moved")).unionAll(scores.select("host", "way", F.lit(0.0).alias("moved"), "score"))
        scores = stored(both.groupBy("host", "way").agg(F.sum("moved").alias("moved"), F.sum("score").alias("score")), "host-scores")
        # what the last step moved makes at most moved * damping / (1 - damping) in all later ones
        left = scores.agg(F.sum("moved")).first()[0] or 0.0
        if left * damping < tolerance * (1 - damping):
            break
    return scores.groupBy("host").agg(*[F.sum(F.when(F.col("way") == x, F.col("score")).otherwise(0.0)).alias(x) for x in ("trust", "distrust")])


def url_verdicts(pages: DataFrame, rules: dict[str, str], damping: float = DAMPING, rounds: int = ROUNDS, least: float = LEAST) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page. ``rules``: ``host/path`` to allow or block."""
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), list(rules)))
    said = reduce(lambda out, x: F.when(F.col("rule") == x[0], F.lit(x[1])).otherwise(out), rules.items(), F.lit(None).cast("string"))
    judged = judged.withColumn("_said", said)
    votes = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("_said") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("_said") == "block", 1)).alias("blocked"),
    )
    seeds = votes.where("host <> ''").select(
        "host",
        (2 * F.col("allowed") > F.col("n")).cast("double").alias("trust"),
        (2 * F.col("blocked") > F.col("n")).cast("double").alias("distrust"),
    )
    edges = stored(host_edges(pages.select("url", "html")), "host-edges")
    hosts = propagate(edges, seeds, damping, rounds)
    found = judged.join(hosts, "host", "left").fillna(0.0, ["trust", "distrust"])
    own = F.when((F.col("distrust") >= least) & (F.col("distrust") > F.col("trust")), F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", F.coalesce("_said", own).alias("verdict"), "trust", "distrust")
