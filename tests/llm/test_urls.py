import re

import pytest
from pyspark.sql import functions as F

from tests.oracle import connect, duck_rows, rows_of
from tradewatch.llm import queries
from tradewatch.llm.linkgraph import DAMPING, LEAST, ROUNDS, host_edges, host_of, path_of, rule_of, url_verdicts

RULES = queries.URL_RULES


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = [r for r in RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Com", "http://a.com/", "https://www.Example.com/en/x?y#z", "x://example.com/en/", "x://notexample.com/en/",
    "http://a.net/es/1", "http://a.net/fr", "http://a.net?q=/es/", "http://b.org#://c.com/", "a://b://c.com/", "://net/es/", "http://É.com/\nen/", "http://com/",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(x,) for x in URLS], "url string")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    for row in df.select("url", host.alias("host"), path.alias("path"), rule_of(host, path, list(RULES)).alias("rule")).collect():
        assert (row["host"], row["path"]) == brute_parts(row["url"])
        assert row["rule"] == brute_rule(row["host"], row["path"])


def page(k, url, *links):
    return k, url, "".join(f"<a href={q}{x}{q}>t</a>" for x, q in links) if links is not None else None, "host?", 1


def brute_scores(pages):
    edges = {}
    hosts = {brute_parts(u)[0] for _, u, *_ in pages}
    for _, url, html, *_ in pages:
        for link in re.findall(r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)""", html or ""):
            target = brute_parts("x:" + link if link.startswith("//") else link)[0]
            hosts.add(target)
            edges[(brute_parts(url)[0], target)] = edges.get((brute_parts(url)[0], target), 0) + 1
    for h in hosts:
        labels = h.split(".")
        if len(labels) > 2 and all(labels):
            edges[(h, ".".join(labels[1:]))] = edges.get((h, ".".join(labels[1:])), 0) + 1
    edges = {(a, b): n for (a, b), n in edges.items() if a and b and a != b}
    seeds = {"trust": {}, "distrust": {}}
    for h in hosts:
        own = [RULES.get(brute_rule(*brute_parts(u))) for _, u, *_ in pages if brute_parts(u)[0] == h]
        if h and own and 2 * own.count("allow") > len(own):
            seeds["trust"][h] = 1.0
        if h and own and 2 * own.count("block") > len(own):
            seeds["distrust"][h] = 1.0
    out = {}
    for way, start in seeds.items():
        steps = edges if way == "trust" else {(b, a): n for (a, b), n in edges.items()}
        total = {}
        for (a, _), n in steps.items():
            total[a] = total.get(a, 0) + n
        score = dict(start)
        for _ in range(ROUNDS):
            new = {h: (1 - DAMPING) * x for h, x in start.items()}
            for (a, b), n in steps.items():
                if a in score:
                    new[b] = new.get(b, 0) + DAMPING * score[a] * n / total[a]
            score = new
        out[way] = score
    return edges, out["trust"], out["distrust"]


@pytest.fixture
def pages():
    return [
        page(1, "http://good.com/", ("http://fine.org/x", '"'), ("//fine.org/y", "'"), ("/local", '"'), ("HTTPS://Other.org", "")),
        page(2, "http://shady.org/a", ("http://bad.net/es/1", '"')),
        page(3, "http://bad.net/es/1", ("http://good.com", '"'), ("http://sub.fine.org", '"')),
        page(4, "http://bad.net/es/2"),
        page(5, "http://fine.org/", ("http://sub.fine.org/", '"'), ("mailto:a@b.c", '"')),
        page(6, "http://sub.fine.org/"),
        page(7, None),
        page(8, "nothing"),
        page(9, "http://low.bad.net/de/"),
        page(9, "http://low.bad.net/de/"),
        (None, "http://www.example.com/en/", None, "x", 2),
    ]


def test_graph_against_brute_force(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string, trust long")
    edges, trust, distrust = brute_scores(pages)
    assert {(x["source"], x["target"]): x["links"] for x in host_edges(df).collect()} == edges
    rows = url_verdicts(df, RULES).collect()
    assert len(rows) == len(pages)
    for x in rows:
        assert abs(x["trust"] - trust.get(x["host"], 0)) < 1e-9 and abs(x["distrust"] - distrust.get(x["host"], 0)) < 1e-9
        own = "block" if x["distrust"] >= LEAST and x["distrust"] > x["trust"] else "allow"
        assert x["verdict"] == RULES.get(x["rule"], own)
    said = {x["host"]: x["verdict"] for x in rows}
    assert said["shady.org"] == "block" and said["fine.org"] == "allow" and said["low.bad.net"] == "block" and said[""] == "allow"
    assert url_verdicts(df.where("false"), RULES).count() == 0


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    df = queries.op4_urls(spark, sf)
    names, want = duck_rows(connect(sf), queries.ORACLES["op4_urls"])
    columns, got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    assert columns == names and got == want


def test_no_python_in_the_plan(spark):
    plan = queries.op4_urls(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_long_chains_converge(spark):
    chain = [page(1, "http://bad.net/es/1")] + [page(k + 1, f"http://h{k}.org/", (f"http://{f'h{k - 1}.org' if k > 1 else 'bad.net'}/", '"')) for k in range(1, 14)]
    rows = url_verdicts(spark.createDataFrame(chain, "page_id long, url string, html string, host string, trust long"), RULES).collect()
    got = {x["host"]: x for x in rows}
    for k in range(1, 14):
        assert abs(got[f"h{k}.org"]["distrust"] - 0.15 * 0.85**k) < 1e-9
        assert got[f"h{k}.org"]["verdict"] == ("block" if 0.15 * 0.85**k >= LEAST else "allow")
