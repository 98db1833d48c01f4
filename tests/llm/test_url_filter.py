import re

import duckdb
import pytest

from loanlens.llm import url_filter as op
from tests.llm.helpers import by_id


def pages(spark, urls):
    rows = [(i, u, "html", "h", "p") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, shape string")


def rule_of(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in op.RULES:
        domain, start = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return host, path, max(fits)[1:] if fits else None


ODD = [None, "", "no scheme/en/1", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x?a/b", "x://example.com/en/",
       "a://example.com/en", "a://notexample.com/en/1", "a://b.net/es/1#/fr/", "a://net/fr/", "a://É.net/es/ü", "a://b.com?x://c/",
       "a://x.org/a\nb/c", "a://b.net/fr/2", "a://u:p@b.net:80/es/"]


def test_hosts_paths_and_rules(spark):
    found = by_id(op.url_verdicts(pages(spark, ODD)), "page_id")
    for i, url in enumerate(ODD):
        host, path, rule = rule_of(url)
        assert (found[i]["host"], found[i]["path"]) == (host, path), url
        assert found[i]["rule"] == (rule[0] if rule else None), url
        if rule:
            assert found[i]["verdict"] == rule[1], url


def varied(n=400):
    hosts = ["a.net", "b.example.com", "www.example.com", "c.org", "a.net", "a.net"]
    kinds = ["es", "fr", "en", "de", "blog", "x" ]
    return [f"http://{hosts[i * 7 % 6]}/{kinds[i * 5 % 6]}/{i % 50}/{'s' + 'abcdefgh'[i % 8] * 2}/{i}/f/g" for i in range(n)]


@pytest.mark.parametrize("tree", [op.Tree(), op.Tree(depth=2, support=1, z=0.5, limit=0.4), op.Tree(depth=6, percent=20)])
def test_templates_equal_sql(spark, tree):
    df = pages(spark, ODD + varied())
    found = sorted(map(tuple, op.url_verdicts(df, tree=tree).collect()))
    pages_table = df.toPandas()  # noqa: F841  read by the SQL below
    db = duckdb.connect()
    db.register("pages", pages_table)
    wanted = sorted(db.sql(op.verdict_sql(tree=tree)).fetchall())
    assert [r[:6] for r in found] == [r[:6] for r in wanted]
    assert all(abs(a[6] - b[6]) < 1e-9 for a, b in zip(found, wanted))


def test_rejected_templates_reach_unnamed_urls(spark):
    """Labels from given rules carry over to urls of the same template."""
    rules = (("block", "bad.org/ads/x"),)
    urls = [f"http://bad.org/ads/x{i}" for i in range(20)] + ["http://bad.org/ads/y7", "http://bad.org/news/a1"]
    tree = op.Tree(support=30)
    verdicts = [r["verdict"] for r in sorted(op.url_verdicts(pages(spark, urls), rules=rules, tree=tree).collect())]
    assert verdicts == ["block"] * 22
    tree = op.Tree(support=1, percent=1)
    verdicts = [r["verdict"] for r in sorted(op.url_verdicts(pages(spark, urls), rules=rules, tree=tree).collect())]
    assert verdicts[:20] == ["block"] * 20 and verdicts[20:] == ["allow", "allow"]


def test_no_python_in_the_plan_and_empty_table(spark):
    df = op.url_verdicts(pages(spark, varied(50)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert op.url_verdicts(pages(spark, [])).count() == 0
