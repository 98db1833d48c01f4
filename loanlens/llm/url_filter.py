"""URL verdicts from curated rules and, where none fits, from a tree of path templates.

Per host the paths form a tree of segments. Segments with digits are generalised by their
shape; segments of little support become a wildcard; sibling branches whose labelled rates
do not differ significantly are merged. A template is rejected when the smoothed share of
blocked urls among its labelled ones is high. Labels are the verdicts of the rules, so
templates carry curated verdicts over to urls that no rule names.

All of it is aggregates and joins of DataFrames. Urls are reduced to distinct shapes, with
partial sums before the shuffle, so a host with a third of all rows is a few rows then.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import cut_lineage

# Verdicts of hosts and paths.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Tree(NamedTuple):
    """How templates are made: levels that are told apart (deeper segments are one ``**``),
    urls a literal segment needs, its least share of its siblings in percent, the normal
    quantile of the merge test, and weight and limit of the smoothed share of blocked urls.
    """

    depth: int = 4
    support: int = 3
    percent: int = 1
    z: float = 1.96
    weight: float = 2.0
    limit: float = 0.7


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.instr(url, "://") > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise("")


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _shape(path: Column) -> Column:
    """The path with digits as ``*`` and without empty segments."""
    segments = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "*"), "/"), lambda s: s != "")
    return F.array_join(segments, "/")


def path_templates(urls: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """From ``host, path, bad`` (1 blocked, 0 allowed, null unlabelled): the templates.

    One row per host and shape of a path: host, shape, template, labelled and blocked urls
    of the template, and ``purity``, the smoothed share of blocked ones.
    """
    shapes = cut_lineage(
        urls.groupBy("host", _shape(F.col("path")).alias("shape")).agg(
            F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("blocked")
        )
    )
    segments = F.split("shape", "/")
    nodes = shapes.withColumn("prefix", F.lit(""))
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    for level in range(tree.depth):
        segment = F.coalesce(F.get(segments, F.lit(level)), F.lit(""))
        nodes = nodes.withColumn("segment", segment)
        children = nodes.groupBy("host", "prefix", "segment").agg(*sums)
        totals = children.groupBy("host", "prefix").agg(
            F.sum("n").alias("all_n"), F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked")
        )
        rare = (F.col("n") < tree.support) | (F.col("n") * 100 < F.col("all_n") * tree.percent)
        # Siblings against all the others of the node, those of little support as one.
        named = children.join(totals, ["host", "prefix"]).withColumn(
            "child", F.when(F.col("segment") == "", "").when(rare, "*").otherwise(F.col("segment"))
        )
        own = named.groupBy("host", "prefix", "child").agg(
            F.sum("labelled").alias("l"),
            F.sum("blocked").alias("b"),
            F.first("all_labelled").alias("al"),
            F.first("all_blocked").alias("ab"),
        )
        others = F.col("al") - F.col("l")
        rate = F.col("ab") / F.col("al")
        spread = rate * (1 - rate) * (1 / F.col("l") + 1 / others)
        gap = F.col("b") / F.col("l") - (F.col("ab") - F.col("b")) / others
        similar = F.when((F.col("l") > 0) & (others > 0), gap * gap <= tree.z**2 * spread).otherwise(False)
        branch = F.when((F.col("child") != "") & similar, "+").otherwise(F.col("child"))
        own = own.select("host", "prefix", "child", branch.alias("branch"))
        step = named.select("host", "prefix", "segment", "child").join(own, ["host", "prefix", "child"])
        step = step.select("host", "prefix", "segment", "branch")
        longer = F.when(F.col("branch") == "", F.col("prefix")).otherwise(F.concat_ws("/", "prefix", "branch"))
        nodes = nodes.join(step, ["host", "prefix", "segment"]).select(
            "host", "shape", "n", "labelled", "blocked", longer.alias("prefix")
        )
        nodes = cut_lineage(nodes)
    deeper = F.size(segments) > tree.depth
    nodes = nodes.withColumn("template", F.when(deeper, F.concat("prefix", F.lit("/**"))).otherwise(F.col("prefix")))
    templates = nodes.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    labelled, blocked = nodes.agg(F.sum("labelled"), F.sum("blocked")).first()
    prior = blocked / labelled if labelled else 0.0
    purity = (F.col("blocked") + tree.weight * prior) / (F.col("labelled") + tree.weight)
    templates = templates.withColumn("purity", purity)
    return nodes.select("host", "shape", "template").join(templates, ["host", "template"])


def url_verdicts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, tree: Tree = Tree()
) -> DataFrame:
    """Per row: id, host, path, rule, verdict, and the template with its purity.

    The longest fitting rule decides; without one a url is blocked if its template has
    labelled urls and a purity of ``tree.limit`` or more, else allowed. A null url, or one
    without ``://``, has an empty host and path, like all such rows. Repeated rows are
    judged each and count as often; an empty table gives no rows. Other columns are not
    read.
    """
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(host_of(url), F.lit("")).alias("host"),
        F.coalesce(path_of(url), F.lit("")).alias("path"),
    ).withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    bad = F.when(F.col("found.verdict").isNotNull(), (F.col("found.verdict") == "block").cast("int"))
    templates = cut_lineage(path_templates(rows.select("host", "path", bad.alias("bad")), tree))
    rejected = (F.col("labelled") > 0) & (F.col("purity") >= tree.limit)
    judged = rows.withColumn("shape", _shape(F.col("path"))).join(templates, ["host", "shape"], "left")
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        "template",
        "purity",
    )


def verdict_sql(rules=RULES, tree: Tree = Tree()) -> str:
    """The same verdicts as SQL over a table ``pages``, for checking."""
    whens = {"rule": [], "verdict": []}
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        domain, _, start = rule.partition("/")
        fits = f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{start}')"
        whens["rule"].append(f"WHEN {fits} THEN '{rule}'")
        whens["verdict"].append(f"WHEN {fits} THEN '{verdict}'")
    levels = []
    for k in range(tree.depth):
        levels.append(f"""
s{k} AS (SELECT *, coalesce(string_split(shape, '/')[{k + 1}], '') AS segment FROM n{k}),
c{k} AS (SELECT host, prefix, segment, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked
         FROM s{k} GROUP BY ALL),
t{k} AS (SELECT *, CASE WHEN segment = '' THEN ''
           WHEN n < {tree.support} OR n * 100 < sum(n) OVER w * {tree.percent} THEN '*' ELSE segment END AS child,
           sum(labelled) OVER w AS al, sum(blocked) OVER w AS ab
         FROM c{k} WINDOW w AS (PARTITION BY host, prefix)),
o{k} AS (SELECT host, prefix, child, sum(labelled) AS l, sum(blocked) AS b, any_value(al) AS al, any_value(ab) AS ab
         FROM t{k} GROUP BY ALL),
b{k} AS (SELECT host, prefix, child, CASE WHEN child <> '' AND l > 0 AND al > l
           AND pow(b / l - (ab - b) / (al - l), 2)
             <= {tree.z**2!r} * (ab / al) * (1 - ab / al) * (1.0::DOUBLE / l + 1.0::DOUBLE / (al - l))
           THEN '+' ELSE child END AS branch FROM o{k}),
n{k + 1} AS (SELECT s.host, s.shape, s.n, s.labelled, s.blocked,
             CASE WHEN branch = '' THEN s.prefix ELSE s.prefix || '/' || branch END AS prefix
           FROM s{k} s JOIN t{k} t USING (host, prefix, segment) JOIN b{k} b ON b.host = t.host
             AND b.prefix = t.prefix AND b.child = t.child)""")
    return f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE {" ".join(whens["rule"])} END AS rule, CASE {" ".join(whens["verdict"])} END AS ruled,
        array_to_string(list_filter(string_split(regexp_replace(path, '[0-9]+', '*', 'g'), '/'),
                                    lambda x: x <> ''), '/') AS shape
      FROM h),
n0 AS (SELECT host, shape, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked,
         '' AS prefix FROM r GROUP BY host, shape),{",".join(levels)},
e AS (SELECT *, CASE WHEN len(string_split(shape, '/')) > {tree.depth} THEN prefix || '/**' ELSE prefix END AS template
      FROM n{tree.depth}),
p AS (SELECT host, template, sum(labelled) AS labelled, (sum(blocked) + {tree.weight} * coalesce(
        (SELECT sum(blocked) / sum(labelled) FROM e), 0)) / (sum(labelled) + {tree.weight}) AS purity
      FROM e GROUP BY ALL)
SELECT r.page_id, r.host, r.path, r.rule,
       coalesce(r.ruled, CASE WHEN p.labelled > 0 AND p.purity >= {tree.limit} THEN 'block' ELSE 'allow' END) AS verdict,
       p.template, p.purity
FROM r JOIN e ON e.host = r.host AND e.shape = r.shape JOIN p ON p.host = e.host AND p.template = e.template
"""
