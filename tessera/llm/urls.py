"""URL filters: a path-template tree per host, in DataFrame functions only.

Given rules decide first.  Their verdicts are also the labels from which the
method judges what no rule fits: for every host the paths form a tree of
templates.  Segments that vary (numbers, hashes, long slugs, rare children of
a node with many) become wildcards; branches whose labelled rate does not
differ significantly from that of all their siblings are merged into one; a
template is rejected if its labelled purity, smoothed towards PRIOR, is high.
The tree is as deep as the deepest path, with two steps a level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

#: A node with more children than MANY keeps those with RARE or more of its
#: urls; merging takes branches under Z standard errors from the pool; the
#: smoothing counts as WEIGHT labels of purity PRIOR; REJECT is the purity to
#: reject from.
MANY, RARE, Z, WEIGHT, PRIOR, REJECT = 50, 0.01, 1.96, 4.0, 0.2, 0.8

#: Fixed values: (verdict, host, path prefix).
RULES = (
    ("block", "com", "en/"),
    ("allow", "example.com", "en/7"),
    ("allow", "net", "de/"),
    ("block", "example.net", "de/8"),
    ("block", "org", "es/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null.  A rule
    like `net/de/` is a host and a path prefix after its slash."""
    ranked = sorted(rules, key=lambda r: -(len(r[1]) + len(r[2])))
    fit = F.lit(None)
    for verdict, h, p in reversed(ranked):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        fit = F.when(fits, F.struct(F.lit(f"{h}/{p}").alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fit)
    return fit


def segment(s: Column) -> Column:
    """A path segment with its variable forms generalised."""
    return (
        F.when(s.isNull(), F.lit("")).when(s.rlike(r"^[0-9]+$"), F.lit("<n>")).when(s.rlike(r"^[0-9]+\.[a-z]+$"), F.lit("<n>."))
        .when(s.rlike(r"^[0-9a-f-]{8,}$"), F.lit("<h>")).when(F.length(s) > 24, F.lit("<s>")).otherwise(s)
    )


def _rare(tree: DataFrame, parent: list[str], child: str) -> DataFrame:
    """tree with rare children of nodes with many children as `*`.

    tree is one row a template, with counts.  Nodes are summed in two steps,
    so no task holds all children of a node."""
    children = tree.groupBy(*parent, child).agg(F.sum("n").alias("_n"))
    nodes = children.groupBy(*parent).agg(F.count("*").alias("_children"), F.sum("_n").alias("_all"))
    nodes = nodes.filter(F.col("_children") > MANY).drop("_children")
    rare = children.join(nodes, parent).filter(F.col("_n") < RARE * F.col("_all")).select(*parent, child, F.lit(True).alias("_rare"))
    return tree.join(rare, [*parent, child], "left").withColumn(child + "g", F.when(F.col("_rare"), "*").otherwise(F.col(child))).drop("_rare")


def _similar(tree: DataFrame, parent: list[str], child: str, out: str) -> DataFrame:
    """tree with branches of like labelled rate under the name `~`."""
    branch = tree.groupBy(*parent, child).agg(F.sum("labelled").alias("_n"), F.sum("blocked").alias("_b"))
    pool = branch.groupBy(*parent).agg(F.sum("_n").alias("_pn"), F.sum("_b").alias("_pb"), F.count_if(F.col("_n") > 0).alias("_with"))
    p, q = F.col("_pb") / F.col("_pn"), F.col("_b") / F.col("_n")
    like = (F.col("_n") > 0) & (F.col("_with") > 1) & (F.abs(q - p) <= Z * F.sqrt(p * (1 - p) / F.col("_n")))
    merged = branch.filter(F.col("_n") > 0).join(pool.filter(F.col("_pn") > 0), parent).filter(like).select(*parent, child, F.lit(True).alias("_like"))
    return tree.join(merged, [*parent, child], "left").withColumn(out, F.when(F.col("_like"), "~").otherwise(F.col(child))).drop("_like")


def judge_urls(pages: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """pages with host, path, rule, verdict, template and purity.

    Null urls have an empty host and path and form a template of their own;
    equal rows get equal verdicts; very long urls and paths of any depth are
    read whole; an empty table gives an empty one; columns of pages with the
    names of new ones are replaced, any other name may occur.
    """
    new = ("host", "path", "rule", "verdict", "template", "purity")
    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c not in new or c == url]
    seen = pages.select(F.struct(*kept).alias("_row"), host.alias("_host"), path.alias("_path"))
    seen = seen.withColumn("_fit", longest_rule(F.col("_host"), F.col("_path"), rules))
    parts = F.filter(F.split(F.col("_path"), "/"), lambda x: x != "")
    raw = ["_host", "_s"]
    seen = seen.withColumn("_s", F.transform(parts, segment))
    none = F.array().cast("array<string>")
    tree = seen.groupBy(*raw).agg(
        F.count("*").alias("n"), F.count("_fit").alias("labelled"), F.count_if(F.col("_fit.verdict") == "block").alias("blocked"),
    ).withColumns({"_g": none, "_t": none})
    # Each step reads the tree several times: written, the plans stay small.
    tree = materialize(tree, "templates")
    depth = tree.agg(F.max(F.size("_s"))).first()[0] or 1
    # Down, a level at a time.  A path's end is a child without a name; below
    # it there is nothing to choose.
    ended = {}
    for level in range(1, depth + 1):
        tree = tree.withColumn("_c", F.coalesce(F.try_element_at("_s", F.lit(level)), F.lit("")))
        tree = _rare(tree, ["_host", "_g"], "_c").withColumn("_g", F.concat("_g", F.array("_cg"))).drop("_c", "_cg")
        tree = materialize(tree, "templates")
        end = F.element_at("_g", -1) == ""
        ended[level], tree = tree.filter(end), tree.filter(~end)
    # Up again, with the paths that end at each level.
    for level in range(depth, 0, -1):
        tree = tree.unionByName(ended[level]).withColumns({"_p": F.slice("_g", 1, level - 1), "_c": F.element_at("_g", level)})
        tree = _similar(tree, ["_host", "_p"], "_c", "_m").withColumn("_t", F.concat(F.array("_m"), "_t")).drop("_p", "_c", "_m")
        tree = materialize(tree, "templates")
    names = F.filter("_t", lambda x: x != "")
    names = F.concat(F.array("_host"), names, F.array_repeat(F.lit(""), F.greatest(F.lit(0), 3 - F.size(names))))
    tree = tree.withColumn("template", F.array_join(names, "/"))
    scores = tree.groupBy("template").agg(F.sum("labelled").alias("_n"), F.sum("blocked").alias("_b"))
    scores = scores.select("template", ((F.col("_b") + WEIGHT * PRIOR) / (F.col("_n") + WEIGHT)).alias("purity"))
    judged = tree.select(*raw, "template").join(scores, "template")
    verdict = F.coalesce(F.col("_fit.verdict"), F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    out = seen.join(judged, raw).withColumns({"verdict": verdict, "rule": F.col("_fit.rule")})
    return out.select("_row.*", F.col("_host").alias("host"), F.col("_path").alias("path"), "rule", "verdict", "template", "purity")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 6).alias("purity"))


ORACLE = r"""
WITH r0 AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
r1 AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM r0),
rules(verdict, h, p) AS (VALUES ('block', 'com', 'en/'), ('allow', 'example.com', 'en/7'), ('allow', 'net', 'de/'), ('block', 'example.net', 'de/8'), ('block', 'org', 'es/')),
fit AS (SELECT page_id, arg_max(h || '/' || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS v
  FROM r1 JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, '/' || p) GROUP BY page_id),
seg AS (SELECT r1.page_id, host, path, rule, v, list_filter(string_split(path, '/'), lambda x: x <> '') AS ps FROM r1 LEFT JOIN fit USING (page_id)),
cls AS (SELECT page_id, host, path, rule, v,
  CASE WHEN ps[1] IS NULL THEN '' WHEN regexp_matches(ps[1], '^[0-9]+$') THEN '<n>' WHEN regexp_matches(ps[1], '^[0-9]+\.[a-z]+$') THEN '<n>.' WHEN regexp_matches(ps[1], '^[0-9a-f-]{8,}$') THEN '<h>' WHEN length(ps[1]) > 24 THEN '<s>' ELSE ps[1] END AS s1,
  CASE WHEN ps[2] IS NULL THEN '' WHEN regexp_matches(ps[2], '^[0-9]+$') THEN '<n>' WHEN regexp_matches(ps[2], '^[0-9]+\.[a-z]+$') THEN '<n>.' WHEN regexp_matches(ps[2], '^[0-9a-f-]{8,}$') THEN '<h>' WHEN length(ps[2]) > 24 THEN '<s>' ELSE ps[2] END AS s2,
  CASE WHEN len(ps) > 2 THEN '<+>' ELSE '' END AS s3 FROM seg),
a1 AS (SELECT *, count(*) OVER (PARTITION BY host, s1) AS n1, count(*) OVER (PARTITION BY host) AS nh FROM cls),
k1 AS (SELECT host, count(DISTINCT s1) AS k FROM cls GROUP BY host),
a2 AS (SELECT a1.*, CASE WHEN k > 50 AND n1 < 0.01::DOUBLE * nh THEN '*' ELSE s1 END AS g1 FROM a1 JOIN k1 USING (host)),
k2 AS (SELECT host, g1, count(DISTINCT s2) AS k2 FROM a2 GROUP BY host, g1),
a3 AS (SELECT *, count(*) OVER (PARTITION BY host, g1, s2) AS n2, count(*) OVER (PARTITION BY host, g1) AS nn FROM a2 JOIN k2 USING (host, g1)),
a4 AS (SELECT *, CASE WHEN k2 > 50 AND n2 < 0.01::DOUBLE * nn THEN '*' ELSE s2 END AS g2 FROM a3),
b2 AS (SELECT host, g1, g2, count(v)::DOUBLE AS n, count(*) FILTER (v = 'block')::DOUBLE AS b FROM a4 GROUP BY ALL),
p2 AS (SELECT host, g1, sum(n) AS pn, sum(b) AS pb, count(*) FILTER (n > 0) AS w FROM b2 GROUP BY ALL),
m2 AS (SELECT host, g1, g2 FROM b2 JOIN p2 USING (host, g1) WHERE n > 0 AND w > 1 AND abs(b / n - pb / pn) <= 1.96::DOUBLE * sqrt(pb / pn * (1 - pb / pn) / n)),
a5 AS (SELECT a4.*, CASE WHEN m2.host IS NOT NULL THEN '~' ELSE a4.g2 END AS t2 FROM a4 LEFT JOIN m2 ON a4.host = m2.host AND a4.g1 = m2.g1 AND a4.g2 = m2.g2),
b1 AS (SELECT host, g1, count(v)::DOUBLE AS n, count(*) FILTER (v = 'block')::DOUBLE AS b FROM a5 GROUP BY ALL),
p1 AS (SELECT host, sum(n) AS pn, sum(b) AS pb, count(*) FILTER (n > 0) AS w FROM b1 GROUP BY ALL),
m1 AS (SELECT host, g1 FROM b1 JOIN p1 USING (host) WHERE n > 0 AND w > 1 AND abs(b / n - pb / pn) <= 1.96::DOUBLE * sqrt(pb / pn * (1 - pb / pn) / n)),
a6 AS (SELECT a5.*, CASE WHEN m1.host IS NOT NULL THEN '~' ELSE a5.g1 END AS t1 FROM a5 LEFT JOIN m1 ON a5.host = m1.host AND a5.g1 = m1.g1),
z AS (SELECT *, (count(*) FILTER (v = 'block') OVER (PARTITION BY host, t1, t2, s3) + 0.8::DOUBLE) / (count(v) OVER (PARTITION BY host, t1, t2, s3) + 4.0::DOUBLE) AS purity FROM a6)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN purity >= 0.8::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
  concat_ws('/', host, t1, t2, s3) AS template, round(purity, 6) AS purity
FROM z
"""
