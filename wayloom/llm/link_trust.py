"""URL filter by rules and, where no rule fits, by trust carried along host links.

The host graph has an edge for every hyperlink to another host (weight: number of
links, any page) and edges between a host and its parent domain in both directions,
down to two labels (hosts within the 253 characters of a valid name). Trust starts
at hosts with pages that an allow rule fits, in proportion to those pages, and
walks along links (personalised PageRank); distrust starts at hosts with blocked
pages and walks along reversed links. Both walks are one iteration over
``(walk, host)``; it goes on for at least the number of rounds that bounds the rest by
``tolerance`` (``damping ** rounds``), and until no host is newly reached and every
score is settled relative to itself. A host is allowed if its trust reaches
``threshold`` of trust plus distrust, as a ratio, so the number of seeds and pages
does not matter; a host that neither reaches is allowed.

Everything is joins and sums: page links fold to host edges first, sums fold before
each shuffle, a hot host is one row in the graph, and the join back to pages can
be split by adaptive execution. Null urls, urls without ``://`` and null html are
pages of the empty host, which has no edges. Repeated rows are judged alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import stored
from wayloom.session import cut, discard, ship

# fixed values: the rules of the contract, (verdict, host, path)
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"),
         ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    after = F.when(rest.isNull(), F.lit("")).otherwise(F.substring(url, F.length(rest) + 4, F.length(url)))
    raw = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(raw) + 1, F.length(after)), "^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as text) and its verdict; null if none fits."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return name, verdict


def judged(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    host, path = host_and_path(F.col(url))
    p = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return p.select("*", name.cast("string").alias("rule"), verdict.cast("string").alias("fixed"))


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, w over different hosts: hyperlinks counted, parent domains once in each direction."""
    host, _ = host_and_path(F.col(url))
    links = pages.select(host.alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("to"))
    links = links.select("src", F.translate("to", UPPER, LOWER).alias("dst")).where("src != dst and src != ''")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("w"))
    known = pages.select(host.alias("h")).distinct().union(links.select("dst")).distinct()
    parts = known.where("length(h) <= 253").select(F.split("h", r"\.").alias("p")).where("size(p) > 2")
    steps = parts.select(F.explode(F.sequence(F.lit(1), F.size("p") - 2)).alias("i"), "p").select(
        F.array_join(F.slice("p", F.col("i"), F.size("p")), ".").alias("a"),
        F.array_join(F.slice("p", F.col("i") + 1, F.size("p")), ".").alias("b")).distinct()
    site = steps.selectExpr("a as src", "b as dst", "1D as w").union(steps.selectExpr("b", "a", "1D"))
    return links.union(site).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def rounds_for(damping: float, tolerance: float) -> int:
    return math.ceil(math.log(tolerance) / math.log(damping))


def host_scores(edges: DataFrame, seeds: DataFrame, damping: float = 0.6, tolerance: float = 0.01,
                cut_every: int = 4, settled: float = 1e-7) -> DataFrame:
    """host, trust, distrust. ``seeds``: walk (0 trust, 1 distrust), host, share.

    A score counts as settled if ``cut_every`` rounds change it by ``settled`` of itself or less.
    """
    both = edges.select(F.lit(0).alias("walk"), "src", "dst", "w").union(
        edges.select(F.lit(1), F.col("dst"), F.col("src"), F.col("w")))
    out = both.groupBy("walk", "src").agg(F.sum("w").alias("out"))
    steps = stored(both.join(out, ["walk", "src"]).select("walk", F.col("src").alias("host"), "dst",
                                                          (F.col("w") / F.col("out")).alias("p")))
    start = cut(seeds.select("walk", "host", "share"))
    base = start.select("walk", "host", (F.col("share") * (1 - damping)).alias("score"))
    score = last = start.select("walk", "host", F.col("share").alias("score"))
    i, least, change = 0, rounds_for(damping, tolerance), 1.0
    while i < least or change > settled:
        for _ in range(cut_every):
            moved = score.join(steps, ["walk", "host"]).select(
                "walk", F.col("dst").alias("host"), (F.col("score") * F.col("p") * damping).alias("score"))
            score = moved.union(base).groupBy("walk", "host").agg(F.sum("score").alias("score"))
        i += cut_every
        score = cut(score)
        # a host reached only now counts as changed by all of its score
        was = score.join(last.withColumnRenamed("score", "was"), ["walk", "host"], "left")
        was = was.where("score > 0").select((F.abs(F.col("score") - F.coalesce("was", F.lit(0.0))) / F.col("score")).alias("c"))
        change = was.agg(F.max("c")).first()[0] or 0.0
        discard(last)  # two tables of scores at a time, however many rounds
        last = score
    part = lambda k: F.coalesce(F.sum(F.when(F.col("walk") == k, F.col("score"))), F.lit(0.0))
    return score.groupBy("host").agg(part(0).alias("trust"), part(1).alias("distrust"))


def filter_urls(pages: DataFrame, rules=RULES, damping: float = 0.6, tolerance: float = 0.01,
                threshold: float = 0.5, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    rows = judged(pages, rules, key, url)
    walk = F.when(F.col("fixed") == "allow", 0).when(F.col("fixed") == "block", 1)
    n = rows.where(F.col("fixed").isNotNull()).groupBy(walk.alias("walk"), "host").agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy("walk").agg(F.sum("n").alias("all"))  # two rows
    seeds = n.join(total, "walk").select("walk", "host", (F.col("n") / F.col("all")).alias("share"))
    scores = host_scores(host_edges(pages, url, html), seeds, damping, tolerance)
    both = F.col("trust") + F.col("distrust")
    ok = F.coalesce(F.round(F.when(both > 0, F.col("trust") / both) - threshold, 6) >= 0, F.lit(True))
    return rows.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", F.when(ok, "allow").otherwise("block")).alias("verdict"))


def op3_link_trust(spark, sf_dir):
    ship(spark)
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _sql(damping: float = 0.6, tolerance: float = 0.01, threshold: float = 0.5) -> str:
    rules = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1]))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN" for _, h, p in rules]
    name = " ".join(f"{f} '{h}{p}'" for f, (_, h, p) in zip(fits, rules, strict=True))
    fixed = " ".join(f"{f} '{v}'" for f, (v, _, _) in zip(fits, rules, strict=True))
    ctes = [f"""
u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
       regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
j AS (SELECT page_id, host, path, CASE {name} END AS rule, CASE {fixed} END AS fixed FROM hp),
raw AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1)), '{UPPER}', '{LOWER}') AS dst FROM hp),
links AS (SELECT src, dst, count(*)::DOUBLE AS w FROM raw WHERE src <> dst AND src <> '' GROUP BY ALL),
known AS (SELECT DISTINCT host AS h FROM hp UNION SELECT dst FROM links),
parts AS (SELECT string_split(h, '.') AS p FROM known WHERE length(h) <= 253),
pos AS (SELECT p, unnest(range(1, len(p) - 1)) AS i FROM parts WHERE len(p) > 2),
steps AS (SELECT DISTINCT array_to_string(p[i:], '.') AS a, array_to_string(p[i + 1:], '.') AS b FROM pos),
edges AS (SELECT src, dst, sum(w) AS w FROM (SELECT * FROM links UNION ALL SELECT a, b, 1 FROM steps UNION ALL SELECT b, a, 1 FROM steps) GROUP BY ALL),
both_ways AS (SELECT 0 AS walk, src, dst, w FROM edges UNION ALL SELECT 1, dst, src, w FROM edges),
flow AS (SELECT walk, src AS host, dst, w / sum(w) OVER (PARTITION BY walk, src) AS p FROM both_ways),
seed AS (SELECT walk, host, n / sum(n) OVER (PARTITION BY walk) AS share FROM (
  SELECT CASE fixed WHEN 'allow' THEN 0 ELSE 1 END AS walk, host, count(*) AS n FROM j WHERE fixed IS NOT NULL GROUP BY ALL)),
r0 AS MATERIALIZED (SELECT walk, host, share AS score FROM seed)"""]
    n = rounds_for(damping, tolerance)
    ctes += [f"""
r{i} AS MATERIALIZED (SELECT walk, host, sum(score) AS score FROM (
  SELECT f.walk, f.dst AS host, r.score * f.p * {damping}::DOUBLE AS score FROM r{i - 1} r JOIN flow f USING (walk, host)
  UNION ALL SELECT walk, host, share * {1 - damping}::DOUBLE FROM seed) GROUP BY ALL)""" for i in range(1, n + 1)]
    return "WITH " + ",".join(ctes) + f""",
s AS (SELECT host, coalesce(sum(score) FILTER (walk = 0), 0) AS trust, coalesce(sum(score) FILTER (walk = 1), 0) AS distrust FROM r{n} GROUP BY host)
SELECT page_id, j.host, path, rule, coalesce(fixed, CASE WHEN
  round(coalesce(trust, 0) - {threshold}::DOUBLE * coalesce(trust + distrust, 0), 12) >= 0 THEN 'allow' ELSE 'block' END) AS verdict
FROM j LEFT JOIN s ON j.host = s.host"""


OP3_SQL = _sql()
