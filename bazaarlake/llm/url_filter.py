"""URL filter with trust and distrust spread over host links. DataFrame functions only.

Rules name a host and the start of a path. A URL that a rule fits gets the rule's verdict (the longest rule wins).
The pages that rules judge make their hosts seeds: allowed pages of trust, blocked pages of distrust. Trust flows along
links (personalised PageRank from the trusted seeds: whom trusted hosts link to); distrust flows against them
(PageRank on the reversed graph from the blocked seeds: who links to blocked hosts). A host whose distrust exceeds
its trust is blocked, for all its URLs without a rule.

Links are summed to one row per pair of hosts before the iterations, so these depend on the number of host pairs only. Each step
joins the scores to the edges and sums per host with partial sums first, which keeps a host with very many links from landing
in one task; every step is cut off in the checkpoint folder. Steps go on until no host's trust or distrust changes by more than
TOLERANCE of itself, so every host that links connect with a seed is reached, and what is still to come is less than RATIO
tells apart.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import clear_names, cut, small, table

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
DAMPING, STEPS, RATIO = 0.85, 8, 1.000001
TOLERANCE = 1e-7
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def lower(c: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return F.coalesce(lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct of rule and verdict of the longest rule that fits, else null. ``rules`` is a list of the caller's, so bounded."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, host: str, html: str = "html") -> DataFrame:
    """One row per pair of different hosts: src, dst, links. Only links that name a host count."""
    return (
        pages.select(F.col(host).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), 1)).alias("dst"))
        .select("src", lower(F.col("dst")).alias("dst"))
        .where((F.col("src") != "") & (F.col("dst") != F.col("src")))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def spread(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, steps: int | None = STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """Scores (host, trust, distrust) after ``steps`` steps, or once none changes by more than ``tolerance`` of itself if that is None, from seeds (host, trust, distrust) over edges (src, dst, links).

    Hosts without outgoing (for distrust: incoming) links keep nothing for others. Without edges the seeds' own share stays.
    """
    zero = F.lit(0.0)
    own = cut(seeds.select("host", *[((1 - damping) * F.col(c)).alias(c) for c in ("trust", "distrust")]))
    edges = cut(edges)
    if edges.isEmpty():
        return own
    out = edges.groupBy("src").agg(F.sum("links").alias("out"))
    into = edges.groupBy("dst").agg(F.sum("links").alias("into"))
    shares = cut(
        edges.join(out, "src")
        .join(into, "dst")
        .select("src", "dst", (F.col("links") / F.col("out")).alias("forth"), (F.col("links") / F.col("into")).alias("back"))
    )
    kinds = ("trust", "distrust")
    none = [zero.alias(f"was_{c}") for c in kinds]
    moved = F.greatest(*[F.abs(F.col(c) - F.col(f"was_{c}")) - tolerance * F.col(c) for c in kinds])
    scores, done = own, 0
    while steps is None or done < steps:
        forth = shares.join(scores.where(F.col("trust") > 0), F.col("src") == F.col("host")).select(
            F.col("dst").alias("host"), (damping * F.col("trust") * F.col("forth")).alias("trust"), zero.alias("distrust"), *none
        )
        back = shares.join(scores.where(F.col("distrust") > 0), F.col("dst") == F.col("host")).select(
            F.col("src").alias("host"), zero.alias("trust"), (damping * F.col("distrust") * F.col("back")).alias("distrust"), *none
        )
        was = scores.select("host", *[zero.alias(c) for c in kinds], *[F.col(c).alias(f"was_{c}") for c in kinds])
        new = own.select("host", *kinds, *none).unionByName(forth).unionByName(back).unionByName(was)
        new = cut(new.groupBy("host").agg(*[F.sum(c).alias(c) for c in (*kinds, "was_trust", "was_distrust")]))
        scores, done = new.select("host", *kinds), done + 1
        if steps is None and new.where(moved > 0).isEmpty():
            break
    return scores


def judge(pages: DataFrame, url: str = "url", html: str = "html", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    A null URL or one without ``://`` has an empty host and path, fits no rule and is allowed. Null or empty html has
    no links; relative addresses name no host and are no links, those in comments and scripts count like any other. Pages are judged row by row, so repeated rows count again as seeds and get equal verdicts. A tie of trust and
    distrust allows. Columns of ``pages`` named like an added one are kept as ``in_<name>``; an empty table gives no rows.
    """
    pages = clear_names(pages, ("host", "path", "rule", "verdict"))
    cols = pages.columns
    parsed = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    judged = parsed.withColumn("_hit", longest_rule(F.col("host"), F.col("path"), rules))
    verdict = F.col("_hit")["verdict"]
    counts = (
        judged.where(verdict.isNotNull())
        .groupBy("host")
        .agg(F.count_if(verdict == "allow").alias("trust"), F.count_if(verdict == "block").alias("distrust"))
    )
    counts = cut(counts)
    ruled = counts.agg(F.sum(F.col("trust") + F.col("distrust"))).first()[0] or 1
    seeds = counts.select("host", *[(F.col(c) / F.lit(float(ruled))).alias(c) for c in ("trust", "distrust")])
    scores = spread(seeds, host_edges(parsed, "host", html), steps=None)
    bad = cut(scores.where(F.col("distrust") > F.col("trust") * RATIO).select("host", F.lit(True).alias("_bad")))
    return judged.join(small(bad), "host", "left").select(
        *cols,
        "host",
        "path",
        F.col("_hit")["rule"].alias("rule"),
        F.coalesce(verdict, F.when(F.col("_bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )


def op1_host_trust(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


def _op1_sql() -> str:
    lowered = lambda x: f"translate({x}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    fits = lambda r: f"((host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}'))"
    by_length = sorted(RULES, key=lambda r: -len(r[1]))
    rule = " ".join(f"WHEN {fits(r)} THEN '{r}'" for _, r in by_length)
    verdict = " ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in by_length)
    # After so many steps less than 1e-10 of the seeds' mass is still to come.
    steps = math.ceil(math.log(1e-10) / math.log(DAMPING))
    link = LINK.replace("'", "''")
    return f"""
WITH RECURSIVE p AS (SELECT page_id, html, coalesce({lowered("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
                  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE {rule} END AS rule FROM p),
v AS (SELECT *, CASE {verdict} END AS ruled FROM r),
c AS (SELECT host, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b FROM v WHERE ruled IS NOT NULL GROUP BY host),
n AS (SELECT greatest(sum(a + b), 1)::DOUBLE AS n FROM c),
t0 AS (SELECT host, {1 - DAMPING} * (a / n) AS trust, {1 - DAMPING} * (b / n) AS distrust FROM c, n),
x AS (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS raw FROM p),
e AS (SELECT src, {lowered("raw")} AS dst, count(*) AS links FROM x WHERE src <> '' GROUP BY ALL HAVING dst <> src),
sh AS (SELECT src, dst, links / sum(links) OVER (PARTITION BY src) AS forth, links / sum(links) OVER (PARTITION BY dst) AS back FROM e),
t AS (SELECT 0 AS step, host, trust, distrust FROM t0
      UNION ALL
      SELECT step + 1, host, sum(trust), sum(distrust) FROM (
        SELECT step, t0.host, t0.trust, t0.distrust FROM t0, (SELECT max(step) AS step FROM t)
        UNION ALL SELECT step, dst, {DAMPING} * trust * forth, 0 FROM sh JOIN t ON src = host
        UNION ALL SELECT step, src, 0, {DAMPING} * distrust * back FROM sh JOIN t ON dst = host)
      WHERE step < {steps} GROUP BY step, host),
bad AS (SELECT host FROM t WHERE step = {steps} AND distrust > trust * {RATIO})
SELECT page_id, host, path, rule,
       CASE WHEN ruled IS NOT NULL THEN ruled WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM v
"""


OP1_SQL = _op1_sql()
