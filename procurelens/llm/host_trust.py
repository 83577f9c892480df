"""URL filter: allow and block rules, and trust that spreads over the links between hosts.

A page's host and path are cut from its url by fixed rules. The longest rule that fits decides; pages
without one get the verdict of their host, which comes from the link graph:

1. Links are the addresses with a host in ``href`` attributes; each pair of hosts counts once and
   links within a host not at all. Addresses without a host stay on the page's own host, so they add
   no edge.
2. Seeds: a host's share of trust is that of its pages that a rule allows among its pages that a rule
   decides, its share of distrust that of the blocked ones.
3. Personalised PageRank: trust goes from seeds along the links, distrust against them, to the hosts
   that link to blocked ones. A host passes ``DAMPING`` of what it has, in equal parts, on; what has
   no way to go ends there. Rounds go on until nothing changes, ``ROUNDS`` at most.
4. A host is blocked if it has distrust and at least ``LIMIT`` times its trust, else allowed.

Shares are whole numbers of ``UNIT`` parts and divisions round down, so results do not depend on the
order of additions. Everything is DataFrame code. Pages are grouped by host with sums combined on the
map side, and meet the one row of their host in a join that adaptive execution can split, so one host
with a third of the pages is no single task. Rounds work on hosts alone and are written.

Defined cases: a url that is null or has no ``://`` has an empty host and path, no rule and no links,
and is allowed; a null html has no links; repeated ids and rows are judged row by row; rules of equal
length: the longer host, then the smaller host and path, then block; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import saved, table

#: Rules of the query (fixed values): host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
UNIT = 1_000_000_000
#: Share that a host passes on, as a fraction of whole numbers.
DAMPING = (17, 20)
ROUNDS = 30
#: A host is blocked from this many times its trust in distrust.
LIMIT = 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host of an address in an href attribute; the scheme may be left out.
LINK = r"""(?i)href[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["']?[\x09-\x0D\x20]*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'<>\x00-\x20]+)"""


def lowered(text: Column) -> Column:
    """A to Z as small letters; others as they are."""
    return F.translate(text, UPPER, LOWER)


def with_host(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path`` of a url; both are empty without ``://``."""
    address = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(address, "://")
    rest = F.when(at > 0, F.substring(address, at + 3, F.length(address))).otherwise("")
    return pages.withColumns(
        {"host": lowered(F.regexp_extract(rest, "^[^/?#]*", 0)), "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)}
    )


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, fitting): the rules of each host and the domains above it, an array that the page's path chooses from."""
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    domains = hosts.select("host", F.explode(above).alias("domain"))
    own = rules.select(
        F.col("host").alias("domain"),
        F.struct(
            F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("depth"),
            F.concat("host", "path").alias("rule"), F.col("path").alias("below"), F.col("verdict"),
        ).alias("rule"),
    )
    return domains.join(own, "domain").groupBy("host").agg(F.collect_list("rule").alias("fitting"))


def _longest(path: Column) -> Column:
    """The rule that decides: of those whose path begins the page's path the longest."""
    fits = F.filter("fitting", lambda r: F.startswith(path, r["below"]))
    better = lambda a, b: (
        F.when(a["size"] != b["size"], F.when(a["size"] > b["size"], -1).otherwise(1))
        .when(a["depth"] != b["depth"], F.when(a["depth"] > b["depth"], -1).otherwise(1))
        .when(a["rule"] != b["rule"], F.when(a["rule"] < b["rule"], -1).otherwise(1))
        .when(a["verdict"] != b["verdict"], F.when(a["verdict"] > b["verdict"], -1).otherwise(1))
        .otherwise(0)
    )
    return F.try_element_at(F.array_sort(fits, better), F.lit(1))


def judged_by_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages (with host and path) and the rule that decides each: ``rule`` and ``ruled``, null where none fits."""
    fitting = host_rules(pages.select("host").distinct(), rules)
    chosen = _longest(F.col("path"))
    return pages.join(fitting, "host", "left").withColumns({"rule": chosen["rule"], "ruled": chosen["verdict"]}).drop("fitting")


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(source, target): the hosts that pages of a host link to, other than itself."""
    found = F.transform(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), 1), lowered)
    targets = pages.select(F.col("host").alias("source"), F.explode(F.array_distinct(found)).alias("target"))
    return targets.where("source <> '' AND target <> source").distinct()


def seeds(judged: DataFrame) -> DataFrame:
    """(side, host, seed): the shares of allowed (side 0) and blocked pages (1) of hosts with rules, in units."""
    counts = judged.where("host <> '' AND ruled IS NOT NULL").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("good"), F.count("*").alias("both")
    )
    sides = F.expr(f"stack(2, 0, {UNIT} * good div both, 1, {UNIT} * (both - good) div both) AS (side, seed)")
    return counts.select("host", sides).where("seed > 0")


def spread(spark: SparkSession, seed: DataFrame, links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(side, host, score): personalised PageRank of the seeds, along the links (side 0) and against them (1)."""
    up, down = DAMPING
    start = saved(spark, seed.select("side", "host", F.expr(f"seed * {down - up} div {down}").alias("score")), "seeds")
    ways = links.select(F.lit(0).alias("side"), "source", "target").unionByName(
        links.select(F.lit(1).alias("side"), F.col("target").alias("source"), F.col("source").alias("target"))
    )
    degrees = ways.groupBy("side", "source").agg(F.count("*").alias("ways"))
    ways = saved(spark, ways.join(degrees, ["side", "source"]).withColumnRenamed("source", "host"), "ways")
    scores = start
    for _ in range(rounds):
        passed = scores.join(ways, ["side", "host"]).select(
            "side", F.col("target").alias("host"), F.expr(f"score * {up} div ({down} * ways)").alias("score")
        )
        after = saved(
            spark, start.unionByName(passed).groupBy("side", "host").agg(F.sum("score").alias("score")).where("score > 0"), "trust"
        )
        # A host's score never falls from round to round, so equal totals mean that nothing changed.
        same = after.agg(F.sum("score")).first() == scores.agg(F.sum("score")).first()
        scores = after
        if same:
            break
    return scores


def judged_pages(
    spark: SparkSession, pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html", limit: int = LIMIT, rounds: int = ROUNDS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page; the shares are those of its host."""
    listed = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), "host string, path string, verdict string")
    addressed = with_host(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")))
    # Written, so that the sums of a host's pages do not go by the partitions of the join.
    judged = saved(spark, judged_by_rules(addressed.select("page_id", "host", "path"), listed), "judged")
    scores = spread(spark, seeds(judged), host_links(addressed), rounds)
    part = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("score"))), F.lit(0).cast("long"))
    hosts = scores.groupBy("host").agg(part(0).alias("trust"), part(1).alias("distrust"))
    rows = judged.join(hosts, "host", "left").fillna(0, ["trust", "distrust"])
    bad = (F.col("distrust") > 0) & (F.col("distrust") >= F.col("trust") * limit)
    verdict = F.coalesce("ruled", F.when(bad, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")


def op12_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_pages(spark, table(spark, sf_dir, "pages"), RULES)


def _rounds_sql(rounds: int = ROUNDS) -> str:
    up, down = DAMPING
    parts = [f"t0 AS MATERIALIZED (SELECT side, host, CAST(seed * {down - up} // {down} AS BIGINT) AS score FROM seeds)"]
    for i in range(1, rounds + 1):
        parts.append(
            f"t{i} AS MATERIALIZED (SELECT side, host, CAST(sum(score) AS BIGINT) AS score FROM (SELECT * FROM t0 UNION ALL"
            f" SELECT s.side, w.target, s.score * {up} // ({down} * w.ways) FROM t{i - 1} s JOIN ways w"
            f" ON s.side = w.side AND s.host = w.source) GROUP BY side, host HAVING sum(score) > 0)"
        )
    return ", ".join(parts)


_LINK_SQL = LINK.replace("'", "''")
OP12_SQL = f"""
WITH rules AS (
    SELECT * FROM (VALUES {', '.join(map(str, RULES))}) AS r(rule_host, rule_path, ruled)
), cut AS (
    SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS html,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), addressed AS (
    SELECT r, page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), fits AS (
    SELECT r, rule_host || rule_path AS rule, ruled, row_number() OVER (
        PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, rule_host || rule_path) AS nth
    FROM addressed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), judged AS (
    SELECT a.r, page_id, host, path, rule, ruled FROM addressed a LEFT JOIN fits f ON a.r = f.r AND nth = 1
), links AS (
    SELECT DISTINCT host AS source, translate(link, '{UPPER}', '{LOWER}') AS target
    FROM (SELECT host, unnest(regexp_extract_all(html, '{_LINK_SQL}', 1)) AS link FROM addressed)
    WHERE host <> '' AND translate(link, '{UPPER}', '{LOWER}') <> host
), counts AS (
    SELECT host, count(*) FILTER (ruled = 'allow') AS good, count(*) AS n FROM judged WHERE host <> '' AND ruled IS NOT NULL GROUP BY host
), seeds AS (
    SELECT 0 AS side, host, {UNIT} * good // n AS seed FROM counts WHERE {UNIT} * good // n > 0
    UNION ALL SELECT 1, host, {UNIT} * (n - good) // n FROM counts WHERE {UNIT} * (n - good) // n > 0
), both_ways AS (
    SELECT 0 AS side, source, target FROM links UNION ALL SELECT 1, target, source FROM links
), ways AS (
    SELECT side, source, target, count(*) OVER (PARTITION BY side, source) AS ways FROM both_ways
), {_rounds_sql()}, hosts AS (
    SELECT host, CAST(coalesce(sum(score) FILTER (side = 0), 0) AS BIGINT) AS trust,
           CAST(coalesce(sum(score) FILTER (side = 1), 0) AS BIGINT) AS distrust FROM t{ROUNDS} GROUP BY host
)
SELECT page_id, host, path, rule, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust,
       coalesce(ruled, CASE WHEN distrust > 0 AND distrust >= trust * {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN hosts USING (host)
"""
