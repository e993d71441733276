"""Page filters: rules on host and path, and link-graph propagation where no rule decides.

Hosts are joined by the links of their pages (absolute and scheme-relative ``href``; relative
links stay on the host) and, weakly, with the domain above them. Personalised PageRank carries
trust along edges from pages that rules allow, standing along edges from pages without a rule,
and distrust against the edges from pages that rules block: what links to blocked pages loses.
A host is blocked if its distrust exceeds its trust and standing. Scores are in pages, so they
need no total, and lie within ``TOLERANCE`` of the seeds to the fixed point. Only DataFrame functions are used.

Cases: a null url, or one without ``://``, has empty host and path, meets no rule, and is allowed.
A null page text has no links. Rows may repeat; every row is judged. Extra columns are ignored.
An empty table gives an empty result. Mass at hosts without edges in a direction stays there
only as seed, the rest of it fades.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import staged, table

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DAMPING = 0.85
TOLERANCE = 1e-4  # of the seeds
ROUND = 4  # steps between two written tables
_LINK = r"(?i)\bhref\s*=\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: F.Column) -> F.Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = lower_ascii(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")))
    return host, F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: F.Column, path: F.Column, rules=RULES) -> tuple[F.Column, F.Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for domain, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0])):  # longer ones are asked first
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(domain + start)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """seeds (kind, host, seed) and edges (kind, src, dst, weight) to (kind, host, score).

    Scores are sums over walks of every length; ``fresh`` is what walks of the last length added.
    Longer ones can add ``damping / (1 - damping)`` times its total at most, so steps end when
    that is within ``tolerance`` of the kind's seeds; the scores, summed over all hosts, then lie
    that near to the fixed point. A step keeps at most ``damping`` of the total, so
    ``log(tolerance) / log(damping)`` steps, rounded up to whole rounds, are always enough.

    A row a host and kind; sums are combined before the shuffle, so a hub costs a row a task.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    walk = edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("all")).alias("share"), F.lit(0.0).alias("own"))
    nodes = seeds.select("kind", "host").unionAll(edges.select("kind", "dst")).distinct()
    # a host's own score goes to itself, so that a step reads the ranks once
    walk = staged(walk.unionByName(nodes.select("kind", F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(0.0).alias("share"), F.lit(1.0).alias("own"))))
    start = F.col("seed") * F.lit(1 - damping)
    rank = staged(seeds.select("kind", "host", start.alias("score"), start.alias("fresh")))

    def ahead() -> dict[str, float]:
        """By kind, the most that longer walks can add."""
        return {r.kind: r.total * damping / (1 - damping) for r in rank.groupBy("kind").agg(F.sum("fresh").alias("total")).collect()}

    left = ahead()
    enough = {kind: most / damping * tolerance for kind, most in left.items()}
    while any(most > enough[kind] for kind, most in left.items()):
        for _ in range(ROUND):
            flow = rank.withColumnRenamed("host", "src").join(walk, ["kind", "src"])
            added = F.col("fresh") * F.col("share") * F.lit(damping)
            flow = flow.select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("own") + added).alias("score"), added.alias("fresh"))
            rank = flow.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("fresh").alias("fresh"))
        rank = staged(rank)
        left = ahead()
    return rank.select("kind", "host", "score")


def judged(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """Per row: id, host, path, rule, verdict, host_score (standing less distrust, in pages)."""
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"), F.col(f"`{html_col}`").alias("html"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    links = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)), lower_ascii))
    pages = staged(rows.select("id", "host", "path", rule.alias("rule"), says.alias("says"), F.array_remove(F.coalesce(links, F.array().cast("array<string>")), F.col("host")).alias("links")))
    named = pages.where("host <> ''")
    kind = F.when(F.col("says") == "allow", "trust").when(F.col("says") == "block", "distrust").otherwise("standing")
    seeds = named.groupBy(kind.alias("kind"), "host").agg(F.count(F.lit(1)).cast("double").alias("seed"))
    linked = named.select(F.col("host").alias("src"), F.explode("links").alias("dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    known = named.select("host").unionAll(linked.select(F.col("dst").alias("host"))).distinct()
    above = known.select("host", F.regexp_replace("host", r"^[^.]*\.", "").alias("up")).where("up <> host and up like '%.%'")
    ties = above.select(F.col("host").alias("src"), F.col("up").alias("dst"), F.lit(1.0).alias("weight"))
    ties = ties.unionByName(ties.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    both = staged(linked.unionByName(ties).groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    forth = both.withColumn("kind", F.explode(F.array(F.lit("trust"), F.lit("standing"))))
    back = both.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", F.lit("distrust").alias("kind"))
    rank = propagate(seeds, forth.unionByName(back))
    signed = F.when(F.col("kind") == "distrust", -F.col("score")).otherwise(F.col("score"))
    hosts = staged(rank.groupBy("host").agg(F.round(F.sum(signed), 9).alias("host_score")))
    got = pages.select("id", "host", "path", "rule", "says").join(hosts, "host", "left")
    verdict = F.coalesce("says", F.when(F.col("host_score") < 0, "block").otherwise("allow"))
    return got.select("id", "host", "path", "rule", verdict.alias("verdict"), "host_score")


def op6(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
