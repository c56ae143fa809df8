"""URL filter: host and path rules, and trust that spreads over links between hosts.

Only DataFrame functions. A rule fits its host and all subdomains if the path starts with the
rule's path; the longest rule wins. Where no rule fits, the host decides: personalised PageRank
spreads trust from trusted seed hosts along links, and distrust from blocked seed hosts against
them (who links to a blocked host is suspect). Rounds go on until what they could still add to any
host is below ``REST``, far less than the margin, however long the ways and however many the seeds. A host is a trusted seed if rules allow more of its
pages than they block, and a blocked seed if rules block more than half of all its pages. It is
blocked if its distrust exceeds its trust by ``MARGIN`` or more, else allowed; so a host without
any evidence is allowed.

A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed.
Null or empty html has no links. Repeated pages are answered each and count each. Links are
counted per pair of hosts before they are joined with anything, and links within a host count
for nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.components import stored

DAMPING = 0.85
ROUNDS = 10
MARGIN = 0.05
REST = 1e-6
STORE_EVERY = 5
# Rules become one expression, so their number is bounded.
MOST_RULES = 1000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def _low(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path`` of ``url``."""
    at = F.locate("://", F.coalesce("url", F.lit("")))
    rest = F.when(at > 0, F.col("url").substr(at + 3, F.length("url"))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return pages.withColumn("host", _low(host)).withColumn("path", path)


def rule_of(rules: tuple[Rule, ...] = RULES, host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """(rule text, its verdict) for a row; null where none fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = ((F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)) & F.col(path).startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, from pages with ``host`` and ``html``."""
    found = F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))
    linked = pages.where("html LIKE '%//%' AND host <> ''").select(F.col("host").alias("src"), F.explode(found).alias("dst"))
    return (
        linked.select("src", _low(F.regexp_replace("dst", "^[^@]*@", "")).alias("dst"))
        .where("dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    )


def host_scores(seeds: DataFrame, links: DataFrame, rounds: int | None = None, damping: float = DAMPING, rest: float = REST) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust) by personalised PageRank.

    Seeds give their weight anew in each round; what reaches a host without links onward ends there.
    Without ``rounds`` they go on until all later ones together add less than ``rest`` to a host.
    """
    start = seeds.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (kind, seed)")).where("seed > 0")
    start = stored(start, "host-seeds")
    ways = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    out = ways.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    ways = stored(ways.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("all")).alias("share")), "host-ways")
    # new: what the last round brought, part of the score; the next round sends this on alone
    given = F.col("seed") * (1 - damping)
    scores = start.select("kind", "host", given.alias("score"), given.alias("new"))
    done = 0
    if ways.isEmpty():
        rounds = 0
    while rounds is None or done < rounds:
        sent = ways.join(scores.where("new > 0").select("kind", F.col("host").alias("src"), "new"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("share") * F.col("new") * damping).alias("score")
        )
        scores = (
            scores.withColumn("new", F.lit(0.0)).unionByName(sent.withColumn("new", F.col("score")))
            .groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("new").alias("new"))
        )
        done += 1
        if done % STORE_EVERY == 0:
            scores = stored(scores, "host-scores")
            # a round sends on at most ``damping`` of what the one before brought
            most = scores.groupBy("kind").agg(F.sum("new").alias("new")).agg(F.max("new")).first()[0] or 0.0
            if rounds is None and most * damping / (1 - damping) < rest:
                break
    value = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    return scores.groupBy("host").agg(value("trust"), value("distrust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, margin: float = MARGIN) -> DataFrame:
    """(page_id, host, path, rule, verdict) per page."""
    own = with_parts(pages.select("page_id", "url", "html"))
    text, verdict = rule_of(rules)
    ruled = own.select("page_id", "host", "path", text.alias("rule"), verdict.alias("ruled"))
    allowed, blocked = F.count_if(F.col("ruled") == "allow"), F.count_if(F.col("ruled") == "block")
    hosts = ruled.where("host <> ''").groupBy("host").agg(
        (allowed > blocked).cast("double").alias("trust"), (blocked * 2 > F.count("*")).cast("double").alias("distrust")
    )
    scores = host_scores(hosts, host_links(own), rounds=None)
    suspect = scores.where(F.col("distrust") - F.col("trust") >= margin).select("host", F.lit("block").alias("spread"))
    return ruled.join(suspect, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "spread", F.lit("allow")).alias("verdict")
    )
