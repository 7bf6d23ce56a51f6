"""URL filtering by rules on hosts and paths.

Each URL is expanded into its host suffixes (at dots) times the path prefixes whose lengths occur in rules. The
expressions are joined with the rules on a short prefix of their digests, candidates are confirmed on full digests,
and of a URL's matches the rule with the longest text wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Host, path and verdict of each rule.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Hex digits of the digests that are joined on, and rules up to which their table is broadcast.
SHORT, BROADCAST = 8, 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def filtered(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages.

    A rule fits its host and all subdomains where the path starts with the rule's. The longest rule text wins, of
    equally long ones the longer host. Without a rule the verdict is the default. A null url, and one without ://,
    has an empty host and path, which no rule fits. Rows are judged one by one, repeated ones too. Only page_id and
    url are read; no rules or no pages are fine.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id())
    lengths = sorted({len(p) for _, p, _ in rules})
    if not lengths:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    starts = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull())
    spread = rows.withColumn("suffix", F.explode(suffixes)).withColumn("start", F.explode_outer(starts))
    spread = spread.withColumn("digest", F.sha2(F.concat_ws("\n", "suffix", "start"), 256)).withColumn("short", F.substring("digest", 1, SHORT))
    known = pages.sparkSession.createDataFrame([tuple(r) for r in rules], "rule_host string, rule_path string, rule_verdict string")
    known = known.withColumn("rule_digest", F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256)).withColumn("short", F.substring("rule_digest", 1, SHORT))
    known = F.broadcast(known) if len(rules) <= BROADCAST else known
    fits = F.col("digest") == F.col("rule_digest")
    text = F.concat("rule_host", "rule_path")
    rank = F.when(fits, F.struct(F.length(text).alias("n"), F.length("rule_host").alias("h"), text.alias("rule"), F.col("rule_verdict").alias("verdict")))
    best = spread.join(known, "short", "left").groupBy("row", "page_id", "host", "path").agg(F.max(rank).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


ORACLE = """
WITH cut AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) END, '') AS rest FROM pages),
p AS (SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
r(rule_host, rule_path, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path,
  (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM r WHERE starts_with(path, rule_path) AND (host = rule_host OR ends_with(host, '.' || rule_host))) AS rule,
  coalesce((SELECT arg_max(v, length(rule_host || rule_path)) FROM r WHERE starts_with(path, rule_path) AND (host = rule_host OR ends_with(host, '.' || rule_host))), 'allow') AS verdict
FROM p
"""
