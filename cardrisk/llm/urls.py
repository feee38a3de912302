"""URL filter: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter.

The Bloom filter passes possible hits to an exact hash join on the canonical URL; its false hits end there, so the
filter's size bears on speed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.llm import bloom
from cardrisk.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.call_function("substring", url, at + 3))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for a null or one without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.``, then the path without closing slashes; null where there is no host."""
    bare = F.regexp_replace(host, r"^www\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"/+$", "")))


def rule_column(host: Column, path: Column, rules: list[tuple[str, str, str]], take: int | None = None) -> Column:
    """The longest fitting rule as text, or its action with ``take=0``; null if none fits.

    A rule is (action, host, path). It fits its host and all subdomains where the path starts with the rule's. Of rules
    of equal length the first in text order wins. Rules are few and become one expression.
    """
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        action, name, start = rule
        fit = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        fits.append(F.when(fit, F.lit(action if take == 0 else name + start)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], listed_verdict: str = "block",
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, listed.

    ``listed`` has a column ``canonical``. A rule decides where one fits; else a listed canonical URL gets
    ``listed_verdict`` and any other the opposite. A null or malformed URL has an empty host and path, no rule and is not
    listed. Repeated pages and null ids are judged row by row; an empty list lists nothing. Only the two named columns
    are read. One URL may hold any share of the rows: only possible hits are shuffled, and the adaptive skew join can
    split them since the list is distinct.
    """
    names = materialise(listed.select(F.col("canonical").alias("_listed")).filter("_listed is not null").distinct())
    other = {"block": "allow", "allow": "block"}[listed_verdict]
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                         path_of(F.col(url_col)).alias("path"))
    parts = parts.select(
        "*",
        rule_column(F.col("host"), F.col("path"), rules).alias("rule"),
        rule_column(F.col("host"), F.col("path"), rules, take=0).alias("_action"),
        canonical(F.col("host"), F.col("path")).alias("_canonical"),
    )
    flagged = bloom.probe(parts, F.col("_canonical"), bloom.build(names, "_listed", names.count()), "_possible")
    hits = flagged.filter("_possible").join(names, F.col("_canonical") == F.col("_listed"), "left")
    hits = hits.withColumn("listed", F.col("_listed").isNotNull()).drop("_listed")
    misses = flagged.filter("not _possible").withColumn("listed", F.lit(False))
    verdict = F.coalesce("_action", F.when(F.col("listed"), listed_verdict).otherwise(other))
    return hits.unionByName(misses).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")
