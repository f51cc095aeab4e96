"""URL filter: host and path rules first, else a weighted vocabulary of URL terms.

The vocabulary has strict terms, of which one rejects, and soft terms, of which several distinct
ones reject. One Aho-Corasick automaton finds all terms in one pass over the URL; a hit counts only
if the characters beside it are no letters or digits.

Defined results: a null URL, or one without ``://``, has empty host and path, meets no rule and, as
far as it is a text, is judged by its terms; null and empty URLs are allowed. Repeated rows are
judged each by itself. Columns of the input that are called like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.llm.registry import query

STRICT = (
    "adult", "bestiality", "casino", "escort", "escorts", "gangbang", "hardcore", "hentai", "milf",
    "porn", "porno", "pornhub", "spam", "viagra", "warez", "xvideos", "xxx",
)
SOFT = (
    "ads", "bet", "bets", "bonus", "cam", "cams", "cheap", "crack", "dating", "deal", "farm",
    "free", "gambling", "girls", "hot", "jackpot", "keygen", "loan", "lottery", "nude", "pharmacy",
    "pills", "poker", "promo", "sex", "sexy", "slots", "teen", "torrent", "track", "tracker", "win",
    "winner",
)


@dataclass(frozen=True)
class Vocabulary:
    """Lower-case terms; a text is rejected by one strict term or ``min_soft`` distinct soft ones.

    ``weights`` raises or lowers single soft terms (1 each): ``min_soft`` is compared with their
    sum.
    """

    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    min_soft: float = 2.0
    weights: tuple[tuple[str, float], ...] = field(default=())


@dataclass(frozen=True)
class Rule:
    """Holds for a host with all its subdomains, where the path starts with ``path``."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(hosts: Column, paths: Column, rules: Iterable[Rule]) -> Column:
    """Name and action of the longest rule that fits; of equally long ones a blocking one."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.action == "block", r.name)):
        fits = ((hosts == r.host) | F.endswith(hosts, F.lit("." + r.host))) & F.startswith(
            paths, F.lit(r.path)
        )
        named = F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"))
        out = F.when(fits, named).otherwise(out)
    return out


@lru_cache(maxsize=8)
def _automaton(v: Vocabulary):
    import ahocorasick

    a = ahocorasick.Automaton()
    weights = dict(v.weights)
    for t in v.soft:
        a.add_word(t, (t, 0, weights.get(t, 1.0)))
    for t in v.strict:
        a.add_word(t, (t, 1, 0.0))
    a.make_automaton()
    return a


def find_terms(url: str | None, v: Vocabulary) -> tuple[list[str], list[str], float]:
    """Distinct strict and soft terms of a URL, sorted, and the weight of the soft ones."""
    strict, soft = set(), {}
    if url and (v.strict or v.soft):
        s = url.lower()
        for end, (term, kind, weight) in _automaton(v).iter(s):
            at = end - len(term) + 1
            if (at and s[at - 1].isalnum()) or (end + 1 < len(s) and s[end + 1].isalnum()):
                continue
            if kind:
                strict.add(term)
            else:
                soft[term] = weight
    return sorted(strict), sorted(soft), float(sum(soft.values()))


def _terms(url: Column, v: Vocabulary) -> Column:
    def found(part: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([find_terms(u, v) for u in part], columns=["strict", "soft", "weight"])

    return F.pandas_udf(found, "strict array<string>, soft array<string>, weight double")(url)


def judge(
    df: DataFrame, url: str = "url", rules: Iterable[Rule] = (), vocabulary: Vocabulary | None = None
) -> DataFrame:
    """Add host, path, rule, strict_terms, soft_terms, soft_weight and verdict to each row."""
    v = vocabulary or Vocabulary()

    u = F.col(url)
    names = ("host", "path", "rule", "strict_terms", "soft_terms", "soft_weight", "verdict")
    kept = [F.col(c) for c in df.columns if c not in names]
    base = df.select(*kept, host(u).alias("host"), path(u).alias("path"), _terms(u, v).alias("_t"))
    base = base.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
    rejected = (F.size("_t.strict") > 0) | (F.col("_t.weight") >= v.min_soft)
    return base.select(
        *kept, "host", "path", F.col("_r.rule").alias("rule"),
        F.col("_t.strict").alias("strict_terms"), F.col("_t.soft").alias("soft_terms"),
        F.col("_t.weight").alias("soft_weight"),
        F.coalesce(F.col("_r.action"), F.when(rejected, "block").otherwise("allow")).alias("verdict"),
    )


#: Fixed values of the query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _sql() -> str:
    edge = "(^|[^\\p{L}\\p{N}])"
    hit = lambda t: f"regexp_matches(u, '{edge}{t}($|[^\\p{{L}}\\p{{N}}])')"
    strict = " OR ".join(map(hit, STRICT))
    soft = " + ".join(f"{hit(t)}::INT" for t in SOFT)
    fits = lambda r: (
        f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    )
    ranked = sorted(RULES, key=lambda r: -len(r.name))
    rule = " ".join(f"WHEN {fits(r)} THEN '{r.name}'" for r in ranked)
    action = " ".join(f"WHEN rule = '{r.name}' THEN '{r.action}'" for r in ranked)
    return f"""
        WITH parts AS (
            SELECT page_id, lower(coalesce(url, '')) AS u,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        ruled AS (SELECT *, CASE {rule} END AS rule FROM parts)
        SELECT page_id, host, path, rule,
            CASE {action} WHEN {strict} OR ({soft}) >= 2 THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled"""


@query("op7_url_filter", _sql())
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, "url", RULES).select("page_id", "host", "path", "rule", "verdict")
