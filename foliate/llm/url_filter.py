"""Weighted URL vocabulary: strict and soft terms counted by one Aho-Corasick automaton.

A term counts where neither neighbour is a letter or digit. One strict term rejects a url;
soft terms reject it when SOFT_LIMIT distinct ones are found. Host and path rules come first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.llm.common import prepare

#: One of these rejects a url.
STRICT = (
    "adult", "betting", "camgirls", "casino", "casinos", "escort", "escorts", "gambling", "hentai",
    "jackpot", "malware", "nude", "nudes", "phishing", "porn", "porno", "pornhub", "slots", "spam",
    "spammer", "viagra", "warez", "xxx",
)
#: Several distinct ones reject a url.
SOFT = (
    "ads", "adserver", "babes", "bet", "bets", "bingo", "bonus", "cash", "cheap", "click", "clickbait", "crack",
    "dating", "deal", "deals", "farm", "free", "hot", "keygen", "loan", "loans", "lottery", "lucky",
    "pills", "poker", "prize", "replica", "sexy", "torrent", "track", "tracker", "win", "winner", "x",
)
SOFT_LIMIT = 2
#: (verdict, host, path); the longest rule that fits decides.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def url_host(url: Column) -> Column:
    """What stands after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as host + path, and its verdict; nulls where none fits."""
    name: Column = F.lit(None).cast("string")
    verdict: Column = F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


@cache
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in soft:
        found.add_word(word, (word, False))
    for word in strict:
        found.add_word(word, (word, True))
    found.make_automaton()
    return found


def term_hits(url: str, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT) -> tuple[set[str], set[str]]:
    """The distinct strict and soft terms that stand in url between boundaries."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url)
    hits: tuple[set[str], set[str]] = (set(), set())
    inside = "abcdefghijklmnopqrstuvwxyz0123456789"
    for last, (word, is_strict) in _automaton(strict, soft).iter(text):
        first = last - len(word) + 1
        if (first == 0 or text[first - 1] not in inside) and (last + 1 == len(text) or text[last + 1] not in inside):
            hits[0 if is_strict else 1].add(word)
    return hits


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """Judge every url: page_id, host, path, rule, verdict, strict_terms, soft_terms.

    A null url, or one without "://", has an empty host and path; no rule fits it, the terms of a
    null url are none, and it is allowed. An empty table gives an empty result. Repeated rows are
    each judged. Other columns are neither read nor returned. No shuffle.
    """
    prepare(pages.sparkSession)
    strict_terms, soft_terms = tuple(strict), tuple(soft)
    kind = pages.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [term_hits(u or "", strict_terms, soft_terms) for u in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([sorted(h[0]) for h in hits], pa.list_(pa.string())), pa.array([sorted(h[1]) for h in hits], pa.list_(pa.string()))],
                names=["page_id", "url", "strict_terms", "soft_terms"],
            )

    counted = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).mapInArrow(
        count, f"page_id {kind}, url string, strict_terms array<string>, soft_terms array<string>"
    )
    url = F.col("url")
    parts = counted.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"), "strict_terms", "soft_terms")
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    method = F.when((F.size("strict_terms") > 0) | (F.size("soft_terms") >= soft_limit), "block").otherwise("allow")
    return parts.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(said, method).alias("verdict"), "strict_terms", "soft_terms")


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    from foliate.llm.common import table

    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _found(word: str) -> str:
    return f"regexp_matches(u, '(^|[^a-z0-9]){word}([^a-z0-9]|$)')"


OP8_SQL = f"""
WITH p AS (
  SELECT page_id, url, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u FROM pages
), parts AS (
  SELECT page_id, u,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM p
), judged AS (
  SELECT page_id, host, path,
    CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
    END AS rule,
    ({" OR ".join(_found(w) for w in STRICT)})
      OR {" + ".join(f"CAST({_found(w)} AS INT)" for w in SOFT)} >= {SOFT_LIMIT} AS bad
  FROM parts
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN bad THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
