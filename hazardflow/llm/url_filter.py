"""URL filter: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter.

1. Every URL is cut into host and path. A rule (host, path, verdict) fits its host and all of its
   subdomains if the URL's path starts with the rule's path; the longest fitting rule decides.
2. URLs that no rule fits are looked up in a list of canonical URLs. The list is folded into a blocked
   Bloom filter: one 256-bit block (eight 32-bit words) per hash value, one bit a word. The filter has
   at most ``max_blocks`` rows whatever the list's length, so it is broadcast; URLs whose eight bits
   are all set are *possible* hits and only these are shuffled to an exact hash join with the list,
   which removes the false positives. A list too long for the filter only makes more URLs possible
   hits; the answer stays exact.

Defined results: a null URL, or one without ``://``, has an empty host and path and is allowed; empty
canonical URLs are never listed; repeated rows are judged alike; an empty list blocks nothing. Of the
input only the key column is carried, so other columns cannot clash with the results.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import lower_ascii, text_of

Rule = tuple[str, str, str]
WORDS = 8  # 32-bit words of a block
BITS_PER_URL = 32


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(text_of(url), r"(?s)\A.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(text_of(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Key of the list: host without ``www.`` and default port, path without ``.html`` and trailing slashes."""
    bare = F.regexp_replace(F.regexp_replace(host, r"\Awww\.", ""), r":(80|443)\z", "")
    return F.concat(bare, F.regexp_replace(path, r"(\.html)?/*\z", ""))


def rule_column(host: Column, path: Column, rules: Sequence[Rule], pick: int) -> Column:
    """Rule text (``pick`` 0) or verdict (``pick`` 1) of the longest fitting rule, else null."""
    out = F.lit(None).cast("string")
    for r_host, r_path, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        on_host = (host == r_host) | host.endswith("." + r_host)
        out = F.when(on_host & path.startswith(r_path), F.lit((r_host + r_path, verdict)[pick])).otherwise(out)
    return out


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n_blocks)).cast("int")


def _mask(url: Column, i: int) -> Column:
    """One of 32 bits of word ``i``, from bits of a second hash."""
    bits = F.shiftrightunsigned(F.xxhash64(url, F.lit("bits")), 5 * i)
    return F.call_function("shiftleft", F.lit(1), bits.bitwiseAND(F.lit(31)).cast("int"))


def build_filter(listed: DataFrame, n_blocks: int) -> DataFrame:
    """(blk, w0..w7): at most ``n_blocks`` rows of 40 bytes. ``listed`` has the column ``url``."""
    return listed.groupBy(_block(F.col("url"), n_blocks).alias("blk")).agg(
        *[F.bit_or(_mask(F.col("url"), i)).alias(f"w{i}") for i in range(WORDS)])


def listed_urls(urls: DataFrame, listed: DataFrame, *, max_blocks: int = 1 << 18) -> DataFrame:
    """Add ``is_listed`` to ``urls`` (column ``canon``; null is not looked up).

    ``max_blocks`` x 40 bytes (10 MB) is the proven size of what is broadcast.
    """
    listed = listed.where((F.col("url") != "") & F.col("url").isNotNull()).distinct()
    n_blocks = min(max_blocks, max(64, 1 << (listed.count() * BITS_PER_URL // (32 * WORDS)).bit_length()))
    bloom = F.broadcast(build_filter(listed, n_blocks))
    hit = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(_mask(F.col("canon"), i)) == _mask(F.col("canon"), i)
                                      for i in range(WORDS)])
    probed = urls.join(bloom, _block(F.col("canon"), n_blocks) == F.col("blk"), "left").select(
        *urls.columns, F.coalesce(F.col("canon").isNotNull() & hit, F.lit(False)).alias("_possible"))
    keys = listed.select(F.col("url").alias("_listed"))
    exact = probed.where("_possible").join(keys, F.col("canon") == F.col("_listed"), "left").select(
        *urls.columns, F.col("_listed").isNotNull().alias("is_listed"))
    return exact.unionByName(probed.where("not _possible").select(*urls.columns, F.lit(False).alias("is_listed")))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], *, key: str = "page_id",
               url: str = "url", max_blocks: int = 1 << 18) -> DataFrame:
    """(key, host, path, rule, verdict, is_listed) of every row of ``pages``.

    ``listed`` has one column ``url`` of canonical URLs. ``rules`` is a parameter of the program
    (a few rules held in expressions); the list may be of any length.
    """
    cut = pages.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = cut.select("_key", "host", "path", rule_column(F.col("host"), F.col("path"), rules, 0).alias("rule"),
                       rule_column(F.col("host"), F.col("path"), rules, 1).alias("by_rule"))
    asked = ruled.select("*", F.when(F.col("rule").isNull() & (F.col("host") != ""),
                                     canonical(F.col("host"), F.col("path"))).alias("canon"))
    judged = listed_urls(asked, listed, max_blocks=max_blocks)
    verdict = F.coalesce(F.col("by_rule"), F.when(F.col("is_listed"), "block").otherwise("allow"))
    return judged.select(F.col("_key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "is_listed")


#: The rules of the registered query.
RULES: list[Rule] = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: The registered query's list: the canonical URLs seen on hosts with such a label.
LISTED_HOSTS = r"(\A|[.-])(adult|spam)([.-]|\z)"


def listed_of(pages: DataFrame, *, url: str = "url") -> DataFrame:
    """Stand-in for a delivered list: canonical URLs of all pages on adult and spam hosts."""
    cut = pages.select(host_of(F.col(url)).alias("h"), path_of(F.col(url)).alias("p"))
    return cut.where(F.col("h").rlike(LISTED_HOSTS)).select(canonical(F.col("h"), F.col("p")).alias("url")).distinct()


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge_urls(pages, listed_of(pages), RULES)


SQL = r"""
WITH cut AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
      WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
    regexp_replace(regexp_replace(host, '\Awww\.', ''), ':(80|443)\z', '')
      || regexp_replace(path, '(\.html)?/*\z', '') AS canon
  FROM cut),
listed AS (SELECT DISTINCT canon FROM ruled WHERE canon <> '' AND regexp_matches(host, '(\A|[.-])(adult|spam)([.-]|\z)'))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       rule IS NULL AND l.canon IS NOT NULL AS is_listed
FROM ruled r LEFT JOIN listed l ON r.canon = l.canon AND r.host <> ''
"""
