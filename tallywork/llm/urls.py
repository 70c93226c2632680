"""Verdicts on URLs from listed hosts and paths, by a blocked Bloom filter and an exact join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.shared import table

BLOCKS = 1 << 16  # words of 64 bits; at 4 bits a key good for some hundred thousand listed URLs
BROADCAST_BLOCKS = 1 << 20  # a filter of at most so many words (16 MB) is broadcast

# The rules of the registered query.
RULES = """
SELECT * FROM VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
  AS rules(host, path, verdict)
"""


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty if there is none."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0)), F.lit(""))


def url_path(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: str) -> Column:
    start = F.instr(F.col(url), "://")
    return F.when(start > 0, F.substring(F.col(url), start + 3, F.length(url)))


def _folder(path: Column) -> Column:
    """The path up to its last slash, that slash included."""
    return F.regexp_extract(path, r"\A(?s:.*)/", 0)


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).alias("block")


def _mask(key: str) -> Column:
    """Four bits of one word, from a second hash."""
    h = F.xxhash64(F.lit(1), F.col(key))
    bits = [F.expr("1L")] * 4
    spots = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]
    mask = F.lit(0).cast("long")
    for one, spot in zip(bits, spots, strict=True):
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, spot))
    return mask


def bloom_words(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """Blocked Bloom filter as a table: at most ``blocks`` rows of ``block`` and ``bits``.

    All bits of a key lie in one word, so a probe looks at one row.
    """
    return (
        keys.select(_block(key, blocks), _mask(key).alias("mask"))
        .groupBy("block")
        .agg(F.bit_or("mask").alias("bits"))
    )


def maybe_listed(rows: DataFrame, key: str, words: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Rows whose key passes the filter: all that are listed, and a few more."""
    if blocks <= BROADCAST_BLOCKS:
        words = F.broadcast(words)
    probes = rows.withColumns({"_block": _block(key, blocks), "_mask": _mask(key)})
    return (
        probes.join(words, F.col("_block") == F.col("block"))
        .where(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
        .drop("_block", "_mask", "block", "bits")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id", default: str = "allow", blocks: int = BLOCKS
) -> DataFrame:
    """Verdict of the longest rule that fits each URL, else ``default``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains
    if the URL's path starts with the rule's. Listed URLs are made canonical: host and the
    folder part of the path. Every distinct page location gives the canonical URLs that could
    be listed for it (its parent hosts, its parent folders); the Bloom filter drops nearly all
    of them, and an exact join removes false positives and compares whole paths.

    Returns ``<key>``, ``host``, ``path``, ``rule`` (host and path, or null) and ``verdict``,
    one row per input row. Null URLs and URLs without ``://`` have an empty host and path and
    fit no rule. Of rules of equal length the one with the longer host wins, then ``block``.
    Rules with a null, or a path that does not start with ``/``, fit nothing. Pages with the
    same location share the work, however many they are.
    """
    listed = rules.where("host IS NOT NULL AND path LIKE '/%' AND verdict IS NOT NULL").select(
        F.concat(ascii_lower(F.col("host")), _folder(F.col("path"))).alias("canonical"),
        F.col("path").alias("rule_path"),
        F.concat(ascii_lower(F.col("host")), "path").alias("rule"),
        "verdict",
        F.size(F.split("host", r"\.", -1)).alias("labels"),
        F.size(F.split(_folder(F.col("path")), "/", -1)).alias("slashes"),
    )
    # Two numbers: no location needs parents longer than those of any rule.
    labels, slashes = listed.agg(
        F.coalesce(F.max("labels"), F.lit(0)), F.coalesce(F.max("slashes"), F.lit(0))
    ).first()

    located = pages.select(F.col(key), url_host(url).alias("host"), url_path(url).alias("path"))
    sites = located.where("host <> '' AND path LIKE '/%'").select("host", "path").distinct()
    parents = (
        sites.select("host", "path", F.split("host", r"\.", -1).alias("parts"), F.split("path", "/", -1).alias("steps"))
        .select(
            "host", "path", "steps",
            F.explode(F.expr(
                f"transform(sequence(1, least({labels}, size(parts))), "
                "n -> array_join(slice(parts, size(parts) - n + 1, n), '.'))"
            )).alias("parent"),
        )
        .select(
            "host", "path",
            F.explode(F.expr(
                f"transform(sequence(2, least({slashes}, size(steps))), "
                "n -> concat(parent, array_join(slice(steps, 1, n - 1), '/'), '/'))"
            )).alias("canonical"),
        )
        if labels and slashes >= 2
        else sites.select("host", "path", F.lit("").alias("canonical")).where("false")
    )
    words = bloom_words(listed, "canonical", blocks)
    hits = maybe_listed(parents, "canonical", words, blocks).join(listed, "canonical").where(
        "startswith(path, rule_path)"
    )
    order = F.struct(F.length("rule"), -F.length("rule_path"), F.col("verdict"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    # The hash is one more key, so that the grouped side is shuffled for this join too and a
    # location that very many pages have can be split.
    mark = F.xxhash64("host", "path")
    marked = located.withColumn("_mark", mark).join(best.withColumn("_mark", mark), ["host", "path", "_mark"], "left")
    return marked.select(
        key, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages."""
    return judge_urls(table(spark, folder, "pages"), spark.sql(RULES))


OP5_SQL = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
rest AS (
  SELECT page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages
),
located AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(r, '^[^/?#]*', 0), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM rest
),
fits AS (
  SELECT l.host, l.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY l.host, l.path
                            ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM (SELECT DISTINCT host, path FROM located) l
  JOIN rules r ON (l.host = r.host OR ends_with(l.host, '.' || r.host)) AND starts_with(l.path, r.path)
)
SELECT page_id, l.host, l.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM located l
LEFT JOIN (SELECT * FROM fits WHERE place = 1) f ON l.host = f.host AND l.path = f.path
"""
