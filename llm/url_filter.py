"""URL filters: a blocked Bloom filter of listed URLs in front of an exact join."""
from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from llm.common import given, query

ALLOW, BLOCK = "allow", "block"
WORDS = 4  # longs of 64 bits in a block of the filter
KEYS = 24  # listed URLs that a block takes on average: 10 bits each
MOST_BLOCKS = 1 << 18  # 10 MB; a longer list fills its blocks more, lets more pass, and loses nothing
BROADCAST_ROWS = 100_000  # listed URLs that are broadcast; more are joined by shuffle
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHOLE, UNDER = 0, 1  # kinds of listed URLs: that URL itself, or all under it


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path: from there up to ``?`` or ``#``.

    Both are empty for null and for a URL without ``://``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _bits(key: Column) -> list[Column]:
    """The bits that a key sets in the words of its block: two in each, from a hash that the block's number does not use."""
    second = F.xxhash64(key, F.lit(1))
    places = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(2 * WORDS)]
    one = F.lit(1).cast("long")
    # By SQL, as the functions take the number of places as a plain number only.
    return [F.call_function("shiftleft", one, a).bitwiseOR(F.call_function("shiftleft", one, b)) for a, b in zip(places[::2], places[1::2])]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """``block`` and its ``WORDS`` words, with the bits of every ``key`` set: partial ors in each task, then one row per block."""
    keyed = listed.select(_block(F.col("key"), blocks).alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(_bits(F.col("key")))])
    return keyed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, default: str = ALLOW) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages`` (``page_id``, ``url``).

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits a URL on its host or a subdomain of it whose path starts
    with the rule's; of those that fit the longest wins (host and path together; of equally long ones that with the longer host, then the first
    by text, and of equal ones ``allow`` before ``block``). ``listed`` has ``host`` and ``path`` of single URLs to block; they count for a URL that
    no rule fits, by its host and whole path. ``rule`` is the rule's host and path, null without one, ``verdict`` the
    rule's, else ``block`` for a listed URL, else ``default``. Hosts of rules and of listed URLs are taken in lower case (A-Z). A null
    path counts as empty. Left out are those with a null or empty host, with a path that neither is empty nor starts with ``/``
    (no URL has one), and rules without one of the two verdicts.

    A null URL, or one without ``://``, has an empty host and path. Repeated rows come out again, a null
    id is kept, other columns are ignored. Without rules and listed URLs every verdict is ``default``.

    Rules and listed URLs are canonical keys in one blocked Bloom filter. Every distinct host and path is looked up there once
    under each length that a rule has (labels of the host, characters of the path), so a common URL or host costs a task no
    more than a rare one. The filter has at most ``MOST_BLOCKS`` blocks of 32 bytes and is broadcast. What passes it is joined with the
    listed keys exactly, by broadcast if these are few, which removes false positives. All of it stays in the JVM.
    """
    named = pages.select("page_id", *[c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))])
    clean_host, clean_path = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path")
    sound = (F.coalesce("host", F.lit("")) != "") & (F.coalesce("path", F.lit("")).rlike("^(/|$)"))
    under = rules.filter(sound & F.col("verdict").isin(ALLOW, BLOCK)).groupBy(clean_host, clean_path).agg(F.min("verdict").alias("listed_verdict"))
    keys = under.select(F.lit(UNDER).alias("kind"), "host", "path", "listed_verdict")
    if listed is not None:
        single = listed.filter(sound).select(F.lit(WHOLE).alias("kind"), clean_host, clean_path, F.lit(BLOCK).alias("listed_verdict")).distinct()
        keys = keys.unionByName(single)
    key = F.concat_ws("\n", F.col("kind").cast("string"), "host", "path").alias("key")
    keys = keys.withColumn("labels", F.size(F.split("host", r"\."))).withColumn("letters", F.char_length("path"))
    many = keys.count()
    blocks = max(1, min(MOST_BLOCKS, many // KEYS))
    bloom = bloom_filter(keys.select(key), blocks)
    exact = keys.select(key.alias("listed_key"), "kind", F.concat("host", "path").alias("listed_rule"), F.char_length("host").alias("listed_host"), "listed_verdict")

    shapes = [tuple(r) for r in keys.filter(F.col("kind") == UNDER).select("labels", "letters").distinct().collect()]
    probes = [
        F.when(F.char_length("path") >= letters, F.concat_ws("\n", F.lit(str(UNDER)), F.substring_index("host", ".", -labels), F.substring("path", 1, letters)))
        for labels, letters in sorted(shapes)
    ]
    probes.append(F.concat_ws("\n", F.lit(str(WHOLE)), "host", "path"))
    urls = named.select("host", "path").distinct()
    looked = urls.select("host", "path", F.explode(F.array_distinct(F.array_compact(F.array(*probes)))).alias("key"))
    looked = looked.withColumn("at", _block(F.col("key"), blocks)).join(F.broadcast(bloom), F.col("at") == F.col("block"))
    passed = looked.filter(_all_set(_bits(F.col("key")))).select("host", "path", "key")
    found = passed.join(F.broadcast(exact) if many <= BROADCAST_ROWS else exact, F.col("key") == F.col("listed_key"))
    best = F.min(F.struct("kind", (-F.char_length("listed_rule")).alias("size"), (-F.col("listed_host")).alias("host_size"), "listed_rule", "listed_verdict"))
    ranked = found.groupBy("host", "path").agg(best.alias("best"))
    # Wrapped in structs, the keys no longer match the grouping's partitions, so that a common URL can be split.
    ranked = ranked.select(F.struct("host", "path").alias("of"), "best")
    joined = named.join(ranked, F.struct("host", "path") == F.col("of"), "left")
    return joined.select(
        "page_id", "host", "path", F.when(F.col("best.kind") == UNDER, F.col("best.listed_rule")).alias("rule"),
        F.coalesce("best.listed_verdict", F.lit(default)).alias("verdict"),
    )


def _all_set(bits: list[Column]) -> Column:
    """Whether the words of the block have all of the key's bits."""
    return reduce(and_, [F.col(f"w{i}").bitwiseAND(mask) == mask for i, mask in enumerate(bits)])


#: Host, path and verdict of the rules.
RULES = [
    ("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK),
]


@query("""
    with cut as (
        select page_id, row_number() over () as place, case when contains(url, '://') then substring(url, instr(url, '://') + 3) else '' end as rest from pages
    ), named as materialized (
        select page_id, place, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(substring(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
        from cut
    ), rules(rule_host, rule_path, rule_verdict) as (
        values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
    ), fitting as (
        select place, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule, max_by(rule_verdict, length(rule_host || rule_path)) as verdict
        from named join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        group by place
    )
    select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from named left join fitting using (place)
""")
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules are the list; a URL that none fits is not listed, so the method allows it."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(given(spark, sf_dir, "pages"), rules)
