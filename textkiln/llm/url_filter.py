"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact join of its hits.

A listed entry is a canonical URL, ``host/path``. It lists its host and all subdomains, and what lies
at its path or, if that ends in a slash, below it. A page's URL is looked up by its expressions: every
label suffix of its host with every leading directory of its path and the whole path, as far as an entry
of the list is as long.

The filter is a table: one row for each block of 512 bits (eight 64-bit words, one bit set in each
word for every entry). It is built by one aggregation and probed by an equi-join on the block number,
so neither side is ever held whole. Where the filter's size is at most ``BROADCAST_BYTES`` it is
broadcast; past that the join shuffles. Hits go to an exact join with the list, which removes the
false positives. Host rules (a short table, at most ``MAX_RULES``) are compiled into an expression.

Defined results: a null url, or one without ``://``, has an empty host and path, matches no rule and
is allowed. Nulls and repeats in the list are ignored. Repeated pages each get a verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.llm.tables import written

BITS_PER_KEY = 16
BROADCAST_BYTES = 8 << 20
MAX_RULES = 1000


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
)


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return _ascii_lower(host), path


def canonical(url: Column) -> Column:
    """Host and path, without scheme, query and fragment; an empty path is the root."""
    host, path = host_path(url)
    return F.concat(host, F.when(path == "", F.lit("/")).otherwise(path))


def expressions(host: Column, path: Column, labels: int, steps: int) -> Column:
    """Everything a list may hold of a URL: label suffixes of its host, each with the path's leading directories and the whole path.

    ``labels`` and ``steps``: the most that an entry's host and path have; longer expressions can't be listed.
    """
    parts, dirs = F.split(host, r"\."), F.split(path, "/")
    hosts = F.transform(F.sequence(F.greatest(F.lit(1), F.size(parts) - labels + 1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size(dirs), F.lit(steps)) - 1)), lambda n: F.concat(F.array_join(F.slice(dirs, F.lit(1), n), "/"), F.lit("/")))
    whole = F.when(path == "", F.lit("/")).when(F.size(dirs) <= steps, path)
    paths = F.array_distinct(F.array_compact(F.concat(above, F.array(whole))))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def match_rule(host: Column, path: Column, rules: tuple[HostRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (host first, then path, decides equal lengths)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} host rules; list URLs instead")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = (((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path))
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _with_hashes(df: DataFrame, key: str, n_blocks: int) -> DataFrame:
    return df.withColumn("__h2", F.xxhash64(F.lit("bloom"), key)).withColumn("__block", F.pmod(F.xxhash64(key), F.lit(n_blocks)))


def bloom_table(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """``block, w0 .. w7``: the blocks that hold at least one key."""
    bits = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(__h2, {6 * i}) & 63 as int))") for i in range(8)]
    return _with_hashes(listed, key, n_blocks).groupBy(F.col("__block").alias("__b")).agg(*[F.bit_or(b).alias(f"__w{i}") for i, b in enumerate(bits)])


def bloom_hits(df: DataFrame, key: str, bloom: DataFrame, n_blocks: int) -> DataFrame:
    """Rows of ``df`` whose key may be listed."""
    mine = _with_hashes(df, key, n_blocks)
    table = F.broadcast(bloom) if n_blocks * 80 <= BROADCAST_BYTES else bloom
    hit = F.col("__block") == F.col("__b")
    for i in range(8):
        hit = hit & F.expr(f"(shiftright(__w{i}, cast(shiftrightunsigned(__h2, {6 * i}) & 63 as int)) & 1) = 1")
    return mine.join(table, hit, "left_semi").drop("__h2", "__block")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: tuple[HostRule, ...] = RULES, url: str = "url", listed_verdict: str = "block", default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict``. ``listed``: one column of canonical URLs, of any size."""
    key = listed.columns[0]
    keys = written(listed.select(F.col(key).alias("__key")).where("__key is not null and __key != ''").distinct(), "urls-listed")
    own, way = F.split(F.substring_index("__key", "/", 1), r"\."), F.split("__key", "/")
    count, labels, steps = keys.agg(F.count(F.lit(1)), F.max(F.size(own)), F.max(F.size(way))).first()
    n_blocks = max(1, -(-count * BITS_PER_KEY // 512))
    bloom = written(bloom_table(keys, "__key", n_blocks), "urls-bloom")
    host, path = host_path(F.col(url))
    name, verdict = match_rule(F.col("host"), F.col("path"), rules)
    judged = written(
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("rule", name).withColumn("__verdict", verdict), "urls-judged")
    # only URLs that no rule settles ask the list; equal URLs ask once
    asked = judged.where("__verdict is null and host != ''").select("host", "path").distinct()
    probes = asked.select(F.col("host").alias("__h"), F.col("path").alias("__p"), F.explode(expressions(F.col("host"), F.col("path"), labels or 1, steps or 1)).alias("probe"))
    hits = bloom_hits(probes, "probe", bloom, n_blocks)
    exact = hits.join(keys, F.col("probe") == F.col("__key"), "left_semi").select("__h", "__p").distinct().withColumn("__listed", F.lit(True))
    return (
        judged.join(exact, (F.col("host") == F.col("__h")) & (F.col("path") == F.col("__p")), "left")
        .select("page_id", "host", "path", "rule",
                F.coalesce("__verdict", F.when(F.col("__listed"), F.lit(listed_verdict)).otherwise(F.lit(default))).alias("verdict"))
    )
