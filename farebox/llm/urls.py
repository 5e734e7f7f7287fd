"""URL rules, and exact membership in a host list by a cascade of Bloom filters.

The first filter holds the listed keys. Of all other keys of the corpus, those
that it lets through by mistake fill the second filter, the listed keys that
the second lets through fill the third, and so on until none is left. A key's
first miss then tells whether it is listed: exact for every key of the
universe, with hashes and bits only and no join. A long list is dealt to shards
by hash, each with a cascade of its own, so that no filter outgrows a task.
DataFrame functions only.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from farebox.llm.frames import no_shuffle_files_left, stored
from farebox.session import work_dir

# fixed values: verdict, host, path
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# fixed values: name parts that put a host on the list
LISTED_NAME = r"(^|[.-])(spam|pills|casino|malware|phish|warez)($|[.-])"
BUCKET_BITS = 32768  # bits in one bitmap of Spark's bitmap functions
MAX_BITS = 1 << 23


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def ruled(h: Column, p: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rh, rp in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith(rp)
        rule, verdict = F.when(fits, rh + rp).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``hashes`` bits per key out of ``8 * len(bits)``, dealt by ``seed``."""

    bits: bytes
    hashes: int
    seed: int

    def __len__(self) -> int:
        return 8 * len(self.bits)

    def places(self, key: Column) -> list[Column]:
        return [_place(key, self.seed + i, len(self)) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        data = F.lit(bytearray(self.bits))
        out = F.lit(True)
        for p in self.places(key):
            byte = F.conv(F.hex(F.substring(data, (F.shiftright(p, 3) + 1).cast("int"), F.lit(1))), 16, 10)
            out = out & (F.getbit(byte.cast("int"), (p % 8).cast("int")) == 1)
        return out


def _place(key: Column, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits))


def bloom_level(keys: DataFrame, key: str, n: int, seed: int, bits_per_key: int = 12, hashes: int = 6) -> Level:
    """A filter of ``n`` keys; its bitmaps are one row per 32768 bits."""
    bits = max(64, 1 << (n * bits_per_key - 1).bit_length())
    places = F.explode(F.array(*(_place(F.col(key), seed + i, bits) for i in range(hashes)))).alias("p")
    rows = (
        keys.select(places)
        .groupBy(F.bitmap_bucket_number(F.col("p") + 1).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p") + 1)).alias("bitmap"))
        .collect()  # at most MAX_BITS / 8 bytes
    )
    data = bytearray(max(bits, BUCKET_BITS) // 8)
    for r in rows:
        at = (r["bucket"] - 1) * BUCKET_BITS // 8
        data[at : at + len(r["bitmap"])] = r["bitmap"]
    return Level(bytes(data[: bits // 8]), hashes, seed)


@dataclass(frozen=True)
class Cascade:
    """Exact membership for the keys of the universe it was built over."""

    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed([*enumerate(self.levels)]):
            out = F.when(~level.holds(key), i % 2 == 1).otherwise(out)
        return F.coalesce(out, F.lit(False))


def cascade(universe: DataFrame, key: str, listed: str, **sizes: int) -> Cascade:
    """Filters for the rows of ``universe`` marked by ``listed``; keys must be distinct and not null.

    The driver holds the filters only, not the keys.
    """
    inside, outside = universe.filter(listed), universe.filter(f"NOT {listed}")
    levels: list[Level] = []
    while n := inside.count():
        levels.append(bloom_level(inside, key, n, seed=1000 * len(levels), **sizes))
        passed = outside.filter(levels[-1].holds(F.col(key)))
        inside, outside = passed, inside
    return Cascade(tuple(levels))


def shards_for(universe: DataFrame, listed: str, max_bits: int = MAX_BITS, bits_per_key: int = 12, hashes: int = 6) -> int:
    """How many shards keep each filter near ``max_bits``.

    The first level holds the listed keys, the second the share of the others that the first lets
    through, by the usual formula; all further ones are smaller.
    """
    inside, every = universe.agg(F.count_if(listed), F.count("*")).first()
    through = (1 - math.exp(-hashes / bits_per_key)) ** hashes
    return max(1, math.ceil(max(inside, every * through) * bits_per_key / max_bits))


def _dealt(df: DataFrame, key: str, shards: int, label: str) -> DataFrame:
    """``df`` as a table with a folder per shard; a shard with a hot key gets several files."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    # a seed that no level has: bits within a shard stay independent of it
    rows = df.withColumn("shard", F.pmod(F.xxhash64(F.col(key), F.lit(-1)), F.lit(shards)).cast("int"))
    with no_shuffle_files_left(spark):
        rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def marked(df: DataFrame, key: str, universe: DataFrame, max_bits: int = MAX_BITS, **sizes: int) -> DataFrame:
    """``df`` with ``listed``: is its ``key`` a listed one of ``universe`` (key, listed)?

    Exact for keys of the universe. Null and empty keys are not listed. With more than one shard, keys and
    rows are dealt to folders and judged a shard at a time: every row is read once, and
    the driver holds one shard's filters.
    """

    def judged(rows: DataFrame, filters: Cascade) -> DataFrame:
        return rows.withColumn("listed", F.when(F.col(key) == "", False).otherwise(filters.contains(F.col(key))))

    shards = shards_for(universe, "listed", max_bits, **sizes)
    if shards == 1:
        return judged(df, cascade(universe, "key", "listed", **sizes))
    keys, rows = _dealt(universe, "key", shards, "url-key-shards"), _dealt(df, key, shards, "url-row-shards")
    done = judged(rows.drop("shard"), Cascade(()))
    path = work_dir(df.sparkSession, "url-judged")
    for i in range(shards):
        filters = cascade(keys.filter(F.col("shard") == i), "key", "listed", **sizes)
        judged(rows.filter(F.col("shard") == i).drop("shard"), filters).write.mode("append").parquet(path)
    return df.sparkSession.read.schema(done.schema).parquet(path)


def host_list(pages: DataFrame, url: str = "url", names: DataFrame | None = None, pattern: str = LISTED_NAME) -> DataFrame:
    """Every host of the pages once, and whether it is on the list.

    The list is the first column of ``names``, hosts in lower case, nulls and repeats ignored. Without
    one, a host is listed if its name fits ``pattern``.
    """
    hosts = pages.select(host(F.col(url)).alias("key")).filter("key <> ''")
    if names is None:
        return hosts.distinct().withColumn("listed", F.col("key").rlike(pattern))
    given = names.select(F.col(names.columns[0]).cast("string").alias("key")).filter("key <> ''")
    both = hosts.select("key", F.lit(True).alias("occurs"), F.lit(False).alias("listed")).unionByName(
        given.select("key", F.lit(False).alias("occurs"), F.lit(True).alias("listed"))
    )
    return both.groupBy("key").agg(F.bool_or("listed").alias("listed"), F.bool_or("occurs").alias("occurs")).filter("occurs").drop("occurs")


def judge_urls(
    pages: DataFrame, universe: DataFrame, url: str = "url", rules: tuple = RULES, **sizes: int
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and ``listed``.

    A rule decides where one fits; elsewhere hosts listed in ``universe`` (key,
    listed: the complete key universe) are blocked and all others allowed. A
    null or malformed URL has an empty host and path, fits no rule and is
    allowed. Rows are kept as they are; columns of the new names are replaced.
    """
    kept = stored(universe.select("key", "listed"), "url-keys")
    source = pages.select(F.struct(*pages.columns).alias("row"), F.col(url).alias("u"))
    parts = source.select("row", host(F.col("u")).alias("h"), path(F.col("u")).alias("p"))
    parts = marked(parts, "h", kept, **sizes)
    rule, verdict = ruled(F.col("h"), F.col("p"), rules)
    new = ("host", "path", "rule", "verdict", "listed")
    return parts.select(
        *(F.col("row").getField(c).alias(c) for c in pages.columns if c not in new),
        F.col("h").alias("host"), F.col("p").alias("path"), rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed",
    )
