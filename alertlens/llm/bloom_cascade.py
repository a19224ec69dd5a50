"""URL rules and an exact URL list as a Bloom filter cascade, in DataFrame functions only.

The first filter holds the listed keys, the second the keys of the corpus that
pass it by mistake, the third the listed keys that pass the second by mistake,
and so on until nothing passes wrongly.  For every key of the corpus the first
filter that misses then tells membership exactly, without joining the list.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import checkpointed, lower_ascii

#: (verdict, host, path): the deepest rule that fits decides.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
BITS_PER_KEY = 10
HASHES = 5
MAX_FILTER_BYTES = 32 << 20
MAX_LEVELS = 40


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url, both empty if it is null or has no `://`."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(whole, shape, 1)), F.regexp_extract(whole, shape, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a parent of it; null if none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decides, on, below in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = F.concat(F.lit("."), host).endswith(f".{on}") & path.startswith(below)
        rule = F.when(fits, F.lit(on + below)).otherwise(rule)
        verdict = F.when(fits, F.lit(decides)).otherwise(verdict)
    return rule, verdict


def _positions(key: Column, level: int, n_bits: int) -> list[Column]:
    """Bit numbers of a key, by double hashing; each level hashes anew."""
    one, two = F.xxhash64(key, F.lit(level)), F.xxhash64(F.lit(-1 - level), key)
    return [F.pmod(F.pmod(one, F.lit(n_bits)) + i * F.pmod(two, F.lit(n_bits)), F.lit(n_bits)) for i in range(HASHES)]


class BloomFilter:
    """The bits of one level as a one-row frame of 64-bit words."""

    def __init__(self, keys: DataFrame, n_keys: int, level: int):
        self.level = level
        self.n_bits = 64 * max(1, -(-n_keys * BITS_PER_KEY // 64))
        words = (
            keys.select(F.explode(F.array(*_positions(F.col("key"), level, self.n_bits))).alias("pos"))
            .groupBy(F.shiftright("pos", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(pos % 64 AS INT))")).alias("bits"))
        )
        every = keys.sparkSession.range(self.n_bits // 64).join(words, F.col("id") == F.col("word"), "left")
        row = every.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("all"))
        self.words = checkpointed(row.select(F.transform("all", lambda w: w["bits"]).alias("words")))

    def passes(self, key: Column) -> Column:
        """Whether the key's bits are all set; the words reach the tasks as a scalar subquery."""
        words = self.words.scalar()
        hit = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) == 1 for p in _positions(key, self.level, self.n_bits)]
        both = hit[0]
        for h in hit[1:]:
            both = both & h
        return both


def cascade(universe: DataFrame) -> list[BloomFilter] | None:
    """Filters for (key, listed); None if the list is too long to send to every task.

    Keys are distinct and not null.  An empty list gives no filter at all.
    """
    inside, outside = universe.filter("listed").select("key"), universe.filter("NOT listed").select("key")
    found: list[BloomFilter] = []
    held = inside
    while n := held.count():
        if n * BITS_PER_KEY // 8 > MAX_FILTER_BYTES:
            return None
        if len(found) == MAX_LEVELS:
            raise RuntimeError("the cascade does not shrink")
        found.append(BloomFilter(held, n, len(found)))
        wrong = outside.filter(found[-1].passes(F.col("key"))).checkpoint()
        held, outside = wrong, held
    return found


def is_listed(key: Column, filters: list[BloomFilter]) -> Column:
    """Exact membership of a key of the universe: the first filter that misses decides."""
    answer = F.lit(len(filters) % 2 == 1)
    for i in reversed(range(len(filters))):
        answer = F.when(filters[i].passes(key), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def tracked_keys(pages: DataFrame) -> DataFrame:
    """The complete key universe (key, listed): host and path of every page;
    listed are those that some page reaches with a tracking parameter."""
    host, path = url_parts(F.col("url"))
    tracked = F.coalesce(F.col("url").rlike(r"[?&](utm_[a-z]+|ref)="), F.lit(False))
    return checkpointed(pages.select(F.concat(host, path).alias("key"), tracked.alias("listed"))
                        .groupBy("key").agg(F.bool_or("listed").alias("listed")))


def judge(pages: DataFrame, universe: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages.

    A fitting rule decides; else a url is blocked if its host and path are a
    listed key of the universe, which must hold every key of the pages.

    Null url or no `://`: empty host and path, the empty key.  Repeated rows
    are judged alike.  Empty input or empty list: everything without a rule is
    allowed.  Long urls are used whole.  Other input columns are not read.
    """
    universe = tracked_keys(pages) if universe is None else universe
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    key = F.concat("host", "path")
    filters = cascade(universe)
    if filters is None:  # beyond the bound: the list itself, joined on its key
        listed = universe.filter("listed").select(F.col("key").alias("l_key"))
        rows = rows.join(listed, key == F.col("l_key"), "left").withColumn("listed", F.col("l_key").isNotNull())
    else:
        rows = rows.withColumn("listed", is_listed(key, filters) if filters else F.lit(False))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


ORACLE = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, position('://' IN coalesce(url, '')) AS p FROM pages),
r AS (SELECT page_id, url, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, url, regexp_extract(rest, '(?s)^[^/?#]*') AS raw, rest FROM r),
k AS (SELECT page_id, url, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '(?s)^[^?#]*') AS path FROM h),
l AS (SELECT host || path AS key, bool_or(regexp_matches(url, '[?&](utm_[a-z]+|ref)=')) AS listed FROM k GROUP BY 1),
j AS (SELECT page_id, host, path,
  CASE WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
       WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
       WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
       WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM k)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
       WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM j JOIN l ON j.host || j.path = l.key
"""
