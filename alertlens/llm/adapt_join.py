"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct word shingles, sorted by one order for all:
by the number of shards that hold a shingle, rare ones first.  Two sets whose
Jaccard similarity reaches t share at least m of their first
n - ceil(t n) + m shingles, for every m.  Each document takes the m for which
the candidates estimated from the posting lists of its prefix cost least; a
pair is verified only if their prefixes share as many shingles as the smaller
m of the two.

The order needs no join of all shingles: shards send 32 bits of the hash of
each distinct shingle to buckets and get a rarity class back, in the order
sent.  Shingles of one shard alone make no candidates and are not sent on.

Documents meet in groups: each prefix shingle's posting list goes to the group
of its most central document (that with the highest estimated cost), so the
many lists of one family of near copies become one group and no pairs are
emitted.  Groups are cut into blocks of bounded size; every pair of blocks is
one unit of work.  Units first compare prefixes alone; only documents left
with a candidate send their whole sets, and the unit returns a spanning forest
of the links it finds.
"""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.llm.bloom_cascade import BITS_PER_KEY, MAX_FILTER_BYTES, BloomFilter
from alertlens.llm.common import materialize, renamed, restored
from alertlens.llm.components import components
from alertlens.llm.wordhash import text_shingles

WIDTH, THRESHOLD = 3, (90, 100)
#: numbers of shared prefix shingles to choose from
MATCHES = (1, 2, 4, 8, 16)
#: cost of verifying a candidate in units of reading one entry of a posting list
VERIFY = 8
MAX_PREFIX = 1 << 30
SHARD_BYTES = 8 << 20
#: documents in a block of a group
BLOCK = 1024


def _batches(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    return text_shingles(batch.column(batch.schema.get_field_index("text")), width)


class _Shard:
    """The sets of a shard's documents and its distinct shingles, in hash order."""

    def __init__(self, docs: pd.DataFrame, width: int):
        self.sets = [s for _, s in text_shingles(pa.Array.from_pandas(docs["text"], type=pa.string()), width)]
        self.keys = [set_key(s) if len(s) else None for s in self.sets]
        once = {k: s for k, s in zip(self.keys, self.sets) if k is not None}
        every = np.concatenate([np.zeros(0, np.uint64), *once.values()])
        self.distinct, self.count = np.unique(every, return_counts=True)

    def parts(self, buckets: int) -> Iterator[tuple[int, slice]]:
        cuts = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
        ends = [0, *np.searchsorted(self.distinct, cuts).tolist(), len(self.distinct)]
        return ((b, slice(lo, hi)) for b, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])) if hi > lo)


def _send(width: int, buckets: int):
    """Per shard and bucket: 31 bits of each distinct shingle, and whether two sets of the shard hold it."""
    def run(docs: pd.DataFrame) -> pd.DataFrame:
        s = _Shard(docs, width)
        items = (s.distinct & np.uint64(0xFFFFFFFE) | (s.count > 1).astype(np.uint64)).astype("<u4")
        return pd.DataFrame([(int(docs["shard"].iloc[0]), b, items[part].tobytes()) for b, part in s.parts(buckets)], columns=["shard", "bucket", "items"])
    return run


def _rarity(pdf: pd.DataFrame) -> pd.DataFrame:
    """Classes for what each shard sent: 0 for shingles of one set, else by the number of shards."""
    lists = [np.frombuffer(x, "<u4") for x in pdf["items"]]
    every = np.concatenate(lists)
    distinct, number, count = np.unique(every >> 1, return_inverse=True, return_counts=True)
    several = np.bincount(number, every & 1, minlength=len(distinct)) > 0
    classes = np.where((count > 1) | several, 1 + np.floor(np.log2(count)), 0).astype(np.uint8)[number]
    return pd.DataFrame({"shard": pdf["shard"], "bucket": pdf["bucket"], "items": [x.tobytes() for x in np.split(classes, np.cumsum([len(x) for x in lists])[:-1])]})


def prefix_length(n, matches, t):
    """Length of the prefix in which two similar sets share `matches` shingles."""
    return n - (t[0] * n + t[1] - 1) // t[1] + matches


def set_key(s: np.ndarray) -> bytes:
    return blake2b(s.tobytes(), digest_size=16).digest()


def _describe(width: int, buckets: int, t):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        s = _Shard(docs, width)
        classes = np.zeros(len(s.distinct), np.uint8)
        told = dict(zip(answers["bucket"], answers["items"]))
        for b, part in s.parts(buckets):
            classes[part] = np.frombuffer(told[b], np.uint8)
        alone, shared = [], []
        for x in s.sets:
            own = classes[np.searchsorted(s.distinct, x)]
            longest = prefix_length(len(x), min(MATCHES[-1], (t[0] * len(x) + t[1] - 1) // t[1]), t)
            n_alone = int((own == 0).sum())
            alone.append(n_alone)
            rest = np.flatnonzero(own)
            rest = x[rest][np.lexsort((x[rest], own[rest]))]
            # nothing shared in the shortest prefix: no partner
            shared.append(rest[: longest - n_alone].view(np.int64) if len(x) and n_alone < prefix_length(len(x), 1, t) else None)
        return pd.DataFrame({"doc_id": docs["doc_id"], "n": [len(x) for x in s.sets], "key": s.keys, "alone": alone, "prefix": shared})
    return run


def describe(docs: DataFrame, width: int, t, shard_bytes: int) -> DataFrame:
    """(doc_id, n, key, alone, prefix) of every document.

    key is null for empty sets; alone counts the shingles of one shard, which
    come first in the order; prefix holds those after them, up to the longest
    prefix, and is null if the document can have no partner.
    """
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-n_bytes // shard_bytes))
    buckets = max(1, -(-shards // 2))
    shard = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(shards)).cast("long")
    rows = docs.select("doc_id", "text", shard.alias("shard")).groupBy("shard")
    kind = "shard long, bucket long, items binary"
    classes = rows.applyInPandas(_send(width, buckets), kind).groupBy("bucket").applyInPandas(_rarity, kind)
    return rows.cogroup(classes.groupBy("shard")).applyInPandas(
        _describe(width, buckets, t), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, key binary, alone long, prefix array<long>")


def groups(sets: DataFrame, t) -> DataFrame:
    """(center, key, matches, n, tokens): the groups in which each distinct set meets its candidates.

    Of `sets` (key, n, alone, prefix); tokens are the shared ones of its own prefix.  Similar sets share m shingles of their
    m-match prefixes, so also the rarest of those by posting list, which is
    not among the m - 1 most frequent of either prefix: these are dropped, and
    a document with nothing left has no partner.  A document probes with the m
    that costs least and stands in the index of every m.
    """
    cap = F.expr(f"({t[0]} * n + {t[1] - 1}) DIV {t[1]}")
    posts = sets.select("key", "n", "alone", F.posexplode("prefix").alias("pos", "token"))
    twice = materialize(posts.groupBy(F.col("token").alias("key")).agg(F.count(F.lit(1)).alias("f")).filter("f > 1"))
    n = twice.count()
    if n * BITS_PER_KEY // 8 <= MAX_FILTER_BYTES:
        # most shingles stand in one prefix only and need not be shuffled with their document
        posts = posts.filter(BloomFilter(twice.select("key"), n, 0).passes(F.col("token")))
    posts = posts.select("key", "n", "token", F.greatest(F.lit(1), F.col("alone") + F.col("pos") - (F.col("n") - cap) + 1).cast("int").alias("from_match"))
    lists = twice.select(F.col("key").alias("l_token"), "f")
    by_list = (posts.join(lists, F.col("token") == F.col("l_token"))
               .groupBy("key", "n").agg(F.sort_array(F.collect_list(F.struct("f", "token", "from_match")), asc=False).alias("own")))
    kept = lambda m: F.slice(F.filter("own", lambda o: o["from_match"] <= m), m, MAX_PREFIX)
    cost = lambda a, m: F.aggregate(a, F.lit(0.0), lambda x, o: x + (o["f"] - 1) * (1.0 + VERIFY / m))
    options = F.array(*[F.struct(cost(kept(m), m).alias("cost"), F.lit(m).alias("matches"), F.transform(kept(m), lambda o: o["token"]).alias("tokens")) for m in MATCHES])
    levels = materialize(by_list.select("key", "n", "own", F.filter(options, lambda o: o["matches"] <= cap).alias("options"))
                         .filter(F.forall("options", lambda o: F.size(o["tokens"]) > 0))
                         .withColumn("best", F.array_min(F.transform("options", lambda o: F.struct(o["cost"], o["matches"])))))
    rows = (levels.select("key", "best.cost", "best.matches", F.explode("options").alias("o"))
            .select("key", "cost", "matches", F.col("o.matches").alias("level"), F.explode("o.tokens").alias("token")))
    centers = (rows.groupBy(F.col("token").alias("t_token"), F.col("level").alias("t_level"))
               .agg(F.max(F.struct("cost", "key")).alias("top"), F.count(F.lit(1)).alias("members"), F.bool_or(F.col("level") == F.col("matches")).alias("probed"))
               .filter("members > 1 AND probed"))
    met = (rows.join(centers, (F.col("token") == F.col("t_token")) & (F.col("level") == F.col("t_level")))
           .select(F.col("top.key").alias("center"), F.col("key").alias("m_key")).distinct())
    own = levels.select("key", "n", "best.matches", F.transform(F.filter("own", lambda o: o["from_match"] <= F.col("best.matches")), lambda o: o["token"]).alias("tokens"))
    return met.join(own, F.col("m_key") == F.col("key")).select("center", "key", "matches", "n", "tokens")


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def _lists(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inverted lists: (token number by entry, start of each array, owners by token, start of each token)."""
    sizes = np.array([len(a) for a in arrays])
    _, number = np.unique(np.concatenate(arrays), return_inverse=True)
    owner = np.repeat(np.arange(len(arrays)), sizes)
    owners = owner[np.argsort(number, kind="stable")]
    starts = np.concatenate(([0], np.cumsum(np.bincount(number))))
    return number, np.concatenate(([0], np.cumsum(sizes))), owners, starts


def _overlaps(x: int, index, n: int) -> np.ndarray:
    number, first, owners, starts = index
    tokens = number[first[x]: first[x + 1]]
    a, b = starts[tokens], starts[tokens + 1]
    sizes = b - a
    at = np.repeat(a - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    return np.bincount(owners[at], minlength=n)


def candidates(size: np.ndarray, prefixes: list[np.ndarray], matches: np.ndarray, side: np.ndarray | None, t) -> Iterator[tuple[int, np.ndarray]]:
    """(x, later rows that share enough of their prefix with x and are of a fitting size); side: only pairs across it."""
    by_prefix = _lists(prefixes)
    for x in range(len(size) - 1):
        ok = _overlaps(x, by_prefix, len(size)) >= np.minimum(matches, matches[x])
        ok[: x + 1] = False
        if side is not None:
            ok &= side != side[x]
        ok &= t[1] * np.minimum(size, size[x]) >= t[0] * np.maximum(size, size[x])
        found = np.flatnonzero(ok)
        if len(found):
            yield x, found


def spanning_links(keys: list[bytes], sets: list[np.ndarray], prefixes: list[np.ndarray], matches: np.ndarray,
                   side: np.ndarray | None, t) -> list[tuple[bytes, bytes]]:
    """Links that connect what all similar pairs of a unit connect."""
    size, by_set = np.array([len(s) for s in sets]), None
    forest, links, label = _Forest(len(keys)), [], np.arange(len(keys))
    for x, found in candidates(size, prefixes, matches, side, t):
        found = found[label[found] != label[x]]
        if not len(found):
            continue
        if len(found) > 16:
            by_set = by_set or _lists(sets)
            common = _overlaps(x, by_set, len(keys))[found]
        else:
            common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for y in found])
        for y in found[t[1] * common >= t[0] * (size[x] + size[found] - common)].tolist():
            a, b = forest.root(x), forest.root(y)
            if a != b:
                forest.up[max(a, b)] = min(a, b)
                links.append((keys[x], keys[y]))
                label[label == max(a, b)] = min(a, b)
    return links


def by_unit(rows: DataFrame, work, result: str, names: list[str]) -> DataFrame:
    """Run work(list of rows) for the rows of each unit (first column); rows of a key count once."""
    def run(batches):
        unit, rows = None, {}

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.binary()) for k in range(len(names))], names=names)

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != unit:
                    out += work(unit, list(rows.values())) if len(rows) > 1 else []
                    unit, rows = row[0], {}
                rows[row[1]] = row[1:]
            yield batch_of(out)
        yield batch_of(work(unit, list(rows.values())) if len(rows) > 1 else [])

    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, result)


def _arrays(rows: list[tuple]) -> tuple:
    """(keys, matches, side) of unit rows (key, matches, block, across, ...)."""
    side = np.array([r[2] for r in rows]) if any(r[3] for r in rows) else None
    return [r[0] for r in rows], np.array([r[1] for r in rows]), side


def units_of(grouped: DataFrame) -> DataFrame:
    """(unit, key, matches, block, across, n, tokens): each pair of blocks of a group is one unit."""
    sizes = grouped.groupBy(F.col("center").alias("g_center")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    ends = F.concat(F.lit("/"), F.least("block", "other"), F.lit("/"), F.greatest("block", "other"))
    return (grouped.join(sizes, F.col("center") == F.col("g_center"))
            .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.concat("center", F.encode(ends, "UTF-8")).alias("unit"), "key", "matches", "block",
                    (F.col("block") != F.col("other")).alias("across"), "n", "tokens"))


def links_of(docs: DataFrame, described: DataFrame, grouped: DataFrame, width: int, t) -> DataFrame:
    """(u, v): links between keys, verified on the whole sets."""
    def survivors(unit, rows):
        keys, matches, side = _arrays(rows)
        hit = np.zeros(len(rows), bool)
        for x, found in candidates(np.array([r[4] for r in rows]), [np.array(r[5], np.int64) for r in rows], matches, side, t):
            hit[x] = hit[found] = True
        return [(unit, keys[i]) for i in np.flatnonzero(hit)]

    def verified(unit, rows):
        rows.sort(key=lambda r: r[0])
        keys, matches, side = _arrays(rows)
        return spanning_links(keys, [np.frombuffer(r[6], np.uint64) for r in rows], [np.array(r[5], np.int64) for r in rows], matches, side, t)

    placed = units_of(grouped)
    left = materialize(by_unit(placed, survivors, "s_unit binary, s_key binary", ["s_unit", "s_key"]))
    placed = placed.join(left, (F.col("unit") == F.col("s_unit")) & (F.col("key") == F.col("s_key"))).withColumnRenamed("key", "m_key")

    members = left.select(F.col("s_key").alias("m_key")).distinct()
    holders = (described.filter(F.col("key").isNotNull()).join(members, F.col("key") == F.col("m_key"), "left_semi")
               .groupBy("key").agg(F.min("doc_id").alias("h_id")))
    texts = docs.select(F.col("doc_id").alias("d_id"), "text").join(holders, F.col("d_id").eqNullSafe(F.col("h_id")))

    def load(batches):
        for batch in batches:
            keys, found = batch.column(0).to_pylist(), []
            for i, s in _batches(batch, width):
                # a repeated id may stand for another text
                found.append(s.tobytes() if len(s) and set_key(s) == keys[i] else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["w_key", "whole"])

    loaded = texts.select("key", "text").mapInArrow(load, "w_key binary, whole binary").filter("whole IS NOT NULL")
    second = placed.join(loaded, F.col("m_key") == F.col("w_key")).select("unit", "m_key", "matches", "block", "across", "n", "tokens", "whole")
    return by_unit(second, verified, "u binary, v binary", ["u", "v"])


def similar_groups(docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of documents.

    Two rows link when the Jaccard similarity of their sets reaches the
    threshold, given as (numerator, denominator); component_id is the smallest
    doc_id that links reach from the row.

    Null, empty or blank text: no shingles, linked with nothing.  Fewer words
    than the width: the whole sequence is the one shingle.  Equal sets (copies)
    count as one in the join and share its component.  Null ids link as any row
    and are no component id unless there is no other.  Repeated ids: each row
    for itself, under the smallest id of its component.  Empty input: no rows.
    Texts are used whole.  Other input columns are not read.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    described = materialize(describe(rows, width, threshold, shard_bytes))
    sets = described.filter("prefix IS NOT NULL").groupBy("key").agg(*[F.first(c).alias(c) for c in ("n", "alone", "prefix")])
    grouped = materialize(groups(sets, threshold))
    edges = links_of(rows, described, grouped, width, threshold)
    roots = components(edges)
    by_key = described.filter(F.col("key").isNotNull()).groupBy(F.col("key").alias("k_key")).agg(F.min("doc_id").alias("least"))
    ids = by_key.join(roots, F.col("k_key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "k_key"))
    least = ids.groupBy(F.col("root").alias("r_root")).agg(F.min("least").alias("component"))
    labels = ids.join(least, F.col("root") == F.col("r_root")).select("k_key", "component")
    return (described.join(labels, F.col("key") == F.col("k_key"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def one_of_each_group(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of documents without all but the first (smallest doc_id) of each group.

    Rows that repeat an id stay or go together; rows without an id stay.  Other
    columns may have any names.
    """
    found = (similar_groups(docs, width, threshold).filter(F.col("doc_id") != F.col("component_id"))
             .select(F.col("doc_id").alias("g_copy")).distinct())
    rows, names = renamed(docs, "doc_id")
    return rows.join(found, F.col("doc_id") == F.col("g_copy"), "left_anti").select(*restored(names))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
l AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM l),
e AS (SELECT doc_id, unnest(s) AS g FROM l),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
k AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.c >= 90 * (x.n_shingles + y.n_shingles - p.c)),
r AS (SELECT doc_id AS node, doc_id AS reach FROM d UNION SELECT r.node, k.b FROM r JOIN k ON r.reach = k.a)
SELECT n.doc_id, n.n_shingles, min(r.reach) AS component_id FROM n JOIN r ON r.node = n.doc_id GROUP BY ALL
"""
