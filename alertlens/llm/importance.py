"""Importance resampling towards a target distribution, over hashed n-grams.

Every document is a bag of word n-grams, each hashed to a bucket by its crc32.
The gain of a bucket is the log ratio of its (smoothed) share in the target
texts to that in the documents; a document's weight is the sum of its gains.
Gumbel noise, fixed by the document's id, turns the highest scores into a
sample without replacement in proportion to exp(weight).

*Hashing.* A document is reduced to its words with one separator before each
and scanned once; the running crc at the end of each word is kept, and the one
at its start follows by one step for the separator.  crc32 is linear over
GF(2): crc(AB) = shift(crc(A), |B|) xor crc(B), where the shift multiplies by
x^(8|B|).  So the crc of the words i..j is the prefix at the end of j, with the
shifted prefix at the start of i cancelled from it, whatever the length.

*Plan.* Tasks add up their own bucket counts, at most one row a bucket leaves a
task.  The gains (one number a bucket, a parameter) are the only thing sent
to all tasks.  Ranks come from one range sort of narrow rows; rows that tie in
everything are told apart by their place, so that they may be split.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertlens.llm.common import SQL_CRC32, UPPER, checkpointed, crc_table, materialize

#: n-grams, buckets and noise of the registered query
LOW, HIGH, BUCKETS, SEED = 1, 1, 10_000, 2024
MIN_WORDS, PERCENT = 20, 10
#: the gains are sent to every task: 8 MB at most
MAX_BUCKETS = 1 << 20
#: words hashed together; a longer text is hashed for itself
BATCH_WORDS = 200_000

_TABLE = np.array(crc_table(), np.uint32)
_SPACE = 0x20
#: letters in lower case, digits and bytes beyond ASCII stand; everything else separates words
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else _SPACE for c in range(256))


def _apply(basis: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The GF(2) map with the given images of the 32 bits, applied to each x."""
    out = np.zeros_like(x)
    for bit in range(32):
        out ^= np.where(x >> np.uint32(bit) & np.uint32(1), basis[bit], np.uint32(0))
    return out


@lru_cache
def _power(k: int) -> np.ndarray:
    """Images of the 32 bits under a shift by 2^k zero bytes."""
    if k:
        return _apply(_power(k - 1), _power(k - 1))
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    return _TABLE[bits & np.uint32(255)] ^ (bits >> np.uint32(8))


@lru_cache(maxsize=4096)
def shift_table(length: int) -> np.ndarray:
    """The shift by `length` zero bytes as four tables, one for each byte of a crc."""
    basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for k in range(length.bit_length()):
        if length >> k & 1:
            basis = _apply(_power(k), basis)
    out = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            half = 1 << bit
            out[byte, half:2 * half] = out[byte, :half] ^ basis[8 * byte + bit]
    return out


def shift(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each crc multiplied by x^(8 length)."""
    kinds, which = np.unique(lengths, return_inverse=True)
    tables = np.stack([shift_table(int(n)) for n in kinds]) if len(kinds) else np.zeros((0, 4, 256), np.uint32)
    out = np.zeros_like(crcs)
    for byte in range(4):
        out ^= tables[which, byte, crcs >> np.uint32(8 * byte) & np.uint32(255)]
    return out


def words_of(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and characters beyond ASCII, A-Z in lower case."""
    return (text or b"").translate(_WORD_BYTES).split()


class Prefixes:
    """Running crcs of several documents, each scanned once."""

    def __init__(self, docs: list[list[bytes]]):
        sizes = np.array([len(d) for d in docs], np.int64)
        self.doc = np.repeat(np.arange(len(docs)), sizes)
        ends, before = [], []
        for words in docs:
            running = list(accumulate(words, lambda crc, word: crc32(word, crc32(b" ", crc)), initial=0))
            before += running[:-1]
            ends += running[1:]
        self.ends = np.array(ends, np.uint32)
        bare = ~np.array(before, np.uint32)
        self.starts = ~(_TABLE[(bare ^ np.uint32(_SPACE)) & np.uint32(255)] ^ (bare >> np.uint32(8)))
        lengths = np.fromiter((len(w) + 1 for d in docs for w in d), np.int64, len(ends))
        self.places = np.concatenate(([0], np.cumsum(lengths)))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Document and crc32 of every run of n words joined by one space."""
        count = max(len(self.doc) - n + 1, 0)
        last = np.arange(n - 1, n - 1 + count)
        inside = self.doc[:count] == self.doc[last]
        first, last = np.flatnonzero(inside), last[inside]
        lengths = self.places[last + 1] - self.places[first] - 1
        return self.doc[first], self.ends[last] ^ shift(self.starts[first], lengths)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Parts of the batches of about BATCH_WORDS words, the text being the last column."""
    for batch in batches:
        start, docs, held = 0, [], 0
        for row, text in enumerate(batch.column(batch.num_columns - 1)):
            words = words_of(text.as_py())
            if docs and held + len(words) > BATCH_WORDS:
                yield batch.slice(start, row - start), docs
                start, docs, held = row, [], 0
            docs.append(words)
            held += len(words)
        if docs:
            yield batch.slice(start), docs


def _as_bytes(text: str) -> Column:
    return F.col(text).cast("string").cast("binary")


def bucket_counts(texts: DataFrame, low: int = LOW, high: int = HIGH, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: occurrences of the n-grams of all texts in each bucket that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, docs in _slices(batches):
            prefixes = Prefixes(docs)
            for n in range(low, high + 1):
                total += np.bincount(prefixes.grams(n)[1] % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    parts = texts.select(_as_bytes("text").alias("text")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, low: int = LOW, high: int = HIGH, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket: floor(1000 ln of the ratio of smoothed shares)."""
    if not 1 <= low <= high or not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"n-grams {low} to {high} in {buckets} buckets")
    both = bucket_counts(docs, low, high, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(
        bucket_counts(target, low, high, buckets).select("bucket", F.lit(0).alias("s"), F.col("n").alias("t")))
    counts = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in counts:                                  # one row a bucket: a parameter, not the data, bounds them
        s[row.bucket], t[row.bucket] = row.s, row.t
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, low: int = LOW, high: int = HIGH, keep: bool = False) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document; with `keep`, its columns as the struct `doc` as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, docs in _slices(batches):
            prefixes = Prefixes(docs)
            features, weight = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
            for n in range(low, high + 1):
                doc, crc = prefixes.grams(n)
                features += np.bincount(doc, minlength=len(docs))
                np.add.at(weight, doc, gain[crc % np.uint32(len(gain))])
            kept = [part.column(1)] if keep else []
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(d) for d in docs], pa.int64()), pa.array(features), pa.array(weight), *kept],
                names=["doc_id", "n_words", "n_features", "weight"] + ["doc"] * keep)

    rows = docs.select("doc_id", *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] * keep, _as_bytes("text").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, f"doc_id {kinds['doc_id']}, n_words long, n_features long, weight long" + (f", doc {kinds['doc']}" if keep else ""))


def resample(docs: DataFrame, target: DataFrame, low: int = LOW, high: int = HIGH, buckets: int = BUCKETS, seed: int = SEED,
             min_words: int = MIN_WORDS, percent: int = PERCENT, keep: bool = False) -> DataFrame:
    """doc_id, n_features, weight, score and rank (from 1; null if not drawn) of every document.

    Drawn are the floor(percent n / 100) highest scores of the n documents with
    `min_words` words or more, ties to the smaller id, null ids last.  Null,
    empty or blank text: no features, weight 0, never drawn unless min_words is
    0.  A null id draws its noise as 'null'.  Repeated rows are judged each for
    itself and get consecutive ranks.  An empty target leaves smoothing alone;
    empty documents give no rows.  With `keep`, a struct `doc` holds all columns
    of the document, whatever their names; otherwise they are not read.
    """
    found = materialize(weigh(docs, gains(docs, target, low, high, buckets), low, high, keep))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = found.withColumn("score", F.col("weight") + noise).withColumn("fit", (F.col("n_words") >= min_words).cast("int"))
    order = [F.desc("fit"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("place")]
    placed = scored.withColumn("place", F.monotonically_increasing_id())
    sorted_ = checkpointed(placed.repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn("place", F.monotonically_increasing_id()))
    # a place is the partition and the row in it; partitions follow each other in the order
    part = F.shiftrightunsigned("place", 33)
    parts = sorted_.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.sum("fit").alias("fits"))
    parts = parts.select("part", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                         F.sum("fits").over(Window.partitionBy()).alias("fits"))
    ranked = sorted_.withColumn("part", part).join(F.broadcast(parts), "part").withColumn(
        "n", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    drawn = (F.col("fit") == 1) & (F.col("n") <= F.expr(f"{percent} * fits DIV 100"))
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("n")).alias("rank"), *["doc"] * keep)


def sample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents drawn, with all their columns, in no order."""
    return resample(docs, target, keep=True, **options).where(F.col("rank").isNotNull()).select("doc.*")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM d),
b AS (SELECT unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
c AS (SELECT word, {SQL_CRC32.format("encode(word)")} % {BUCKETS} AS bucket FROM (SELECT word FROM w UNION SELECT word FROM b)),
s AS (SELECT bucket, count(*) AS s FROM w JOIN c USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN c USING (word) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM w) + {BUCKETS})
             / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + {BUCKETS})))) AS BIGINT) AS gain
      FROM (SELECT DISTINCT bucket FROM c) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
f AS (SELECT r, CAST(count(*) AS BIGINT) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM w JOIN c USING (word) JOIN g USING (bucket) GROUP BY r),
e AS (SELECT r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN f USING (r)),
x AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM e),
y AS (SELECT *, n_features >= {MIN_WORDS} AS fit FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST, r) AS n, count(*) FILTER (fit) OVER () AS fits FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND n <= {PERCENT} * fits // 100 THEN n END AS rank FROM z
"""
