"""Periodic runs of words, found by seeds on diagonals.

A run is a stretch of consecutive words with smallest period q and at least
max(min_length, 2 q) words that no neighbouring word extends.  Seen on the
diagonal (i, i + q) a run of m + q words is m matching pairs in a row, and
m >= max(min_length - q, q).  That guarantees an overlap:

* lags below min_length (rounded up to even) share min_length / 2 words,
* lags from k to 2 k share k words, for k = that length, twice it, and so on.

So k-grams are numbered exactly for each k (a gram twice as long is the pair of
the numbers of its halves; only grams that recur in their document go on), the
places of a gram whose lag lies in its band are paired, and each pair is a
seed.  Seeds are taken from left to right.  A table keeps, for each lag, the
furthest word that an extension covered: a seed before it is skipped, any other
is extended by comparing the numbered grams, longest first.

Places of a gram that overlap by half or more are periodic among themselves and
all but the first of such a chain continue the pair to their left, so pairs
of two later members are never listed.  This keeps the pairs in proportion to
the words, whatever the text repeats.

Texts never leave their partition and nothing is shuffled.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import SQL_CRC32

MIN_LENGTH = 12
#: words numbered together; a longer text is numbered for itself
BATCH_WORDS = 200_000

Run = tuple[int, int, int]


def _renumber(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


def _number_words(texts: list[list[bytes]]) -> np.ndarray:
    """Numbers of the words of all texts; equal words of different texts differ, so no gram crosses texts."""
    out, base = [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        out += [base + seen.setdefault(w, len(seen)) for w in words]
        base += len(seen)
    return np.array(out, np.int64)


class _Grams:
    """Numbers of the grams at every place, by gram length; -1 where there is none that matters."""

    def __init__(self, words: np.ndarray, shortest: int):
        self.n, self.shortest = len(words), shortest
        self.levels: list[tuple[int, np.ndarray]] = [(1, np.append(words, -1).astype(np.int32))]
        size = 1
        while size < shortest:
            step = min(size, shortest - size)
            self.levels.append((size + step, self._join(self.levels[-1][1], step, size + step)))
            size += step

    def _join(self, numbers: np.ndarray, step: int, size: int) -> np.ndarray:
        """Numbers of grams of `size` words, each made of two (overlapping) shorter ones."""
        out = np.full(self.n + 1, -1, np.int32)
        count = self.n - size + 1
        if count > 0:
            a, b = numbers[:count], numbers[step:step + count]
            at = np.flatnonzero((a >= 0) & (b >= 0))
            out[at] = _renumber(a[at].astype(np.int64) * (self.n + 1) + b[at])
        return out

    def double(self) -> None:
        size, numbers = self.levels[-1]
        self.levels.append((2 * size, self._join(numbers, size, 2 * size)))

    def recurring(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the longest grams that occur again, by number and place; the others are struck."""
        numbers = self.levels[-1][1]
        at = np.flatnonzero(numbers >= 0)
        counts = np.bincount(numbers[at]) if len(at) else np.zeros(0, np.int64)
        single = at[counts[numbers[at]] < 2]
        at = at[counts[numbers[at]] > 1]
        if self.levels[-1][0] >= self.shortest:
            numbers[single] = -1
        at = at[np.argsort(numbers[at], kind="stable")]
        return at, numbers[at].astype(np.int64)

    def common(self, i: int, j: int) -> int:
        """Number of equal words from i and from j on, by the longest grams as often as they fit, then shorter ones."""
        start = i
        size, numbers = self.levels[-1]
        while (a := numbers[i]) >= 0 and a == numbers[j]:
            i, j = i + size, j + size
        for size, numbers in reversed(self.levels[:-1]):
            if (a := numbers[i]) >= 0 and a == numbers[j]:
                i, j = i + size, j + size
        return i - start


def _expand(owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each owner with every index of its range."""
    count = high - low
    index = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return np.repeat(owner, count), index


def _seeds(at: np.ndarray, numbers: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places i < j of a gram with low <= j - i < high, but those of two later members of chains."""
    span = int(at.max()) + 2 * high + 1
    keys = numbers * span + at + high
    first = np.ones(len(at), bool)
    first[1:] = (numbers[1:] != numbers[:-1]) | (at[1:] - at[:-1] > size // 2)
    own = np.flatnonzero(first)
    left, right = _expand(own, np.searchsorted(keys, keys[own] + low), np.searchsorted(keys, keys[own] + high))
    to, back = _expand(own, np.searchsorted(keys, keys[own] - high, "right"), np.searchsorted(keys, keys[own] - low, "right"))
    later = ~first[back]
    i = np.concatenate((at[left], at[back[later]]))
    j = np.concatenate((at[right], at[to[later]]))
    order = np.argsort(i, kind="stable")
    return i[order], j[order]


def find_runs(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[Run]]:
    """(start, length, period) of the runs of each text, by start and period."""
    half = (min_length + 1) // 2
    words = _number_words(texts)
    ends = np.cumsum([len(t) for t in texts])
    grams = _Grams(words, half)
    found: dict[tuple[int, int], int] = {}
    size, low = half, 1
    while True:
        at, numbers = grams.recurring()
        if not len(at):
            break
        covered: dict[int, int] = {}
        for i, j in zip(*(x.tolist() for x in _seeds(at, numbers, size, low, 2 * size))):
            lag = j - i
            reached = covered.get(lag, 0)
            if i < reached:
                continue
            while i > reached and words[i - 1] == words[j - 1]:
                i, j = i - 1, j - 1
            end = j + grams.common(i, j)
            covered[lag] = end - lag
            if end - i >= max(min_length, 2 * lag):
                # a multiple of the smallest period covers the same words
                found[i, end] = min(lag, found.get((i, end), lag))
        low = size = 2 * size
        grams.double()
    out: list[list[Run]] = [[] for _ in texts]
    for (start, end), period in sorted(found.items(), key=lambda x: (x[0][0], x[1])):
        text = int(np.searchsorted(ends, start, "right"))
        out[text].append((start - int(ends[text]) + len(texts[text]), end - start, period))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def repeat_by_id(doc_id: object, words: list[bytes]) -> list[bytes]:
    """One document in ten, by the crc32 of its id, made periodic from some word on; a null id leaves it as it is."""
    if doc_id is None or not words:
        return words
    rest, pick = divmod(crc32(str(doc_id).encode()), 10)
    if pick:
        return words
    n = len(words)
    start = rest % n
    period = 1 + (n - start) // (3 + rest % 8)
    return words[:start] + [words[start + (i - start) % period] for i in range(start, n)]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH,
                  reword: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start and period) and collapsed text of every document.

    `reword(doc_id, words)` may replace the words first.  Null, empty or blank
    text: no words, no runs, empty collapsed text.  Rows are judged each for
    itself, so repeated rows, repeated and null ids stand as often as they
    came in.  Texts are searched whole, however long.  Empty input: no rows.
    Other input columns are not read.
    """
    def answer(id_type: pa.DataType, ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = find_runs(texts, min_length)
        flat = np.array([r for of in runs for r in of], np.int64).reshape(-1, 3)
        entries = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=["start", "length", "period"])
        offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_type), pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(offsets, entries),
             pa.array([b" ".join(collapse(t, r)) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.column(0).type
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").split()
                words = reword(doc_id, words) if reword else words
                if texts and held + len(words) > BATCH_WORDS:
                    yield answer(id_type, ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
            if texts:
                yield answer(id_type, ids, texts)

    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def report(docs: DataFrame, min_length: int = MIN_LENGTH, reword=repeat_by_id) -> DataFrame:
    """One row a document: number of runs, the longest one and digests of the runs and of the collapsed text."""
    found = periodic_runs(docs, min_length, reword)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                  {SQL_CRC32.format("encode(CAST(doc_id AS VARCHAR))")} AS h FROM documents),
e AS (SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS parts FROM d),
f AS (SELECT r, doc_id, n, CASE WHEN planted THEN
        list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END]) ELSE w END AS w FROM e),
t AS (SELECT r, unnest(range(n)) AS i, unnest(w) AS word, w FROM f),
g AS (SELECT r, i, array_to_string(w[i + 1:i + {MIN_LENGTH // 2}], ' ') AS gram FROM t WHERE i + {MIN_LENGTH // 2} <= len(w)),
p AS (SELECT x.r, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i),
isle AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM p),
seg AS (SELECT r, q, min(i) AS s, count(*) + {MIN_LENGTH // 2 - 1} + q AS length FROM isle GROUP BY r, q, k),
runs AS (SELECT r, s, length, min(q) AS q FROM seg WHERE length >= greatest({MIN_LENGTH}, 2 * q) GROUP BY r, s, length),
per AS (SELECT r, count(*) AS n_runs, first(struct_pack(s := s, length := length, q := q) ORDER BY length DESC, s, q) AS best,
               string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + length)) AS i FROM runs),
kept AS (SELECT t.r, string_agg(word, ' ' ORDER BY t.i) AS text FROM t ANTI JOIN gone ON t.r = gone.r AND t.i = gone.i GROUP BY t.r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length,
       CAST(best.q AS BIGINT) AS period, CAST(1000 * best.length // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM f LEFT JOIN per USING (r) LEFT JOIN kept USING (r)
"""
