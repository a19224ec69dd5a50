"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of WINDOW bytes that covers it also starts in a
document with a smaller id.  Equal strings must meet without comparing every
shard with every other:

* Every string holds an anchor, the smallest hash of its ANCHOR-byte grams, and
  equal strings hold the same one.  Shards send the hashes of their anchors and
  learn which are found in two documents; only text around those can repeat.
* The contexts of an anchor (all strings that hold it) go to one merge shard,
  equal contexts of a shard once, with their smallest id.  The merge shard
  builds the suffix array of its contexts (Larsson-Sadakane refinement), the
  common prefixes of neighbours (Kasai) and so the smallest id of each string.
* An anchor with more contexts than one suffix array takes is answered place by
  place: equal strings hold their anchor at the same place.
* An anchor held by very many shards would load one merge shard.  Its strings
  are sent as sorted fingerprints instead, dealt by value, and the shards'
  sorted lists are merged by binary search.

Whole copies are found first and need none of this.  The shards' texts are
shuffled once and that exchange is used by every pass.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.llm.wordhash import mix

WINDOW, ANCHOR = 50, 16
#: grams in a string, and bytes of a string before its anchor at most
GRAMS = WINDOW - ANCHOR + 1
BEFORE = WINDOW - ANCHOR
CONTEXT = BEFORE + WINDOW
SHARD_BYTES = 4 << 20
SLICE_BYTES = 1 << 17
#: contexts in one suffix array; those of an anchor stay together
ARRAY_CONTEXTS = 2048
#: an anchor found in so many shards is common
COMMON_SHARDS = 1024
LAST_ID = np.iinfo(np.int64).max
_U = np.uint64


# --- suffix arrays -------------------------------------------------------------------------

def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Sorted suffixes of strings of symbols > 0, each ended by a 0; suffixes stop at the 0.

    Seven symbols are sorted at once, then groups of equal suffixes are
    refined by the rank of what follows, twice as deep each time.
    """
    n, depth = len(symbols), 7
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    padded = np.concatenate((symbols.astype(np.int64), np.zeros(depth, np.int64)))
    for k in range(depth):
        key = key << 9 | np.where(alive, padded[k: n + k], 0)
        alive &= padded[k: n + k] > 0
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    starts = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    while True:
        single = starts & np.concatenate((starts[1:], [True]))
        open_at = np.flatnonzero(~single & alive[sa])
        if not len(open_at):
            return sa
        members = sa[open_at]
        pair = rank[members] * (n + 1) + rank[members + depth]
        order = np.argsort(pair, kind="stable")
        members, pair = members[order], pair[order]
        sa[open_at] = members
        begins = np.concatenate(([True], pair[1:] != pair[:-1]))
        starts[open_at] |= begins
        rank[members] = np.maximum.accumulate(np.where(begins, open_at, 0))
        # a group is done when its suffixes end within the depth just sorted
        reached = np.minimum(members + depth, n - 1)
        alive[members] &= alive[reached]
        depth *= 2


def common_prefixes(symbols: np.ndarray, sa: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Length of the prefix each sorted suffix shares with the one before it.

    The walk in text order that loses at most one symbol a step, taken by all
    strings (beginning at `first`) side by side.
    """
    n = len(symbols)
    place = np.empty(n, np.int64)
    place[sa] = np.arange(n)
    out = np.zeros(n, np.int64)
    length = np.diff(np.concatenate((first, [n]))) - 1
    at, h, left = first.copy(), np.zeros(len(first), np.int64), length.copy()
    padded = np.concatenate((symbols, [0]))
    while len(at):
        going = left > 0
        at, h, left = at[going], h[going], left[going]
        other = sa[np.maximum(place[at] - 1, 0)]
        some = np.flatnonzero(place[at] > 0)
        h[place[at] == 0] = 0
        while len(some):
            a, b = at[some] + h[some], other[some] + h[some]
            same = (padded[a] == padded[b]) & (padded[a] > 0)
            some = some[same]
            h[some] += 1
        out[place[at]] = h
        at, h, left = at + 1, np.maximum(h - 1, 0), left - 1
    return out


def first_owner(contexts: np.ndarray, sizes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Smallest owner of the string of WINDOW bytes at each place of each context; LAST_ID where none fits."""
    m, width = contexts.shape
    inside = np.arange(width + 1) < sizes[:, None]
    ended = np.arange(width + 1) <= sizes[:, None]
    symbols = np.zeros((m, width + 1), np.int16)
    symbols[:, :width] = contexts.astype(np.int16) + 1
    symbols[~inside] = 0
    flat = symbols[ended]
    first = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    sa = suffix_array(flat)
    shared = common_prefixes(flat, sa, first)
    row = np.repeat(np.arange(m), sizes + 1)
    place = np.arange(len(flat)) - first[row]
    fits = (place + WINDOW <= sizes[row])[sa]
    sa = sa[fits]
    # shorter suffixes between two fitting ones only lower what these share
    runs = np.concatenate(([0], np.cumsum(shared < WINDOW)))[1:][fits]
    out = np.full((m, width), LAST_ID)
    if len(sa):
        starts = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
        least = np.minimum.reduceat(owner[row[sa]], starts)
        group = np.cumsum(np.concatenate(([0], (runs[1:] != runs[:-1]).astype(int))))
        out[row[sa], place[sa]] = least[group]
    return out


# --- anchors and contexts of a shard -------------------------------------------------------

def _words_at_every_byte(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as an integer; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    out = np.empty(len(data) + 8, np.uint64)
    for s in range(8):
        part = padded[s: s + (len(padded) - s) // 8 * 8].view("<u8")
        target = out[s::8]
        target[:] = part[: len(target)]
    return out


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i: i + width] for each i that has so many."""
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[: len(x) - (width - span)], x[width - span:]) if span < width else x


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the anchors of all strings of WINDOW bytes inside one document; hashes are even."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    eight = _words_at_every_byte(data)
    grams = n - ANCHOR + 1
    h = eight[:grams] * _U(0x9E3779B97F4A7C15)
    h += eight[8: grams + 8] * _U(0xC2B2AE3D27D4EB4F)
    h ^= h >> _U(32)
    h *= _U(0xBF58476D1CE4E5B9)
    order = (h >> _U(32)).astype(np.uint32) | np.uint32(1)
    least = _sliding(order, GRAMS, np.minimum)
    # strings across two documents choose nothing
    for b in offsets[1:-1].tolist():
        least[max(0, b - WINDOW + 1): min(b, len(least))] = 0
    wide = np.zeros(len(least) + 2 * (GRAMS - 1), np.uint32)
    wide[GRAMS - 1: GRAMS - 1 + len(least)] = least
    top = _sliding(wide, GRAMS, np.maximum)
    at = np.flatnonzero(top[:grams] == order)
    # chosen hashes are small ones: mixed again, their ranges make even buckets
    return at, mix(h[at]) & ~_U(1)


class _Shard:
    """The texts of one shard with their anchors, in an order that does not depend on arrival."""

    def __init__(self, docs: pd.DataFrame, copies: set):
        ids = docs["doc_id"]
        self.ids = np.array([LAST_ID if pd.isna(x) else int(x) for x in ids], np.int64)
        self.texts = [bytes(t) for t in docs["text"]]
        order = sorted(range(len(self.texts)), key=lambda i: (self.ids[i], self.texts[i]))
        self.ids, self.texts, self.rows = self.ids[order], [self.texts[i] for i in order], [ids.iloc[i] for i in order]
        digest = (lambda t: hashlib.sha256(t).digest()) if copies else (lambda t: b"")
        self.copy = np.array([(x, digest(t)) in copies for x, t in zip(self.ids.tolist(), self.texts)], bool)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        places, hashes = [], []
        first = 0
        while first < len(sizes):
            last = max(first + 1, int(np.searchsorted(self.offsets, self.offsets[first] + SLICE_BYTES, "right")) - 1)
            lo, hi = self.offsets[first], self.offsets[last]
            at, h = anchors(self.data[lo:hi], self.offsets[first: last + 1] - lo)
            places.append(at + lo)
            hashes.append(h)
            first = last
        self.place = np.concatenate(places) if places else np.zeros(0, np.int64)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.doc = np.searchsorted(self.offsets, self.place, "right") - 1
        own = ~self.copy[self.doc] if len(self.place) else np.zeros(0, bool)
        self.place, self.hash, self.doc = self.place[own], self.hash[own], self.doc[own]
        self.distinct, self.number = np.unique(self.hash, return_inverse=True)

    def twice(self) -> np.ndarray:
        """Which distinct hashes stand in two documents of this shard."""
        low, high = np.full(len(self.distinct), LAST_ID), np.full(len(self.distinct), -1)
        ids = self.ids[self.doc]
        np.minimum.at(low, self.number, ids)
        np.maximum.at(high, self.number, ids)
        return low < high

    def contexts(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of chosen anchors: (records, distinct records, number of each in them, bytes before each, document)."""
        p, d = self.place[chosen], self.doc[chosen]
        start, end = np.maximum(self.offsets[d], p - BEFORE), np.minimum(self.offsets[d + 1], p + WINDOW)
        records = np.empty((len(p), CONTEXT + 2), np.uint8)
        for lo in range(0, len(p), 1 << 15):
            part = slice(lo, lo + (1 << 15))
            columns = start[part, None] + np.arange(CONTEXT)
            text = self.data[np.minimum(columns, len(self.data) - 1)]
            text[columns >= end[part, None]] = 0
            records[part, :CONTEXT] = text
        records[:, CONTEXT], records[:, CONTEXT + 1] = p - start, end - start
        seen = records.view(f"V{CONTEXT + 2}").ravel()
        distinct, number = np.unique(seen, return_inverse=True)
        return records, distinct, number, start, d

    def strings(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, documents and fingerprints (two hashes) of all strings around chosen anchors."""
        p, d = self.place[chosen], self.doc[chosen]
        edges = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edges, np.maximum(p - BEFORE, self.offsets[d]), 1)
        np.add.at(edges, p + 1, -1)
        at = np.flatnonzero(np.cumsum(edges[:-1], dtype=np.int32))
        doc = np.searchsorted(self.offsets, at, "right") - 1
        fits = at + WINDOW <= self.offsets[doc + 1]
        at, doc = at[fits], doc[fits]
        prints = np.zeros((len(at), 2), np.uint64)
        for lo in range(0, len(at), 1 << 17):
            prints[lo: lo + (1 << 17)] = _fingerprints(self.data, at[lo: lo + (1 << 17)])
        return at, doc, prints


def _fingerprints(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two independent hashes of the string at each place."""
    out = np.empty((len(at), 2), np.uint64)
    for k in range(2):
        h = np.full(len(at), 17 + k, np.uint64)
        for s in range(0, WINDOW, 5):
            piece = np.zeros(len(at), np.uint64)
            for b in range(5):
                piece = piece << _U(8) | data[at + s + b]
            h = mix(h * _U(0x9E3779B97F4A7C15 + 2 * k) + piece + _U(1))
        out[:, k] = h
    return out


def _numbered(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct fingerprints, number of each in them)."""
    order = np.lexsort((prints[:, 1], prints[:, 0]))
    ranked = prints[order]
    new = np.concatenate((np.ones(min(1, len(order)), bool), (ranked[1:] != ranked[:-1]).any(axis=1)))
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return np.ascontiguousarray(ranked[new]).view([("a", "u8"), ("b", "u8")]).ravel(), number


# --- the passes ----------------------------------------------------------------------------

def _cuts(buckets: int) -> np.ndarray:
    return np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)


def _parts(ordered: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    ends = [0, *np.searchsorted(ordered, _cuts(buckets)).tolist(), len(ordered)]
    for b, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
        if hi > lo:
            yield b, slice(lo, hi)


_SENT = "kind int, shard long, bucket long, items binary, owners binary"


def _copies_in(pdf: pd.DataFrame) -> set:
    """(id, sha256 of the text) of whole copies: an id alone may belong to several texts."""
    found: set = set()
    for kind, owners in zip(pdf["kind"], pdf["owners"]):
        if kind < 0:
            found.add((int.from_bytes(owners[:8], "big", signed=True), bytes(owners[8:])))
    return found


def _send_anchors(buckets: int):
    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame([], columns=["kind", "shard", "bucket", "items", "owners"])
        s = _Shard(docs, _copies_in(told))
        items = s.distinct | s.twice().astype(np.uint64)
        return pd.DataFrame([(0, int(docs["shard"].iloc[0]), b, items[part].tobytes(), b"") for b, part in _parts(s.distinct, buckets)],
                            columns=["kind", "shard", "bucket", "items", "owners"])
    return run


def _find_shared(common: int):
    """Tell each shard about its anchors: 0 found in one document, 1 in several, 2 common."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, np.uint64) for x in pdf["items"]]
        every = np.concatenate(lists)
        distinct, number, count = np.unique(every & ~_U(1), return_inverse=True, return_counts=True)
        marked = np.bincount(number, (every & _U(1)).astype(float), minlength=len(distinct)) > 0
        state = ((count > 1) | marked).astype(np.uint8) + (count >= common)
        answers = np.split(state.astype(np.uint8)[number], np.cumsum([len(x) for x in lists])[:-1])
        return pd.DataFrame({"kind": 0, "shard": pdf["shard"], "bucket": pdf["bucket"], "items": [a.tobytes() for a in answers], "owners": b""})
    return run


def _states(s: _Shard, told: pd.DataFrame, buckets: int) -> np.ndarray:
    """The state of every anchor of a shard."""
    state = np.zeros(len(s.distinct), np.uint8)
    answers = {b: x for k, b, x in zip(told["kind"], told["bucket"], told["items"]) if k == 0}
    for b, part in _parts(s.distinct, buckets):
        state[part] = np.frombuffer(answers[b], np.uint8)
    return state[s.number]


def _least_by(number: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    least = np.full(n, LAST_ID)
    np.minimum.at(least, number, ids)
    return least


def _anchor_of(records: np.ndarray) -> np.ndarray:
    """Hash of each record's anchor, which stands after the bytes before it."""
    rows = records.view(np.uint8).reshape(len(records), CONTEXT + 2)
    columns = rows[:, CONTEXT].astype(np.int64)[:, None] + np.arange(ANCHOR)
    gram = np.ascontiguousarray(np.take_along_axis(rows, columns, 1)).view("<u8").reshape(-1, 2)
    return mix(gram[:, 0] + mix(gram[:, 1] + _U(0x9E3779B97F4A7C15)))


def _bucket_of(records: np.ndarray, merges: int) -> np.ndarray:
    """Merge shard of each distinct record."""
    return (_anchor_of(records) % _U(merges)).astype(np.int64)


def _removed_by_place(rows: np.ndarray, least: np.ndarray) -> np.ndarray:
    """As _removed_strings, for the records of one anchor: their strings that hold it at one place are compared at a time."""
    removed = np.zeros(len(rows), np.int64)
    before, size = rows[:, CONTEXT].astype(np.int64), rows[:, CONTEXT + 1].astype(np.int64)
    flat, width = rows.reshape(-1), rows.shape[1]
    for ahead in range(BEFORE + 1):
        start = before - ahead
        own = np.flatnonzero((start >= 0) & (start + WINDOW <= size))
        prints, number = _numbered(_fingerprints(flat, own * width + start[own]))
        smallest = _least_by(number, least[own], len(prints))
        goes = own[smallest[number] < least[own]]
        removed[goes] |= 1 << start[goes]
    return removed


def _removed_strings(distinct: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Bits of the places at which a record's strings start in a document with a smaller id than its own."""
    rows = distinct.view(np.uint8).reshape(len(distinct), CONTEXT + 2)
    removed = np.zeros(len(distinct), np.int64)
    order = np.argsort(_anchor_of(distinct), kind="stable")
    anchor = _anchor_of(distinct)[order]
    starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    sizes = np.diff(np.append(starts, len(order)))
    # an anchor with one context has equal strings in equal contexts only
    large = sizes > ARRAY_CONTEXTS
    for a, n in zip(starts[large].tolist(), sizes[large].tolist()):
        removed[order[a: a + n]] = _removed_by_place(rows[order[a: a + n]], least[order[a: a + n]])
    usual = (sizes > 1) & ~large
    several, sizes = starts[usual], sizes[usual]
    bits = 1 << np.arange(BEFORE + 1, dtype=np.int64)
    lo = 0
    while lo < len(several):
        hi = max(lo + 1, int(np.searchsorted(several, several[lo] + ARRAY_CONTEXTS)))
        part = np.concatenate([order[a: a + n] for a, n in zip(several[lo:hi].tolist(), sizes[lo:hi].tolist())])
        owners = first_owner(rows[part, :CONTEXT], rows[part, CONTEXT + 1].astype(np.int64), least[part])
        removed[part] = (owners[:, : BEFORE + 1] < least[part, None]) @ bits
        lo = hi
    return removed


def _chosen(s: _Shard, told: pd.DataFrame, buckets: int, merges: int):
    """What a shard sends: contexts by merge shard and fingerprints by value, always in the same order."""
    state = _states(s, told, buckets)
    records, distinct, number, start, doc = s.contexts(state == 1)
    least = _least_by(number, s.ids[doc], len(distinct))
    bucket = _bucket_of(distinct, merges) if len(distinct) else np.zeros(0, np.int64)
    at, at_doc, prints = s.strings(state == 2)
    distinct_prints, print_number = _numbered(prints)
    print_least = _least_by(print_number, s.ids[at_doc], len(distinct_prints))
    return (records, distinct, number, start, doc, least, bucket), (at, at_doc, distinct_prints, print_number, print_least)


def _send_contexts(buckets: int, merges: int):
    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(docs):
            s, shard = _Shard(docs, _copies_in(told)), int(docs["shard"].iloc[0])
            (_, distinct, _, _, _, least, bucket), (_, _, prints, _, print_least) = _chosen(s, told, buckets, merges)
            for b in np.unique(bucket).tolist():
                out.append((1, shard, b, distinct[bucket == b].tobytes(), least[bucket == b].tobytes()))
            for b, part in _parts(prints["a"], merges):
                out.append((2, shard, b, prints[part].tobytes(), print_least[part].tobytes()))
        return pd.DataFrame(out, columns=["kind", "shard", "bucket", "items", "owners"])
    return run


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Smallest ids of the strings that the shards sent, back to each in its order."""
    owners = [np.frombuffer(x, "<i8") for x in pdf["owners"]]
    ids, ends = np.concatenate(owners), np.cumsum([len(x) for x in owners])[:-1]
    if pdf["kind"].iloc[0] == 2:
        # binary search of each shard's sorted list in the merged one
        lists = [np.frombuffer(x, [("a", "u8"), ("b", "u8")]) for x in pdf["items"]]
        merged = np.unique(np.concatenate(lists))
        least = np.full(len(merged), LAST_ID)
        found = [np.searchsorted(merged, x) for x in lists]
        for at, x in zip(found, owners):
            least[at] = np.minimum(least[at], x)
        items = [least[at].tobytes() for at in found]
        return pd.DataFrame({"kind": 2, "shard": pdf["shard"], "bucket": pdf["bucket"], "items": items, "owners": b""})
    every = np.concatenate([np.frombuffer(x, f"V{CONTEXT + 2}") for x in pdf["items"]])
    distinct, number = np.unique(every, return_inverse=True)
    least = _least_by(number, ids, len(distinct))
    removed = _removed_strings(distinct, least)
    return pd.DataFrame({"kind": 1, "shard": pdf["shard"], "bucket": pdf["bucket"],
                         "items": [x.tobytes() for x in np.split(removed[number], ends)], "owners": [x.tobytes() for x in np.split(least[number], ends)]})


def removed_spans(offsets: np.ndarray, starts: Iterator[np.ndarray], whole: np.ndarray) -> np.ndarray:
    """Which bytes go: those covered by a removed string, or of a removed document."""
    edges = np.zeros(offsets[-1] + 1, np.int32)
    for some in starts:
        np.add.at(edges, some, 1)
        np.add.at(edges, some + WINDOW, -1)
    gone = np.cumsum(edges, dtype=np.int32)[:-1] > 0
    for d in np.flatnonzero(whole).tolist():
        gone[offsets[d]: offsets[d + 1]] = True
    return gone


def _finish(buckets: int, merges: int, texts: bool):
    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        if not len(docs):
            return pd.DataFrame([], columns=columns)
        s = _Shard(docs, _copies_in(told))
        (records, distinct, number, start, doc, least, bucket), (at, at_doc, prints, print_number, print_least) = _chosen(s, told, buckets, merges)
        removed, owner = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        smallest = np.full(len(prints), LAST_ID)
        answers = {(k, b): (x, y) for k, b, x, y in zip(told["kind"], told["bucket"], told["items"], told["owners"]) if k > 0}
        for b in np.unique(bucket).tolist():
            removed[bucket == b], owner[bucket == b] = (np.frombuffer(x, "<i8") for x in answers[1, b])
        for b, part in _parts(prints["a"], merges):
            smallest[part] = np.frombuffer(answers[2, b][0], "<i8")
        first = s.ids[doc] == owner[number] if len(doc) else np.zeros(0, bool)
        sizes = records[:, CONTEXT + 1].astype(np.int64)

        def starts():
            if len(at):
                yield at[smallest[print_number] < s.ids[at_doc]]
            for o in range(BEFORE + 1):
                fits = (o <= records[:, CONTEXT]) & (o + WINDOW <= sizes)
                yield start[fits & (~first | (removed[number] >> o & 1).astype(bool))] + o

        gone = removed_spans(s.offsets, starts(), s.copy & (np.diff(s.offsets) >= WINDOW))
        out = []
        for i, text in enumerate(s.texts):
            own = gone[s.offsets[i]: s.offsets[i + 1]]
            n = int(own.sum())
            spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if n else 0
            kept = text if not n else np.frombuffer(text, np.uint8)[~own].tobytes()
            out.append((s.rows[i], len(text), n, spans, kept if texts else hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=columns)
    return run


def remove_repeats(docs: DataFrame, texts: bool = True, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept of every row: the remaining bytes, or their sha256 without `texts`.

    Null or empty text: no bytes.  A text shorter than the window loses
    nothing.  Null ids come after all others.  Rows that repeat an id do not
    remove from each other.  Equal texts: all but those of the smallest id go.
    Empty input: no rows.  Texts are used whole.  Other input columns are not
    read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-n_bytes // shard_bytes))
    buckets, merges = max(1, -(-shards // 4)), 2 * shards
    shard = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(shards)).cast("long")
    rows = docs.select("doc_id", text.alias("text"), shard.alias("shard")).groupBy("shard")

    ids = docs.select(F.coalesce("doc_id", F.lit(int(LAST_ID))).cast("long").alias("id"), shard.alias("shard"), F.sha2(text, 256).alias("sha"))
    least = ids.groupBy(F.col("sha").alias("l_sha")).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = ids.join(least, F.col("sha") == F.col("l_sha")).filter(F.col("id") > F.col("least")).select("shard", "id", "sha")
    packed = F.concat(F.unhex(F.lpad(F.hex("id"), 16, "0")), F.unhex("sha"))
    copies = copies.select(F.lit(-1).alias("kind"), "shard", F.lit(0).cast("long").alias("bucket"), F.lit(b"").alias("items"), packed.alias("owners"))

    sent = rows.cogroup(copies.groupBy("shard")).applyInPandas(_send_anchors(buckets), _SENT)
    shared = sent.groupBy("bucket").applyInPandas(_find_shared(COMMON_SHARDS), _SENT).unionByName(copies)
    contexts = rows.cogroup(shared.groupBy("shard")).applyInPandas(_send_contexts(buckets, merges), _SENT)
    merged = contexts.groupBy("kind", "bucket").applyInPandas(_merge, _SENT).unionByName(shared)
    return rows.cogroup(merged.groupBy("shard")).applyInPandas(
        _finish(buckets, merges, texts), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept {'binary' if texts else 'string'}")
