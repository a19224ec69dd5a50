"""Secrets in texts: fixed rules, and formats inferred from what the rules find.

Rules of three kinds (`assign`, `access`, `hex`) mark credentials; their values
are labelled strings.  From each kind's values a probabilistic automaton is
inferred: a prefix tree with counts, whose states are merged, in order of their
depth, wherever a Hoeffding bound can't tell their ends and continuations
apart, and those of all their successors.  A state is first compared with the
one before it, so that a random tail becomes a loop behind its fixed prefix.
A symbol that no string had at a state leads to a last state with the shares
of all symbols.  Ordinary tokens of the texts train
one more automaton in the same way.  Every token of a length that a kind's
values have is then scored by its log likelihood as that kind over that as an
ordinary token, a character; tokens over the kind's threshold are marked
`grammar`.  The threshold is fitted on labelled and ordinary strings that the
automata have not seen.  The texts may hold credentials that no rule marks, so
strings as likely for a kind as its own values are not taken for ordinary.

The automata learn from at most SAMPLE distinct strings a kind: those with the
smallest crc32, so the choice depends on neither order nor partitions.  Each
task keeps no more than that of its own, and no more reaches the driver.
The automata (at most SAMPLE * MAX_LENGTH states) are sent to all tasks; texts
never leave their partition.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import materialize

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
KINDS = ("assign", "access", "hex")
RULES = {
    "assign": re.compile(r"""(?ia)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("(AKIA[A-Z0-9]{12,})"),
    "hex": re.compile("([0-9a-f]{32,})"),
}
SHORTEST_VALUE = 8
ADDED = "grammar"

#: strings that an automaton learns from and is calibrated on, and the longest of them
SAMPLE, MAX_LENGTH = 1000, 256
#: fewer labelled strings make no automaton
MIN_LABELLED = 20
#: confidence of the merging test, pseudo-count of each symbol
ALPHA, PSEUDO = 0.05, 0.1
#: shares of unseen labelled and of unseen ordinary strings that the threshold does not heed
MISSED, FALSE = 0.02, 0.001
#: characters of text handled together
BATCH_CHARS = 4_000_000

_ORDINARY = "ordinary"
_CODE = np.full(256, -1, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_TRIMMED = ".-_"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, kind's place, kind, value) ordered, with ends: spans of the fixed rules, leftmost first within a kind."""
    out = []
    for place, kind in enumerate(KINDS):
        for m in RULES[kind].finditer(text):
            if len(m[1]) >= SHORTEST_VALUE:
                out.append((m.start(), place, m.end(), m[1]))
    return sorted(out)


def tokens(text: str, shortest: int) -> Iterator[tuple[int, int]]:
    """Spans of the runs of value characters, without dots, hyphens and underscores at their ends."""
    for m in re.finditer(f"[A-Za-z0-9+/_.=-]{{{shortest},}}", text):
        found = m[0]
        start = m.start() + len(found) - len(found.lstrip(_TRIMMED))
        end = m.end() - len(found) + len(found.rstrip(_TRIMMED))
        if end - start >= shortest:
            yield start, end


def outside(spans: Iterable[tuple[int, int]], taken: list[tuple]) -> Iterator[tuple[int, int]]:
    """The spans, given in order, that overlap none of the base spans."""
    rest = iter(sorted((s[0], s[2]) for s in taken))
    blocks, ahead, reach = [], next(rest, None), 0
    for start, end in spans:
        while ahead is not None and ahead[0] < end:
            reach = max(reach, ahead[1])
            blocks.append(ahead)
            ahead = next(rest, None)
        if reach <= start or not any(a < end and b > start for a, b in blocks):
            yield start, end


# ------------------------------------------------------------- inference

class _Tree:
    """A prefix tree with counts; merging turns it into a graph."""

    def __init__(self, strings: list[str]):
        self.visits, self.ends, self.next, self.uses = [0], [0], [{}], [{}]
        for s in strings:
            at = 0
            self.visits[0] += 1
            for c in s:
                self.uses[at][c] = self.uses[at].get(c, 0) + 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.visits.append(0)
                    self.ends.append(0)
                    self.next.append({})
                    self.uses.append({})
                at = self.next[at][c]
                self.visits[at] += 1
            self.ends[at] += 1

    def differ(self, a: int, b: int, alpha: float) -> bool:
        """Whether some frequency of a and b, or of what follows them, is too far apart for one state."""
        rest = [(a, b)]
        while rest:
            a, b = rest.pop()
            n, m = self.visits[a], self.visits[b]
            bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return True
            for c in self.uses[a].keys() | self.uses[b].keys():
                if abs(self.uses[a].get(c, 0) / n - self.uses[b].get(c, 0) / m) > bound:
                    return True
                if c in self.next[a] and c in self.next[b]:
                    rest.append((self.next[a][c], self.next[b][c]))
        return False

    def fold(self, a: int, b: int) -> None:
        """Add the tree below b to the state a."""
        rest = [(a, b)]
        while rest:
            a, b = rest.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for c, n in self.uses[b].items():
                self.uses[a][c] = self.uses[a].get(c, 0) + n
                if c in self.next[a]:
                    rest.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]


@dataclass
class Automaton:
    """Next state and log probability by state and symbol; the last symbol ends, the last state follows the unexpected."""
    next: np.ndarray
    log: np.ndarray

    def scores(self, strings: list[bytes]) -> np.ndarray:
        """Log probability of each string of the alphabet."""
        lengths = np.array([len(s) for s in strings], np.int64)
        order = np.argsort(-lengths, kind="stable")
        codes = _CODE[np.frombuffer(b"".join(strings), np.uint8)]
        starts = (np.cumsum(lengths) - lengths)[order]
        state, total, sorted_ = np.zeros(len(strings), np.int64), np.zeros(len(strings)), lengths[order]
        for at in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-sorted_, -at))       # strings longer than `at`
            symbol = codes[starts[:live] + at]
            total[:live] += self.log[state[:live], symbol]
            state[:live] = self.next[state[:live], symbol]
        total += self.log[state, -1]
        out = np.empty(len(strings))
        out[order] = total
        return out


def infer(strings: list[str], alpha: float = ALPHA, pseudo: float = PSEUDO) -> Automaton:
    """The automaton of the strings; states are merged in order of depth and symbol, with the nearest that fits."""
    tree = _Tree(sorted(strings))
    kept = [0]
    border = [(1, c, 0) for c in sorted(tree.next[0])]
    known = {0}
    while border:
        border.sort(reverse=True)
        depth, symbol, parent = border.pop()
        state = tree.next[parent][symbol]
        if state in known:
            continue
        nearest = (parent, *(k for k in reversed(kept) if k != parent))
        same = next((k for k in nearest if not tree.differ(k, state, alpha)), None)
        if same is None:
            known.add(state)
            kept.append(state)
            border += [(depth + 1, c, state) for c in tree.next[state]]
        else:
            tree.next[parent][symbol] = same
            tree.fold(same, state)
            # folding may hang new states below any kept one
            border += [(depth + 1, c, k) for k in kept for c, to in tree.next[k].items() if to not in known]
            border = list({(c, k): (d, c, k) for d, c, k in sorted(border, reverse=True)}.values())
    number = {state: i for i, state in enumerate(kept)}
    size, end = len(ALPHABET), len(kept)
    counts, follow = np.zeros((end + 1, size + 1)), np.full((end + 1, size), end)
    for state, i in number.items():
        counts[i, -1] = tree.ends[state]
        for c, n in tree.uses[state].items():
            code = ALPHABET.index(c)
            counts[i, code], follow[i, code] = n, number[tree.next[state][c]]
    counts[end] = counts.sum(axis=0)
    counts += pseudo
    return Automaton(follow, np.log(counts / counts.sum(axis=1, keepdims=True)))


@dataclass
class Format:
    """An automaton of credentials, the lengths it holds for and the score from which a token counts."""
    automaton: Automaton
    shortest: int
    longest: int
    threshold: float


@dataclass
class Formats:
    """All inferred formats against the ordinary tokens."""
    ordinary: Automaton | None
    formats: list[Format]

    @property
    def shortest(self) -> int | None:
        return min((f.shortest for f in self.formats), default=None)

    def accepted(self, strings: list[bytes]) -> np.ndarray:
        """Which tokens some format takes."""
        out, lengths = np.zeros(len(strings), bool), np.array([len(s) for s in strings], np.int64)
        for f in self.formats:
            at = np.flatnonzero((lengths >= f.shortest) & (lengths <= f.longest) & ~out)
            if len(at):
                out[at] = _ratio(f.automaton, self.ordinary, [strings[i] for i in at]) >= f.threshold
        return out


def _each(automaton: Automaton, strings: list) -> np.ndarray:
    """Log probability a symbol, the end counted."""
    return automaton.scores([s if isinstance(s, bytes) else s.encode() for s in strings]) / np.array([len(s) + 1 for s in strings])


def _ratio(automaton: Automaton, ordinary: Automaton, strings: list) -> np.ndarray:
    return _each(automaton, strings) - _each(ordinary, strings)


def _lowest(scores: np.ndarray) -> float:
    return np.sort(scores)[int(MISSED * len(scores))]


def _halves(strings: Iterable[str]) -> tuple[list[str], list[str]]:
    """Strings at even and at odd places by crc32."""
    ordered = [s for _, s in sorted((crc32(s.encode()), s) for s in set(strings) if len(s) <= MAX_LENGTH)]
    return ordered[::2], ordered[1::2]


def learn(labelled: dict[str, list[str]], ordinary: list[str]) -> Formats:
    """Formats of the kinds with enough strings; one half trains, the other sets the threshold."""
    halves = {kind: _halves(labelled[kind]) for kind in KINDS if len(set(labelled.get(kind, ()))) >= MIN_LABELLED}
    automata = {kind: infer(seen) for kind, (seen, _) in halves.items()}
    for kind, (_, unseen) in halves.items():
        alike = _each(automata[kind], ordinary) >= _lowest(_each(automata[kind], unseen))
        ordinary = [s for s, like in zip(ordinary, alike) if not like]
    plain, rest = _halves(ordinary)
    background = infer(plain)
    formats = []
    for kind, (seen, unseen) in halves.items():
        threshold = _lowest(_ratio(automata[kind], background, unseen))
        if rest:
            other = np.sort(_ratio(automata[kind], background, rest))
            most = other[-1 - int(FALSE * len(other))]
            # half way between the two, if they are apart
            threshold = (threshold + most) / 2 if most < threshold else np.nextafter(most, np.inf)
        lengths = [len(s) for s in seen + unseen]
        formats.append(Format(automata[kind], min(lengths), max(lengths), float(threshold)))
    return Formats(background, formats)


# ----------------------------------------------------------------- frames

def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        start, held, texts = 0, 0, []
        for row, text in enumerate(batch.column(1)):
            text = text.as_py()
            if texts and held + len(text) > BATCH_CHARS:
                yield batch.slice(start, row - start), texts
                start, held, texts = row, 0, []
            texts.append(text)
            held += len(text)
        if texts:
            yield batch.slice(start), texts


def samples(docs: DataFrame, size: int = SAMPLE) -> dict[str, list[str]]:
    """At most `size` distinct values of each kind, and ordinary tokens, of the whole corpus: the smallest by crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, set] = {kind: set() for kind in (*KINDS, _ORDINARY)}
        limit = dict.fromkeys(best, 1 << 32)

        def shrink(kind):
            kept = sorted(best[kind])[:size]
            best[kind] = set(kept)
            if len(kept) == size:
                limit[kind] = kept[-1][0]

        def add(kind, value):
            crc = crc32(value.encode())
            if crc <= limit[kind] and len(value) <= MAX_LENGTH:
                best[kind].add((crc, value))
                if len(best[kind]) > 2 * size:
                    shrink(kind)

        for _, texts in _slices(batches):
            for text in texts:
                spans = base_spans(text)
                for _, place, _, value in spans:
                    add(KINDS[place], value)
                for start, end in outside(tokens(text, SHORTEST_VALUE), spans):
                    add(_ORDINARY, text[start:end])
        for kind in best:
            shrink(kind)
        rows = [(kind, crc, value) for kind in best for crc, value in sorted(best[kind])]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.int64(), pa.string()))],
                                         names=["kind", "crc", "value"])

    found = materialize(_texts(docs).mapInArrow(run, "kind string, crc long, value string").distinct())
    # each kind's smallest are found task by task (take ordered), so no task sees more than the samples
    parts = [found.where(F.col("kind") == kind).orderBy("crc", "value").limit(size) for kind in (*KINDS, _ORDINARY)]
    out: dict[str, list[str]] = {kind: [] for kind in (*KINDS, _ORDINARY)}
    for row in reduce(DataFrame.union, parts).collect():
        out[row.kind].append(row.value)
    return out


def find_secrets(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """doc_id and spans (kind, start, end by start and kind) of every document.

    Without `formats` they are learned from the documents.  Offsets are code
    points, ends exclusive.  Null or empty text: no spans.  Rows are searched
    each for itself; repeated rows and ids, and null ids, stand as often as they
    came in.  With too few labelled strings of a kind only its rule applies.
    Empty input: no rows.  Other input columns are not read.
    """
    if formats is None:
        found = samples(docs)
        formats = learn(found, found.pop(_ORDINARY))
    shared = docs.sparkSession.sparkContext.broadcast(formats)
    names = (*KINDS, ADDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part, texts in _slices(batches):
            spans = [base_spans(t) for t in texts]
            if known.formats:
                at = [(row, a, b) for row, t in enumerate(texts) for a, b in outside(tokens(t, known.shortest), spans[row])]
                taken = known.accepted([texts[row][a:b].encode() for row, a, b in at])
                for (row, a, b), good in zip(at, taken):
                    if good:
                        spans[row].append((a, len(KINDS), b, ""))
            flat = [s for of in spans for s in sorted(of)]
            entries = pa.StructArray.from_arrays(
                [pa.array([names[s[1]] for s in flat], pa.string()), pa.array([s[0] for s in flat], pa.int64()), pa.array([s[2] for s in flat], pa.int64())],
                names=["kind", "start", "end"])
            offsets = pa.array(np.cumsum([0, *map(len, spans)]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, entries)], names=["doc_id", "spans"])

    rows = _texts(docs)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind: string, start: long, end: long>>")


def report(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """Counts of the base spans by kind, the digest of the base spans and the list of all spans of every document."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.kind != ADDED)
    counts = [counted(kind) for kind in KINDS]
    return find_secrets(docs, formats).select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
