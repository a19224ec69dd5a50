"""Byte-pair encoding and decoding of whole texts.

Each piece of a text is a doubly linked list of symbols.  A priority queue
holds the mergeable neighbours by (rank, position); entries whose symbols have
changed since are skipped when they come up.  Decoding looks the ids up again
and joins their vocabulary strings.

The vocabulary file is read on the driver and broadcast: its size is that of
the file, whatever the corpus.  Texts never leave their partition.
"""
from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: pieces whose ids a worker remembers, and texts it holds at a time
REMEMBERED = 200_000
BATCH_ROWS = 256
MAX_VOCABULARY_BYTES = 64 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE model with word ends, read from a tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.digest = hashlib.sha256(content.encode()).hexdigest()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = model["vocab"]
        self.names = {i: s for s, i in {**ids, **self.special}.items()}
        self.base = len(self.names)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {ids[a] * self.base + ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        end = model["end_of_word_suffix"] or ""
        self.inner = [ids[s] for s in byte_symbols()]
        self.last = [ids[s + end] for s in byte_symbols()]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]


class Encoder:
    """Encodes and decodes with one vocabulary; remembers the pieces it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pieces = regex.compile(vocabulary.pattern).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.known: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours, lowest rank first and leftmost among equals."""
        merges, base, n = self.v.merges, self.v.base, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            pair = symbols[i] * base + symbols[i + 1]
            if pair in merges:
                queue.append((merges[pair][0], i, pair))
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i]
            if j >= n or symbols[i] < 0 or symbols[i] * base + symbols[j] != pair:
                continue  # stale: one of the two has been merged since
            symbols[i], symbols[j] = merges[pair][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                pair = symbols[i] * base + symbols[k]
                if pair in merges:
                    heapq.heappush(queue, (merges[pair][0], i, pair))
            h = before[i]
            if h >= 0:
                pair = symbols[h] * base + symbols[i]
                if pair in merges:
                    heapq.heappush(queue, (merges[pair][0], h, pair))
        return [s for s in symbols if s >= 0]

    def piece(self, text: str) -> bytes:
        """Ids of one piece as little-endian 32-bit integers."""
        raw = text.encode("utf-8", "surrogatepass")
        ids = self.merge([*(self.v.inner[b] for b in raw[:-1]), self.v.last[raw[-1]]])
        return struct.pack(f"<{len(ids)}I", *ids)

    def plain(self, text: str) -> bytes:
        """Ids of text without special tokens: composed, lower-cased by character, split, merged."""
        text = unicodedata.normalize("NFC", text)
        pieces = self.pieces(text.replace("Σ", "σ").lower())
        known = self.known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        out = []
        for p in pieces:
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(p) < 64:
                    known[p] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special is None:
            return self.plain(text)
        special = self.v.special
        return b"".join(struct.pack("<I", special[part]) if part in special else self.plain(part)
                        for part in self.special.split(text) if part)

    def decode(self, ids: bytes | None) -> str:
        """Vocabulary strings of the ids, joined as the model without a decoder joins them."""
        names = self.v.names
        return " ".join([names[i] for i in memoryview(ids or b"").cast("I")])


_ENCODERS: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    vocabulary = shared.value
    if vocabulary.digest not in _ENCODERS:
        _ENCODERS[vocabulary.digest] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.digest]


_SENT: dict[tuple[str, str], object] = {}


def _broadcast(docs: DataFrame, path: str):
    """The vocabulary of a file, sent once for each application."""
    if Path(path).stat().st_size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is not a vocabulary: over {MAX_VOCABULARY_BYTES} bytes")
    content, context = Path(path).read_text(encoding="utf-8"), docs.sparkSession.sparkContext
    key = context.applicationId, hashlib.sha256(content.encode()).hexdigest()
    if key not in _SENT:
        _SENT[key] = context.broadcast(Vocabulary(content))
    return _SENT[key]


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), n_tokens and, on request, decoded.

    Null or empty text: no ids, empty decoded text.  Repeated rows are encoded
    each for itself; null ids pass through.  Empty input: no rows.  Texts are
    encoded whole, however long.  Other input columns are not read.
    """
    shared = _broadcast(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                ids = [coder.encode(t) for t in batch.column(1).to_pylist()]
                cols = [batch.column(0), pa.array(ids, pa.binary())]
                if decoded:
                    cols.append(pa.array([coder.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "ids", "decoded"][: len(cols)])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, ids binary" + ", decoded string" * decoded)
    return out.withColumn("n_tokens", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded text of (doc_id, ids); null ids decode to the empty text."""
    shared = _broadcast(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared)
        for batch in batches:
            text = [coder.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "decoded"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the sha256 of the ids and of the decoded text."""
    return encode(docs, path, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
