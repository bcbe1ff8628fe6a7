"""Packing by minimum bin slack.

Documents are tokenised and cut into full windows and one remainder.  The
remainders are packed by length: a window starts with the longest remaining
length, and a subset-sum dynamic program over the multiset of remaining lengths
(bitsets, counts in binary parts) finds the fill closest to capacity, whose
counts are read back by backtracking.  The pattern is used as often as its
lengths last.  Where no fill reaches capacity, one more remainder per window is
cut to fill the gap, and what is left of it rejoins the multiset.

The plan depends on the histogram of lengths alone (under ``window`` numbers)
and is made on the driver; it says for runs of ranks within a length where they
go.  Ranks come from counts per input partition and length, added up per
length, so no length's rows ever meet in one task, however many there are.

Defined results: null or empty text is the end token alone; repeated rows are
separate documents; every token lies in exactly one piece; only the last window
can stay short; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship, text_of


@dataclass(frozen=True)
class PackSpec:
    window: int = 2048
    tokenizer: str = public_tokenizers.path("byte_bpe_50k.json")
    end_id: int = 1
    cache_words: int = 200_000


# ---------------------------------------------------------------- tokens

def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}


class Encoder:
    """Ids of a byte-level BPE file, added tokens in a text included.  Texts are cut before single blanks
    between other characters, where no token crosses, and the pieces' ids are
    remembered: the same ids as encoding the text as a whole."""

    def __init__(self, spec: PackSpec):
        with open(spec.tokenizer, encoding="utf-8") as f:
            described = json.load(f)
        vocabulary = described["model"]["vocab"]
        added = {t["content"]: t["id"] for t in described.get("added_tokens", ())}
        if any(t.get(k) for t in described.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{spec.tokenizer}: added tokens that take in their surroundings are not supported")
        byte = byte_alphabet()
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token)}
        self.plain = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.code = "H" if max([*ranks.values(), *added.values()]) < 1 << 16 else "I"
        #: tokens that stand in a text as such, the longest first, and their ids
        self.added = {content: array(self.code, [i]).tobytes() for content, i in added.items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        self.limit = spec.cache_words
        self.end = array(self.code, [spec.end_id]).tobytes()
        encoder = self

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                ids = array(encoder.code, encoder.plain.encode_ordinary(" " + word)).tobytes()
                if len(word) <= 24 and len(self) < encoder.limit:
                    self[word] = ids
                return ids

        self.words = Words()

    def encode(self, text: str) -> bytes:
        """The document's ids with the end token, as machine integers."""
        if len(self.words) >= self.limit:
            self.words.clear()
        if any(t in text for t in self.added):
            parts = self.parts.split(text)
            return b"".join([*(self.added[x] if k % 2 else self.between(x) for k, x in enumerate(parts)), self.end])
        return self.between(text) + self.end

    def between(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if "  " in text:  # blanks in a row belong to one piece
            return array(self.code, self.plain.encode_ordinary(text)).tobytes()
        first, *rest = text.split(" ")
        head = array(self.code, self.plain.encode_ordinary(first)).tobytes()
        return b"".join([head, *map(self.words.__getitem__, rest)])

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, np.uint16 if self.code == "H" else np.uint32)


_encoders: dict[PackSpec, Encoder] = {}


def encoder(spec: PackSpec) -> Encoder:
    """One per worker process."""
    if spec not in _encoders:
        _encoders[spec] = Encoder(spec)
    return _encoders[spec]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


# ---------------------------------------------------------------- plan

def closest_fill(room: int, available: list[tuple[int, int]]) -> dict[int, int]:
    """Counts by length of the sub-multiset with the largest sum <= room.
    ``available``: (length, count), longest first."""
    full = (1 << room + 1) - 1
    reach, steps = 1, []
    for length, count in available:
        left, part = min(count, room // length), 1
        while left > 0:
            take = min(part, left)
            nxt = reach | (reach << length * take) & full
            if nxt != reach:
                steps.append((reach, length, take))
                reach = nxt
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> at & 1:  # only reached with this part
            out[length] = out.get(length, 0) + take
            at -= length * take
    return out


@dataclass
class Plan:
    """Rows (length, first rank, end rank, start in the remainder, piece
    length, first window, per window, index of the first, offset): item r of
    the run is number n = index + r - first rank of its kind; it lies in window
    first + n // per at offset + n % per * piece length."""

    rows: np.ndarray
    windows: int


def plan_windows(histogram: dict[int, int], window: int) -> Plan:
    """Minimum-bin-slack windows for ``histogram`` (length -> remainders)."""
    # per length: runs (original length, first rank, count, start) still to place
    runs = {length: [(length, 0, n, 0)] for length, n in histogram.items() if n}
    count = {length: n for length, n in histogram.items() if n}
    rows: list[tuple] = []
    at = 0

    def take(length: int, n: int) -> list[tuple[int, int, int, int]]:
        got, queue = [], runs[length]
        count[length] -= n
        while n:
            o, r, c, s = queue[0]
            used = min(c, n)
            got.append((o, r, used, s))
            queue[0:1] = [(o, r + used, c - used, s)] if used < c else []
            n -= used
        if not count[length]:
            del count[length], runs[length]
        return got

    while count:
        anchor = max(count)
        left = {**count, anchor: count[anchor] - 1}
        pattern = closest_fill(window - anchor, [(k, n) for k, n in sorted(left.items(), reverse=True) if n and k <= window - anchor])
        pattern[anchor] = pattern.get(anchor, 0) + 1
        gap = window - sum(k * n for k, n in pattern.items())
        times = min(count[k] // n for k, n in pattern.items())
        cut = None
        if gap:
            longer = [k for k, n in count.items() if k > gap and n > pattern.get(k, 0)]
            if longer:
                cut = max(longer)
                times = min(times, count[cut] // (pattern.get(cut, 0) + 1))
            else:
                times = 1 if times * sum(pattern.values()) >= sum(count.values()) else times
        offset = 0
        for k, n in sorted(pattern.items(), reverse=True):
            index = 0
            for o, r, c, s in take(k, n * times):
                rows.append((o, r, r + c, s, k, at, n, index, offset))
                index += c
            offset += k * n
        if cut is not None:
            index, rest = 0, []
            for o, r, c, s in take(cut, times):
                rows.append((o, r, r + c, s, gap, at, 1, index, offset))
                index += c
                rest.append((o, r, c, s + gap))
            runs.setdefault(cut - gap, []).extend(rest)
            count[cut - gap] = count.get(cut - gap, 0) + times
        at += times
    return Plan(np.array(rows, np.int64).reshape(-1, 9), at)


class Placer:
    """Looks up the pieces of a remainder by its length and rank."""

    def __init__(self, plan: Plan):
        self.rows = plan.rows[np.lexsort((plan.rows[:, 3], plan.rows[:, 1], plan.rows[:, 0]))] if len(plan.rows) else plan.rows
        self.edges: dict[int, np.ndarray] = {}
        self.inside: dict[int, list[np.ndarray]] = {}
        for length in np.unique(self.rows[:, 0]) if len(self.rows) else []:
            own = np.flatnonzero(self.rows[:, 0] == length)
            edges = np.unique(self.rows[own][:, 1:3])
            members: list[list[int]] = [[] for _ in edges]
            for i in own:
                for j in range(*np.searchsorted(edges, self.rows[i, 1:3])):
                    members[j].append(i)
            self.edges[int(length)] = edges
            self.inside[int(length)] = [np.array(sorted(m, key=lambda i: self.rows[i, 3]), np.int64) for m in members]

    def pieces(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the remainder, piece length, window, offset)."""
        j = int(np.searchsorted(self.edges[length], rank, "right")) - 1
        for i in self.inside[length][j]:
            _, first, _, start, size, window, per, index, offset = self.rows[i].tolist()
            n = index + rank - first
            yield start, size, window + n // per, offset + n % per * size


# ---------------------------------------------------------------- Spark

def tokenise(docs: DataFrame, spec: PackSpec = PackSpec()) -> DataFrame:
    """doc_id, tokens, part, rank (of the remainder's length, within the input
    partition), first_full (full windows before, within the partition),
    full_crcs, tail (the remainder's ids)."""
    w = spec.window
    schema = pa.schema([("doc_id", pa.int64()), ("tokens", pa.int64()), ("part", pa.int32()), ("tail_length", pa.int32()), ("rank", pa.int64()), ("first_full", pa.int64()), ("full_crcs", pa.list_(pa.int64())), ("tail", pa.binary())])

    ship()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = encoder(spec), TaskContext.get().partitionId()
        seen, full = [0] * w, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                out: list[tuple] = []
                for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text")):
                    ids = code.ids(code.encode(text.as_py()))
                    n, cut = len(ids), len(ids) // w * w
                    tail = n - cut
                    out.append((doc, n, part, tail, seen[tail] if tail else None, full, [crc(ids[i:i + w]) for i in range(0, cut, w)], ids[cut:].tobytes()))
                    full += cut // w
                    if tail:
                        seen[tail] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
        code.words.clear()  # workers live on and serve other stages

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, tokens long, part int, tail_length int, rank long, first_full long, full_crcs array<bigint>, tail binary")


def pack(docs: DataFrame, spec: PackSpec = PackSpec(), keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset; with ``keep_ids`` also a remainder piece's ids (binary,
    little-endian; null for full windows)."""
    w = spec.window
    rows = materialize(tokenise(docs, spec), "pack-tokens")
    counts = rows.filter("tail_length > 0").groupBy("part", "tail_length").agg(F.count("*").alias("n"))
    counts = materialize(counts, "pack-counts")
    plan = plan_windows({r["tail_length"]: r["n"] for r in counts.groupBy("tail_length").agg(F.sum("n").alias("n")).collect()}, w)  # under ``window`` rows
    before = Window.partitionBy("tail_length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("part", "tail_length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank_base"))
    # full windows take the sequences after the planned ones
    fulls = rows.groupBy("part").agg(F.sum(F.size("full_crcs")).alias("n")).withColumn("one", F.lit(0))
    ahead = Window.partitionBy("one").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    fulls = fulls.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("full_base"))
    based = rows.join(ranks, ["part", "tail_length"], "left").join(fulls, "part")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), *([("ids", pa.binary())] if keep_ids else [])])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, placer = encoder(spec), Placer(plan)
        names = ("doc_id", "tokens", "tail_length", "rank", "rank_base", "first_full", "full_base", "full_crcs", "tail")
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                out: list[tuple] = []
                piece = batch.slice(at, 2048)
                for doc, n, tail, rank, rank_base, full, full_base, crcs, packed in zip(*(piece.column(c).to_pylist() for c in names)):
                    for i, c in enumerate(crcs):
                        out.append((doc, i * w, w, c, n, plan.windows + full_base + full + i, 0, None))
                    ids = code.ids(packed)
                    for start, size, window, offset in placer.pieces(tail, rank_base + rank) if tail else ():
                        own = ids[start:start + size]
                        out.append((doc, n - tail + start, size, crc(own), n, window, offset, own.astype("<u4").tobytes() if keep_ids else None))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids binary" if keep_ids else "")
    return based.mapInArrow(place, kind)
