"""SentencePiece encoding and decoding for merge-type vocabularies.

A text becomes characters; an agenda holds the adjacent pairs whose
concatenation is a piece, best score first and leftmost first among equals.
The best pair is merged, its neighbours enter the agenda with the new symbol,
and pairs whose symbols have changed meanwhile are skipped.  Symbols that are no
piece become byte pieces.  No piece continues behind a word beginning and some
characters occur in no longer piece, so texts are cut there, without changing
any merge, and the ids of short words are remembered within bounds.  Each
different word of a run is looked up once.  Words that are not remembered are
merged together: the agenda of each is a row of a matrix of ranks by score
(numpy), words of over 40 symbols keep theirs in a heap.

Every Arrow batch is checked against the sentencepiece library, ids and decoded
texts; a difference fails the task.

Supported are models as described by ``Pieces.__init__``: merge type, identity
normaliser, a blank put in front, blanks kept, byte pieces; others raise.

Defined results: a null or empty text is the end id alone and decodes to an
empty text; a text's own word-beginning mark decodes as a blank, as the library
does; repeated rows are repeated; very long texts are encoded whole, words
without blanks included; an empty table gives an empty result; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from .common import ship, text_of
from .texts import byte_slices, spans

#: the mark that models of this library put where a word begins (fixed value)
MARK = "▁"
#: symbols up to which the agenda is a list in text order, and the cost there of a pair that is no piece
LIST_AGENDA = 40
NEVER = float("inf")
#: words that are merged together, and words of a text looked up together
ROWS, SLICE = 4_096, 200_000
#: behind every rank: a pair that is no piece
NO_PAIR = np.int32(2**31 - 1)


@dataclass(frozen=True)
class PieceSpec:
    model: str = public_tokenizers.path("piece_bpe_32k.model")
    #: words of at most ``word_chars`` characters whose ids a worker remembers (some 200 bytes each)
    cache_words: int = 600_000
    word_chars: int = 24
    #: bytes of texts that are encoded and checked together
    run_bytes: int = 1 << 20


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, spec: PieceSpec):
        with open(spec.model, "rb") as f:
            raw = f.read()
        model = model_pb2.ModelProto.FromString(raw)
        norm, train, kind = model.normalizer_spec, model.trainer_spec, model_pb2.ModelProto.SentencePiece
        unusual = {kind.USER_DEFINED, kind.UNUSED} & {p.type for p in model.pieces}
        if (train.model_type != model_pb2.TrainerSpec.BPE or not train.byte_fallback or unusual or norm.precompiled_charsmap or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or train.treat_whitespace_as_suffix or model.denormalizer_spec.precompiled_charsmap):
            raise ValueError(f"{spec.model}: not a merge-type model with identity normaliser, leading blank and byte pieces")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.end = self.library.eos_id()
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        #: cost of a piece: the agenda takes the smallest first
        self.cost = {p.piece: -p.score for p in model.pieces if p.type == kind.NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.is_byte = {i: b for b, i in self.byte.items()}
        self.shown = [p.piece if p.type == kind.NORMAL else "" for p in model.pieces]
        self.unknown = self.library.unk_id()
        self.unknown_text = train.unk_surface
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError(f"{spec.model}: a piece continues behind a word beginning")
        alone = [b for b in range(32) if not any(chr(b) in p for p in self.id if len(p) > 1)]
        #: bytes that are a word by themselves
        self.alone = np.isin(np.arange(256), alone)
        self.spec = spec
        self._pairs()
        #: ids by word: of the words met lately, and of those met before them
        self.lately: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.silent = [i for i, p in enumerate(model.pieces) if p.type == kind.CONTROL]
        #: what each id contributes to a decoded text, one behind the other
        shares = [bytes([self.is_byte[i]]) if i in self.is_byte else self.unknown_text.encode() if i == self.unknown else t.replace(MARK, " ").encode() for i, t in enumerate(self.shown)]
        self.share_size = np.array([len(b) for b in shares], np.int64)
        self.share_at = np.concatenate([[0], np.cumsum(self.share_size)[:-1]])
        self.shares = np.frombuffer(b"".join(shares), np.uint8)

    def merge(self, word: str) -> list[int]:
        """Ids of a stretch of text that no merge leaves."""
        cost, symbols = self.cost, list(word)
        if len(symbols) <= LIST_AGENDA:
            agenda = [cost.get(p, NEVER) for p in map(add, symbols, symbols[1:])]
            while agenda and (best := min(agenda)) < NEVER:
                i = agenda.index(best)  # the leftmost
                symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
                del agenda[i]
                if i < len(agenda):
                    agenda[i] = cost.get(symbols[i] + symbols[i + 1], NEVER)
                if i:
                    agenda[i - 1] = cost.get(symbols[i - 1] + symbols[i], NEVER)
        else:
            symbols = self.merge_long(symbols)
        out, known = [], self.id
        for s in symbols:
            if s in known:
                out.append(known[s])
            else:
                out.extend(map(self.byte.__getitem__, s.encode()))
        return out

    def merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap for the agenda and links between symbols."""
        cost = self.cost
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(cost[p], i, p) for i, p in enumerate(map(add, symbols, symbols[1:])) if p in cost]
        heapify(agenda)
        while agenda:
            _, i, pair = heappop(agenda)
            j = after[i]
            # stale: the symbols here have been merged otherwise since
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                wider = pair + symbols[k]
                if wider in cost:
                    heappush(agenda, (cost[wider], i, wider))
            h = before[i]
            if h >= 0:
                wider = symbols[h] + pair
                if wider in cost:
                    heappush(agenda, (cost[wider], h, wider))
        return [s for s in symbols if s]

    def _pairs(self) -> None:
        """Numbers for symbols (characters and pieces; 0: a character of no
        piece), ranks of pieces by cost (equal costs, equal ranks), and the
        table of pairs: sorted keys, rank and merged symbol of each."""
        symbols = sorted({s for p in self.cost for s in (p, *p)})
        number = {s: k for k, s in enumerate(symbols, 1)}
        self.n_symbols = len(symbols) + 1
        self.of_char = np.zeros(0x110000, np.int32)
        for s, k in number.items():
            if len(s) == 1:
                self.of_char[ord(s)] = k
        self.id_of = np.array([-1, *(self.id.get(s, -1) for s in symbols)], np.int32)
        merged = [p for p in self.cost if len(p) > 1]
        rank = {c: k for k, c in enumerate(sorted({self.cost[p] for p in merged}))}
        #: the only symbol of a rank; 0 where several have it
        self.of_rank = np.full(len(rank), -1, np.int32)
        for p in merged:
            k = rank[self.cost[p]]
            self.of_rank[k] = number[p] if self.of_rank[k] < 0 else 0
        found = {}
        for p in merged:
            for i in range(1, len(p)):
                left, right = number.get(p[:i]), number.get(p[i:])
                if left and right:
                    found[left * self.n_symbols + right] = (rank[self.cost[p]], number[p])
        keys = sorted(found)
        self.pair_key = np.array([*keys, np.iinfo(np.int64).max], np.int64)
        self.pair_rank = np.array([*(found[k][0] for k in keys), NO_PAIR], np.int32)
        self.pair_to = np.array([*(found[k][1] for k in keys), 0], np.int32)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair stands in the table (the last place: nowhere)."""
        key = left.astype(np.int64) * self.n_symbols + right
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, at, len(self.pair_key) - 1)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pair_rank[self._find(left, right)]

    def merge_many(self, words: list[str]) -> list[bytes]:
        """Ids of many words: a word's agenda is a row of a matrix, and each
        round merges the best (leftmost among equals) pair of every row."""
        out: list[bytes | None] = [None] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        low = 0
        for width in (6, 8, 11, 16, LIST_AGENDA):
            which = np.flatnonzero((size > low) & (size <= width))
            low = width
            for k in range(0, len(which), ROWS):
                rows = which[k:k + ROWS]
                self._merge_rows([words[i] for i in rows], size[rows], width, rows, out)
        return [ids if ids is not None else array("i", self.merge(w)).tobytes() for w, ids in zip(words, out)]

    def _merge_rows(self, words: list[str], size: np.ndarray, width: int, rows: np.ndarray, out: list) -> None:
        """Fill ``out[rows]``; words with a character of no piece, or with a
        symbol left that has no id, are left to :meth:`merge`."""
        inside = np.arange(width) < size[:, None]
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols = np.zeros((len(words), width + 1), np.int32)  # one more than a word has: no pair with it
        symbols[:, :width][inside] = self.of_char[chars]
        unknown = ((symbols[:, :width] == 0) & inside).any(1)
        agenda = np.full((len(words), width), NO_PAIR, np.int32)
        pairs = inside[:, 1:]
        agenda[:, :-1][pairs] = self._rank(symbols[:, :width - 1][pairs], symbols[:, 1:width][pairs])
        final = np.zeros_like(symbols)
        alive = np.arange(len(words))
        while len(alive):
            at = agenda.argmin(1)
            best = agenda[np.arange(len(alive)), at]
            more = best < NO_PAIR
            if not more.all():
                final[alive[~more], :symbols.shape[1]] = symbols[~more]
                alive, symbols, agenda, at, best = alive[more], symbols[more], agenda[more], at[more], best[more]
                if not len(alive):
                    break
            row = np.arange(len(alive))
            to = self.of_rank[best]
            several = np.flatnonzero(to == 0)
            to[several] = self.pair_to[self._find(symbols[several, at[several]], symbols[several, at[several] + 1])]
            # without the pair's second symbol every row is one shorter
            symbols[row, at] = to
            stay = np.ones(symbols.shape, bool)
            stay[row, at + 1] = False
            symbols = symbols[stay].reshape(len(row), -1)
            stay = np.ones(agenda.shape, bool)
            stay[row, at] = False
            agenda = agenda[stay].reshape(len(row), -1)
            agenda[row, at] = self._rank(to, symbols[row, at + 1])
            left = np.flatnonzero(at)
            before = at[left] - 1
            agenda[left, before] = self._rank(symbols[left, before], to[left])
        ids = self.id_of[final]
        there = final > 0
        plain = ~unknown & ~((ids < 0) & there).any(1)
        ends = np.concatenate([[0], np.cumsum(there.sum(1))]) * 4
        flat = ids[there].tobytes()
        for i, ok, a, b in zip(rows.tolist(), plain.tolist(), ends.tolist(), ends[1:].tolist()):
            if ok:
                out[i] = flat[a:b]

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of each word (blanks count as word-beginning marks), remembered
        ones first; the others in one go."""
        if len(self.lately) >= self.spec.cache_words // 2:
            self.lately, self.before = {}, self.lately
        out = list(map(self.lately.get, words))
        new = [i for i, ids in enumerate(out) if ids is None]
        met = [words[i] for i in new]
        found = list(map(self.before.get, met))
        made = iter(self.merge_many([w.replace(" ", MARK) for w, ids in zip(met, found) if ids is None]))
        found = [next(made) if ids is None else ids for ids in found]
        for i, ids in zip(new, found):
            out[i] = ids
        self.lately.update((w, ids) for w, ids in zip(met, found) if len(w) <= self.spec.word_chars)
        return out

    def cut(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where words begin in the UTF-8 bytes of texts (blanks for marks) that
        begin at ``begins``: there, at the first of blanks in a row, and at and
        behind characters that stand alone."""
        blank, alone = data == 32, self.alone[data]
        first = alone.copy()
        first[1:] |= alone[:-1] | (blank[1:] & ~blank[:-1])
        first[begins] = True
        return np.flatnonzero(first)

    def encode_texts(self, texts: list[str]) -> list[array]:
        """Ids of each text and the end id."""
        raw = [b" " + t.replace(MARK, " ").encode() if t else b"" for t in texts]
        ends = np.cumsum([0, *map(len, raw)])
        data = b"".join(raw)
        at = self.cut(np.frombuffer(data, np.uint8), ends[:-1][np.diff(ends) > 0])
        words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)])
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for k in range(0, len(at), SLICE):
            # each different word is looked up once
            coded = words.slice(k, SLICE).dictionary_encode()
            found = self.ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            which = coded.indices.to_numpy()
            size = np.fromiter(map(len, found), np.int64, len(found)) // 4
            ids.append(gather(np.frombuffer(b"".join(found), np.int32), np.cumsum(size) - size, size, which))
            sizes.append(size[which])
        flat = np.concatenate(ids)
        # ids before each text: those of the words that begin before it
        upto = np.cumsum(np.concatenate(sizes))[np.searchsorted(at, ends)].tolist()
        out = []
        for i, j in zip(upto, upto[1:]):
            own = array("i")
            own.frombytes(flat[i:j].tobytes())
            own.append(self.end)
            out.append(own)
        return out

    def encode(self, text: str) -> array:
        return self.encode_texts([text])[0]

    def decode(self, ids: array) -> str:
        """The text of ``ids``: pieces in a row, runs of byte pieces as UTF-8
        (each byte of no character as U+FFFD), without the leading blank."""
        body = np.frombuffer(ids, np.int32)
        body = body[:-1] if len(body) and body[-1] == self.end else body
        if len(body) == 0:
            return ""
        if len(body) < 4 or any((body == i).any() for i in self.silent):  # control pieces part runs of bytes
            return self.decode_runs(ids)
        share = gather(self.shares, self.share_at, self.share_size, body)
        try:
            text = share.tobytes().decode()
        except UnicodeDecodeError:
            return self.decode_runs(ids)
        return text[1:] if self.shown[body[0]].startswith(MARK) else text

    def decode_runs(self, ids: array) -> str:
        out, pending, first = [], bytearray(), True
        for i in ids:
            if i in self.is_byte:
                pending.append(self.is_byte[i])
                continue
            if pending:
                out.append(utf8(bytes(pending)))
                pending.clear()
                first = False
            piece = self.unknown_text if i == self.unknown else self.shown[i]
            if first and piece:
                piece, first = piece.removeprefix(MARK), False
            out.append(piece)
        if pending:
            out.append(utf8(bytes(pending)))
        return "".join(out).replace(MARK, " ")


def gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches ``flat[at:at + size]`` numbered ``which``, one behind the other."""
    size = size[which]
    ends = np.cumsum(size)
    return flat[np.repeat(at[which] - ends + size, size) + np.arange(ends[-1])]


def utf8(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError as e:
        return data[:e.start].decode() + "�" + utf8(data[e.start + 1:])


_pieces: dict[PieceSpec, Pieces] = {}


def pieces(spec: PieceSpec) -> Pieces:
    """One per worker process."""
    if spec not in _pieces:
        _pieces[spec] = Pieces(spec)
    return _pieces[spec]


def check(texts: list[str], ids: list[array], decoded: list[str], own: Pieces) -> None:
    """Hold a batch against the library."""
    theirs = own.library.encode(texts, add_eos=True, num_threads=1)
    for text, a, b, back, plain in zip(texts, ids, theirs, decoded, own.library.decode(theirs)):
        if a != array("i", b) or back != plain:
            raise ValueError(f"ids or decoded text differ from the library's for {text[:80]!r}")


def encode(docs: DataFrame, spec: PieceSpec = PieceSpec()) -> DataFrame:
    """One row per document: doc_id, ids (with the end id), decoded."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    ship()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(spec)
        for batch in batches:
            data, offsets = byte_slices(batch.column("text"))
            for i, j in spans(offsets, spec.run_bytes):
                raw = data[offsets[i]:offsets[j]].tobytes()
                where = (offsets[i:j + 1] - offsets[i]).tolist()
                texts = [raw[a:b].decode() for a, b in zip(where, where[1:])]
                ids = own.encode_texts(texts)
                decoded = [own.decode(x) for x in ids]
                check(texts, ids, decoded, own)
                ends = array("i", [0])
                for x in ids:
                    ends.append(ends[-1] + len(x))
                flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(x.tobytes() for x in ids))])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array(decoded, pa.string())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
