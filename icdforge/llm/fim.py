"""Fill-in-middle transformation with cuts found in a wavelet matrix.

Texts stay UTF-8 bytes.  Every byte has a class: the continuation of a
character, or the start of one (a line feed, a blank, an ASCII letter or digit,
another ASCII character, a longer character, or any of the last three where a
word begins).  The wavelet matrix over the classes of a run of texts answers how
many bytes of a class lie before a position; the classes that begin a unit add
up to the number of units before it, and bisection on these ranks finds the
byte at which the k-th unit begins.  No text is decoded or walked through.

A document's two cuts and its form come from a digest of its doc_id alone, so
repeated tasks and other partitionings give the same rows.

Defined results: a null text is empty and stays plain; a null doc_id is hashed
as an empty number; repeated rows are repeated; equal cuts leave an empty
middle; a very long text is cut whole, with a matrix of its own; an empty table
gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, text_of
from .texts import byte_slices, spans
from .wavelet import WaveletMatrix

CONTINUED, LINE_FEED, BLANK, ALNUM, OTHER, LONGER, WORD_START = range(7)
#: classes whose bytes begin a unit
UNITS = {
    "character": (LINE_FEED, BLANK, ALNUM, OTHER, LONGER, WORD_START),
    "word": (WORD_START,),
}


def _class_table() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[0x80:0xC0] = CONTINUED
    table[0xC0:] = LONGER
    table[[b for b in range(128) if chr(b).isalnum()]] = ALNUM
    table[[ord(c) for c in " \t\x0b\x0c\r"]] = BLANK
    table[ord("\n")] = LINE_FEED
    return table


CLASS_OF_BYTE = _class_table()


@dataclass(frozen=True)
class FimSpec:
    unit: str = "character"
    seed: str = "1"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    #: documents of a hundred that are transformed, and of those the ones suffix first
    fim_percent: int = 90
    spm_percent: int = 20
    #: bytes of texts that share a matrix
    run_bytes: int = 4 << 20


def classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every byte; ``starts`` are the positions where texts begin."""
    out = CLASS_OF_BYTE[data]
    if len(out):
        apart = (out == BLANK) | (out == LINE_FEED)
        after = np.concatenate([[True], apart[:-1]])
        after[starts[starts < len(out)]] = True
        out[after & ~apart & (out != CONTINUED)] = WORD_START
    return out


def cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray, spec: FimSpec) -> tuple[np.ndarray, ...]:
    """Per text: units, bytes at which the middle and the suffix begin, and
    the characters before each; ``offsets`` begin at 0."""
    matrix = WaveletMatrix(classes(data, offsets[:-1]), 3)
    units, characters = UNITS[spec.unit], UNITS["character"]
    low, high = offsets[:-1], offsets[1:]
    n = matrix.count(units, high) - matrix.count(units, low)
    one, two = h1 % (n + 1), h2 % (n + 1)
    at, seen = [], []
    for k in (np.minimum(one, two), np.maximum(one, two)):
        # unit k begins at the byte before which k units lie and which begins the next
        first = matrix.select(units, k + 1, low, high) - 1
        byte = np.where(k == 0, low, np.where(k == n, high, first))
        at.append(byte)
        seen.append(matrix.count(characters, byte) - matrix.count(characters, low))
    return n, at[0], at[1], seen[0], seen[1]


def transform(docs: DataFrame, spec: FimSpec = FimSpec()) -> DataFrame:
    """One row per document: doc_id, n (units), form (plain, psm, spm),
    prefix_chars, middle_chars (null if plain), output."""
    number = F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(number.cast("binary"), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    text = text_of("text")
    marked = [F.contains(F.col("text"), F.lit(s)) for s in (spec.prefix, spec.suffix, spec.middle)]
    plain = (F.col("text") == "") | marked[0] | marked[1] | marked[2] | (h[2] % 100 >= spec.fim_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spec.spm_percent, "spm").otherwise("psm")
    rows = docs.select("doc_id", text.alias("text")).select(F.col("doc_id").cast("long").alias("doc_id"), "text", h[0].alias("h1"), h[1].alias("h2"), form.alias("form"))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
    marks = [s.encode() for s in (spec.prefix, spec.suffix, spec.middle)]

    ship()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_slices(batch.column("text"))
            h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
            forms = batch.column("form").to_pylist()
            for i, j in spans(offsets, spec.run_bytes):
                own = data[offsets[i]:offsets[j]]
                where = offsets[i:j + 1] - offsets[i]
                n, a, b, before, upto = cuts(own, where, h1[i:j], h2[i:j], spec)
                raw, outputs = own.tobytes(), []
                for k, form in enumerate(forms[i:j]):
                    parts = raw[where[k]:a[k]], raw[a[k]:b[k]], raw[b[k]:where[k + 1]]
                    if form == "plain":
                        outputs.append(b"".join(parts))
                    elif form == "psm":
                        outputs.append(b"".join((marks[0], parts[0], marks[1], parts[2], marks[2], parts[1])))
                    else:
                        outputs.append(b"".join((marks[1], parts[2], marks[0], parts[0], marks[2], parts[1])))
                whole = np.array([f == "plain" for f in forms[i:j]], bool)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), pa.array(n, pa.int64()), pa.array(forms[i:j], pa.string()),
                    pa.array(before, pa.int64(), mask=whole), pa.array(upto - before, pa.int64(), mask=whole),
                    pa.array(outputs, pa.binary()).cast(pa.string()),
                ], schema=schema)

    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column, spec: FimSpec = FimSpec()) -> Column:
    """The text that ``output`` was made from.  A transformed text holds none
    of the three marks, so they part the output in one way only."""
    part = F.split(output, "|".join(re.escape(s) for s in (spec.prefix, spec.suffix, spec.middle)), -1)
    psm = F.concat(part[1], part[3], part[2])
    spm = F.concat(part[2], part[3], part[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
