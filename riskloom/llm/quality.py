"""Quality rules: compression bands, with repetition counts beside them.

A text is compressed with zstandard as a whole and in fixed chunks that
cover all of it (the last one ends at the text's end and may overlap the one
before; a text shorter than a chunk has none); the ratio (bytes / compressed bytes) must lie in a band that depends on the
length, because short texts compress less. Above the band a text repeats
itself, below it looks random. A text also fails if too large a share of
its chunks lies outside the chunk band (a repetitive or random part inside
an otherwise plain text).

The counts: words are runs of non-blank characters; ``word_chars`` code
points in words; ``n_symbols`` characters of ``#*$%&|<>``;
``n_dup_lines`` lines with a word that equal an earlier line;
``n_repeat_words`` words inside 5-word windows that occur at least twice.

One narrow pass, no shuffle; a task holds one slice of texts. Defined
results: a null or empty text has no words, ratio 0 and fails the base
rule (fewer than ``min_words`` words); a row each for repeated rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.llm import text as X
from riskloom.llm.frames import fresh

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANKS = " \t\n\v\f\r"


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio by length: rows (least bytes, lowest ratio, highest ratio)."""

    limits: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 1e9), (128, 0.85, 3.0), (512, 1.1, 3.0), (2048, 1.25, 3.5), (16384, 1.3, 4.2), (65536, 1.3, 5.0))
    chunk_bytes: int = 2048
    chunk_low: float = 1.2
    chunk_high: float = 4.5
    bad_share: float = 0.25
    level: int = 3

    def of(self, size: int) -> tuple[float, float]:
        return [x[1:] for x in self.limits if x[0] <= size][-1]


DETAIL = T.StructType([T.StructField(n, t, False) for n, t in (
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()),
    ("kept", T.BooleanType()), ("ratio", T.DoubleType()), ("n_chunks", T.LongType()),
    ("n_bad_chunks", T.LongType()), ("reason", T.StringType()))])
_ARROW = pa.struct([pa.field(n, t, False) for n, t in (
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()),
    ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64()), ("reason", pa.string()))])


def dup_lines(raw: bytes) -> int:
    lines = Counter(raw.split(b"\n"))
    return sum(n - 1 for line, n in lines.items() if n > 1 and line.strip(_BLANKS.encode()))


def counts(data: np.ndarray, bounds: np.ndarray, window: int = 5) -> dict[str, np.ndarray]:
    """The word and symbol counts of each text between consecutive bounds."""
    hashes, starts, _ = X.hash_words(data, bounds[:-1], X.NONBLANK)
    first = np.searchsorted(starts, bounds)
    chars = X.per_text(X.NONBLANK[data] & ((data & 0xC0) != 0x80), bounds)
    at = X.windows(hashes, window)
    owner = np.searchsorted(first, np.arange(len(at)), side="right") - 1
    whole = np.flatnonzero(np.arange(len(at)) + window <= first[owner + 1])
    key = X.mix(at[whole] + owner[whole].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    repeats = X.covered(whole[twice], window, len(hashes))
    return {"n_words": np.diff(first), "word_chars": chars, "n_symbols": X.per_text(_SYMBOL[data], bounds),
            "n_repeat_words": X.per_text(repeats, first)}


def verdict(raw: bytes, bands: Bands, zip_: zstandard.ZstdCompressor) -> tuple[float, int, int, str]:
    """(ratio, chunks, chunks outside their band, reason; empty: passes)."""
    if not raw:
        return 0.0, 0, 0, ""
    ratio = len(raw) / len(zip_.compress(raw))
    low, high = bands.of(len(raw))
    size, n, bad = bands.chunk_bytes, 0, 0
    starts = [*range(0, len(raw) - size + 1, size)]
    if starts and len(raw) % size:
        starts.append(len(raw) - size)
    for lo in starts:
        r = size / len(zip_.compress(raw[lo:lo + size]))
        n += 1
        bad += not bands.chunk_low <= r <= bands.chunk_high
    reason = "incompressible" if ratio < low else "repetitive" if ratio > high else \
        "chunks" if n and bad > bands.bad_share * n else ""
    return ratio, n, bad, reason


def assess(docs: DataFrame, text_col: str = "text", out_col: str = "quality_rules", bands: Bands = Bands(),
           min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """docs plus a struct with the counts, the ratios, the reason and the verdict."""
    out = fresh(docs, out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            column = [x.lower() for x in batch.schema.names].index(text_col.lower())
            offsets, data = X.column_bytes(batch.column(column))
            for lo, hi in X.slices(offsets):
                bounds = offsets[lo:hi + 1] - offsets[lo]
                part = data[offsets[lo]:offsets[hi]]
                n, rows = counts(part, bounds), []
                for k in range(hi - lo):
                    raw = part[bounds[k]:bounds[k + 1]].tobytes()
                    ratio, chunks, bad, reason = verdict(raw, bands, zip_)
                    row = {x: int(v[k]) for x, v in n.items()}
                    failed = row["n_words"] < min_words or 100 * row["n_repeat_words"] > max_repeat_percent * row["n_words"]
                    rows.append(row | {"n_dup_lines": dup_lines(raw), "base_failed": failed, "ratio": ratio,
                                       "kept": not failed and not reason, "n_chunks": chunks,
                                       "n_bad_chunks": bad, "reason": reason})
                piece = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(rows, type=_ARROW)],
                                                 names=[*piece.schema.names, out])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, DETAIL, False)]))


def keep(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with the columns of docs."""
    found = assess(docs, **options)
    return found.where(found[f"`{found.columns[-1]}`.kept"]).select([f"`{c}`" for c in docs.columns])
