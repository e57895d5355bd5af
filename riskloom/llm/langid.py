"""Language identification by bit-sliced Bloom filters over character n-grams.

Every learned language has a Bloom filter of its n-grams. The filters are
stored across: row p of one table is a bit mask with the bit of each
language whose filter has position p set, so the AND of an n-gram's rows is
the set of all languages that contain it, in one lookup for any number of
languages. A document's bits are counted for each language. A filter also
answers yes for a share f of n-grams it doesn't contain (the filled share of
its bits to the power of the number of rows read), so of n n-grams with c
yes, (c - n * f) / (1 - f) are expected to be contained; the language with
the largest such number is predicted. The score is that number over the sum
of it and the second language's: 0.5 is a draw, 1 no evidence for another,
0 no evidence at all.

n-grams: runs of 3, 4 and 5 characters of the lower-cased text, other
characters than letters and marks as one blank between words, a blank only
at either end. They are compared by 64-bit hash.

Learning: from at most ``rows_per_language`` rows of each language (the
smallest hashes of their ids), the only sample here. An n-gram belongs to a
language if at least ``LEAST_TEXTS`` and ``least_share`` of its texts have
it and the share is not under ``least_ratio`` of the largest share in any
language (so quotations in another language don't enter). At most
``max_grams`` n-grams a language, those of the most texts, so the filters
have a fixed size bound: 16 bits a gram times languages. Counting is one
aggregation; only the chosen hashes reach the driver.

Defined cases: a null text, or one without a letter, is ``und`` with score
0; without any learned language every document is. A text with letters of
which nothing is known gets the language of the most training texts, score
0; so does a draw. Rows without a language or an id are not learned from,
repeated rows count as often as they occur; every row gets a result of its
own. An empty table gives an empty result. Texts of any length are handled
in pieces of ``PIECE`` characters. Other columns are carried along as they
are; the result column takes another name where its own is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.frames import fresh, written
from riskloom.llm.text import column_bytes, mix, slices

SIZES = (3, 4, 5)
LEAST_TEXTS = 2
BITS_PER_GRAM = 16
ROWS_READ = 3
PIECE = 1 << 19
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK, _BREAK = 32, 10
_LETTER = r"\p{L}"


def fold(id_column: str) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % FOLDS


def _words(text: Column) -> Column:
    """The lower-cased words between blanks; null where there is no letter."""
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))
    return F.when(text.rlike(_LETTER), words)


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, n-gram hash), piece by piece, of texts as ``_words`` makes them."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype=np.uint32)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    longest = max(SIZES)
    for lo in range(0, len(codes), PIECE):
        part = codes[lo:lo + PIECE + longest - 1].astype(np.uint64)
        doc = np.searchsorted(starts, np.arange(lo, min(len(codes), lo + PIECE)), side="right") - 1
        gaps = np.concatenate([[0], np.cumsum(part <= _BLANK)])
        acc, done = np.zeros(len(part), np.uint64), 0
        for n in SIZES:
            m = min(PIECE, len(part) - n + 1)  # n-grams that begin in this piece
            if m <= 0:
                break
            acc = acc[:m]
            for j in range(done, n):
                acc = acc * _BASE + part[j:j + m]
            done = n
            ok = (gaps[n - 1:n - 1 + m] == gaps[1:1 + m]) & (part[:m] != _BREAK) & (part[n - 1:n - 1 + m] != _BREAK)
            yield doc[:m][ok], mix(acc[ok] + np.uint64(n))


class LanguageFilters:
    """Bloom filters of all languages in one table of bit masks."""

    def __init__(self, languages: list[str], grams: list[np.ndarray]):
        self.languages = languages
        most = max([len(g) for g in grams], default=0)
        self.size = 1 << max(10, (BITS_PER_GRAM * most - 1).bit_length())
        self.rows = np.zeros((-(-max(1, len(languages)) // 64), self.size), np.uint64)
        for number, hashes in enumerate(grams):
            bit = np.uint64(1 << (number % 64))
            for at in self._places(hashes):
                self.rows[number // 64, at] |= bit
        filled = np.array([np.count_nonzero(self._bit(self.rows[i // 64], i)) for i in range(len(languages))])
        self.false_share = (filled / self.size) ** ROWS_READ

    @staticmethod
    def _bit(masks: np.ndarray, number: int) -> np.ndarray:
        return (masks >> np.uint64(number % 64)) & np.uint64(1)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for j in range(ROWS_READ):
            yield ((hashes + np.uint64(j) * step) & np.uint64(self.size - 1)).astype(np.int64)

    def masks(self, hashes: np.ndarray) -> list[np.ndarray]:
        """The languages that contain each n-gram, a mask for every 64 languages."""
        out = None
        for at in self._places(hashes):
            found = [row[at] for row in self.rows]
            out = found if out is None else [a & b for a, b in zip(out, found)]
        return out

    def decide(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(language number, score) of each text."""
        # n-grams of each text by four bits of their masks: one count serves four languages.
        groups = -(-len(self.languages) // 4)
        counts = np.zeros((groups, len(texts), 16))
        for doc, hashes in _grams(texts):
            masks = self.masks(hashes)
            for g in range(groups):
                four = ((masks[g // 16] >> np.uint64(4 * (g % 16))) & np.uint64(15)).astype(np.int64)
                counts[g] += np.bincount(doc * 16 + four, minlength=16 * len(texts)).reshape(-1, 16)
        n = counts[0].sum(axis=1)
        bits = (np.arange(16)[:, None] >> np.arange(4)) & 1
        yes = np.concatenate([(c @ bits).T for c in counts])[:len(self.languages)]
        share = self.false_share[:, None]
        sure = np.clip((yes - n * share) / np.maximum(1 - share, 1e-9), 0, None)
        best = np.argmax(sure, axis=0)
        top = np.sort(sure, axis=0)[::-1]
        both = top[:2].sum(axis=0)
        return best, np.where(both > 0, top[0] / np.where(both > 0, both, 1), 0.0)


def _counted(sample: DataFrame) -> DataFrame:
    """(language, gram, n_texts) of the sample's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, _ = column_bytes(batch.column(0))
            for lo, hi in slices(off):
                texts = batch.column(0).slice(lo, hi - lo).to_pylist()
                number = batch.column(1).slice(lo, hi - lo).to_numpy()
                for language in np.unique(number):
                    rows = np.flatnonzero(number == language)
                    found = list(zip(*_grams([texts[r] for r in rows])))
                    doc, hashes = (np.concatenate(x) for x in found)
                    order = np.lexsort((doc, hashes))
                    doc, hashes = doc[order], hashes[order]
                    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])])
                    grams, n = np.unique(hashes[new], return_counts=True)  # an n-gram once a text
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(grams), language, np.int32)), pa.array(grams.view(np.int64)), pa.array(n)],
                        names=["language", "gram", "n_texts"])
    rows = sample.mapInArrow(run, "language int, gram bigint, n_texts bigint")
    return rows.groupBy("language", "gram").agg(F.sum("n_texts").alias("n_texts"))


def fit(docs: DataFrame, training: Column, id_column: str = "doc_id", text_column: str = "text",
        lang_column: str = "lang", rows_per_language: int = 2000, least_share: float = 0.001,
        least_ratio: float = 0.1, max_grams: int = 1 << 18) -> LanguageFilters:
    """Filters learned from the rows of docs where ``training`` holds; see the module docstring for the bounds."""
    spark = docs.sparkSession
    text = F.col(f"`{text_column}`")
    known = docs.where(training).select(F.col(f"`{id_column}`").alias("id"), text.alias("text"),
                                        F.col(f"`{lang_column}`").alias("lang")).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(_LETTER))
    totals = known.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").collect()  # a row a language
    languages = [r.lang for r in totals]
    if not languages:
        return LanguageFilters([], [])
    numbers = spark.createDataFrame([(lang, i) for i, lang in enumerate(languages)], "lang string, language int")
    # Rows are chosen by ids alone; at most rows_per_language of each are broadcast, so no text is shuffled.
    order = [F.xxhash64("id"), F.col("id")]
    chosen = (known.select("id", "lang").withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("r") <= rows_per_language).select("id", "lang").distinct().join(F.broadcast(numbers), "lang"))
    sample = written(known.join(F.broadcast(chosen), ["id", "lang"]).select(_words(F.col("text")).alias("words"), "language"),
                     "language-sample")
    n_sampled = dict(sample.groupBy("language").count().collect())
    share = F.col("n_texts") / F.element_at(F.create_map(*[F.lit(x) for kv in n_sampled.items() for x in kv]),
                                            F.col("language"))
    counts = written(_counted(sample).where(F.col("n_texts") >= LEAST_TEXTS).withColumn("share", share)
                     .where(F.col("share") >= least_share), "language-grams")
    widest = counts.groupBy("gram").agg(F.max("share").alias("widest"))
    kept = counts.join(widest, "gram").where(F.col("share") >= least_ratio * F.col("widest"))
    widely = Window.partitionBy("language").orderBy(F.col("n_texts").desc(), F.col("gram"))
    best = kept.withColumn("r", F.row_number().over(widely)).where(F.col("r") <= max_grams).select("language", "gram").toArrow()
    number, hashes = best.column(0).to_numpy(), best.column(1).to_numpy().view(np.uint64)
    return LanguageFilters(languages, [hashes[number == i] for i in range(len(languages))])


def identify(docs: DataFrame, filters: LanguageFilters, text_column: str = "text", out_column: str = "language",
             keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of docs (all by default) plus a struct: lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    kept = docs.columns if keep is None else keep
    out = fresh(docs, out_column)
    kind = pa.struct([pa.field("lang_pred", pa.string(), False), pa.field("score", pa.float64(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            words = batch.column(batch.num_columns - 1)
            off, _ = column_bytes(words)
            for lo, hi in slices(off):
                part = batch.slice(lo, hi - lo)
                texts = words.slice(lo, hi - lo).to_pylist()
                names, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
                rows = np.array([i for i, t in enumerate(texts) if t is not None], dtype=np.int64)
                if len(rows) and f.languages:
                    best, scores[rows] = f.decide([texts[i] for i in rows])
                    names[rows] = np.array(f.languages, dtype=object)[best]
                found = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], fields=list(kind))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], found], names=[*part.schema.names[:-1], out])

    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(out, T.StructType([
        T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)]), False)])
    return docs.select(*[F.col(f"`{c}`") for c in kept],
                       _words(F.col(f"`{text_column}`")).alias(fresh(docs, "words"))).mapInArrow(run, schema)
