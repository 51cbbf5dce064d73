"""Importance resampling towards a target distribution, by bit-sliced aggregation.

A text's features are its runs of one to three consecutive words; each falls in one of ``BUCKETS`` buckets
by its CRC-32. Counts of all texts and of all target texts give each bucket a whole-number gain. A text's
bucket counts, and the gains in two's complement, are held as planes of one bit per bucket: plane k of the
counts ANDed with plane g of the gains, its ones counted, adds 2**(k + g) to the text's weight per one (the
gains' sign plane takes away). The sums are whole numbers, so weights are exact. Gumbel noise from the id
turns weights into scores whose highest are a draw without replacement.

Two passes over the texts, neither of which shuffles them: each task of the first gives one row per bucket
at most, the second only scores. Ranking shuffles ids and scores by ranges.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import text as T
from reviewlens.operators.places import numbered
from reviewlens.session import written

BUCKETS = 10_000
LONGEST = 3
PERCENT = 5
MIN_WORDS = 20
SEED = 42
#: Documents, and words of one document, that are worked on together.
GROUP, PART = 128, 1 << 17
#: Word lengths with a ready table, and the longest word whose bytes are taken in step with others.
_LENGTHS, _STEPS = 256, 64
_POLYNOMIAL = 0xEDB88320


def _word_bytes() -> np.ndarray:
    """Every byte to itself, A-Z to a-z, and what stands between words to a space."""
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 0x20
    for low, high in [(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)]:
        out[low : high + 1] = 0x20
    return out


_WORD_BYTES = _word_bytes()


# CRC-32 of many strings at once


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def _through(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values on each byte, at ``values``."""
    out = tables[0][values & 0xFF]
    for i in (1, 2, 3):
        out = out ^ tables[i][(values >> np.uint32(8 * i)) & 0xFF]
    return out


def _map_of(columns: np.ndarray) -> np.ndarray:
    """Tables by byte of the linear map whose values on single bits are ``columns``."""
    tables = np.zeros((4, 256), dtype=np.uint32)
    bytes_ = np.arange(256)
    for bit in range(8):
        tables[:, (bytes_ >> bit) & 1 == 1] ^= columns.reshape(4, 8)[:, bit : bit + 1]
    return tables


_BITS = np.uint32(1) << np.arange(32, dtype=np.uint32)


@lru_cache(maxsize=4096)
def _appended(length: int) -> np.ndarray:
    """Tables of what appending ``length`` bytes does to a CRC, but for those bytes' own CRC."""
    if length == 0:
        return _map_of(_BITS)
    if length == 1:
        return _map_of(_CRC[_BITS & 0xFF] ^ (_BITS >> np.uint32(8)))
    half = _appended(length // 2)
    columns = _through(half, _through(half, _BITS))
    return _map_of(_through(_appended(1), columns) if length % 2 else columns)


@lru_cache(maxsize=1)
def _ready() -> np.ndarray:
    return np.stack([_appended(length) for length in range(_LENGTHS)])


def append(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs after as many more bytes, to be combined with those bytes' CRC by xor."""
    ready = _ready()
    at = np.minimum(lengths, _LENGTHS - 1)
    out = ready[at, 0, crc & 0xFF]
    for i in (1, 2, 3):
        out ^= ready[at, i, (crc >> np.uint32(8 * i)) & 0xFF]
    for length in np.unique(lengths[lengths >= _LENGTHS]).tolist():
        longer = lengths == length
        out[longer] = _through(_appended(length), crc[longer])
    return out


def crc_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:end] for arrays of bounds."""
    lengths = end - start
    out = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    left = np.flatnonzero((lengths > 0) & (lengths <= _STEPS))
    step = 0
    while len(left):
        out[left] = _CRC[(out[left] ^ data[start[left] + step]) & 0xFF] ^ (out[left] >> np.uint32(8))
        step += 1
        left = left[lengths[left] > step]
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > _STEPS).tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]])
    return out


def feature_buckets(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, first: int = 0, buckets: int = BUCKETS
) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every run of one to LONGEST words of a row that ends at word ``first`` or later."""
    lengths = end - start
    crc = crc_of(data, start, end)
    space = np.full(len(start), zlib.crc32(b" "), dtype=np.uint32)
    spaced = append(space, lengths) ^ crc  # of a space and the word
    rows, found, run = [row[first:]], [crc[first:] % buckets], crc
    for more in range(1, LONGEST):
        run = append(run[:-1], lengths[more:] + 1) ^ spaced[more:]
        inside = row[: len(run)] == row[more:]
        inside[: max(first - more, 0)] = False
        rows.append(row[more:][inside])
        found.append(run[inside] % buckets)
    return np.concatenate(rows), np.concatenate(found).astype(np.int64)


def grouped_counts(column: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, numbers of words and bucket counts of groups of rows; whatever the texts' lengths, memory
    is that of GROUP rows of counts, SLICE bytes of short texts or one long text, and PART of its words."""
    data, offsets = T.texts(column)
    for low, high in T.slices(offsets):
        for first in range(low, high, GROUP):
            last = min(first + GROUP, high)
            bounds = offsets[first : last + 1] - offsets[first]
            part = _WORD_BYTES[data[offsets[first] : offsets[last]]]
            start, end, row = T.words(part, bounds)
            counts = np.zeros((last - first) * buckets, dtype=np.int64)
            for at in range(0, len(start), PART):
                back = min(at, LONGEST - 1)
                piece = slice(at - back, at + PART)
                rows, found = feature_buckets(part, start[piece], end[piece], row[piece], back, buckets)
                counts += np.bincount(rows * buckets + found, minlength=len(counts))
            yield first, np.bincount(row, minlength=last - first), counts.reshape(-1, buckets)


# statistics


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, text_col: str = "text") -> DataFrame:
    """bucket, n: features of all texts by bucket; added up in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, counts in grouped_counts(batch.column("text"), buckets):
                total += counts.sum(axis=0)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Whole-number gain of each bucket; the counts behind it cover all rows of both tables."""
    held = []
    for table in (docs, target):
        counts = bucket_counts(table, buckets).toArrow()  # one row per bucket at most
        dense = np.zeros(buckets)
        dense[counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
        held.append(dense)
    s, t = held
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


# planes


def planes(values: np.ndarray, count: int) -> np.ndarray:
    """Bits 0 to ``count`` - 1 of rows of whole numbers, as planes: (count, rows, words of 64 bits)."""
    width = -(-values.shape[1] // 64) * 8
    out = np.zeros((count, values.shape[0], width), dtype=np.uint8)
    for k in range(count):
        bits = np.packbits((values >> k) & 1, axis=1)
        out[k, :, : bits.shape[1]] = bits
    return out.view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Two's complement planes of the gains and what a one in each is worth."""
    count = max(int(gain.max(initial=0)).bit_length(), int(-gain.min(initial=0)).bit_length()) + 1
    worth = [1 << g for g in range(count - 1)] + [-(1 << (count - 1))]
    return planes(gain[None, :], count)[:, 0], worth


def weights(counts: np.ndarray, sliced: tuple[np.ndarray, list[int]]) -> np.ndarray:
    """Sum over buckets of count times gain for every row of counts."""
    out = np.zeros(len(counts), dtype=np.int64)
    gain, worth = sliced
    most = int(counts.max(initial=0))
    for k, plane in enumerate(planes(counts.astype(np.min_scalar_type(most)), most.bit_length())):
        for g, value in enumerate(worth):
            ones = np.bitwise_count(plane & gain[g]).sum(axis=1, dtype=np.int64)
            out += ones * (value << k if value > 0 else -(-value << k))
    return out


def weighted(docs: DataFrame, gain: np.ndarray, carry: Sequence[str | Column] = ()) -> DataFrame:
    """doc_id, tag (a hash of the text), n_words, n_features, weight (and ``carried``) of every row."""
    sliced, buckets = gain_planes(gain), len(gain)
    names = ["doc_id", "tag", *(["carried"] if carry else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n_words, counts in grouped_counts(batch.column("text"), buckets):
                columns = [
                    *(batch.column(name).slice(first, len(counts)) for name in names),
                    pa.array(n_words.astype(np.int64)),
                    pa.array(counts.sum(axis=1)),
                    pa.array(weights(counts, sliced)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "n_features", "weight"])

    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("tag"),
        text.alias("text"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    kinds = [f"{name} {rows.schema[name].dataType.simpleString()}" for name in names]
    return rows.mapInArrow(run, ", ".join([*kinds, "n_words bigint", "n_features bigint", "weight bigint"]))


def gumbel(seed: int = SEED, id_col: str = "doc_id") -> Column:
    """Noise in thousandths from the first 32 bits of sha256 of ``seed:id``; a null id counts as no text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    carry: Sequence[str | Column] = (),
) -> DataFrame:
    """Every row of ``docs`` with doc_id, n_words, n_features, weight, score, and rank if it is drawn.

    ``percent`` of the rows with ``min_words`` words or more are drawn, rounded down: those of the highest
    scores, equal scores by ascending id (nulls last), then by a hash of the text. Both tables need a
    column text, ``docs`` doc_id too; other columns are ignored, or come out in the struct ``carried``.

    Null and empty texts have no words, weight 0 and are not drawn. Rows that repeat an id share their
    noise; equal rows get neighbouring ranks. An empty target leaves every bucket its smoothing alone; no
    documents give no rows.
    """
    rows = written(weighted(docs, gains(docs, target, buckets), carry), "weighted")
    rows = rows.withColumn("score", F.col("weight") + gumbel(seed))
    enough = F.col("n_words") >= min_words
    placed = numbered(rows.filter(enough), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("tag")])
    drawn = percent * placed.count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    out = placed.withColumn("rank", rank).unionByName(rows.filter(~enough), allowMissingColumns=True)
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank", *(["carried"] if carry else []))
