"""Where long strings repeat across documents: the part that substring dedup (words) and suffix-array
dedup (bytes) share.

A *window* is WIDTH consecutive symbols of one document. Within each window the GRAM-symbol string with
the smallest hash, the leftmost of several, is its anchor; equal windows have equal anchors at equal
places. A *block* is a run of consecutive windows around one anchor, so a text has one block for about
every (WIDTH - GRAM) / 2 symbols, and no two windows of a block are equal. The work goes from few rows to few rows, without dropping a case:

1. blocks whose anchor occurs once in the corpus hold no repeated window;
2. of equal blocks (same anchor, extent and content hash) all but the first are repeated as a whole;
   this takes groups of copies down to one block before anything is compared window by window;
3. first blocks whose anchor also has another, different block are opened, and the operator decides
   window by window: these are the ends of repeated runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import text as T
from reviewlens.llm.frames import IDENTITY
from reviewlens.session import written

KEYS = ["ah", "bh"]
#: Bits of the number of windows where a block's place is packed into one long, below the first window:
#: rows of blocks are most of what is shuffled.
_N_BITS = 9


@dataclass(frozen=True)
class Units:
    """How a text becomes symbols, and how long windows and grams are."""

    width: int
    gram: int
    #: (bytes, offsets) of rows to (symbols, offsets of symbols)
    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def row_blocks(symbols: np.ndarray, offsets: np.ndarray, units: Units):
    """Anchor, row, first window and number of windows of every block; windows stay inside rows.

    Long rows are taken in slices that overlap by WIDTH - 1 symbols and are counted from the row's
    start, so a row's blocks don't depend on the rows around it.
    """
    found = []
    for first, last in T.slices(offsets):
        low, high = int(offsets[first]), int(offsets[last])
        step = max(T.SLICE, units.width)
        starts = range(low, max(high - units.width + 1, low), step) if last - first == 1 else [low]
        for start in starts:
            part = symbols[start : min(start + step + units.width - 1, high) if last - first == 1 else high]
            grams = T.windows_hash(part, units.gram)
            lows = T.windows_min(grams, units.width - units.gram + 1)
            if not len(lows):
                continue
            spots = np.arange(len(lows)) + start
            row = np.searchsorted(offsets, spots, side="right") - 1
            inside = spots + units.width <= offsets[row + 1]
            fresh = np.ones(len(lows), dtype=bool)
            left = grams[: len(lows) - 1] == lows[1:]  # the anchor of the window before began with it
            fresh[1:] = (lows[1:] != lows[:-1]) | left | (row[1:] != row[:-1])
            fresh &= inside
            opened = np.flatnonzero(fresh)
            ends = np.append(opened[1:], len(lows))
            total = np.concatenate([[0], np.cumsum(inside)])
            found.append((lows[opened], row[opened], spots[opened] - offsets[row[opened]], total[ends] - total[opened]))
    if not found:
        empty = np.empty(0, dtype=np.int64)
        return empty.view(np.uint64), empty, empty, empty
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def block_codes(symbols: np.ndarray, offsets: np.ndarray, units: Units, row, p, n) -> np.ndarray:
    """Content hash of blocks, in slices of the symbols."""
    start = offsets[row] + p
    end = start + n + units.width - 1
    out = np.empty(len(row), dtype=np.uint64)
    first = 0
    while first < len(row):
        last = max(int(np.searchsorted(end, start[first] + T.SLICE, side="right")), first + 1)
        base = start[first]
        sums = T.prefix(symbols[base : end[first:last].max()], T._SECOND)
        out[first:last] = T.spans_hash(sums, start[first:last] - base, end[first:last] - base, T._SECOND)
        first = last
    return out


def _blocks(units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.texts(batch.column("text"))
            ord_, tag = batch.column("ord").to_numpy(), batch.column("tag").to_numpy()
            for first, last in T.slices(offsets, 4 * T.SLICE):
                part = data[offsets[first] : offsets[last]]
                symbols, bounds = units.symbols(part, offsets[first : last + 1] - offsets[first])
                anchor, row, p, n = row_blocks(symbols, bounds, units)
                code = block_codes(symbols, bounds, units, row, p, n)
                columns = [T.signed(anchor), T.signed(code), ord_[first:last][row], tag[first:last][row], p << _N_BITS | n]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [*KEYS, *IDENTITY, "spot"])

    return run


def repeated_blocks(docs: DataFrame, units: Units) -> DataFrame:
    """Every block whose anchor has another block somewhere: KEYS, ord, tag, spot (see ``unpacked``).

    Written once to the shared folder: a few tenths of the texts' size, read several times.
    """
    if units.width - units.gram >= (1 << _N_BITS) - 1:
        raise ValueError("gram is too short for this width")
    blocks = docs.select("text", "ord", "tag").mapInArrow(
        _blocks(units), "ah bigint, bh bigint, ord bigint, tag bigint, spot bigint"
    )
    twice = blocks.groupBy("ah").agg(F.count("*").alias("times")).filter("times > 1").select("ah")
    return written(blocks.join(twice, "ah"), "blocks")


def unpacked(blocks: DataFrame) -> DataFrame:
    """``spot`` as p (the first window) and n (how many)."""
    p = F.shiftright("spot", _N_BITS).cast("int")
    n = F.col("spot").bitwiseAND(F.lit((1 << _N_BITS) - 1)).cast("int")
    return blocks.select("*", p.alias("p"), n.alias("n")).drop("spot")


def first_blocks(blocks: DataFrame, place: Column) -> DataFrame:
    """One row per distinct block: its first place, and in how many versions its anchor occurs.

    Copies are combined inside the tasks before the shuffle.
    """
    first = blocks.groupBy(*KEYS).agg(F.min(place).alias("first"))
    versions = first.groupBy("ah").agg(F.count("*").alias("versions"))
    return first.join(versions, "ah")


def gathered(rows: DataFrame, name: str) -> DataFrame:
    """All rows of each document as one list. Every join with the texts is on IDENTITY and takes the same
    columns of them, so that one query shuffles the texts once."""
    others = [column for column in rows.columns if column not in IDENTITY]
    return rows.groupBy(*IDENTITY).agg(F.collect_list(F.struct(*others)).alias(name))


def own(batch: pa.RecordBatch, name: str, i: int) -> pa.StructArray | None:
    """Row i's entries of the list column."""
    entries = batch.column(name)[i].values
    return entries if entries is not None and len(entries) else None


def merged(pieces: pa.StructArray | None) -> np.ndarray:
    """The maximal stretches that the pieces cover: rows of (start, end), in order."""
    if pieces is None or not len(pieces):
        return np.empty((0, 2), dtype=np.int64)
    start = pieces.field("start").to_numpy().astype(np.int64)
    order = np.argsort(start)
    start = start[order]
    reach = np.maximum.accumulate(start + pieces.field("size").to_numpy()[order])
    fresh = np.concatenate([[0], np.flatnonzero(start[1:] > reach[:-1]) + 1])
    return np.stack([start[fresh], reach[np.append(fresh[1:], len(start)) - 1]], axis=1)


def outside(stretches: np.ndarray, size: int) -> list[tuple[int, int]]:
    """What lies between the stretches."""
    edges = [0, *stretches.ravel().tolist(), size]
    return [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def spans_column(found: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    flat = np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)
    spans = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(bounds), spans).cast(SPANS)
