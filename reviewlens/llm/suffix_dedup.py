"""Suffix-array dedup: bytes covered by a ``width``-byte string that also starts earlier are removed.

A text is its UTF-8 bytes; strings never cross documents, may overlap, and are judged on the input.
"Earlier" is a smaller document id, or a smaller start in the same document.

Blocks of windows find where strings can repeat and take out what repeats block by block (see
``repeats``). What is left, the windows at the ends of repeated runs, goes to tasks by anchor, as the
bytes around it; each task orders the suffixes that begin there with deep-shallow sorting
(``suffix_sort``) and reads equal strings off the order. An anchor with more than ``crowd`` different
surroundings (a phrase that a large part of all documents holds) would make one task's work grow with
the input: its windows are dealt out one by one instead, by two 64-bit hashes of the whole string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import repeats
from reviewlens.llm import text as T
from reviewlens.llm.frames import IDENTITY, identified
from reviewlens.llm.substring_dedup import joined, opened_windows
from reviewlens.llm.suffix_sort import deep_shallow

WIDTH = 100
GRAM = 24
CROWD = 1 << 14
#: Bytes of surroundings that are sorted at a time, at least one anchor's.
LOAD = 1 << 20


def byte_symbols(data: np.ndarray, offsets: np.ndarray):
    return data, offsets


_SPOTTED = "ah bigint, ord bigint, tag bigint, p int, around binary"


def _surroundings(width: int):
    """The bytes that the windows of each opened block cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.texts(batch.column("text"))
            ord_, tag = batch.column("ord").to_pylist(), batch.column("tag").to_pylist()
            for i in range(batch.num_rows):
                blocks = repeats.own(batch, "opened", i)
                if blocks is None:
                    continue
                whole = data[offsets[i] : offsets[i + 1]]
                start = blocks.field("p").to_numpy()
                end = start + blocks.field("n").to_numpy() + width - 1
                around = [whole[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        blocks.field("ah"),
                        pa.array(np.full(len(start), ord_[i], dtype=np.int64)),
                        pa.array(np.full(len(start), tag[i], dtype=np.int64)),
                        blocks.field("p"),
                        pa.array(around, pa.binary()),
                    ],
                    ["ah", "ord", "tag", "p", "around"],
                )

    return lambda batches: joined(run(batches))


def _sorted_repeats(width: int):
    """Stretches covered by windows that begin earlier too; rows come ordered by anchor."""

    def judge(rows: pa.Table) -> pa.RecordBatch:
        around = rows.column("around").combine_chunks().cast(pa.large_binary())
        bounds = np.frombuffer(around.buffers()[1], dtype=np.int64)[around.offset : around.offset + len(around) + 1]
        data = np.frombuffer(around.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        count = np.diff(bounds) - width + 1
        block = np.repeat(np.arange(len(count)), count)
        shift = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
        order, fresh = deep_shallow(data, bounds[block] + shift, width)
        block, shift = block[order], shift[order]
        ord_ = rows.column("ord").to_numpy()[block]
        tag = rows.column("tag").to_numpy()[block]
        start = rows.column("p").to_numpy()[block] + shift
        string = np.cumsum(fresh)
        by = np.lexsort((start, tag, ord_, string))
        again = by[np.concatenate([[False], string[by][1:] == string[by][:-1]])]
        ord_, tag, start = ord_[again], tag[again], start[again]
        by = np.lexsort((start, tag, ord_))
        ord_, tag, start = ord_[by], tag[by], start[by].astype(np.int32)
        apart = np.ones(len(start), dtype=bool)
        apart[1:] = (ord_[1:] != ord_[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + width)
        heads = np.flatnonzero(apart)
        last = start[np.append(heads[1:], len(start)) - 1] if len(heads) else start
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (ord_[heads], tag[heads], start[heads], last - start[heads] + np.int32(width))],
            ["ord", "tag", "start", "size"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.nbytes < LOAD:
                continue
            anchors = held.column("ah").to_numpy()
            heads = T.runs(anchors)
            room = np.linspace(0, len(heads) - 1, max(int(held.nbytes // LOAD), 1) + 1).astype(int)
            cuts = np.unique(heads[room])  # the last anchor may go on in the next batch
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield judge(held.slice(a, b - a))
            held = held.slice(int(cuts[-1])).combine_chunks()
        if held is not None and held.num_rows:
            yield judge(held)

    return lambda batches: joined(run(batches))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = T.texts(batch.column("text"))
        kept, spans = [], []
        for i in range(batch.num_rows):
            whole = data[offsets[i] : offsets[i + 1]]
            spans.append(repeats.merged(repeats.own(batch, "pieces", i)))
            kept.append(b"".join(whole[a:b].tobytes() for a, b in repeats.outside(spans[-1], len(whole))))
        removed = [int((x[:, 1] - x[:, 0]).sum()) for x in spans]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                repeats.spans_column(spans),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def suffix_dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, spans (maximal removed runs, start and end in bytes),
    kept (the remaining bytes).

    Null texts are empty; texts under ``width`` bytes keep all. Of rows with equal ids the one with the
    smaller text hash counts as earlier; rows equal in id and text count as one document and get the
    same result each; a null id comes last. Other columns are ignored. No rows give no rows.
    """
    units = repeats.Units(width, gram, byte_symbols)
    docs = identified(docs)
    blocks = repeats.repeated_blocks(docs, units)
    place, here = F.struct("ord", "tag", "spot"), F.struct("ord", "tag", "p")
    first = repeats.first_blocks(blocks, place)
    marked = blocks.join(first, repeats.KEYS).withColumn("again", place > F.col("first")).drop("first")
    marked = repeats.unpacked(marked)
    whole = marked.filter("again").select(
        "ord", "tag", F.col("p").alias("start"), (F.col("n") + width - 1).alias("size")
    )
    opened = marked.filter("not again and versions > 1")

    few = opened.filter(F.col("versions") <= crowd).select("ah", "ord", "tag", "p", "n")
    around = docs.join(repeats.gathered(few, "opened"), IDENTITY).mapInArrow(_surroundings(width), _SPOTTED)
    ends = (
        around.repartition("ah")
        .sortWithinPartitions("ah")
        .mapInArrow(_sorted_repeats(width), "ord bigint, tag bigint, start int, size int")
    )

    crowded = opened.filter(F.col("versions") > crowd).select("ord", "tag", "p", "n")
    windows = opened_windows(docs, crowded, units)
    earliest = windows.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count("*").alias("times"))
    single = windows.join(earliest.filter("times > 1"), ["h1", "h2"]).filter(here > F.col("first")).select(
        "ord", "tag", F.col("p").alias("start"), F.lit(width).alias("size")
    )

    pieces = repeats.gathered(whole.unionByName(ends).unionByName(single), "pieces")
    return docs.join(pieces, IDENTITY, "left").mapInArrow(
        _finish,
        "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary",
    )
