"""Substring dedup: Rabin-Karp hashes of all windows of words, counted in Spark.

A window is ``width`` consecutive words. A word goes if a window that covers it has the same words as
a window of an earlier document (smaller id). Windows are judged on the input, not on what is left.

Every window's Rabin-Karp hash follows from the prefix sums of the word hashes. Windows are counted in
blocks first (see ``repeats``), then one by one, by two 64-bit hashes, where blocks differ. Repeated
windows of a document merge into maximal intervals, which are removed.
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

WIDTH = 50
GRAM = 20


def word_symbols(data: np.ndarray, offsets: np.ndarray):
    start, end, row = T.words(data, offsets)
    return T.word_codes(data, start, end), np.searchsorted(row, np.arange(len(offsets)), side="left")


def _windows(units: repeats.Units):
    """Two hashes of each window in the blocks to open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.texts(batch.column("text"))
            ord_, tag = batch.column("ord").to_pylist(), batch.column("tag").to_pylist()
            for i in range(batch.num_rows):
                blocks = repeats.own(batch, "opened", i)
                if blocks is None:
                    continue
                piece = data[offsets[i] : offsets[i + 1]]
                symbols, _ = units.symbols(piece, np.array([0, len(piece)]))
                p, n = blocks.field("p").to_numpy(), blocks.field("n").to_numpy()
                parts = [symbols[a : a + b + units.width - 1] for a, b in zip(p.tolist(), n.tolist(), strict=True)]
                one = np.concatenate([T.windows_hash(part, units.width) for part in parts])
                two = np.concatenate([T.windows_hash(part, units.width, T._SECOND) for part in parts])
                start = np.concatenate([np.arange(a, a + b, dtype=np.int32) for a, b in zip(p, n, strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(T.signed(one)),
                        pa.array(T.signed(two)),
                        pa.array(np.full(len(one), ord_[i], dtype=np.int64)),
                        pa.array(np.full(len(one), tag[i], dtype=np.int64)),
                        pa.array(start),
                    ],
                    ["h1", "h2", "ord", "tag", "p"],
                )

    return run


def joined(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, count = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def opened_windows(docs: DataFrame, opened: DataFrame, units: repeats.Units) -> DataFrame:
    """h1, h2, ord, tag, p of every window in the opened blocks (ord, tag, p, n)."""
    run = _windows(units)
    return docs.join(repeats.gathered(opened, "opened"), IDENTITY).mapInArrow(
        lambda batches: joined(run(batches)), "h1 bigint, h2 bigint, ord bigint, tag bigint, p int"
    )


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, removed stretches and kept text of each document."""
    for batch in batches:
        data, offsets = T.texts(batch.column("text"))
        counts, kept, spans = [], [], []
        for i in range(batch.num_rows):
            words = data[offsets[i] : offsets[i + 1]].tobytes().split()
            counts.append(len(words))
            spans.append(repeats.merged(repeats.own(batch, "pieces", i)))
            left = [word for a, b in repeats.outside(spans[-1], len(words)) for word in words[a:b]]
            kept.append(b" ".join(left).decode())
        removed = [int((x[:, 1] - x[:, 0]).sum()) for x in spans]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()),
                repeats.spans_column(spans),
                pa.array(kept, pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "spans", "kept_text"],
        )


def substring_dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, spans (removed, start and end in words), kept_text.

    ``kept_text`` is the kept words joined by one space.

    Null or empty texts have no words and keep the empty text. Texts shorter than ``width`` words keep
    all. Of rows with equal ids the one with the smaller text hash counts as earlier; rows equal in id
    and text count as one document and get the same result each; a null id comes last. Other columns
    are ignored. No rows give no rows.
    """
    units = repeats.Units(width, gram, word_symbols)
    docs = identified(docs)
    blocks = repeats.repeated_blocks(docs, units)
    first = repeats.first_blocks(blocks, F.struct("ord", "tag"))
    here = F.struct("ord", "tag")
    marked = repeats.unpacked(blocks.join(first, repeats.KEYS))
    whole = marked.filter(here > F.col("first")).select(
        "ord", "tag", F.col("p").alias("start"), (F.col("n") + width - 1).alias("size")
    )
    opened = marked.filter((here == F.col("first")) & (F.col("versions") > 1)).select("ord", "tag", "p", "n")
    windows = opened_windows(docs, opened, units)
    earliest = windows.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count("*").alias("times"))
    single = windows.join(earliest.filter("times > 1"), ["h1", "h2"]).filter(here > F.col("first")).select(
        "ord", "tag", F.col("p").alias("start"), F.lit(width).alias("size")
    )
    pieces = repeats.gathered(whole.unionByName(single), "pieces")
    return docs.join(pieces, IDENTITY, "left").mapInArrow(
        _finish,
        "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, "
        "kept_text string",
    )
