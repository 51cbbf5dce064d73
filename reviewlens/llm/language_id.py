"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over bytes: contexts of up to ``ORDER`` preceding bytes, of variable
length, since a context is kept only where the sample supports it. A byte's probability comes from the
longest kept context; what that context has not seen in a language shares its escape probability
(method C: distinct successors / (occurrences + distinct successors)) in proportion to the next shorter
context, seen successors excluded. The statistics are frozen after fitting, so a text's code length
under a language is an exact sum of -log2 probabilities, one table entry per byte.

Fitting takes a bounded sample: at most about ``FIT_DOCS`` labelled documents per language, those with
the smallest hashes of their ids, from the whole table. Every byte of every text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import text as T

ORDER = 3
FIT_DOCS = 3000
#: Entries of the frozen table at most: contexts x bytes x languages.
CELLS = 1 << 22
MIN_COUNT = 8
#: Rows of a batch that are scored at once.
ROWS = 256
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_PAD = 0x0A


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: Byte to symbol; 0 stands for bytes the sample has not.
    symbol: np.ndarray
    #: Last three symbols, as one number, to the row of the longest kept context.
    context: np.ndarray
    #: Code length in bits by (context, symbol), one column per language.
    bits: np.ndarray


def held_out(id_col: str = "doc_id") -> Column:
    """Documents whose crc32 of the id as text is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each (language, four bytes in a row) per batch."""
    for batch in batches:
        data, offsets = T.texts(batch.column("text"))
        rows: dict[str, list[np.ndarray]] = {}
        for i, language in enumerate(batch.column("lang").to_pylist()):
            whole = np.concatenate([np.full(ORDER, _PAD, dtype=np.uint8), data[offsets[i] : offsets[i + 1]]]).astype(np.int64)
            gram = whole[ORDER:].copy()
            for back in range(1, ORDER + 1):
                gram |= whole[ORDER - back : len(whole) - back] << (8 * back)
            rows.setdefault(language, []).append(gram)
        for language, grams in rows.items():
            gram, count = np.unique(np.concatenate(grams), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(gram), pa.string()), pa.array(gram), pa.array(count)], ["lang", "gram", "n"]
            )


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """Fit on documents that have an id, a text and a lang and are not held out.

    Only texts and labels are used; ids choose the sample. No labelled documents give a model without
    languages, which answers ``und``.
    """
    labelled = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).filter("doc_id is not null and lang is not null and text is not null")
    labelled = labelled.filter(~held_out())
    sizes = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros(256, dtype=np.int64), np.zeros(1, dtype=np.int32), np.zeros((1, 0), dtype=np.float32))
    share = F.lit(None).cast("double")
    for language, size in sizes.items():
        share = F.when(F.col("lang") == language, fit_docs / size).otherwise(share)
    drawn = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    counts = (
        drawn.select("text", "lang")
        .mapInArrow(_grams, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    return build(counts, sorted(sizes))


def build(counts: pa.Table, languages: list[str]) -> Model:
    """Freeze counts of (lang, gram) into tables of code lengths."""
    number = {language: i for i, language in enumerate(languages)}
    lang = np.array([number[x] for x in counts.column("lang").to_pylist()], dtype=np.int64)
    gram = counts.column("gram").to_numpy()
    times = counts.column("n").to_numpy().astype(np.float64)
    present = np.unique(np.concatenate([[_PAD], *[(gram >> (8 * i)) & 0xFF for i in range(ORDER + 1)]]))
    symbol = np.zeros(256, dtype=np.int64)
    symbol[present] = np.arange(1, len(present) + 1)
    size, many = len(present) + 1, len(languages)
    last = symbol[gram & 0xFF]
    room = max(CELLS // (size * many), 1 + size)

    def table(keys: np.ndarray, count: int) -> np.ndarray:
        out = np.zeros((count, size, many))
        np.add.at(out, (keys, last, lang), times)
        return out

    probability = _blend(table(np.zeros(len(gram), dtype=np.int64), 1), np.full((1, size, many), 1.0 / size))
    rows = [probability]
    context = np.zeros(1, dtype=np.int64)
    used = 1
    for order in range(1, ORDER + 1):
        key = np.zeros(len(gram), dtype=np.int64)
        for back in range(order, 0, -1):
            key = key * size + symbol[(gram >> (8 * back)) & 0xFF]
        support = np.bincount(key, weights=times, minlength=size**order)
        kept = np.flatnonzero(support >= MIN_COUNT)
        if len(kept) > room - used:
            kept = np.sort(kept[np.argsort(-support[kept], kind="stable")[: room - used]])
        longer = np.tile(context, size)  # without a row of its own a context falls back to its suffix
        place = np.full(size**order, -1, dtype=np.int64)
        place[kept] = np.arange(len(kept))
        inside = place[key] >= 0
        counted = np.zeros((len(kept), size, many))
        np.add.at(counted, (place[key[inside]], last[inside], lang[inside]), times[inside])
        shorter = np.concatenate(rows)[longer[kept]]
        rows.append(_blend(counted, shorter))
        longer[kept] = used + np.arange(len(kept))
        context, used = longer, used + len(kept)
    bits = -np.log2(np.concatenate(rows))
    return Model(languages, symbol, context.astype(np.int32), bits.reshape(-1, many).astype(np.float32))


def _blend(counted: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probabilities of contexts from their counts and those of the next shorter contexts."""
    total = counted.sum(axis=1, keepdims=True)
    distinct = (counted > 0).sum(axis=1, keepdims=True)
    left = np.where(counted > 0, 0.0, shorter)
    rest = left.sum(axis=1, keepdims=True)
    full = rest <= 0
    whole = np.where(full, total, total + distinct)
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = counted / whole
        unseen = distinct / whole * left / rest
    return np.where(total == 0, shorter, np.where(counted > 0, seen, unseen))


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each row under each language."""
    size = int(model.symbol.max()) + 1
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    for row, last in T.slices(offsets):
        for at in range(int(offsets[row]), int(offsets[last]), T.SLICE):
            end = min(at + T.SLICE, int(offsets[last]))
            low = max(at - ORDER, int(offsets[row]))
            marks = model.symbol[data[low:end]]
            near = np.concatenate([np.full(ORDER - (at - low), model.symbol[_PAD]), marks])
            key = np.zeros(end - at, dtype=np.int64)
            starts = offsets[row:last]
            starts = starts[(starts >= at) & (starts < end)] - at
            for back in range(ORDER, 0, -1):
                part = near[ORDER - back : ORDER - back + end - at]
                spots = (starts[:, None] + np.arange(back)).ravel()  # before a row's start stand pads
                spots = spots[spots < end - at]
                if len(spots):
                    part = part.copy()
                    owner = np.searchsorted(starts, spots, side="right") - 1
                    part[spots[spots - starts[owner] < back]] = model.symbol[_PAD]
                key = key * size + part
            found = model.bits[model.context[key].astype(np.int64) * size + near[ORDER:]]
            rows = np.arange(row, last)
            edges = np.clip(offsets[row : last + 1] - at, 0, end - at)
            full = edges[1:] > edges[:-1]
            if full.any():
                out[rows[full]] += np.add.reduceat(found, edges[:-1][full], axis=0, dtype=np.float64)
    return out


def _predicted(frozen: Model, column: pa.Array) -> list[pa.Array]:
    """Language, score and bits per byte of every text."""
    data, offsets = T.texts(column)
    texts = column.to_pylist()
    known = np.array([bool(text) and _LETTER.search(text) is not None for text in texts], dtype=bool)
    known &= bool(frozen.languages)
    names, score, rate = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
    if known.any():
        bits = code_lengths(frozen, data, offsets)
        least = bits.min(axis=1)
        best = bits.argmin(axis=1).tolist()
        likely = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
        names = [frozen.languages[b] if k else UNKNOWN for b, k in zip(best, known.tolist(), strict=True)]
        score = np.where(known, likely, 0.0)
        rate = np.where(known, least / np.maximum(np.diff(offsets), 1), np.nan)
    return [pa.array(names, pa.string()), pa.array(score), pa.array(rate, from_pandas=True)]


def identified_rows(docs: DataFrame, model: Model) -> DataFrame:
    """row (all columns of the input as a struct), lang_pred, score, bits_per_byte; see ``identify``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at_text = [name.lower() for name in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.column("row").slice(at, ROWS)
                text = rows.flatten()[at_text] if batch.num_columns == 1 else batch.column("text").slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([rows, *_predicted(shared.value, text)], ["row", "lang_pred", "score", "bits_per_byte"])

    # a text goes to the workers once, in its row, if it is a string there
    apart = [] if dict(docs.dtypes)[docs.columns[at_text]] == "string" else [F.col("text").cast("string").alias("text")]
    rows = docs.select(F.struct("*").alias("row"), *apart)
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, lang_pred string, score double, bits_per_byte double")


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, lang_pred, score, bits_per_byte.

    ``score`` is the posterior of the predicted language, all languages being equally likely before.
    Equal code lengths go to the first language by name. ``und`` with score 0 where the text is null or
    has no letter. Rows stay one to one; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return identified_rows(rows, model).select("row.doc_id", "lang_pred", "score", "bits_per_byte")
