"""Quality rules from tokeniser fertility.

A public vocabulary (a SentencePiece model with byte fallback, whose path is a parameter) measures each
text: characters per token, the share of tokens that are fallback bytes, and the entropy of the text's
tokens. Each has a band of accepted values; the base rules on words come first. One pass over the texts
measures them without a shuffle.

``quality_rules`` takes fixed bands per script. They are wide: they hold for any corpus, and reject little
but text that the vocabulary cannot spell. ``fitted_rules`` takes the bands from the corpus itself, per
language and script: robust deviations around the median of the documents that pass the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import text as T
from reviewlens.llm.frames import identified
from reviewlens.session import written

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MIN_WORDS = 50
WINDOW = 3

SCRIPTS = ["none", "latin", "greek", "cyrillic", "arabic", "cjk", "other"]


@dataclass(frozen=True)
class Band:
    """Accepted characters per token, largest share of byte tokens, least entropy in bits."""

    least_chars: float
    most_chars: float
    byte_share: float
    entropy: float


#: The vocabulary knows Latin and Cyrillic best; it spells much of other scripts in bytes.
BANDS = {
    "none": Band(0.3, 16.0, 0.60, 0.5),
    "latin": Band(1.2, 8.0, 0.20, 1.5),
    "greek": Band(0.6, 8.0, 0.50, 1.5),
    "cyrillic": Band(0.8, 8.0, 0.30, 1.5),
    "arabic": Band(0.4, 8.0, 0.60, 1.5),
    "cjk": Band(0.3, 4.0, 0.90, 1.5),
    "other": Band(0.2, 8.0, 1.00, 1.5),
}


def _script_of_byte() -> np.ndarray:
    """Script by the first byte of a UTF-8 character; continuation bytes and ASCII non-letters have none."""
    out = np.zeros(256, dtype=np.uint8)
    for script, ranges in {
        "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9)],
        "greek": [(0xCD, 0xCF)],
        "cyrillic": [(0xD0, 0xD4)],
        "arabic": [(0xD8, 0xDD)],
        "cjk": [(0xE3, 0xED)],
        "other": [(0xCA, 0xCC), (0xD5, 0xD7), (0xDE, 0xE2), (0xEE, 0xF4)],
    }.items():
        for low, high in ranges:
            out[low : high + 1] = SCRIPTS.index(script)
    return out


_SCRIPT = _script_of_byte()
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(codes: np.ndarray, row: np.ndarray, rows: int, width: int = WINDOW) -> np.ndarray:
    """Per row, words in windows of ``width`` words found twice or more in the row."""
    hashes = T.windows_hash(codes, width)
    spots = np.flatnonzero(row[: len(hashes)] == row[width - 1 :]) if len(hashes) else np.empty(0, dtype=np.int64)
    order = spots[np.lexsort((hashes[spots], row[spots]))]
    same = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(order) else order
    covered = np.zeros(len(codes), dtype=bool)
    for i in range(width):
        covered[twice + i] = True
    return np.bincount(row[covered], minlength=rows)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


#: Fitted bands: so many deviations on either side of the median. A deviation is the distance to the
#: quartile on that side as a normal distribution has it, and at least a hundredth of the median and
#: LEAST_STEP, so that where most documents are equal no band is empty.
DEVIATIONS = 4
LEAST_STEP = 0.005
#: The band of a wider group (a script for a language in it, the fixed bands for a script) weighs as much as
#: this many documents of the group itself.
PRIOR_DOCS = 20
#: Entropy of any text at most, in bits: the fixed bands have no upper end of it.
_MOST_ENTROPY = 16.0
_QUARTILE = 0.6745
#: Measures with a fitted band, and whether it has a lower end.
FITTED = {"chars_per_token": True, "byte_share": False, "token_entropy": True}


def _measure(model: bytes, bands: dict[str, Band], carry: tuple[str, ...] = ()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        is_byte = np.array([encoder.is_byte(i) for i in range(encoder.get_piece_size())])
        table = np.array([[getattr(bands[s], f) for f in Band.__dataclass_fields__] for s in SCRIPTS])
        for batch in batches:
            data, offsets = T.texts(batch.column("text"))
            for first, last in T.slices(offsets):
                part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                rows = last - first
                start, end, row = T.words(part, bounds)
                codes = T.word_codes(part, start, end)
                n_words = np.bincount(row, minlength=rows)
                chars = (part & 0xC0) != 0x80
                repeats = repeated_words(codes, row, rows)
                raw = [part[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                tokens, shares, entropy, script = [], [], [], []
                for text in raw:
                    ids = np.array(encoder.encode(text.decode("utf-8", "replace")), dtype=np.int64)
                    counts = np.bincount(ids) if len(ids) else np.zeros(1, dtype=np.int64)
                    p = counts[counts > 0] / max(len(ids), 1)
                    tokens.append(len(ids))
                    shares.append(counts[is_byte[: len(counts)]].sum() / max(len(ids), 1))
                    entropy.append(float(-(p * np.log2(p)).sum()) if len(p) else 0.0)
                    votes = np.bincount(_SCRIPT[np.frombuffer(text, dtype=np.uint8)], minlength=len(SCRIPTS))
                    script.append(int(votes[1:].argmax()) + 1 if votes[1:].any() else 0)
                tokens, shares, entropy, script = map(np.array, (tokens, shares, entropy, script))
                per_token = _per_row(chars, bounds) / np.maximum(tokens, 1)
                low, high, most, least = table[script].T
                in_band = (per_token >= low) & (per_token <= high) & (shares <= most) & (entropy >= least)
                failed = (n_words < MIN_WORDS) | (100 * repeats > 50 * n_words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, rows),
                        pa.array(n_words),
                        pa.array(_per_row(chars & ~T._SPACE[part], bounds)),
                        pa.array(_per_row(_SYMBOL[part], bounds)),
                        pa.array([repeated_lines(text) for text in raw], pa.int64()),
                        pa.array(repeats),
                        pa.array(failed),
                        pa.array(~failed & in_band),
                        pa.array([SCRIPTS[i] for i in script], pa.string()),
                        pa.array(tokens, pa.int64()),
                        pa.array(per_token, pa.float64()),
                        pa.array(shares, pa.float64()),
                        pa.array(entropy, pa.float64()),
                        *(batch.column(name).slice(first, rows) for name in carry),
                    ],
                    [*COLUMNS, *carry],
                )

    return run


COLUMNS = (
    "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept "
    "script n_tokens chars_per_token byte_share token_entropy"
).split()
_KINDS = ["bigint"] * 6 + ["boolean"] * 2 + ["string", "bigint"] + ["double"] * 3
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in zip(COLUMNS, _KINDS, strict=True))


def quality_rules(docs: DataFrame, model: bytes, bands: dict[str, Band] = BANDS) -> DataFrame:
    """Per document: the base counts, base_failed, kept, and the measures the verdict rests on.

    Words are runs of characters other than space and \\t to \\r. ``base_failed``: under 50 words, or more
    than half of the words in three-word windows that the text holds twice. ``kept``: not failed, and all
    three measures within the band of the text's main script. Null texts count as empty (no words, failed).
    Rows stay one to one, with repeated and null ids; other columns are ignored.
    """
    return identified(docs).select("doc_id", "text").mapInArrow(_measure(model, bands), SCHEMA)


def _ends(passed: DataFrame, by: list[str], deviations: float) -> DataFrame:
    """``by``, n, and per measure x its ends high_x and low_x around the median of the group's documents."""
    quartiles = F.lit([0.25, 0.5, 0.75])
    found = passed.groupBy(*by).agg(F.count("*").alias("n"), *[F.percentile(F.round(x, 3), quartiles).alias(x) for x in FITTED])

    def end(x: str, side: int) -> Column:
        middle = F.col(x)[1]
        step = F.greatest((F.col(x)[1 + side] - middle) * side / _QUARTILE, middle / 100, F.lit(LEAST_STEP))
        return middle + step * (side * deviations)

    ends = [end(x, 1).alias(f"high_{x}") for x in FITTED]
    ends += [end(x, -1).alias(f"low_{x}") for x, low in FITTED.items() if low]
    return found.select(*by, "n", *ends)


ENDS = [f"high_{x}" for x in FITTED] + [f"low_{x}" for x, low in FITTED.items() if low]


def _fixed(band: Band) -> dict[str, float]:
    return {
        "high_chars_per_token": band.most_chars,
        "low_chars_per_token": band.least_chars,
        "high_byte_share": band.byte_share,
        "high_token_entropy": _MOST_ENTROPY,
        "low_token_entropy": band.entropy,
    }


def fitted_bands(
    measured: DataFrame, deviations: float = DEVIATIONS, prior_docs: float = PRIOR_DOCS, bands: dict[str, Band] = BANDS
) -> DataFrame:
    """lang, script, and per measure x its ends low_x and high_x, of every group with documents that pass the
    base rules.

    An end is the mean of the group's own, weighed by its documents, and its script's, weighed by
    ``prior_docs``; a script's end is that of its documents and the fixed band's in the same way. So a small
    group has nearly its script's band, and no band changes by leaps as a group grows. Values are
    rounded to three decimals, so a quartile's state has a bounded number of values, whatever the corpus,
    and no retry changes it.
    """
    passed = measured.filter("not base_failed")

    def towards(wide: dict[str, Column]) -> list[Column]:
        total = F.col("n") + F.lit(float(prior_docs))
        return [((F.col(end) * F.col("n") + wide[end] * F.lit(float(prior_docs))) / total).alias(end) for end in ENDS]

    def fixed(end: str) -> Column:
        pairs = [F.lit(x) for script, band in bands.items() for x in (script, _fixed(band)[end])]
        return F.element_at(F.create_map(*pairs), F.col("script"))

    scripts = _ends(passed, ["script"], deviations).select("script", *towards({end: fixed(end) for end in ENDS}))
    wide = scripts.withColumnsRenamed({end: f"script_{end}" for end in ENDS})
    groups = _ends(passed, ["lang", "script"], deviations).join(wide, "script")
    return groups.select("lang", "script", *towards({end: F.col(f"script_{end}") for end in ENDS}))


def fitted_rules(
    docs: DataFrame,
    model: bytes,
    lang_col: str = "lang",
    deviations: float = DEVIATIONS,
    prior_docs: float = PRIOR_DOCS,
    bands: dict[str, Band] = BANDS,
) -> DataFrame:
    """The columns of ``quality_rules``; ``kept`` needs the measures to be within the fitted bands of the
    text's language (a label, null is one of its own) and script too. Every text is measured once.

    Equal texts of one language have equal rows, and repeated rows count in the bands as often as they
    stand; null and empty texts fail the base rules and have no part in the bands. No rows give no rows.
    """
    rows = identified(docs, carry=[F.col(lang_col).cast("string").alias("lang")])
    rows = rows.select("doc_id", "text", F.col("carried.lang").alias("lang"))
    measured = written(rows.mapInArrow(_measure(model, bands, ("lang",)), f"{SCHEMA}, lang string"), "measures")
    ends = fitted_bands(measured, deviations, prior_docs, bands)
    ends = ends.withColumnsRenamed({"lang": "of_lang", "script": "of_script"})
    inside = F.lit(True)
    for x, low in FITTED.items():
        value = F.round(x, 3)
        inside &= value <= F.col(f"high_{x}")
        if low:
            inside &= value >= F.col(f"low_{x}")
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("script") == F.col("of_script"))
    joined = measured.join(ends, same, "left")
    return joined.withColumn("kept", F.col("kept") & F.coalesce(inside, F.lit(True))).select(*COLUMNS)
