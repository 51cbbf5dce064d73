"""Mixing sources to target weights by Pfair scheduling.

Documents of a source, in the order of a hash of their ids, form blocks of ``block`` documents; each
slot of the mix takes one block. A source with integer weight w out of W gives its i-th block (from 0)
the release time floor(i W / w) and the deadline ceil((i + 1) W / w). In every slot the released block
with the earliest deadline goes next; of equal deadlines the one whose window overlaps its successor's
goes first, then the one with the longer cascade of such windows (Pfair's PD2 order), then the first
source by name. So before every slot t each source has given between t w / W - 1 and t w / W + 1 blocks,
exclusive: it deviates from its target by less than one block.

The schedule repeats after W slots, so one period, bounded by the weights, gives every block's slot in
closed form, and the documents are placed by joins alone. When a source has given its last block, a new
phase starts in which the others share the slots by the same weights: no document is dropped or
repeated. A phase is counted from its own first slot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 16
OTHER = "(other)"


def period(weights: Mapping[str, int]) -> list[str]:
    """The source of every slot of one period."""
    total = sum(weights.values())
    given = dict.fromkeys(weights, 0)
    out = []
    for slot in range(total):
        ready = []
        for name in sorted(weights):
            w, i = weights[name], given[name]
            if i < w and i * total // w <= slot:
                ready.append((_deadline(i, w, total), not _overlaps(i, w, total), -_cascade(i, w, total), name))
        name = min(ready)[3]
        given[name] += 1
        out.append(name)
    return out


def _deadline(i: int, w: int, total: int) -> int:
    return -(-(i + 1) * total // w)


def _overlaps(i: int, w: int, total: int) -> bool:
    """Whether block i's last slot is also the next block's first."""
    return (i + 1) * total % w != 0


def _cascade(i: int, w: int, total: int) -> int:
    """End of the chain of two-slot windows that begins at block i, for sources of half the slots or more."""
    if 2 * w < total:
        return 0
    j = i
    while _overlaps(j, w, total) and _deadline(j + 1, w, total) - (j + 1) * total // w == 2:
        j += 1
    return _deadline(j, w, total)


@dataclass(frozen=True)
class Phase:
    """Slots from ``first_slot`` on, for the sources that still have blocks."""

    first_slot: int
    weights: dict[str, int]
    #: Blocks that each source gave before.
    given: dict[str, int]

    def slots(self) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {name: [] for name in self.weights}
        for slot, name in enumerate(period(self.weights)):
            out[name].append(slot)
        return out


def phases(blocks: Mapping[str, int], weights: Mapping[str, int]) -> list[Phase]:
    """The phases of a mix; there are at most as many as sources."""
    given = {name: 0 for name in weights}
    left = {name: w for name, w in weights.items() if blocks.get(name, 0) > 0}
    out, slot = [], 0
    while left:
        common = gcd(*left.values())
        phase = Phase(slot, {name: w // common for name, w in left.items()}, dict(given))
        out.append(phase)
        total, slots = sum(phase.weights.values()), phase.slots()
        length = min(
            (rest // w * total + (slots[name][rest % w - 1] + 1 if rest % w else slots[name][-1] + 1 - total))
            for name, w in phase.weights.items()
            if (rest := blocks[name] - given[name])
        )
        for name, w in phase.weights.items():
            given[name] += length // total * w + sum(s < length % total for s in slots[name])
        slot += length
        left = {name: w for name, w in left.items() if given[name] < blocks[name]}
    return out


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, int],
    block: int = BLOCK,
    other: int = 1,
    id_col: str = "doc_id",
    source_col: str = "source",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per document: id_col, source_col, stream (the source, or ``(other)``), block, release, deadline,
    slot, position (0-based place in the mix); with ``carry``, those columns of the input as ``carried``.

    ``weights`` are positive integers by source. Sources without a weight, null included, form one stream
    together, with weight ``other``. Within a stream documents go by the md5 of their id as text (null
    ids: of the empty text), then by id, source, and a hash of the columns in ``carry``, so rows that repeat
    an id have a fixed order too as far as these columns tell them apart. Ties between sources go by name.
    Other columns are ignored. No rows give no rows. ``release`` and ``deadline`` count from the first slot
    of the phase, as slots of the whole mix.
    """
    if any(w < 1 for w in (*weights.values(), other)) or OTHER in weights:
        raise ValueError("weights are positive integers, and (other) is no source's name")
    spark = docs.sparkSession
    named = F.col("source").isin(*weights) if weights else F.lit(False)
    carried = [F.struct(*carry).alias("carried")] if carry else []
    # a hash skips nulls, so each column goes with whether it is one
    parts = [part for name in carry for part in (F.col(name), F.col(name).isNull())]
    rows = docs.select(F.col(id_col).alias("id"), (F.xxhash64(*parts) if parts else F.lit(0)).alias("tie"), F.col(source_col).cast("string").alias("source"), *carried).select(
        "id",
        "source",
        "tie",
        *(["carried"] if carry else []),
        F.when(named, F.col("source")).otherwise(OTHER).alias("stream"),
        F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")).alias("key"),
    )
    # numbering: a stream is cut by its keys into bands of similar size, so that no task holds a stream
    total = rows.count()
    bands = max(int(total**0.5), 1)
    band = F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint") * bands, 32)
    rows = rows.withColumn("band", band)
    sizes = rows.groupBy("stream", "band").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("stream").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("stream", "band", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("stream", "band").orderBy("key", "id", "source", "tie")
    numbered = (
        rows.withColumn("place", F.row_number().over(within))
        .join(offsets, ["stream", "band"])
        .withColumn("place", F.col("place") + F.col("ahead") - 1)
        .withColumn("block", F.floor(F.col("place") / block))
    )
    counts = {row["stream"]: row["n"] for row in sizes.groupBy("stream").agg(F.sum("n").alias("n")).collect()}
    plan, slots, short = _plan(counts, {**weights, OTHER: other}, block)
    plan = spark.createDataFrame(
        plan, "stream string, phase int, given bigint, until bigint, weight bigint, total bigint, first_slot bigint"
    )
    slots = spark.createDataFrame(slots, "stream string, phase int, turn bigint, at bigint")
    # both tables are bounded by the number of weights and their sum, not by the data
    placed = (
        numbered.join(F.broadcast(plan), "stream")
        .filter((F.col("block") >= F.col("given")) & (F.col("block") < F.col("until")))
        .withColumn("i", F.col("block") - F.col("given"))
        .withColumn("turn", F.col("i") % F.col("weight"))
        .join(F.broadcast(slots), ["stream", "phase", "turn"])
        .withColumn("slot", F.col("first_slot") + F.floor(F.col("i") / F.col("weight")) * F.col("total") + F.col("at"))
    )
    missing = F.lit(0).cast("bigint")  # documents that the last, shorter blocks of earlier slots lack
    for slot, lack in short:
        missing += F.when(F.col("slot") > slot, lack).otherwise(0)
    begins = F.floor(F.col("i") * F.col("total") / F.col("weight"))
    ends = F.ceil((F.col("i") + 1) * F.col("total") / F.col("weight"))
    return placed.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "stream",
        "block",
        (F.col("first_slot") + begins).alias("release"),
        (F.col("first_slot") + ends).alias("deadline"),
        "slot",
        (F.col("slot") * block + F.col("place") % block - missing).alias("position"),
        *(["carried"] if carry else []),
    )


def _plan(counts: Mapping[str, int], weights: Mapping[str, int], block: int):
    """Rows of the phase table and the slot table, and (slot, documents lacking) of shorter last blocks."""
    blocks = {name: -(-n // block) for name, n in counts.items()}
    plan, table, short = [], [], []
    found = phases(blocks, weights)
    for number, phase in enumerate(found):
        total, slots = sum(phase.weights.values()), phase.slots()
        after = found[number + 1].given if number + 1 < len(found) else blocks
        for name, w in phase.weights.items():
            plan.append((name, number, phase.given[name], after[name], w, total, phase.first_slot))
            table += [(name, number, turn, at) for turn, at in enumerate(slots[name])]
            lack = blocks[name] * block - counts[name]
            if after[name] == blocks[name] and phase.given[name] < blocks[name] and lack:
                i = blocks[name] - 1 - phase.given[name]
                short.append((phase.first_slot + i // w * total + slots[name][i % w], lack))
    return plan, table, sorted(short)
