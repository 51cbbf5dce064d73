"""SimHash near-dedup with multi-index hashing.

A document's fingerprint has a bit for every bit that is set in more than half of its shingles' hashes
(XXH64, seed 42; shingles are three words, A-Z in lower case, joined by one space, repeats included).
Two fingerprints link at ``RADIUS`` or fewer differing bits.

Multi-index hashing: a fingerprint has two 32-bit segments. If two fingerprints differ in at most three
bits, one segment differs in at most one: each fingerprint looks up the 33 values of the Hamming ball
of radius 1 around each segment in the table of segments, and whole distances are verified.

Equal fingerprints are one node. Where more than ``CROWD`` fingerprints share a segment (large groups
of near copies), links are not listed: every fingerprint there goes to all points of its Hamming ball
of radius 2, and at each point that lies within 1 of some fingerprint all others are linked to the
smallest such one. Two fingerprints within 3 bits share such a point, and what meets at one is within
3 bits of the one it is linked to: components are exact and rows grow with the group, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import text as T
from reviewlens.llm.components import components
from reviewlens.llm.frames import IDENTITY, LAST, identified, unsized
from reviewlens.session import written

SHINGLE = 3
SEED = 42
RADIUS = 3
CROWD = 32


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Fingerprint of one text; fewer words than a shingle has make one shingle, no words give 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), 8192):
        spots = zip(starts[at : at + 8192].tolist(), ends[at : at + 8192].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spots], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint16)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(starts)).tolist())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = T.texts(batch.column("text"))
        marks = [fingerprint(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        marks = np.array(marks, dtype=np.uint64)
        others = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in others), pa.array(T.signed(marks))], [*others, "mark"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, ord, mark (the fingerprint as a signed long) per document."""
    return identified(docs).select("doc_id", "ord", "text").mapInArrow(
        _fingerprints, "doc_id bigint, ord bigint, mark bigint"
    )


def _segments(marks: DataFrame, radius: int) -> DataFrame:
    """The values within ``radius`` (0 or 1) of both segments; the segment's number is in the key."""
    halves = F.array(F.shiftrightunsigned("mark", 32), F.col("mark").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(1 << 32))
    keys = marks.select("mark", "node", F.explode(halves).alias("key"))
    if not radius:
        return keys
    flips = F.transform(F.sequence(F.lit(-1), F.lit(31)), lambda i: F.when(i < 0, F.lit(0).cast("bigint")).otherwise(_bit(i)))
    return keys.select("mark", "node", "key", F.explode(flips).alias("flip")).select(
        "mark", "node", F.col("key").bitwiseXOR(F.col("flip")).alias("key")
    )


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def _ball(marks: DataFrame) -> DataFrame:
    """All points within 2 bits of each fingerprint; ``near``: within 1."""
    first = marks.select("*", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("i"))
    points = first.select("*", F.explode(F.sequence(F.col("i"), F.when(F.col("i") < 0, -1).otherwise(63))).alias("j"))
    none = F.lit(0).cast("bigint")
    flip = F.when(F.col("i") < 0, none).otherwise(
        _bit(F.col("i")).bitwiseOR(F.when(F.col("i") == F.col("j"), none).otherwise(_bit(F.col("j"))))
    )
    return points.select("node", F.col("mark").bitwiseXOR(flip).alias("point"), (F.col("i") == F.col("j")).alias("near"))


def links(marks: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) between nodes that connect what the links of all fingerprints connect.

    ``marks`` has one row (mark, node) per distinct fingerprint.
    """
    held = _segments(marks, 0)
    crowded = held.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select("key")
    probes = _segments(marks, 1)
    other = held.join(crowded, "key", "left_anti").select("key", F.col("mark").alias("other"), F.col("node").alias("b"))
    apart = F.bit_count(F.col("mark").bitwiseXOR(F.col("other")))
    listed = unsized(probes).alias("p").join(
        other.alias("o"), (F.col("p.key") == F.col("o.key")) & (F.col("mark") < F.col("other")) & (apart <= radius)
    )
    dense = written(probes.join(crowded, "key", "left_semi").select("mark", "node").distinct(), "crowded")
    points = _ball(dense)
    centre = (
        points.groupBy("point")
        .agg(F.min(F.when(F.col("near"), F.col("node"))).alias("b"), F.count("*").alias("n"))
        .filter("b is not null and n > 1")
        .select("point", "b")
    )
    stars = unsized(points).join(centre, "point").select(F.col("node").alias("a"), "b")
    return listed.select(F.col("node").alias("a"), "b").unionByName(stars).filter("a <> b")


def _labelled(marks: DataFrame, low: Column, crowd: int) -> DataFrame:
    """mark, low (the smallest of its rows), component per distinct fingerprint."""
    nodes = marks.groupBy("mark").agg(F.min(low).alias("low")).withColumn("node", F.col("mark"))
    nodes = written(nodes, "nodes")
    found = components(links(nodes.select("mark", "node"), RADIUS, crowd))
    return nodes.join(found, "node", "left").select("mark", "low", F.coalesce("component", "node").alias("component"))


def simhash_groups(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id, the smallest id reachable by links.

    Null, empty and wordless texts have fingerprint zero and link like others. Rows that repeat an id
    each get a row by their own text. A null id is smaller than none, and a component of null ids alone
    has a null component_id. Other columns are ignored. No rows give no rows.
    """
    marks = written(fingerprints(docs), "fingerprints")
    of = _labelled(marks, F.col("ord"), crowd)
    lowest = of.groupBy("component").agg(F.min("low").alias("lowest"))
    labels = of.join(lowest, "component").select("mark", "lowest")
    return marks.join(labels, "mark").select(
        "doc_id",
        F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"),
        F.when(F.col("lowest") < LAST, F.col("lowest")).alias("component_id"),
    )


def first_of_groups(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One whole row of each component: the smallest id's, null ids last; of rows with that id the one with
    the smallest text hash, then the smallest hash of the other columns. No other row goes.

    ``docs`` has columns doc_id and text; their other columns come along.
    """
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    # a hash skips nulls, so each column goes with whether it is one
    parts = [part for name in others for part in (F.col(f"carried.{name}"), F.col(f"carried.{name}").isNull())]
    rest = F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")
    whole = identified(docs, carry=others).withColumn("rest", rest)
    place = [*IDENTITY, "rest"]
    marks = whole.select(*place, "text").mapInArrow(
        _fingerprints, "ord bigint, tag bigint, rest bigint, mark bigint"
    )
    of = _labelled(written(marks, "fingerprints"), F.struct(*place), crowd)
    first = of.groupBy("component").agg(F.min("low").alias("low")).select("low.*")
    kept = whole.join(first, place, "left_semi").dropDuplicates(place)  # rows equal in all columns
    return kept.select("doc_id", "text", *[f"carried.{name}" for name in others])
