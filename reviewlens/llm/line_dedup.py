"""Line dedup with an exact set-similarity join.

A line's set is its distinct words (runs of characters other than space and \\t to \\r). A line goes if an
earlier line, of a smaller document id or of the same document, has a set with a Jaccard similarity of
at least ``SIMILARITY``; lines are judged on the input, not on what is left. Lines without words stay.

Lines with equal sets are told by one window over their names; a line that repeats one of its own slice of
texts is dealt apart, so a group of copies gives that window a row per slice. Distinct sets meet in the
join: the words of a set are ordered by rarity, and two sets of m and n words that share at least
a = ceil(t (m + n) / (1 + t)) words must share one among the first m - a + 1 and n - a + 1. So only a
set's rarest words are posted (prefix filter); sets of too different sizes don't meet (length filter); a
shared word counts only at places that still allow a shared words (positional filter); and 128 parities
of each set bound the number of differing words from below, for long sets too. What passes is verified
on the full sets.

Postings are dealt out by ranges of their words' hashes, as packed blocks: whole columns of bytes,
compressed. A task takes up one range after the other.

Rarity comes from counts of all words in a table of fixed size (words are hashed to buckets), which any
corpus fits; prefix filtering is exact under every order that all sets share.

A word that more than ``CROWD`` sets post (a common phrase, a large group of near copies) does not pair
all of them: each set there meets ``PIVOTS`` chosen ones first, and only sets that this does not remove
meet the rest. A line needs one earlier match, not all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm import repeats
from reviewlens.llm import text as T
from reviewlens.llm.frames import IDENTITY, flagged, identified
from reviewlens.session import written

#: Similarity as a fraction.
SIMILARITY = (4, 5)
CROWD = 1024
PIVOTS = 4
BUCKETS = 1 << 18
#: Postings of a range, about, and those that a task holds before it looks for crowded words.
RANGE = 1 << 17
HOLD = 1 << 19
#: Pairs of postings that are compared at a time.
AT_ONCE = 1 << 18
#: A word at a place of a set's order, with what tells whether the set may resemble another.
POSTING = np.dtype(
    [("word", "u4"), ("at", "u4"), ("size", "u4"), ("ord", "i8"), ("id", "i8"), ("low", "u8"), ("high", "u8")]
)
#: Words of a line are told apart by this many bits of their hash.
_BITS = 44
_CODE = np.uint64((1 << _BITS) - 1)


def _sorted(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values (below 2**44) in order within each group; groups are in order already."""
    if not len(group) or group[-1] < 1 << (64 - _BITS):
        both = np.sort(group.astype(np.uint64) << np.uint64(_BITS) | value)
        return (both >> np.uint64(_BITS)).astype(np.int64), both & _CODE
    order = np.lexsort((value, group))
    return group[order], value[order]


def _line_words(data: np.ndarray, offsets: np.ndarray):
    """The distinct words of every line with words: word codes in order, line by line; the first of each
    line; and each line's row and number (the line ends before it in its row)."""
    start, end, row = T.words(data, offsets)
    ends = np.flatnonzero(data == 0x0A)
    group, codes = _sorted(np.searchsorted(ends, start) + row, T.word_codes(data, start, end) >> np.uint64(64 - _BITS))
    if len(codes):
        fresh = np.ones(len(codes), dtype=bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (group[1:] != group[:-1])
        codes, group = codes[fresh], group[fresh]
    heads = T.runs(group)
    opened = np.searchsorted(ends, offsets[:-1]) + np.arange(len(offsets) - 1)
    row = np.searchsorted(opened, group[heads], side="right") - 1
    return codes, heads, row, group[heads] - opened[row]


def bucket(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(26)).astype(np.int64) & (BUCKETS - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        data, offsets = T.texts(batch.column("text"))
        for first, last in T.slices(offsets, 4 * T.SLICE):
            part = data[offsets[first] : offsets[last]]
            start, end, _ = T.words(part, offsets[first : last + 1] - offsets[first])
            codes = T.word_codes(part, start, end) >> np.uint64(64 - _BITS)
            total += np.bincount(bucket(codes), minlength=BUCKETS)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of all words, in BUCKETS buckets."""
    found = docs.select("text").mapInArrow(_count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def _rarity(counts: np.ndarray) -> np.ndarray:
    """Buckets' counts in steps of an eighth of an octave."""
    return np.floor(8 * np.log2(np.maximum(counts, 1))).astype(np.uint64)


def _repeated(keys: Sequence[np.ndarray], place: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of lines with these names and places: which come after one with an equal name, and which repeat a place."""
    order = np.lexsort([*place[::-1], *keys[::-1]])
    other = lambda columns: np.any([column[order[1:]] != column[order[:-1]] for column in columns], axis=0)
    opens = np.concatenate([[True], other(keys)])
    head = np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))
    again, double = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    again[order] = np.any([column[order] != column[order[head]] for column in place], axis=0)
    double[order] = ~opens & ~np.concatenate([[True], other(place)])
    return again, double


def _sets(counts, similarity: tuple[int, int]):
    """Name, size, parities, place and rarest words of every line's set; ``again``, without the words, where an
    earlier line of the same slice has the same name.

    Words are ordered by rarity, then by 35 bits of their hash; 32 bits of it are posted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, (top, bottom) = _rarity(counts.value), similarity
        for batch in batches:
            data, offsets = T.texts(batch.column("text"))
            ord_, tag = batch.column("ord").to_numpy(), batch.column("tag").to_numpy()
            for first, last in T.slices(offsets, 4 * T.SLICE):
                codes, heads, row, line = _line_words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                if not len(codes):
                    continue
                size = np.diff(np.append(heads, len(codes)))
                name = T.mix(np.add.reduceat(T.mix(codes), heads) + size.astype(np.uint64))
                bit, upper = np.uint64(1) << (codes & np.uint64(63)), codes >> np.uint64(6) & np.uint64(1)
                low, high = (np.bitwise_xor.reduceat(bit * half, heads) for half in (upper ^ np.uint64(1), upper))
                line_of = np.repeat(np.arange(len(heads)), size)
                _, order = _sorted(line_of, rarity[bucket(codes)] << np.uint64(35) | codes >> np.uint64(_BITS - 35))
                posted = size - (top * size + bottom - 1) // bottom + 1
                posted[size * (bottom - top) < top] = 0  # only an equal set is as similar to so small a one
                place = [ord_[first:last][row], tag[first:last][row], line.astype(np.int32)]
                again, double = _repeated([name, low, high], place)
                posted[again] = 0
                bounds = np.concatenate([[0], np.cumsum(posted)])
                spots = np.repeat(heads - bounds[:-1], posted) + np.arange(bounds[-1])
                rare = pa.py_buffer(order[spots].astype("<u4").tobytes())
                rare = pa.BinaryArray.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer((4 * bounds).astype(np.int32)), rare])
                columns = [T.signed(name), size.astype(np.int32), T.signed(low), T.signed(high), *place]
                out = pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), rare, pa.array(again)],
                    ["name", "size", "low", "high", "ord", "tag", "line", "rare", "again"],
                )
                yield out.filter(pa.array(~double))

    return run


def _packed(posts: np.ndarray) -> bytes:
    """Byte by byte, and ids as steps: what repeats in the upper bytes takes no room."""
    posts = posts.copy()
    posts["id"][1:] = np.diff(posts["id"])
    return pa.compress(posts.view(np.uint8).reshape(len(posts), -1).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(block: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(block, n * POSTING.itemsize, codec="zstd", asbytes=True)
    posts = np.frombuffer(raw, dtype=np.uint8).reshape(-1, n).T.copy().view(POSTING)[:, 0]
    posts["id"] = np.cumsum(posts["id"])
    return posts


def _post(bits: int):
    """The postings of sets, in blocks; ``part`` is the upper ``bits`` bits of their words."""

    def blocks(held: list[np.ndarray]) -> pa.RecordBatch:
        posts = np.concatenate(held)
        part = (posts["word"] >> np.uint32(32 - bits)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        posts, part = posts[order], part[order]
        heads = T.runs(part)
        found = np.split(posts, heads[1:]) if len(heads) else []
        columns = [pa.array(part[heads]), pa.array([len(x) for x in found], pa.int32()), pa.array(map(_packed, found), pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["part", "n", "posts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            words = batch.column("rare").to_pylist()
            many = np.array([len(x) // 4 for x in words], dtype=np.int64)
            posts = np.empty(many.sum(), dtype=POSTING)
            posts["word"] = np.frombuffer(b"".join(words), dtype="<u4")
            posts["at"] = np.arange(len(posts)) - np.repeat(np.cumsum(many) - many, many)
            for name in ("size", "ord", "id", "low", "high"):
                column = batch.column(name).to_numpy()
                posts[name] = np.repeat(column.view(np.uint64) if name in ("low", "high") else column, many)
            held.append(posts)
            total += len(posts)
            if total >= HOLD:
                yield blocks(held)
                held, total = [], 0
        if total:
            yield blocks(held)

    return run


def _near(x: np.ndarray, y: np.ndarray, similarity: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Which postings x and y of one word may be of similar sets, as ``_may_match`` has it, and the bits by which
    those differ."""
    top, bottom = similarity
    m, n = x["size"].astype(np.int64), y["size"].astype(np.int64)
    need = -(-(m + n) * top // (top + bottom))
    at = (x["at"] <= m - need) & (y["at"] <= n - need) & (m * bottom >= n * top) & (n * bottom >= m * top)
    at = np.flatnonzero(at)
    x, y = x[at], y[at]
    differing = np.bitwise_count(x["low"] ^ y["low"]).astype(np.int32) + np.bitwise_count(x["high"] ^ y["high"])
    fits = (differing <= (m + n - 2 * need)[at]) & (x["id"] != y["id"])
    return at[fits], differing[fits]


#: What postings give: pairs of sets (a, b), and the postings of crowded words.
_MET = "a bigint, b bigint, differing int, tie boolean, word bigint, at int, size int, ord bigint, id bigint, low bigint, high bigint"


def _pair_rows(x: np.ndarray, y: np.ndarray, differing: np.ndarray) -> pa.RecordBatch:
    """a is the later of two documents' sets; of one document, which is later shows only with the lines."""
    later = (x["ord"] > y["ord"]) | ((x["ord"] == y["ord"]) & (x["id"] > y["id"]))
    a, b = np.where(later, x["id"], y["id"]), np.where(later, y["id"], x["id"])
    none = [pa.nulls(len(x), kind) for kind in (pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 4)]
    columns = [pa.array(a), pa.array(b), pa.array(differing.astype(np.int32)), pa.array(x["ord"] == y["ord"]), *none]
    return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in _MET.split(", ")])


def _dense_rows(posts: np.ndarray) -> pa.RecordBatch:
    none = [pa.nulls(len(posts), kind) for kind in (pa.int64(), pa.int64(), pa.int32(), pa.bool_())]
    kinds = {"word": "i8", "at": "i4", "size": "i4", "ord": "i8", "id": "i8", "low": "i8", "high": "i8"}
    columns = [pa.array(posts[name].astype(kind)) for name, kind in kinds.items()]
    return pa.RecordBatch.from_arrays([*none, *columns], [part.split()[0] for part in _MET.split(", ")])


def _all_pairs(posts: np.ndarray, similarity: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs of postings of one word: each with those of as large or larger sets, up to the size that may match."""
    top, bottom = similarity
    key = posts["word"].astype(np.uint64) << np.uint64(32) | posts["size"]
    order = np.argsort(key)
    posts, key = posts[order], key[order]
    size = posts["size"].astype(np.int64)
    end = np.searchsorted(key, key - size.astype(np.uint64) + (size * bottom // top).astype(np.uint64), side="right")
    leads = posts["at"] <= size - -(-2 * size * top // (top + bottom))
    many = np.where(leads, end - np.arange(len(posts)) - 1, 0)
    ends = np.cumsum(many)
    first = 0
    while first < len(posts):
        before = ends[first] - many[first]
        last = max(int(np.searchsorted(ends, before + AT_ONCE, side="right")), first + 1)
        i = np.repeat(np.arange(first, last), many[first:last])
        j = i + 1 + np.arange(len(i)) - np.repeat(ends[first:last] - many[first:last] - before, many[first:last])
        at, differing = _near(posts[i], posts[j], similarity)
        if len(at):
            yield _pair_rows(posts[i[at]], posts[j[at]], differing)
        first = last


def _meet(similarity: tuple[int, int], crowd: int):
    """Pairs of sets that may be similar, from blocks of postings sorted by part; of crowded words the pairs with
    their pivots, and all postings."""

    def crowded(posts: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which postings are of crowded words; pivots of these, PIVOTS at most for each word."""
        word, at, n = np.unique(posts["word"], return_inverse=True, return_counts=True)
        many = (n > max(crowd, 1)) | np.isin(word, pivots["word"])
        fresh = posts[(many & ~np.isin(word, pivots["word"]))[at]]
        fresh = fresh[np.lexsort((fresh["id"], fresh["ord"], fresh["word"]))]
        turn = np.arange(len(fresh)) - np.searchsorted(fresh["word"], fresh["word"])
        return many[at], np.sort(np.concatenate([pivots, fresh[turn < PIVOTS]]), order="word")

    def apart(posts: np.ndarray, pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
        for first in range(0, len(posts), AT_ONCE // PIVOTS):
            x = posts[first : first + AT_ONCE // PIVOTS]
            yield _dense_rows(x)
            low, high = (np.searchsorted(pivots["word"], x["word"], side=side) for side in ("left", "right"))
            for turn in range(PIVOTS):
                one = x[low + turn < high]
                other = pivots[(low + turn)[low + turn < high]]
                at, differing = _near(one, other, similarity)
                if len(at):
                    yield _pair_rows(one[at], other[at], differing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, dtype=POSTING)
        part, held, total, limit, pivots = None, [none], 0, HOLD, none
        for batch in batches:
            blocks = batch.column("posts")
            for i, (now, n) in enumerate(zip(batch.column("part").to_pylist(), batch.column("n").to_pylist(), strict=True)):
                if now != part or total >= limit:
                    posts = np.concatenate(held)
                    many, pivots = crowded(posts, pivots)
                    yield from apart(posts[many], pivots)
                    posts = posts[~many]
                    held, total, limit = [posts], len(posts), HOLD + 2 * len(posts)
                    if now != part:
                        yield from _all_pairs(posts, similarity)
                        part, held, total, limit, pivots = now, [none], 0, HOLD, none
                held.append(_unpacked(blocks[i].as_py(), n))
                total += n
        posts = np.concatenate(held)
        many, pivots = crowded(posts, pivots)
        yield from apart(posts[many], pivots)
        yield from _all_pairs(posts[~many], similarity)

    return run


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word codes and places of the wanted lines."""
    for batch in batches:
        data, offsets = T.texts(batch.column("text"))
        ord_, tag = batch.column("ord").to_numpy(), batch.column("tag").to_numpy()
        lists = batch.column("wanted")
        marks, entries = lists.offsets.to_numpy(), lists.values
        ids, lines = (entries.field(c).to_numpy() for c in ("id", "line"))
        for first, last in T.slices(offsets, 4 * T.SLICE):
            codes, heads, row, line = _line_words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            low, high = marks[first], marks[last]
            owner = np.repeat(np.arange(last - first), np.diff(marks[first : last + 1]))
            id_, number = ids[low:high], lines[low:high].astype(np.int64)
            at = np.searchsorted(row << 32 | line, owner << 32 | number)
            size = np.diff(np.append(heads, len(codes)))[at]
            bounds = np.concatenate([[0], np.cumsum(size)])
            spots = np.repeat(heads[at] - bounds[:-1], size) + np.arange(bounds[-1])
            columns = [id_, ord_[first:last][owner], tag[first:last][owner], number.astype(np.int32)]
            words = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(T.signed(codes[spots])))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), words], ["id", "ord", "tag", "line", "words"])


def _may_match(similarity: tuple[int, int]) -> Column:
    """Length filter, positional filter and parities, for postings x and y of one word."""
    top, bottom = similarity
    m, n = F.col("x.size"), F.col("y.size")
    need = F.floor(((m + n) * top + (top + bottom - 1)) / (top + bottom))
    return (
        (m * bottom >= n * top)
        & (n * bottom >= m * top)
        & (F.col("x.at") <= m - need)
        & (F.col("y.at") <= n - need)
        & (_differing() <= m + n - need * 2)
    )


def _differing() -> Column:
    return sum(F.bit_count(F.col(f"x.{half}").bitwiseXOR(F.col(f"y.{half}"))) for half in ("low", "high"))


def _of_ids(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """id and place of these sets; a bit map keeps most of the others out of the shuffle."""
    places = flagged(sets.select("id", "ord", "tag", "line"), ids, ["id"]).filter("flagged").drop("flagged")
    return places.join(ids, "id", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Ids of the sets that are similar to that of an earlier place, among the pairs (a, b) of ids."""
    top, bottom = similarity
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = written(_of_ids(sets, ids).select("ord", "tag", "line", "id"), "wanted")
    near = flagged(docs, wanted).filter("flagged").drop("flagged")
    words = near.join(repeats.gathered(wanted, "wanted"), IDENTITY).mapInArrow(
        _words_of, "id bigint, ord bigint, tag bigint, line int, words array<bigint>"
    )
    place = F.struct("ord", "tag", "line")
    left = words.select(F.col("id").alias("a"), F.col("words").alias("x"), place.alias("x_place"))
    right = words.select(F.col("id").alias("b"), F.col("words").alias("y"), place.alias("y_place"))
    both = F.size(F.array_intersect("x", "y"))
    alike = both * bottom >= (F.size("x") + F.size("y") - both) * top
    later = F.when(F.col("x_place") > F.col("y_place"), F.col("a")).otherwise(F.col("b"))
    found = pairs.join(left, "a").join(right, "b").filter(alike).select(later.alias("id")).distinct()
    return written(found, "alike")


def similar_sets(sets: DataFrame, docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, crowd: int = CROWD) -> DataFrame:
    """Ids of the sets that have a similar set at an earlier place.

    ``sets`` has one row per distinct set: id, size, low, high, ord, tag, line (its first place), rare.
    A set that is later than several candidates is held against the likeliest first (the fewest differing
    bits), and against the others only if that is not similar.
    """
    posts = (sets.agg(F.sum(F.length("rare"))).first()[0] or 0) // 4
    bits = max(6, (posts // RANGE).bit_length())
    blocks = sets.select("id", "size", "ord", "low", "high", "rare").mapInArrow(_post(bits), "part int, n int, posts binary")
    met = blocks.repartition("part").sortWithinPartitions("part").mapInArrow(_meet(similarity, crowd), _MET)
    met = written(met, "met")  # one shuffle of all postings gives the pairs and the crowded words' postings
    pairs = met.filter("a is not null").select("a", "b", "differing", "tie")
    dense = met.filter("word is not null").select("word", "at", "size", "ord", "id", "low", "high")
    likely = pairs.groupBy("a").agg(F.min(F.struct("differing", "b")).alias("first")).select("a", "first.b")
    likely = written(likely, "likely")
    found = _verified(likely.unionByName(pairs.filter("tie").select("a", "b")), sets, docs, similarity)
    unsure = likely.join(found.select(F.col("id").alias("a")), "a", "left_anti").select("a")
    others = flagged(pairs.filter("not tie").select("a", "b"), unsure, ["a"]).filter("flagged").select("a", "b")
    others = others.join(unsure, "a", "left_semi").distinct().join(likely, ["a", "b"], "left_anti")
    left = dense.join(found, "id", "left_anti").alias("x")
    same = (F.col("x.word") == F.col("y.word")) & _may_match(similarity)
    rest = left.join(dense.alias("y"), same & (F.col("x.id") != F.col("y.id")) & (F.col("x.ord") >= F.col("y.ord")))
    rest = rest.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    return found.unionByName(_verified(others.unionByName(rest), sets, docs, similarity)).distinct()


def removed_lines(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, crowd: int = CROWD) -> DataFrame:
    """ord, tag, line of every line that goes, some more than once; ``docs`` as ``identified`` gives them.
    Repeated rows are one."""
    counts = docs.sparkSession.sparkContext.broadcast(word_counts(docs))
    lines = docs.select("text", "ord", "tag").mapInArrow(
        _sets(counts, similarity),
        "name bigint, size int, low bigint, high bigint, ord bigint, tag bigint, line int, rare binary, again boolean",
    )
    place = ["ord", "tag", "line"]
    lines = lines.withColumn("salt", F.when(F.col("again"), F.xxhash64(*place)))
    here = Window.partitionBy("name", "size", "low", "high", "salt").orderBy(*place)
    lines = lines.select("*", F.row_number().over(here).alias("turn"), F.rank().over(here).alias("rank"))
    lines = lines.filter("again or turn = 1 or rank > 1").withColumn("first", ~F.col("again") & (F.col("rank") == 1))
    body = [F.when(F.col("first"), F.col(name)).alias(name) for name in ("size", "low", "high", "rare")]
    lines = written(lines.select(F.monotonically_increasing_id().alias("id"), *place, "first", *body), "lines")
    sets = lines.filter("first").drop("first")
    gone = _of_ids(sets, similar_sets(sets, docs, similarity, crowd))
    return lines.filter("not first").select(*place).unionByName(gone.select(*place))


#: Rows whose lines are handled at a time; a batch of long texts would take several times its size otherwise.
_ROWS = 256


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (whole.slice(first, _ROWS) for whole in batches for first in range(0, len(whole), _ROWS)):
        texts, numbers, left, total = batch.column("text").to_pylist(), [], [], []
        for i, text in enumerate(texts):
            gone = repeats.own(batch, "lines", i)
            gone = sorted(set(gone.field("line").to_pylist())) if gone is not None else []
            lines = text.split("\n") if text else []
            numbers.append(gone)
            total.append(len(lines))
            out = set(gone)
            left.append("\n".join(line for n, line in enumerate(lines) if n not in out) if gone else text)
        others = [name for name in batch.schema.names if name not in ("text", "lines")]
        columns = [pa.array(total, pa.int64()), pa.array(numbers, pa.list_(pa.int32())), pa.array(left, pa.string())]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in others), *columns], [*others, "n_lines", "removed_lines", "kept_text"]
        )


def line_dedup(
    docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, crowd: int = CROWD, carry: Sequence[str] = ()
) -> DataFrame:
    """Per document: doc_id, ord, tag (its place in the order), n_lines, removed_lines (numbers from 0),
    kept_text (the other lines, joined by \\n); with ``carry``, those columns of the input as ``carried``.

    Null and empty texts have no lines and stay as they are. Of rows with equal ids the one with the
    smaller text hash counts as earlier; rows equal in id and text count as one document and get the same
    result each; a null id comes last. Other columns are ignored. No rows give no rows.
    """
    whole = identified(docs, carry=carry)
    gone = written(removed_lines(identified(docs), similarity, crowd), "gone")
    split = flagged(whole, gone)
    gone = repeats.gathered(gone, "lines")
    near = split.filter("flagged").drop("flagged").join(gone, IDENTITY, "left")
    others = split.filter("not flagged").drop("flagged").withColumn("lines", F.lit(None).cast(gone.schema["lines"].dataType))
    kinds = {f.name: f.dataType.simpleString() for f in whole.schema.fields if f.name != "text"}
    head = ["ord", *(name for name in kinds if name != "ord")]
    schema = ", ".join(f"{name} {kinds[name]}" for name in head)
    return near.unionByName(others).select(*head, "text", "lines").mapInArrow(
        _keep, f"{schema}, n_lines bigint, removed_lines array<int>, kept_text string"
    )
