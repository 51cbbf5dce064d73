"""Spelling variants by pivotal grams.

Two words are near if one code point inserted, deleted or replaced turns one into the other. Their bigrams
are ordered by how many words of the vocabulary hold them, rarest first. One change touches at most two
bigrams, so a word's three rarest occurrences (its prefix, with all that tie with the third) hold two that
do not overlap (its pivots; dynamic programming takes the pair with the fewest postings), of which a near
word keeps one, in its own prefix where that reaches at least as far down the order. Hence of two near words
one has a pivot in the other's prefix, with all that stands before it the same, at the same place, or all
that stands behind it, at the same place from the end. The join is on the bigram, that place, a hash of that
part and the length, which differs by one at most; reach and letters are compared next, and the survivors
verified.

Only counts of words come from the texts; all else is joins over the vocabulary, and nothing of it meets
the driver but the bigrams' counts, which the alphabet bounds (90 letters, 8100 bigrams).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.session import written

#: Words: ASCII letters and U+00C0 to U+00FF.
RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT = 6, 5
#: A word's form must be this many times as frequent.
RATIO = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GRAM, _PREFIX = 2, 3
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def with_typos(word: Column, doc_id: Column, every: int) -> Column:
    """``word``, one of its code points taken out if ``every`` divides the CRC-32 of ``<doc_id>:<word>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = F.pmod(h, F.length(word)).cast("int")
    rest = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, rest).otherwise(word)


def vocabulary(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, typo_every: int | None = None
) -> DataFrame:
    """word, n: runs of letters, A-Z lower-cased, of ``min_length`` code points and ``min_count`` occurrences.

    With ``typo_every`` one occurrence in about that many loses a letter first (``with_typos``), which
    gives every corpus misspellings to find. Occurrences are added up in each task before the shuffle.
    """
    text = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    words = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("word"))
    if typo_every:
        words = words.select(with_typos(F.col("word"), F.col("doc_id"), typo_every).alias("word"))
    counted = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram stands in the words; as many entries as the alphabet has pairs at most."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(places).alias("at"), "word").select(F.substring("word", F.col("at"), F.lit(_GRAM)).alias("gram"))
    return {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.count("*").alias("n")).toLocalIterator()}


def prefix_and_pivots(word: str, rank: dict[str, int], cost: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
    """(rank, place) of the prefix and of the pivots, and the rank down to which the prefix reaches."""
    grams = [(rank[word[i : i + _GRAM]], i) for i in range(len(word) - 1)]
    reach = sorted(grams)[_PREFIX - 1][0]
    prefix = [g for g in grams if g[0] <= reach]  # by place
    # best[j][i]: least cost of j bigrams that do not overlap among the first i of the prefix
    best: list[list[tuple[int, tuple]]] = [[(0, ())] * (len(prefix) + 1)]
    before = 0
    befores = []
    for i, (_, at) in enumerate(prefix):
        while prefix[before][1] + _GRAM <= at:
            before += 1
        befores.append(min(before, i))
    for taken in (1, 2):
        line: list = [None]
        for i, gram in enumerate(prefix):
            rest = best[taken - 1][befores[i]]
            with_it = (rest[0] + cost[gram[0]], (*rest[1], gram)) if rest else None
            line.append(min((x for x in (line[-1], with_it) if x), default=None))
        best.append(line)
    return prefix, list(best[2][-1][1]), reach


def _parts(word: str) -> list[int]:
    """Hash of every beginning of a word, by its length."""
    out, code = [0], 0
    for char in word:
        code = (code * _BASE + ord(char)) % _PRIME
        out.append(code)
    return out


def _postings(counts: dict[str, int]):
    order = sorted(counts, key=lambda gram: (counts[gram], gram))
    rank = {gram: i for i, gram in enumerate(order)}
    cost = [counts[gram] for gram in order]

    def rows_of(key: int, word: str) -> Iterator[tuple]:
        prefix, pivots, reach = prefix_and_pivots(word, rank, cost)
        letters, size = 0, len(word)
        for char in set(word):
            letters |= 1 << (ord(char) % 63)
        before, behind = _parts(word), _parts(word[::-1])
        for pivot, grams in ((False, prefix), (True, pivots)):
            for gram, at in grams:
                rest = size - at - _GRAM
                for length in (size - 1, size, size + 1) if pivot else (size,):
                    yield key, letters, reach, pivot, hash((gram, 0, at, before[at], length))
                    yield key, letters, reach, pivot, hash((gram, 1, rest, behind[rest], length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], _NAMES)

        for batch in batches:
            rows: list[tuple] = []
            for key, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
                rows.extend(rows_of(key, word))
                if len(rows) > 50_000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    return run


_NAMES = ["id", "letters", "reach", "pivot", "place"]
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64()]
_SCHEMA = "id bigint, letters bigint, reach int, pivot boolean, place bigint"


def near_words(words: DataFrame) -> DataFrame:
    """a, b, n_a, n_b for every two near words of ``words`` (word, n), both ways round.

    ``words`` holds each word once, of three letters at least. No words, no rows.
    """
    words = written(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()), "words")
    postings = written(words.select("id", "word").mapInArrow(_postings(gram_counts(words)), _SCHEMA), "postings")
    held = postings.filter("not pivot").select("place", F.col("id").alias("b"), F.col("letters").alias("lb"), F.col("reach").alias("rb"))
    asked = postings.filter("pivot").select("place", F.col("id").alias("a"), "letters", "reach")
    met = asked.join(held, "place").filter(
        (F.col("a") != F.col("b")) & (F.col("reach") <= F.col("rb")) & (F.bit_count(F.col("letters").bitwiseXOR(F.col("lb"))) <= 2)
    )
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda name: words.select(F.col("id").alias(name), F.col("word").alias(f"w{name}"), F.col("n").alias(f"n{name}"))
    checked = pairs.join(side("a"), "a").join(side("b"), "b").filter(F.levenshtein("wa", "wb", 1) == 1)
    both = F.inline(F.array(*(F.struct(*(F.col(c).alias(n) for c, n in zip(way, "a b n_a n_b".split(), strict=True))) for way in (["wa", "wb", "na", "nb"], ["wb", "wa", "nb", "na"]))))
    return checked.select(both)


def roots(forms: DataFrame) -> DataFrame:
    """word, root from rows (word, form): where following the forms ends.

    A form is RATIO times as frequent as its word, so no chain comes back to a word, and none is longer than
    27 steps for counts of 64 bits. Each round doubles the steps taken and is written; what comes to the
    driver is the number of words that moved.
    """
    found = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = written(found.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if found.filter("moved").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def spelling_groups(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    typo_every: int | None = None,
) -> DataFrame:
    """Per word of the vocabulary: word, n, n_near, form, form_n, root.

    ``form`` is the near word of the largest n (ties: the first in code-point order) if its n is at least
    ``ratio`` (2 or more) times the word's, else null; ``root`` is where forms lead, the word itself without
    one. ``docs`` needs doc_id and text; other columns are ignored. Null and empty texts have no words; a
    null id counts as no text in ``typo_every``; repeated rows count as often as they stand. Words may be of
    any length. No documents, no rows.
    """
    if ratio < 2 or min_length < 6:
        raise ValueError("ratio must be 2 or more, min_length 6 or more")
    words = written(vocabulary(docs, min_length, min_count, typo_every), "vocabulary")
    near = near_words(words).groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("top")
    )
    known = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "top")
    is_form = -F.col("top.less") >= F.col("n") * ratio
    found = written(
        known.select("word", "n", "n_near", F.when(is_form, F.col("top.form")).alias("form"), F.when(is_form, -F.col("top.less")).alias("form_n")),
        "forms",
    )
    return found.join(roots(found.filter("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))
