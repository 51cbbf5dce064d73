"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import plain
import pytest
from pyspark.sql import functions as F

from reviewlens.llm.spelling import near_words, prefix_and_pivots, spelling_groups


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow(rows, every=199, least=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least and len(w) >= 6}
    near = {w: [v for v in words if is_near(v, w)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def made(seed, count):
    pick = random.Random(seed)
    stems = ["".join(pick.choice("abcdeéßñÀ÷") for _ in range(pick.randint(5, 9))) for _ in range(30)]

    def bent(word):
        for _ in range(pick.choice([0, 0, 0, 0, 1, 1, 2])):
            at = pick.randrange(len(word))
            word = pick.choice([word[:at] + word[at + 1 :], word[:at] + pick.choice("abcé") + word[at:], word[:at] + pick.choice("abÿ") + word[at + 1 :]])
        return word

    return [(i, " ".join(bent(stems[min(pick.randrange(30), pick.randrange(30))]) for _ in range(pick.randint(0, 60)))) for i in range(count)]


def found(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("every", [199, 3])
def test_against_the_plain_version(spark, every):
    rows = made(every, 300) + plain.corpus()
    rows += [(None, "Chained " * 900), (None, "chainedx " * 150), (7, "chaine " * 30), (7, "chain " * 99), (8, "cchaine " * 6), (9, None), (10, "")]
    rows += [(20, "aaaaaaa " * 40), (21, "aaaaaa " * 7), (22, "aaaaaaaa " * 5), (23, "abababab " * 9), (24, "babababa " * 9), (25, "bababab " * 50)]
    rows += [(30, ("é" * 3000 + " ") * 6), (31, ("é" * 3001 + " ") * 60), (32, "İstanbulK " * 8)] + [(40, "Repeated rowss rowssx ")] * 9
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs = docs.withColumns({"word": F.lit("x"), "n": F.lit(1), "id": F.lit(2), "form": F.lit("f")})
    got = found(spelling_groups(docs.repartition(5), typo_every=every))
    want = slow(rows, every)
    assert got == want
    assert len({row for row in want if row[1]}) > 15 and any(row[2] != row[1] for row in want if row[1])


def test_pivots_do_not_overlap_and_cost_least():
    pick = random.Random(5)
    for _ in range(500):
        word = "".join(pick.choice("abc") for _ in range(pick.randint(6, 12)))
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)})
        pick.shuffle(grams)
        rank = {g: i for i, g in enumerate(grams)}
        cost = sorted(pick.randint(1, 50) for _ in grams)
        prefix, pivots, reach = prefix_and_pivots(word, rank, cost)
        assert len(prefix) >= 3 and all(r <= reach for r, _ in prefix) and set(pivots) <= set(prefix)
        (a, i), (b, j) = pivots
        assert j - i >= 2
        least = min(cost[x] + cost[y] for x, k in prefix for y, m in prefix if m - k >= 2)
        assert cost[a] + cost[b] == least


def test_no_pair_is_lost(spark):
    """All near pairs of a dense vocabulary, where every bigram is in most words."""
    pick = random.Random(9)
    words = {"".join(pick.choice("ab") for _ in range(pick.randint(6, 9))) for _ in range(300)}
    rows = spark.createDataFrame([(w, 5) for w in sorted(words)], "word string, n bigint")
    got = [(r["a"], r["b"]) for r in near_words(rows).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if is_near(a, b))


def test_empty_tables_and_bad_parameters(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling_groups(docs).collect() == []
    assert spelling_groups(spark.createDataFrame([(1, "onceonly")], docs.schema)).collect() == []
    with pytest.raises(ValueError):
        spelling_groups(docs, ratio=1)
