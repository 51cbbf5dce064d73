"""Personal data: base spans against regular expressions, the field against enumeration and planted cases."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import personal_data as pd
from reviewlens.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD, OTHER = "4539578763621486", "6011000990139424"
ODD = [None, "", " \t\n", "@", "a@b", "a@b.c@d.e.f", "x@@y.z w@v.u", "1.2.3.4.5.6.7.8.9 256.1.1.1 1.2.3", "+1 ", "٣٤ é@ü.de", "\U0001f600 me@here.org 😀 10.0.0.1"]


def luhn(digits):
    values = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(v // 10 + v % 10 for v in values) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0]), s[2]))


def test_base_spans_equal_the_regular_expressions():
    pick = random.Random(3)
    pieces = ["a", "B9", "@", ".", "-", " ", "+", "1", "25", "256", "(", ")", "x.y", CARD, "007", "\n", "é", "%", "_", "4539 5787 6362 1486", "+49 30 1234567", "10.0.0.1"]
    for _ in range(6000):
        text = "".join(pick.choices(pieces, k=pick.randint(1, 14)))
        assert pd.base_spans(text) == plain_spans(text), text
    for text in ODD:
        assert pd.base_spans(text or "") == plain_spans(text)


def test_long_texts_take_linear_time():
    for text in ("1" * 400_000, "a" * 400_000 + "@", "1." * 200_000, "a" * 300_000 + "@b", "+1" * 200_000, "x" * 400_000, "1 " * 200_000, "a.b@" * 100_000):
        pd.base_spans(text)
        pd.Tokens().add(text, pd.matches(text))


def test_messages_are_exact_without_loops():
    pick = np.random.default_rng(5)
    many = len(pd.LABELS)
    own, pairs = pick.normal(size=(5, many)), pick.normal(size=(3, many, many))
    pairs[1:] = pairs[1:] + pairs[1:].transpose(0, 2, 1)
    links = ([(0, 1)], [(1, 3)], [(1, 2), (3, 4)])
    weight = np.zeros((5, many))
    for labels in itertools.product(range(many), repeat=5):
        score = sum(own[i, x] for i, x in enumerate(labels))
        score += sum(pairs[k][labels[a], labels[b]] for k, found in enumerate(links) for a, b in found)
        for i, x in enumerate(labels):
            weight[i, x] += np.exp(score)
    exact = np.log(weight / weight.sum(axis=1, keepdims=True))
    assert np.allclose(pd.beliefs(own, links, pairs, 40), exact, atol=1e-6)


def test_the_fit_reaches_the_largest_pseudo_likelihood_of_two_forms():
    """With one form and no links the probabilities are the shares of square roots."""
    rows = [("digits|16|l|||;;3", 900), ("digits|16|l|||;;0", 100)]
    own = pd.fit_patterns(rows, steps=2000, decay=0).own([("digits", "16", "l", "", "", "")])[0]
    assert np.exp(own[3] - own[0]) == pytest.approx(3, rel=0.05)


def corpus():
    pick = random.Random(8)
    say = lambda n: " ".join(pick.choice(["the", "house", "was", "red", "and", "old"]) for _ in range(n))
    ip = lambda: ".".join(str(pick.randint(1, 255)) for _ in range(4))
    phone = lambda: f"+1 ({pick.randint(100, 999)}) 555-{pick.randint(1000, 9999)}"
    rows = []
    for i in range(300):
        thing = [f"user.{i}@mail{i % 7}.example.com", ip(), CARD, phone(), f"v{i % 9}.2", str(pick.randint(1, 99)), "1234567890123456"][i % 7]
        rows.append(f"{say(6)} {thing} {say(5)}" + (f" {thing} {say(2)}" if i % 3 == 0 else ""))
    return rows


def test_the_field_adds_what_patterns_lose_and_nothing_else(spark):
    rows = corpus()
    model = pd.fit(spark.createDataFrame([(text,) for text in rows], "text string"))
    lost = {
        f"pay {CARD} {OTHER} now": [CARD, OTHER],
        "call +1 (663) 555-6869 227.5.221.1 today": ["+1 (663) 555-6869"],
        "write to user.9@mail2.example.com or user.9@mail2.example.com": [],
        "version 2.0 of 16 and 1234567890123456 twice 1234567890123456": [],
        "no numbers at all": [],
    }
    docs = spark.createDataFrame(list(enumerate(lost)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["spans"] for r in pd.personal_data(docs, model).collect()}
    for i, (text, want) in enumerate(lost.items()):
        assert [text[s["start"] : s["end"]] for s in got[i] if not s["base"]] == want, text
        assert [(s["kind"], s["start"], s["end"]) for s in got[i] if s["base"]] == plain_spans(text)


def test_a_distant_mention_decides_a_doubtful_token():
    """The same token with and without a linked mention that is known: only the skip tells."""
    rows = [("dial|9||||;;0", 50), ("dial|9||||;;5", 40), ("dial|9||||;1<4;5", 90), ("dial|9||||;1>4;5", 90), ("dial|9||||;1<0;0", 60), ("dial|9||||;1>0;0", 60)]
    model = pd.fit_patterns(rows)
    form = ("dial", "9", "", "", "", "")
    alone = pd.Tokens([(0, 9)], [form], [-1])
    linked = pd.Tokens([(0, 9), (20, 29), (40, 49)], [form] * 3, [5, -1, -1], ([], [(0, 1), (1, 2)], []))
    assert pd.label(alone, model) == [0] and pd.label(linked, model) == [5, 5, 5]


def test_rows_tables_and_clashing_columns(spark):
    texts = ODD + corpus()[:20] + ["9" * 30_000, f"{CARD} " * 3000]
    rows = list(enumerate(texts)) + [(5, texts[5]), (5, "again 10.0.0.9"), (None, "x 10.0.0.8"), (None, "x 10.0.0.8")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"spans": F.lit(1), "kind": F.lit("k"), "held": F.lit(2)})
    got = pd.personal_data(docs.repartition(3), pd.fit(docs), carry=["spans", F.col("text").alias("source")]).collect()
    have = sorted((str(r["doc_id"]), str(r["carried"]["source"]), [tuple(s)[:3] for s in r["spans"] if s["base"]]) for r in got)
    assert have == sorted((str(i), str(text), plain_spans(text)) for i, text in rows)
    assert {r["carried"]["spans"] for r in got} == {1}
    none = docs.filter("false")
    assert pd.personal_data(none, pd.fit(none)).collect() == []
    assert [r["spans"][0]["base"] for r in pd.personal_data(docs.filter("doc_id is null"), pd.fit(none)).collect()] == [True, True]


def test_the_query_against_the_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op12_pii"](spark, folder).collect()
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        base = plain_spans(texts[r["doc_id"]])
        told = [":".join(map(str, s)) for s in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
        assert set(told) <= set(r["spans"].split(","))
