"""Dedup operators against plain Python, on texts with nulls, copies, ties and clashing columns."""

import plain
import pytest
from pyspark.sql import functions as F

from reviewlens.llm.components import components
from reviewlens.llm.frames import identified
from reviewlens.llm.line_dedup import line_dedup
from reviewlens.llm.simhash import simhash_groups
from reviewlens.llm.substring_dedup import substring_dedup
from reviewlens.llm.suffix_dedup import suffix_dedup

CLASHING = "ord tag name size words row pieces key word n carried component node mark".split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(plain.corpus(), "doc_id bigint, text string").repartition(5)
    return rows.withColumns({name: F.lit(None).cast("string") for name in CLASHING}).cache()


@pytest.fixture(scope="module")
def keyed(docs):
    return [(r["ord"], r["tag"], r["text"]) for r in identified(docs).collect()]


def by_id(docs, result, keyed, value):
    """Results by (ord, tag), through the texts' ids; rows alike must have equal results."""
    out = {}
    for row in result:
        out.setdefault(row["doc_id"] if row["doc_id"] is not None else plain.LAST, []).append(value(row))
    return {key: sorted(values, key=repr) for key, values in out.items()}


def expected(keyed, want):
    out = {}
    for o, t, _ in keyed:
        out.setdefault(o, []).append(want[o, t])
    return {key: sorted(values, key=repr) for key, values in out.items()}


@pytest.mark.parametrize(("width", "gram"), [(50, 20), (8, 3)])
def test_substrings(docs, keyed, width, gram):
    got = substring_dedup(docs, width, gram).collect()
    have = by_id(docs, got, keyed, lambda r: (r["n_words"], r["n_removed"], r["kept_text"]))
    assert have == expected(keyed, plain.repeated_words(keyed, width))
    for row in got:
        assert sum(s["end"] - s["start"] for s in row["spans"]) == row["n_removed"]


@pytest.mark.parametrize(("width", "gram", "crowd"), [(100, 24, 1 << 14), (100, 24, 1), (40, 9, 3)])
def test_suffixes(docs, keyed, width, gram, crowd):
    got = suffix_dedup(docs, width, gram, crowd).collect()
    have = by_id(docs, got, keyed, lambda r: (r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])))
    assert have == expected(keyed, plain.repeated_bytes(keyed, width))


@pytest.mark.parametrize("crowd", [32, 1])
def test_lines(docs, keyed, crowd):
    got = line_dedup(docs, crowd=crowd, carry=["ord", "text"]).collect()
    have = by_id(docs, got, keyed, lambda r: (r["removed_lines"], r["kept_text"] or ""))
    assert have == expected(keyed, plain.repeated_lines(keyed))
    assert all(r["carried"]["ord"] is None for r in got)
    nulls = [r for r in got if r["carried"]["text"] is None]
    assert [(r["n_lines"], r["kept_text"]) for r in nulls] == [(0, None)]


@pytest.mark.parametrize("crowd", [32, 1, 0])
def test_simhash(docs, keyed, crowd):
    with_id = [(o, plain.fingerprint(x)) for o, _, x in keyed if o < plain.LAST]
    want = plain.groups(with_id)
    got = simhash_groups(docs.filter("doc_id is not null"), crowd).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == sorted(
        (i, f"{mark:016x}", low) for (i, mark), low in zip(with_id, want, strict=True)
    )


def test_simhash_without_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (None, "quite another text"), (3, "quite another text"), (4, None), (5, "")]
    got = simhash_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"]) == [(3, 3), (4, 4), (5, 4)]
    assert sorted(str(r["component_id"]) for r in got if r["doc_id"] is None) == ["3", "None", "None"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 102), (101, 102), (7, 7), (200, 200), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 0), 101: 100, 102: 100, 103: 100}


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup, line_dedup, simhash_groups])
def test_no_rows(spark, operator):
    assert operator(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
