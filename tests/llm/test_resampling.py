"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import resampling
from reviewlens.llm.resampling import append, crc_of, gain_planes, resample, weights

SCHEMA = "doc_id bigint, text string"


def features(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10000 for run in runs]


def slow(docs, target, percent=5, least=20):
    """(id, features, weight, score) of every row, and the drawn (id, weight) in order."""
    own, wanted = Counter(), Counter()
    for _, text in docs:
        own.update(features(text)[1])
    for text in target:
        wanted.update(features(text)[1])
    s, t = sum(own.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s + 10000) / ((own[b] + 1) * (t + 10000))))
    rows, pool = [], []
    for key, text in docs:
        count, found = features(text)
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((key, len(found), weight, score))
        if count >= least:
            pool.append((-score, key is None, key or 0, weight))
    return rows, [(None if none else key, weight) for _, none, key, weight in sorted(pool)[: percent * len(pool) // 100]]


def test_crc_of_many_strings_and_of_joined_ones():
    pick = random.Random(1)
    data = np.frombuffer(pick.randbytes(9000), dtype=np.uint8)
    bounds = sorted(pick.choices(range(9001), k=60)) + [8000]
    start, end = np.array(bounds[:-1]), np.array(bounds[1:])
    end = np.maximum(start, end)
    crc = crc_of(data, start, end)
    assert crc.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end, strict=True)]
    joined = append(crc[:-1], (end - start)[1:]) ^ crc[1:]
    for i, value in enumerate(joined.tolist()):
        assert value == zlib.crc32(data[start[i] : end[i]].tobytes() + data[start[i + 1] : end[i + 1]].tobytes())


@pytest.mark.parametrize("low,high", [(-9000, 9000), (0, 5), (-7, -1), (0, 0)])
def test_planes_sum_to_the_product(low, high):
    pick = np.random.default_rng(2)
    counts = pick.integers(0, 4, (9, 10000)) * pick.integers(0, 70000, (9, 10000))
    gain = pick.integers(low, high + 1, 10000)
    assert (weights(counts, gain_planes(gain)) == counts @ gain).all()


def test_against_the_plain_version(spark):
    rows = [(i, text) for i, text in plain.corpus()]
    rows += [(200 + i, text) for i, text in enumerate([None, "", " , ", "Word " * 30_000, "é" * 70_000 + " b", "ÄB ab AB 12-3 " * 9])]
    rows += [(300, "same words here " * 8)] * 3 + [(None, "same words here " * 8)]
    target = [text for _, text in rows[:3]] + ["same words here", None, "other things"]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit("x"), "tag": F.lit(1), "bucket": F.lit(2)})
    aims = spark.createDataFrame([(text,) for text in target], "text string").withColumn("n", F.lit(3))
    got = resample(docs.repartition(5), aims, percent=30, carry=["bucket"]).collect()
    want, drawn = slow(rows, target, 30)
    key = lambda r: (r[0] is None, *map(int, (r[0] or 0, *r[1:])))
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got), key=key) == sorted(want, key=key)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1)) and len(drawn) > 5
    assert [(r["doc_id"], r["weight"]) for r in ranked] == drawn
    assert {r["carried"]["bucket"] for r in got} == {2}


def test_words_are_taken_in_parts_without_a_seam(monkeypatch):
    import pyarrow as pa

    text = " ".join(f"w{i % 37}" for i in range(1000))
    whole = [c for *_, c in resampling.grouped_counts(pa.array([text, "a b c"]))]
    monkeypatch.setattr(resampling, "PART", 7)
    parts = [c for *_, c in resampling.grouped_counts(pa.array([text, "a b c"]))]
    assert (whole[0] == parts[0]).all() and whole[0].sum() == 3 * 1000 - 3 + 6


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a " * 25)], SCHEMA)
    assert resample(none, one).collect() == [] and resample(none, none).collect() == []
    row = resample(one, none, percent=100).first()
    assert (row["rank"], row["n_features"]) == (1, 72)
    assert resample(one, none).first()["rank"] is None, "5 in 100 of one document is none"
