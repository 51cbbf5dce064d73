"""Scans, scores, search, mixing and token ids against plain Python or exact round trips."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import plain
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import language_id, mixing, pieces, quality
from reviewlens.llm.license_scan import PHRASES, REQUIRED, TEMPLATES, license_scan
from reviewlens.llm.vector_search import quantized, top_k

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " \t\n\v\f\r ", "a" * 70_000, "word " * 20_000, "ü∂🙂 日本語 " * 40, "\x00\x01 x", "#$% 12 34"]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(pieces.MODEL)


def frame(spark, texts, **others):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return rows.withColumns({name: F.lit(value).cast("string") for name, value in others.items()})


# licenses


def test_licenses(spark):
    texts = ODD + [f"Intro\n{text}.\nmore" for text in TEMPLATES.values()]
    texts += ["CC-BY cc by Cc  BY", "cc BY\nNC 4", "GNU General\nPublic License all RIGHTS reserved", "cc by" * 3, "ı cc by İ"]
    texts += [" ".join(reversed(TEMPLATES["mit"].split())), " ".join(TEMPLATES["bsd"].split()[:17]), "x " * 3000 + "cc by"]
    texts += ["K", "all rightsé reserved", texts[-1]]
    got = license_scan(frame(spark, texts, words=1, ord=2, label=3, tag=4)).collect()
    have = {r["doc_id"]: tuple(r)[1:] for r in got}
    assert have == {i: plain.licenses(text, PHRASES, TEMPLATES, REQUIRED) for i, text in enumerate(texts)}


def test_license_headers_are_found_over_line_breaks_and_versions_apart(spark):
    texts = {
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
        "documentation files (the \"Software\"), to deal\nin the Software without restriction, including": "mit",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that "
        "the following conditions\nare met:": "bsd",
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy": "mpl-2.0",
        "   Licensed under the Apache License,\n   Version 2.0 (the \"License\");": "apache-2.0",
        "This work is licensed under the GNU General Public License, version 2.": "gpl,gpl-2.0",
        "This work is licensed under the GNU General Public License,\nversion 3.": "gpl,gpl-3.0",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
        "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa-4.0",
        "licensed " + "x " * 20 + "under the apache " + "y " * 20 + "license version 2 0": "",
    }
    got = license_scan(frame(spark, list(texts))).collect()
    assert [r["labels"] for r in sorted(got, key=lambda r: r["doc_id"])] == list(texts.values())


def test_licenses_of_no_rows(spark):
    assert license_scan(frame(spark, ["cc by"]).filter("false")).collect() == []


def test_licenses_run_no_python(spark):
    plan = license_scan(frame(spark, ["cc by"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# quality


def test_quality(spark, model):
    texts = ODD + [text for _, text in plain.corpus()] + ["one two three " * 30, "\n".join(["a line here"] * 30)]
    got = quality.quality_rules(frame(spark, texts, n_words=1, row=2), model).collect()
    assert {r["doc_id"]: tuple(r)[1:7] for r in got} == {i: plain.quality(text) for i, text in enumerate(texts)}
    for row in got:
        text = texts[row["doc_id"]] or ""
        assert not (row["base_failed"] and row["kept"])
        assert row["n_tokens"] == 0 or abs(row["chars_per_token"] - len(text) / row["n_tokens"]) < 1e-9


def test_quality_bands(spark, model):
    pick = random.Random(1)
    prose = " ".join("".join(pick.choice("etaoinshr") for _ in range(pick.randint(2, 7))) for _ in range(200))
    noise = " ".join("".join(chr(pick.randint(0x100, 0x24F)) for _ in range(12)) for _ in range(120))
    got = {r["doc_id"]: r for r in quality.quality_rules(frame(spark, [prose, noise]), model).collect()}
    assert got[0]["kept"] and not got[1]["base_failed"]
    assert not got[1]["kept"] and got[1]["byte_share"] > quality.BANDS["latin"].byte_share


# languages


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language_id.identify(docs, language_id.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.select("*", language_id.held_out().alias("held_out")).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    tried = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in tried) >= 0.97 * len(tried)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_documents_change_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    swapped = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    one, other = (language_id.identify(docs, language_id.fit(d)) for d in (docs, swapped))
    assert one.exceptAll(other).count() == 0


def slow_bits(frozen, text, k):
    symbols = [int(frozen.symbol[b]) for b in b"\n" * language_id.ORDER + text.encode()]
    size, total = int(frozen.symbol.max()) + 1, 0.0
    for i in range(language_id.ORDER, len(symbols)):
        key = 0
        for s in symbols[i - language_id.ORDER : i]:
            key = key * size + s
        total += float(frozen.bits[frozen.context[key] * size + symbols[i], k])
    return total


def test_code_lengths(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    frozen = language_id.fit(docs)
    sums = (2.0 ** -frozen.bits.astype("float64")).reshape(-1, int(frozen.symbol.max()) + 1, len(frozen.languages)).sum(axis=1)
    assert abs(sums - 1).max() < 1e-4, "every context's probabilities add up to one"
    texts = ["a", "", "Die der", "", "xé", "la " * 50]
    data, offsets = language_id.T.texts(language_id.pa.array(texts))
    bits = language_id.code_lengths(frozen, data, offsets)
    for i, text in enumerate(texts):
        for k in range(len(frozen.languages)):
            assert abs(bits[i, k] - slow_bits(frozen, text, k)) < 1e-3 * (1 + len(text))


def test_odd_texts_have_no_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = frame(spark, ODD, lang_pred="x", row="y", score="z")
    got = {r["doc_id"]: r for r in language_id.identify(rows, language_id.fit(docs)).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 7)] == ["und"] * 4 and got[0]["score"] == 0
    none = language_id.identify(rows, language_id.fit(docs.filter("false"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


# search


def test_search(spark):
    pick = random.Random(3)
    vector = lambda d: [pick.uniform(-1, 1) for _ in range(d)]
    rows = [(i, vector(24), "x") for i in range(300)] + [(i, [0.5] * 24, None) for i in range(300, 330)]
    rows += [(400, None, ""), (401, [float("nan")] * 24, ""), (402, [None] * 24, ""), (403, [float("inf")] * 24, "")]
    rows += [(None, vector(24), ""), (404, [], ""), (405, vector(3), ""), (406, vector(3), ""), (300, [0.5] * 24, "")]
    found = quantized(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, size string"))
    valid = [(r["vec_id"], list(r["vector"])) for r in found.collect()]
    assert len(valid) == 333
    got = top_k(found, found.filter("vec_id % 5 = 0"), 5, block=64).collect()
    queries = {v: x for v, x in valid if v % 5 == 0}
    assert {tuple(r) for r in got} == plain.nearest(valid, list(queries.items()), 5)
    assert top_k(found.filter("false"), found.filter("false")).collect() == []
    assert top_k(found, found.filter("false")).collect() == []


def test_search_with_large_components(spark):
    rows = [(i, [(-1) ** i * (2**40 + i * 977), i * 3, 7]) for i in range(20)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    small = spark.createDataFrame([(i, [x % 10**6 for x in v]) for i, v in rows], vectors.schema)
    got = top_k(small, small, 3).collect()
    assert {tuple(r) for r in got} == plain.nearest([(i, [x % 10**6 for x in v]) for i, v in rows], [(i, [x % 10**6 for x in v]) for i, v in rows], 3)


# mixing


@pytest.mark.parametrize("seed", range(30))
def test_periods_keep_every_window(seed):
    pick = random.Random(seed)
    weights = {f"s{i}": pick.randint(1, pick.choice([3, 12, 40])) for i in range(pick.randint(1, 9))}
    total, given = sum(weights.values()), dict.fromkeys(weights, 0)
    for slot, name in enumerate(mixing.period(weights)):
        i, w = given[name], weights[name]
        assert i * total // w <= slot < -(-(i + 1) * total // w)
        given[name] += 1
        assert all(abs(Fraction((slot + 1) * weights[s], total) - given[s]) < 1 for s in weights)
    assert given == weights


def test_mix(spark):
    pick = random.Random(5)
    rows = [(i, pick.choice(["a"] * 6 + ["b", "c", "c", "zz", None]), "t") for i in range(700)]
    rows += [(3, "a", "again"), (None, "b", "none")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, slot string").repartition(4)
    weights = {"a": 3, "b": 2, "c": 4, "absent": 7}
    got = sorted(mixing.mix_sources(docs, weights, 16, 2, carry=["slot"]).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(len(rows)))
    assert sorted(((r["doc_id"], r["source"], r["carried"]["slot"]) for r in got), key=repr) == sorted(rows, key=repr)
    streams = {}
    for r in got:
        streams.setdefault(r["stream"], []).append(r)
        assert r["release"] <= r["slot"] < r["deadline"]
    for rs in streams.values():
        keys = [hashlib.md5(str("" if r["doc_id"] is None else r["doc_id"]).encode()).hexdigest() for r in rs]
        assert keys == sorted(keys) and [r["block"] for r in rs] == [i // 16 for i in range(len(rs))]
    blocks = {s: -(-len(rs) // 16) for s, rs in streams.items()}

    def period(weights):
        common = mixing.gcd(*weights.values())
        return mixing.period({s: w // common for s, w in weights.items()})

    want = plain.mixed(blocks, {**weights, mixing.OTHER: 2}, period)
    assert [want[r["slot"]] for r in got] == [(r["stream"], r["block"]) for r in got]
    assert mixing.mix_sources(docs.filter("false"), weights).collect() == []


def test_mix_refuses_bad_weights(spark):
    with pytest.raises(ValueError):
        mixing.mix_sources(frame(spark, [], source="a"), {"a": 0})


# token ids


def random_texts():
    pick = random.Random(11)
    alphabet = "ab the  \n\t.éñ日本ß🙂,=*-_aeiou"
    fuzz = ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 80))) for _ in range(600)]
    return fuzz + ["a" * 5000, " " * 700, "ab" * 999, "=" * 1000, "the" * 800, "日本語" * 300, " x", "x ", ""]


def test_bpe_ids_are_the_librarys(model):
    import sentencepiece

    library, codec = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Codec(pieces.read_vocabulary(model))
    texts = random_texts() + [text for _, text in plain.corpus() if text]
    assert [codec.encode(text) for text in texts] == library.encode(texts)
    assert all(codec.decode(codec.encode(text)) == text for text in texts)
    assert codec.window <= 3 * codec.longest, "ids come out as paths meet, whatever the text's length"


def test_letters_are_segmented_once_whatever_stands_beside_them(model):
    codec = pieces.Codec(pieces.read_vocabulary(model))
    codec.encode("Stadt Stadt, Stadt. Stadt!! Stadt?) (Stadt) Stadt2")
    assert {word for word in codec.known if "t" in word} == {"▁Stadt", "Stadt"}


def test_a_memo_holds_no_more_than_its_size_and_keeps_what_is_asked_for():
    asked = []
    memo = pieces._Memo(lambda key: asked.append(key) or -key, 20, lambda key: key < 1000)
    for key in range(200):
        assert (memo[key], memo[0], memo[2000]) == (-key, 0, -2000)
        assert len(memo) + len(memo.older) <= 20
    assert asked.count(0) == 1 and asked.count(2000) == 200


def test_a_text_goes_to_the_workers_once(spark):
    docs = frame(spark, ["one", None, "zwei"]).selectExpr("*", "'de' lang")
    found = language_id.identified_rows(docs, language_id.fit(docs))
    assert re.search(r"MapInArrow run\(row#\d+\)", found._jdf.queryExecution().analyzed().toString())


def test_unigram_ids_have_the_best_score():
    pick = random.Random(2)
    rows = {"".join(pick.choice("▁abc") for _ in range(pick.randint(1, 4))): -pick.random() * 9 for _ in range(90)}
    rows |= {c: rows.get(c, -9.5) for c in "▁abc"}
    names = ("<unk>", *rows)
    vocabulary = pieces.Vocabulary(pieces.UNIGRAM, names, (0.0, *rows.values()), (2, *[1] * len(rows)), False, True)
    codec = pieces.Codec(vocabulary)
    for _ in range(200):
        text = "".join(pick.choice("abc ") for _ in range(pick.randint(1, 120)))
        whole, best = "▁" + text.replace(" ", "▁"), [0.0]
        for end in range(1, len(whole) + 1):
            best.append(max(best[s] + rows[whole[s:end]] for s in range(max(0, end - 4), end) if whole[s:end] in rows))
        found = codec.encode(text)
        assert abs(sum(vocabulary.scores[i] for i in found) - best[-1]) < 1e-6
        assert codec.decode(found) == text
    assert codec.window < 120


def test_round_trip(spark, model):
    texts = ODD + [text for _, text in plain.corpus()]
    docs = frame(spark, texts, ids="clash", window="clash", id="clash")
    got = {r["doc_id"]: r for r in pieces.round_trip(docs, model).collect()}
    assert got[0]["ids"] is None and got[0]["round_trip"] is None and got[1]["ids"] == []
    assert all(r["round_trip"] for i, r in got.items() if texts[i] is not None)
    back = pieces.decode(pieces.encode(docs, model), model).collect()
    assert {r["doc_id"]: r["decoded"] for r in back} == dict(enumerate(texts))
    assert pieces.round_trip(docs.filter("false"), model).collect() == []


# queries and pipeline


def test_registered():
    import __spark_entry__ as entry
    from reviewlens.llm.queries import QUERIES, SQL

    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", ["op4_license", "op5_substring_dedup", "op6_topk", "op11_resampling", "op13_spelling"])
def test_sql(spark, name):
    from compare import difference, duck

    from registry import Query
    from reviewlens.llm.queries import QUERIES, SQL

    assert difference(spark, duck(FOLDER), Query(QUERIES[name], SQL[name]), FOLDER) is None


def test_pipeline(spark):
    import corpus_pipeline as corpus

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(900, None, None, None, None), (901, "12 34", "en", "src0", 5), (None, "a b c", None, None, 5)], docs.schema)
    docs = docs.unionByName(extra)
    told = corpus.identify_language(spark, docs, FOLDER).cache()
    ids = {r["doc_id"] for r in told.collect()}
    assert told.columns == corpus.COLUMNS and ids == {r["doc_id"] for r in docs.collect()} - {900, 901}
    rows = [tuple(r) for r in told.select(F.coalesce("doc_id", F.lit(plain.LAST)), F.hash("text"), "text").collect()]
    lines = corpus.drop_lines(spark, told, FOLDER).cache()
    want = {key[0]: text for key, (gone, text) in plain.repeated_lines(rows).items() if not gone or plain.WORD.search(text)}
    have = {r["doc_id"] if r["doc_id"] is not None else plain.LAST: r for r in lines.collect()}
    assert lines.columns == corpus.COLUMNS and {i: r["text"] for i, r in have.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in have.values())
    near = corpus.drop_near_copies(spark, lines, FOLDER).cache()
    marks = [(i, plain.fingerprint(r["text"])) for i, r in have.items() if i < plain.LAST]
    first = {i for (i, _), low in zip(marks, plain.groups(marks), strict=True) if i == low}
    assert {r["doc_id"] for r in near.collect()} == first | {None} and near.columns == corpus.COLUMNS
    mix = corpus.mix(spark, near, FOLDER)
    assert mix.columns == corpus.COLUMNS and sorted(map(repr, mix.collect())) == sorted(map(repr, near.collect()))
    order = sorted(mixing.mix_sources(near, corpus.MIX, other=corpus.MIX_OTHER).collect(), key=lambda r: r["position"])
    assert [r["doc_id"] for r in mix.collect()] == [r["doc_id"] for r in order]
    last = corpus.encode(spark, mix, FOLDER).collect()
    assert len(last) == len(first) + 1 and all(r["round_trip"] for r in last)
