"""Cases in which an operator once did less than the whole job."""

import base64
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewlens import session
from reviewlens.llm import line_dedup as lines
from reviewlens.llm import mixing, pieces, quality, simhash
from reviewlens.llm.components import components
from reviewlens.llm.license_scan import license_scan
from reviewlens.llm.line_dedup import line_dedup
from reviewlens.llm.substring_dedup import substring_dedup
from reviewlens.llm.suffix_dedup import suffix_dedup

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_returns_the_place_in_the_mix(spark, tmp_path, monkeypatch):
    import corpus_pipeline as corpus

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    again = docs.limit(20).withColumn("text", F.concat(F.lit("again "), "text"))
    nulls = docs.limit(9).withColumn("doc_id", F.lit(None).cast("bigint"))
    docs.unionByName(again).unionByName(nulls).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus, "STAGES", corpus.STAGES[-2:])
    got = sorted(corpus.run(spark, str(tmp_path)).collect(), key=lambda r: r["position"])
    read = spark.read.parquet(f"{tmp_path}/documents.parquet").repartition(3, "text")
    order = mixing.mix_sources(read, corpus.MIX, other=corpus.MIX_OTHER, carry=["text", "lang", "n_chars"]).collect()
    order.sort(key=lambda r: r["position"])
    encode = pieces.Codec(pieces.read_vocabulary(pieces.read_model(pieces.MODEL))).encode
    assert [r["position"] for r in got] == list(range(len(order)))
    assert [(r["doc_id"], r["ids"]) for r in got] == [(r["doc_id"], encode(r["carried"]["text"])) for r in order]


def test_quality_rejects_what_only_the_vocabulary_shows(spark):
    pick = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = [" ".join("".join(pick.choices(letters, k=6)) for _ in range(200)) for _ in range(5)]
    junk += [" ".join(base64.b64encode(pick.randbytes(9)).decode() for _ in range(200)) for _ in range(5)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = [(10**6 + i, text, "en") for i, text in enumerate(junk)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    got = {r["doc_id"]: r for r in quality.fitted_rules(both, pieces.read_model(pieces.MODEL)).collect()}
    assert not any(got[10**6 + i]["base_failed"] or got[10**6 + i]["kept"] for i in range(len(junk)))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    gone = lambda label: [not r["kept"] for i, r in got.items() if labels.get(i) == label and not r["base_failed"]]
    assert sum(gone(0)) > 0.3 * len(gone(0)) and sum(gone(1)) < 0.05 * len(gone(1))
    assert len(got) == both.count()


def test_texts_without_ids_are_told_apart_by_more_than_23_bits(spark):
    """Two texts whose 32-bit hashes agree in 23 bits, without ids, next to many other such rows."""
    tail = " ".join(f"w{i}" for i in range(60))
    texts = spark.range(30000).select(F.concat(F.col("id").cast("string"), F.lit(" cc by " + tail)).alias("text"))
    plain = spark.range(30000, 60000).select(F.concat(F.lit("only "), "id").alias("text"))
    bits = lambda frame, name: frame.select(F.col("text").alias(name), F.hash("text").bitwiseAND((1 << 23) - 1).alias("t"))
    long, short = bits(texts, "long").join(bits(plain, "short"), "t").select("long", "short").orderBy("long").first()
    other = long.split(" ", 1)[1]
    rows = [(None, long), (None, short), (1, "first " + other)] + [(None, f"filler {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for operator, kept in ((substring_dedup, "kept_text"), (suffix_dedup, "kept"), (line_dedup, "kept_text")):
        found = operator(docs).collect()
        left = sorted(bytes(r[kept]).decode() if kept == "kept" else r[kept] for r in found if r["doc_id"] is None)
        assert len(left) == 302 and short in left and long not in left, operator.__name__
        assert sum(text.startswith("filler") for text in left) == 300
    labels = [r["base_labels"] for r in license_scan(docs).collect() if r["doc_id"] is None]
    assert sorted(labels) == [""] * 301 + ["cc-by"]


def test_pipeline_keeps_one_row_of_each_group_and_drops_nothing_else(spark):
    import corpus_pipeline as corpus

    lone, copied, third = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(5, lone), (5, copied), (2, copied), (None, copied), (None, third), (None, third), (9, lone), (9, "other words here")]
    docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i, text in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = corpus.drop_near_copies(spark, docs.repartition(3), FOLDER).collect()
    want = [(5, lone), (2, copied), (None, third), (9, "other words here")]
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)


def thue_morse(size: int, letters: str = "ab") -> str:
    return "".join(letters[i.bit_count() & 1] for i in range(size))


def test_words_that_collide_under_any_odd_base_are_told_apart(spark):
    """A Thue-Morse word and its complement have one polynomial hash modulo 2**64."""
    same = [f"w{i}" for i in range(49)]
    word, other = thue_morse(1024), thue_morse(1024, "ba")
    docs = spark.createDataFrame([(1, " ".join([*same, word])), (2, " ".join([*same, other]))], "doc_id bigint, text string")
    assert all(r["n_removed"] == 0 for r in substring_dedup(docs).collect())
    lines = spark.createDataFrame([(1, f"{word}\n{other}"), (2, f"{other} {word} x y z")], "doc_id bigint, text string")
    assert all(r["removed_lines"] == [] for r in line_dedup(lines).collect())
    texts = [f"{word} a b {other} a b " + " ".join(same)]
    got = quality.quality_rules(spark.createDataFrame(list(enumerate(texts)), docs.schema), pieces.read_model(pieces.MODEL))
    assert got.first()["n_repeat_words"] == 0


def test_word_codes_depend_on_the_bytes_of_the_word_alone():
    import numpy as np

    from reviewlens.llm import text as T

    pick = random.Random(3)
    words = ["".join(pick.choice("abé") for _ in range(pick.randint(1, 40))) for _ in range(3000)] + ["x" * 9, "x" * 8, "x" * 16, "xy" * 300_000]
    codes = {}
    for join in (" ", "\n  "):
        data = np.frombuffer(join.join(pick.sample(words, len(words))).encode(), dtype=np.uint8)
        start, end, _ = T.words(data, np.array([0, len(data)]))
        for a, b, code in zip(start, end, T.word_codes(data, start, end).tolist(), strict=True):
            assert codes.setdefault(data[a:b].tobytes(), code) == code
    assert len(set(codes.values())) == len(codes) == len(set(words))


def plain_kept(rows, deviations=4, prior=20):
    """Verdicts from rows (lang, script, base_failed, in fixed band, chars, share, entropy), by numpy."""
    import numpy as np

    def ends(values, low_too):
        q1, middle, q3 = np.percentile(np.round(values, 3), [25, 50, 75])
        step = lambda quartile: max(abs(quartile - middle) / 0.6745, middle / 100, 0.005)
        return middle - deviations * step(q1) if low_too else -np.inf, middle + deviations * step(q3)

    passed = [r for r in rows if not r[2]]
    blend = lambda own, wide, n: tuple((o * n + w * prior) / (n + prior) if np.isfinite(o) else o for o, w in zip(own, wide, strict=True))

    def band(lang, script):
        b = quality.BANDS[script]
        fixed = [(b.least_chars, b.most_chars), (0.0, b.byte_share), (b.entropy, 16.0)]
        of_script = [r for r in passed if r[1] == script]
        own = [r for r in of_script if r[0] == lang]
        out = []
        for i in range(3):
            wide = blend(ends([r[4 + i] for r in of_script], i != 1), fixed[i], len(of_script))
            out.append(blend(ends([r[4 + i] for r in own], i != 1), wide, len(own)))
        return out

    bands = {key: band(*key) for key in {(r[0], r[1]) for r in passed}}
    return [
        r[3] and not r[2] and all(low <= round(r[4 + i], 3) <= high for i, (low, high) in enumerate(bands[r[0], r[1]]))
        for r in rows
    ]


def test_fitted_bands_against_the_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = [(10**6, None, "en"), (10**6 + 1, "", None), (10**6 + 2, "Ёжик и другие слова " * 30, "ru"), (None, "some words here and there " * 20, None)]
    both = docs.unionByName(spark.createDataFrame(odd + odd[2:], docs.schema)).withColumns({"kept": F.lit(1), "script": F.lit("x")})
    model = pieces.read_model(pieces.MODEL)
    langs = both.select("doc_id", F.col("lang").alias("label"))
    fixed = quality.quality_rules(both, model).select("doc_id", "n_words", F.col("kept").alias("within"))
    key = lambda r: (str(r["doc_id"]), r["n_words"])
    within = {key(r): r["within"] for r in fixed.collect()}
    label = {str(r["doc_id"]): r["label"] for r in langs.collect()}
    got = quality.fitted_rules(both.repartition(5), model).collect()
    rows = [(label[str(r["doc_id"])], r["script"], r["base_failed"], within[key(r)], r["chars_per_token"], r["byte_share"], r["token_entropy"]) for r in got]
    assert [r["kept"] for r in got] == plain_kept(rows)
    assert len(got) == 1006 and 0 < sum(r["kept"] for r in got) < 1000
    assert quality.fitted_rules(both.filter("false"), model).collect() == []


def test_a_verdict_does_not_turn_on_the_size_of_its_group(spark):
    """The ends of a band move by little from 50 documents of a language to 150."""
    rows = spark.range(1000).select(
        F.lit("en").alias("lang"), F.lit("latin").alias("script"), F.lit(False).alias("base_failed"),
        (3.0 + F.col("id") % 100 / 500).alias("chars_per_token"), F.lit(0.01).alias("byte_share"), (7 + F.col("id") % 50 / 100).alias("token_entropy"),
    )
    highs = []
    for n in (50, 99, 100, 101, 150):
        small = rows.limit(n).withColumn("lang", F.lit("xx")).withColumn("chars_per_token", F.col("chars_per_token") - 1)
        highs.append(quality.fitted_bands(rows.unionByName(small)).filter("lang = 'xx'").first()["high_chars_per_token"])
    assert abs(highs[1] - highs[2]) < 0.02 and abs(highs[2] - highs[3]) < 0.02 and highs[0] > highs[4] > 2.2


def _scattered_lines() -> list[tuple[int, str]]:
    """Long lines of common words, two of each sharing a word that no other has; the last resembles the first."""
    pick = random.Random(11)
    lines = [pick.sample([f"w{i}" for i in range(600)], 120) + [f"rare{n // 2}"] for n in range(40)]
    lines.append(lines[0][:-4] + ["x1", "x2", "x3"])
    return [(i, " ".join(line)) for i, line in enumerate(lines)]


def test_long_lines_are_not_held_against_all_that_share_a_rare_word(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    docs = spark.createDataFrame(_scattered_lines(), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r["removed_lines"] for r in line_dedup(docs).collect()}
    assert got == {i: [0] if i == 40 else [] for i in range(41)}
    (met,) = tmp_path.glob("**/met-*")
    assert spark.read.parquet(str(met)).filter("a is not null").select("a", "b").distinct().count() == 1


@pytest.mark.parametrize(("hold", "crowd"), [(1 << 20, 1024), (1, 1024), (7, 3), (1, 0), (1 << 20, 2)])
def test_postings_meet_however_few_are_held(monkeypatch, hold, crowd):
    monkeypatch.setattr(lines, "HOLD", hold)
    monkeypatch.setattr(lines, "AT_ONCE", 8)
    pick = random.Random(hold + crowd)
    base = [pick.sample(range(300), 30) for _ in range(6)]
    sets = [sorted({*pick.sample(pick.choice(base), 28), pick.randrange(300)}) for _ in range(60)]
    sets = [[w * 7919 << 8 for w in words] for words in sets]
    code = lambda word, half: 1 << (word // 2027264 * 37 + half) % 64
    parity = lambda words, half: np.bitwise_xor.reduce([np.uint64(code(w, half)) for w in words]).view(np.int64)
    columns = {
        "id": pa.array([8 * i for i in range(60)], pa.int64()),
        "size": pa.array([len(x) for x in sets], pa.int32()),
        "ord": pa.array([i % 20 for i in range(60)], pa.int64()),
        "low": pa.array([parity(x, 0) for x in sets], pa.int64()),
        "high": pa.array([0] * 60, pa.int64()),
        "rare": pa.array([np.array(x[: len(x) - -(-4 * len(x) // 5) + 1], dtype="<u4").tobytes() for x in sets], pa.binary()),
    }
    table = pa.Table.from_pydict(columns)
    blocks = pa.Table.from_batches(lines._post(6)(iter(table.to_batches(max_chunksize=9)))).sort_by("part")
    met = pa.Table.from_batches(lines._meet(lines.SIMILARITY, crowd)(iter(blocks.to_batches(max_chunksize=5)))).to_pylist()
    pairs = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in met if r["a"] is not None}
    dense = {}
    for r in met:
        if r["word"] is not None:
            dense.setdefault(r["word"], set()).add(r["id"])
    alike = [(8 * i, 8 * j) for i in range(60) for j in range(i + 1, 60) if 5 * len({*sets[i]} & {*sets[j]}) >= 4 * len({*sets[i]} | {*sets[j]})]
    assert len(alike) > 50
    assert all((a, b) in pairs or any(a in ids and b in ids for ids in dense.values()) for a, b in alike)
    assert bool(dense) == (crowd < 1024)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_points_around_crowded_fingerprints_are_not_broadcast(spark):
    """Each makes 2145 points, whose size Spark takes for that of the fingerprint."""
    bit = F.expr("shiftleft(1L, cast(id as int))")
    found = simhash.links(spark.range(40).select(bit.alias("mark"), bit.alias("node")), crowd=2)
    plan = _final_plan(found)
    assert re.search(r"SortMergeJoin \[point", plan) and not re.search(r"BroadcastHashJoin \[point", plan)
    assert {r["node"] for r in components(found).collect()} == {1 << i for i in range(1, 40)}


@pytest.mark.parametrize("operator", [simhash.simhash_groups, simhash.first_of_groups])
def test_segments_looked_up_are_not_broadcast(spark, monkeypatch, operator):
    """Each fingerprint makes 66 rows, whose size Spark takes for that of the fingerprint."""
    plans = []
    monkeypatch.setattr(simhash, "components", lambda edges: plans.append(_final_plan(edges)) or components(edges))
    operator(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")).collect()
    assert re.search(r"SortMergeJoin \[key", plans[0]) and not re.search(r"BroadcastHashJoin \[key[^\n]* Inner", plans[0])
