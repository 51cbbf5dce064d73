"""Raw JSON read once, files that are one JSON value, sources with faults, small functions."""

import json
from random import Random

import pytest
from pyspark.sql import functions as F

from reviewlens import sources
from reviewlens.functions import days_before, megabytes, slug
from reviewlens.operators.prepare import harmonise
from reviewlens.sources.choose import reads_whole
from reviewlens.sources.json_values import whole_values

RECORDS = [
    {"parent_asin": "a", "average_rating": 4.5, "description": ["x", None, "y"], "price": 9.5, "rating_number": 3},
    {"parent_asin": None, "average_rating": "3", "description": "text", "features": [], "details": {"Date First Available": "May 1, 2020"}},
    {"parent_asin": "c", "average_rating": "none", "title": "t", "categories": [["n", 1], "m"], "rating_number": "7", "other": {"deep": [1]}},
    {"asin": "z", "title": 5, "details": '{"k": 1}', "store": True},
]


def write(path, lines):
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")
    return str(path)


def test_raw_json_of_mixed_types_is_read_once(spark, tmp_path):
    path = write(tmp_path / "raw.json", [*RECORDS, "", "broken {", "[1]", "  "])
    spark.sparkContext.setJobGroup("raw", "one scan")
    df = sources.read_raw_once(spark, path, "Toys")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("raw")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1, "the table is written by one job, and nothing else has run"
    assert "other" not in df.columns and "main_category" not in df.columns and {"asin", "parent_asin"} <= set(df.columns)
    got = harmonise(df).orderBy(F.asc_nulls_last("product_id"), F.desc_nulls_last("description")).collect()
    assert [r.product_id for r in got] == ["a", "c", None, None, None, None], "a column that occurs is the origin, nulls and all"
    a, c, second = got[0], got[1], got[2]
    assert (a.rating, a.description, a.price, a.rating_number) == (4.5, "x y", "9.5", 3)
    assert (c.rating, c.title, c.categories, c.rating_number) == (None, "t", '["n",1] m', 7)
    assert (second.rating, second.description, second.features) == (3.0, "text", "")
    assert json.loads(second.details) == {"Date First Available": "May 1, 2020"}
    assert any((r.title, r.store, r.details) == ("5", "true", '{"k": 1}') for r in got)
    assert {r.category for r in got} == {"Toys"}


def test_raw_json_agrees_with_inference_on_a_regular_file(spark, tmp_path, rows):
    path = write(tmp_path / "raw.json", [{"asin": f"p{i}", "overall": i / 2, "features": ["a", str(i)], "category": "own"} for i in range(50)])
    one, two = (harmonise(read(spark, path, "Toys")) for read in (sources.read_raw_once, sources.read_raw_products))
    assert rows(one) == rows(two) and one.dtypes == two.dtypes


def test_raw_json_without_known_fields_or_rows(spark, tmp_path):
    odd = harmonise(sources.read_raw_once(spark, write(tmp_path / "odd.json", ['{"q": 1}']), "Toys")).collect()
    assert [(r.product_id, r.category) for r in odd] == [("unknown", "Toys")]
    (tmp_path / "empty.json").write_text("\n")
    assert harmonise(sources.read_raw_once(spark, str(tmp_path / "empty.json"), "Toys")).count() == 0


def test_profiles_of_files_that_are_one_value(spark, tmp_path):
    (tmp_path / "in").mkdir()
    files = {
        "array.json": json.dumps([{"b": 1, "a": [1, 2]}, {"c": 2}, 3], indent=2),
        "object.json": json.dumps({"x": [1, 2, 3], "y": {"z": None}}, indent=1),
        "items.json": '[\n{"a": 1},\n{"a": 2}\n]\n',
        "one line.json": '[{"k": 1}, {"k": 2}]',
        "lines[1].json": '{"a": 1}\n{"b": 2}\n',
        "cut*.json": '[\n{"a": 1},\n{"a": 2},\n',
        "spoiled.json": '{"broken": \n' + '{"a": 1}\n' * 5,
    }
    for name, text in files.items():
        (tmp_path / "in" / name).write_text(text)
    got = {r.file.rsplit("/", 1)[1]: r for r in sources.json_profile(spark, f"{tmp_path}/in").collect()}
    shown = {name: (r.format, r.object_lines, r.array_items, r.first_keys) for name, r in got.items()}
    assert shown == {
        "array.json": ("array", 0, 3, ["b", "a"]),
        "object.json": ("object", 0, None, ["x", "y"]),
        "items.json": ("array", 0, 2, ["a"]),
        "one line.json": ("lines", 0, 2, None),
        "lines[1].json": ("lines", 2, None, ["a"]),
        "cut*.json": ("invalid", 0, None, None),
        "spoiled.json": ("lines", 5, None, ["a"]),
    }
    assert got["array.json"].invalid_lines == 0 and got["spoiled.json"].invalid_lines == 1 and got["cut*.json"].invalid_lines == 3


def test_one_value_of_any_size_is_profiled_by_stretches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = json.dumps({"k": "x" * (1 << 20), "l": [1]})
    with open(tmp_path / "in" / "large.json", "w") as out:  # more than a VARIANT or a row of a whole file may have
        out.write("[\n" + ",\n".join([line] * 140) + "\n]\n")
    row = sources.json_profile(spark, f"{tmp_path}/in").first()
    assert (row.format, row.object_lines, row.array_items, row.first_keys) == ("array", 0, 140, ["k", "l"])


def _made(random, depth):
    kind = random.randrange(7 if depth else 4)
    if kind < 4:
        return [random.randrange(-9, 99), random.choice([True, None, -1.5e-3]), "a]\u00e4\"{", ""][kind]
    if kind < 6:
        return [_made(random, depth - 1) for _ in range(random.randrange(4))]
    return {f"k{i}\n": _made(random, depth - 1) for i in range(random.randrange(4))}


def test_stretches_of_one_value_give_what_the_whole_gives(spark, tmp_path):
    random = Random(3)
    (tmp_path / "in").mkdir()
    texts = {}
    for i in range(60):
        value = [[_made(random, 4) for _ in range(6)], {f"f{j}": _made(random, 4) for j in range(6)}][i % 2]
        text = json.dumps(value, indent=1, ensure_ascii=i % 3 == 0)
        if i >= 30:  # one character lost, doubled or another
            at = random.randrange(2, len(text))
            text = text[: at - random.randrange(2)] + random.choice(["", text[at], *'[]{},:"1']) + text[at + 1 :]
        texts[f"v{i:02}.json"] = text
        (tmp_path / "in" / f"v{i:02}.json").write_text(text, encoding="utf-8")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 40)
        files = [f"{tmp_path}/in/{name}" for name in texts]
        got = {r.path.rsplit("/", 1)[1]: (r.whole_items, r.whole_keys) for r in whole_values(spark, files).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    want = {}
    for name, text in texts.items():
        try:
            value = json.loads(text)
        except ValueError:
            continue
        first = value[0] if isinstance(value, list) and value else value
        pairs = json.loads(text, object_pairs_hook=lambda pairs: [k for k, _ in pairs]) if isinstance(first, dict) else None
        keys = (pairs[0] if isinstance(value, list) else pairs) if pairs is not None else None
        want[name] = (len(value) if isinstance(value, list) else None, keys)
    assert got == want and 30 <= len(want) < 60


def test_a_source_with_a_fault_is_passed_over(spark, tmp_path):
    good, bad = f"{tmp_path}/good", f"{tmp_path}/bad"
    for path in (good, bad):
        spark.range(20).repartition(3).write.parquet(path)
    (tmp_path / "bad" / "part-99999.parquet").write_bytes(b"PAR1 cut off")
    readers = [(name, lambda p=path: spark.read.schema("id bigint").parquet(p)) for name, path in (("bad", bad), ("good", good))]
    assert sources.first_readable(readers).first().source == "good"
    assert sources.first_readable(readers, probe=None).limit(0).columns == ["id", "source"]
    failing = [("late", lambda: spark.range(5).selectExpr("if(id = 4, raise_error('no'), id) id")), readers[1]]
    assert sources.first_readable(failing).limit(1).collect()[0].source == "late", "files are touched, values are not read"
    assert sources.first_readable(failing, reads_whole).first().source == "good"
    with pytest.raises(ValueError, match="bad: "):
        sources.first_readable(readers[:1])


def test_small_functions(spark):
    row = spark.sql("select date'2024-03-01' d, 1 n, cast(null as int) e, 'Toys And Games' t").select(
        days_before(F.col("d"), F.col("n")).cast("string").alias("a"), days_before(F.col("d"), F.lit(-1)).cast("string").alias("b"),
        days_before(F.col("d"), F.col("e")).alias("c"), slug(F.col("t")).alias("s"), megabytes(F.lit(1 << 19)).alias("m"),
    ).first()
    assert tuple(row) == ("2024-02-29", "2024-03-02", None, "toys_and_games", 0.5)
