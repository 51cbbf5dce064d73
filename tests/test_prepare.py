import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlens.operators import prepare
from reviewlens.plans import datasets
from reviewlens.schemas import PROCESSED


def test_all_shapes_come_to_one_schema(spark):
    shapes = [
        spark.sql(
            "select 'A1' parent_asin, 'zz' asin, 't' title, 4.5D average_rating, 7L rating_number, '9.99' price, "
            "'m' main_category, 's' store, array('a', null, 'b') description, array('f') features, "
            "array('x', 'y') categories, '{}' details"
        ),
        spark.sql("select 'B1' asin, 't' title, 3.0D overall, 9.99D price, 'd' description, 'own' category"),
        spark.sql("select 1 nothing"),
    ]
    done = [prepare.harmonise(prepare.with_category(df, "Electronics")) for df in shapes]
    kinds = [(f.name, f.dataType) for f in PROCESSED.fields]
    assert all([(f.name, f.dataType) for f in df.schema.fields] == kinds for df in done)
    first, second, third = (df.first() for df in done)
    assert (first.product_id, first.rating, first.description, first.categories) == ("A1", 4.5, "a b", "x y")
    assert (first.category, second.category) == ("Electronics", "own")
    assert (second.product_id, second.rating, second.price) == ("B1", 3.0, "9.99")
    assert (third.product_id, third.rating, third.title) == ("unknown", None, None)


def test_the_id_is_chosen_per_dataset_not_per_row(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "b")], "parent_asin string, asin string")
    ids = [r.product_id for r in prepare.harmonise(prepare.with_category(df, "c")).collect()]
    assert sorted(ids, key=str) == [None, "a"] or sorted(ids, key=str) == ["a", None]


def test_details_survive_so_dates_can_be_extracted(spark):
    df = spark.createDataFrame(
        [
            ("a", '{"Date First Available": "March 5, 2019"}'),
            ("b", '{"Date First Available": "5 March 2019"}'),
            ("c", "{}"),
            ("d", None),
        ],
        "parent_asin string, details string",
    )
    extract = prepare.time_extract(prepare.harmonise(prepare.with_category(df, "c")))
    assert [(r.product_id, str(r.review_date)) for r in extract.collect()] == [("a", "2019-03-05")]


def test_length_cascade(spark, rows):
    data = [
        ("abc", "zz", "t"), (None, "ab", "t"), ("", "xy", None), ("", "", "t"), (None, None, None),
    ]
    df = spark.createDataFrame(
        [(str(i), *d, 4.0, "c") for i, d in enumerate(data)],
        "product_id string, description string, features string, title string, rating double, category string",
    )
    assert rows(prepare.length_extract(df), "product_id", "review_length") == [
        ("0", 3), ("1", 2), ("2", 2), ("3", 1),
    ]
    only_title = df.drop("description", "features")
    assert rows(prepare.length_extract(only_title), "product_id", "review_length") == [
        ("0", 1), ("1", 1), ("3", 1),
    ]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.none() | st.text(alphabet="aé😀 \n", max_size=4)] * 3), min_size=1, max_size=20))
def test_length_is_that_of_the_first_text_with_any(spark, texts):
    df = spark.createDataFrame(
        [(str(i), *t, 1.0, "c") for i, t in enumerate(texts)],
        "product_id string, description string, features string, title string, rating double, category string",
    )
    ours = {r.product_id: r.review_length for r in prepare.length_extract(df).collect()}
    expected = {str(i): next((len(x) for x in t if x), 0) for i, t in enumerate(texts)}
    assert ours == {k: n for k, n in expected.items() if n}


def test_missing_columns_are_named(spark):
    with pytest.raises(prepare.MissingColumns, match="rating"):
        prepare.rating_pairs(spark.sql("select 'a' product_id"))


def test_dual_keys_skip_blanks(spark, rows):
    df = spark.createDataFrame([("p", 1.0, " "), (None, 2.0, "c")], "product_id string, rating double, category string")
    assert rows(prepare.dual_keys(df)) == [("CATEGORY", "c", 2.0), ("PRODUCT", "p", 1.0)]


def test_routing_of_prefixed_keys(spark, rows):
    lines = spark.createDataFrame([("CATEGORY_toys", 1), ("p1", 2)], "key string, n int")
    assert rows(prepare.route_keys(lines)) == [("CATEGORY", "toys", 1), ("PRODUCT", "p1", 2)]
    odd = spark.createDataFrame([("OTHER",), ("PRODUCT",)], "item_type string")
    assert prepare.known_items(odd).count() == 1


def test_sample_covers_the_whole_input_in_any_layout(spark):
    df = spark.range(0, 1_000_000, 1, 8)
    drawn = [r.id for r in prepare.row_sample(df).orderBy("id").collect()]
    assert 9_000 < len(drawn) < 11_000 and drawn[0] < 1_000 and drawn[-1] > 999_000
    tenths = [sum(x // 100_000 == i for x in drawn) for i in range(10)]
    assert min(tenths) > 800
    assert [r.id for r in prepare.row_sample(df.repartition(3)).orderBy("id").collect()] == drawn
    few = [r.id for r in prepare.row_sample(df, rows=1000).collect()]
    assert len(few) == 1000 and set(few) <= set(drawn) and max(few) > 900_000
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "a string, b int")
    assert prepare.row_sample(nulls, 1.0).count() == 2 and prepare.row_sample(nulls.limit(0), rows=5).count() == 0


def test_union_matches_columns_by_name(spark, rows):
    a = spark.createDataFrame([("x", 1.0)], "product_id string, rating double")
    b = spark.createDataFrame([(2.0, "y")], "rating double, product_id string")
    assert rows(datasets.union_all({"a": a, "b": b}), "dataset", "product_id", "rating") == [
        ("a", "x", 1.0), ("b", "y", 2.0),
    ]
    with pytest.raises(ValueError):
        datasets.union_all({})


def test_prepare_leaves_out_what_it_cannot_make(spark, tmp_path):
    df = spark.createDataFrame([("p", 4.0, None)], "product_id string, rating double, details string").withColumn(
        "category", F.lit("c")
    )
    counts = datasets.prepare(df, str(tmp_path / "out"))
    assert counts == {"product_ratings": 1, "time_analysis": 0, "review_length": 0}
    assert not (tmp_path / "out_time_analysis").exists()
