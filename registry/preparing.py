from pyspark.sql import functions as F

from reviewlens import views
from reviewlens.functions import days_before, megabytes, slug
from reviewlens.operators import prepare
from reviewlens.plans import datasets
from reviewlens.schemas import LENGTH_EXTRACT, RATING_PAIR, TIME_EXTRACT
from reviewlens.session import scratch_path
from reviewlens.sinks import write_csv, write_json, write_json_or_reject
from reviewlens.sources import read_events, read_json_pairs, read_raw_once, read_raw_products

from registry.core import query
from registry.sql import RAW, TEXT_PRODUCTS

DETAILS = """case when p_size <= 35 then '{"Date First Available": "' || strftime(available, '%B %-d, %Y') || '", "Rank": 1}'
                  when p_size <= 42 then '{"Date First Available": "' || strftime(available, '%-d %B %Y') || '", "Rank": 1}'
             end as details"""


def _raw_json(spark, folder):
    """Raw products written as gz JSON Lines."""
    path = scratch_path(spark, "raw_json")
    write_json(views.raw_products(spark, folder), path, "gzip")
    return path


@query(
    "harmonise_arrays",
    f"""with {RAW}
    select product_id, title, rating, rating_number, price, main_category, store, description,
           features, categories, {DETAILS}, 'Parts' as category from raw""",
)
def harmonise_arrays(spark, folder):
    """gz JSON Lines with array columns, read once and brought to the processed schema."""
    return prepare.harmonise(read_raw_once(spark, _raw_json(spark, folder), "Parts"))


@query(
    "harmonise_inferred",
    f"""with {RAW}
    select product_id, title, rating, rating_number, price, main_category, store, description,
           features, categories, {DETAILS}, 'Parts' as category from raw""",
)
def harmonise_inferred(spark, folder):
    """The same with Spark's own inference of all columns."""
    return prepare.harmonise(read_raw_products(spark, _raw_json(spark, folder), "Parts"))


@query(
    "harmonise_plain",
    """select 'B' || p_partkey as product_id, p_name as title, p_size / 10.0::double as rating,
              cast(null as bigint) as rating_number, cast(p_retailprice as varchar) as price,
              cast(null as varchar) as main_category, cast(null as varchar) as store,
              p_type as description, cast(null as varchar) as features,
              cast(null as varchar) as categories, cast(null as varchar) as details, p_brand as category
       from part""",
)
def harmonise_plain(spark, folder):
    return prepare.harmonise(prepare.with_category(views.raw_products_plain(spark, folder), "Parts"))


@query(
    "harmonise_bare",
    """select 'unknown' as product_id, p_name as title, cast(null as double) as rating,
              cast(null as bigint) as rating_number, cast(null as varchar) as price,
              cast(null as varchar) as main_category, p_brand as store,
              cast(null as varchar) as description, cast(null as varchar) as features,
              cast(null as varchar) as categories, cast(null as varchar) as details, 'Parts' as category
       from part""",
)
def harmonise_bare(spark, folder):
    return prepare.harmonise(prepare.with_category(views.raw_products_bare(spark, folder), "Parts"))


@query(
    "rating_pairs",
    f"with {TEXT_PRODUCTS} select product_id, rating from text_products where rating is not null",
)
def rating_pairs(spark, folder):
    return prepare.rating_pairs(views.text_products(spark, folder))


@query(
    "time_extract",
    f"""with {RAW}
    select product_id, cast(available as varchar) as review_date, rating, 'Parts' as category
    from raw where p_size <= 35""",
)
def time_extract(spark, folder):
    raw = prepare.with_category(views.raw_products(spark, folder), "Parts")
    return prepare.time_extract(prepare.harmonise(raw))


@query(
    "length_extract",
    f"""with {TEXT_PRODUCTS}
    select product_id, cast(coalesce(nullif(length(description), 0), nullif(length(features), 0),
           length(title)) as int) as review_length, rating, category
    from text_products
    where coalesce(nullif(length(description), 0), nullif(length(features), 0), length(title), 0) > 0""",
)
def length_extract(spark, folder):
    return prepare.length_extract(views.text_products(spark, folder))


@query(
    "field_lengths",
    f"""with {TEXT_PRODUCTS}
    select product_id, cast(coalesce(length(description), 0) as int) as description_length,
           cast(coalesce(length(features), 0) as int) as features_length,
           cast(coalesce(length(title), 0) as int) as title_length, cast(0 as int) as summary_length
    from text_products""",
)
def field_lengths(spark, folder):
    """Every text's length, and 0 for a column that is not there."""
    measured = prepare.field_lengths(views.text_products(spark, folder), [*prepare.TEXTS, "summary"])
    return measured.select("product_id", *[f"{t}_length" for t in [*prepare.TEXTS, "summary"]])


EVENTS = """events_text as (
  select case when l_linenumber = 6 then null else cast(l_partkey as varchar) end as product_id,
         case when l_linenumber = 7 then null
              else 1 + (cast(floor(l_quantity) as bigint) % 41) / cast(10 as double) end as rating,
         case when l_linenumber = 5 then null else p_type end as category
  from lineitem join part on l_partkey = p_partkey)"""


@query(
    "good_events",
    f"""with {EVENTS}
    select product_id, category, rating, count(*) as events from events_text
    where rating is not null group by all""",
)
def good_events(spark, folder):
    """Events through a CSV file with header, bad ratings dropped, keys trimmed."""
    path = scratch_path(spark, "events_csv")
    write_csv(views.review_events(spark, folder), path)
    events = prepare.good_events(read_events(spark, path))
    return events.groupBy("product_id", "category", "rating").agg(F.count("*").alias("events"))


@query(
    "rejected_events",
    f"""with {EVENTS}, short as (
      select cast(l_partkey as varchar) as product_id, l_linenumber from lineitem where l_linenumber in (1, 2))
    select product_id, category, 'bad' as rating_text, 'rating is not a number' as reason, count(*) as events
    from events_text where rating is null group by all
    union all
    select product_id, null, null, 'too few fields', count(*) from short where l_linenumber = 1 group by all
    union all
    select null, null, '4.0', 'no key', count(*) from short where l_linenumber = 2""",
)
def rejected_events(spark, folder):
    """Events that are left out, for each of the three reasons, from CSV files: bad ratings, rows cut off
    after two fields, rows with neither id nor category."""
    path = scratch_path(spark, "rejected_csv")
    write_csv(views.review_events(spark, folder), path)
    rows = views.table(spark, folder, "lineitem")
    cut = rows.filter("l_linenumber = 1").select(F.concat(F.lit("r,"), F.col("l_partkey").cast("string")))
    blank = rows.filter("l_linenumber = 2").select(F.lit('r," ",u,4.0,"\t"'))
    cut.unionByName(blank.toDF(*cut.columns)).write.option("lineSep", "\n").text(f"{path}-more")
    whole, more = read_events(spark, path), read_events(spark, f"{path}-more", header=False)
    rejected = prepare.rejected_events(whole.unionByName(more))
    return rejected.groupBy("product_id", "category", "rating_text", "reason").agg(
        F.count("*").alias("events")
    )


@query(
    "truthy_pairs",
    """select cast(p_partkey as varchar) as product_id, (p_size % 41) / cast(10 as double) as rating
       from part where p_size % 41 <> 0""",
)
def truthy_pairs(spark, folder):
    parts = views.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        (F.pmod("p_size", F.lit(41)) / F.lit(10.0)).alias("rating"),
    )
    return prepare.truthy_pairs(parts)


@query(
    "sanitise_ids",
    r"""select doc_id, replace(replace(text, chr(9), ' '), chr(10), ' ') as product_id from documents""",
)
def sanitise_ids(spark, folder):
    """Whole documents with tabs and line breaks replaced."""
    documents = views.table(spark, folder, "documents").select("doc_id", F.col("text").alias("product_id"))
    return prepare.sanitised_ids(documents)


@query(
    "column_guard",
    f"""with {RAW}
    select 'product_ratings' as extract, count(*) as row_count from raw
    union all select 'time_analysis', 0 union all select 'review_length', 0""",
)
def column_guard(spark, folder):
    """A dataset without details and category: only the extract whose columns are there is written."""
    raw = prepare.with_category(views.raw_products(spark, folder), "Parts")
    bare = prepare.harmonise(raw).drop("details", "category")
    counts = datasets.prepare(bare, scratch_path(spark, "guarded"))
    return spark.createDataFrame(list(counts.items()), "extract string, row_count bigint")


@query("json_pairs", f"with {RAW} select product_id, rating from raw")
def json_pairs(spark, folder):
    return read_json_pairs(spark, _raw_json(spark, folder))


@query(
    "preprocess_job",
    f"""with {RAW}
    select 'parts_one' as dataset, 'Parts_One' as category, count(*) as n, round(sum(rating), 6) as rating_sum,
           cast(sum(length(description || features || categories)) as bigint) as characters from raw
    union all
    select 'parts_two', 'Parts_Two', count(*), round(sum(rating), 6),
           cast(sum(length(description || features || categories)) as bigint) from raw""",
)
def preprocess_job(spark, folder):
    """Two raw datasets to one processed table partitioned by dataset; a third input is missing."""
    raw = _raw_json(spark, folder)
    output = scratch_path(spark, "processed")
    inputs = {"Parts_One": raw, "Parts_Two": raw, "Absent": f"{raw}-absent"}
    errors = datasets.preprocess(spark, inputs, output)
    if set(errors) != {"Absent"}:
        raise AssertionError(f"unexpected errors: {errors}")
    characters = F.length(F.concat("description", "features", "categories"))
    return (
        spark.read.parquet(output)
        .groupBy("dataset", "category")
        .agg(
            F.count("*").alias("n"),
            F.sum("rating").alias("rating_sum"),
            F.sum(characters).alias("characters"),
        )
    )


@query(
    "prepare_job",
    f"""with {RAW}
    select 'product_ratings' as extract, product_id, rating, null as review_date, null as review_length, null as category from raw
    union all select 'time_analysis', product_id, rating, cast(available as varchar), null, 'Parts' from raw where p_size <= 35
    union all select 'review_length', product_id, rating, null, cast(length(description) as int), 'Parts' from raw""",
)
def prepare_job(spark, folder):
    """All extracts of a processed dataset written as TSV from one scan, then read from the files."""
    target = scratch_path(spark, "prepared")
    raw = prepare.with_category(views.raw_products(spark, folder), "Parts")
    counts = datasets.prepare(prepare.harmonise(raw), target)
    kinds = {"product_ratings": RATING_PAIR, "time_analysis": TIME_EXTRACT, "review_length": LENGTH_EXTRACT}
    read = {
        name: spark.read.schema(kind).option("sep", "\t").csv(f"{target}_{name}") for name, kind in kinds.items()
    }
    if counts != {name: df.count() for name, df in read.items()}:
        raise AssertionError(f"counts differ from the files: {counts}")
    return datasets.union_all(read, "extract")


@query(
    "json_rejects",
    """select doc_id, case when doc_id % 50 = 3 then 'lang, text' when doc_id % 50 = 0 then 'text' end as error,
              case when doc_id % 50 not in (0, 3) then md5(text) end as digest from documents""",
)
def json_rejects(spark, folder):
    """Documents as gz JSON, of which one in 25 holds text that is no UTF-8: those come out as rejects."""
    broken = F.concat(F.unhex(F.lit("C328")), F.lit("x")).cast("string")
    turn = F.col("doc_id") % 50
    documents = views.table(spark, folder, "documents").select(
        "doc_id",
        F.when(turn == 3, broken).otherwise(F.col("lang")).alias("lang"),
        F.when(turn.isin(0, 3), F.concat(F.col("text"), broken)).otherwise(F.col("text")).alias("text"),
    )
    path = scratch_path(spark, "rejects")
    counts = write_json_or_reject(documents, f"{path}/good", f"{path}/bad")
    good = spark.read.schema("doc_id bigint, lang string, text string").json(f"{path}/good")
    bad = spark.read.schema("error string, row struct<doc_id: string>").json(f"{path}/bad")
    rows = good.select("doc_id", F.lit(None).cast("string").alias("error"), F.md5("text").alias("digest")).unionByName(
        bad.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "error"), allowMissingColumns=True
    )
    if sum(counts.values()) != documents.count():
        raise AssertionError(f"rows are missing: {counts}")
    return rows


@query(
    "days_before",
    """select l_orderkey, l_linenumber,
              cast(cast(l_shipdate as date) - cast(floor(l_quantity) as int) as varchar) as ordered,
              cast(null as varchar) as never from lineitem""",
)
def days_before_query(spark, folder):
    """Dates a number of days before an anchor of each row."""
    rows = views.table(spark, folder, "lineitem")
    anchor = F.col("l_shipdate").cast("date")
    return rows.select(
        "l_orderkey", "l_linenumber",
        days_before(anchor, F.floor("l_quantity")).alias("ordered"),
        days_before(anchor, F.lit(None)).alias("never"),
    )


@query("slugs", "select p_partkey, replace(lower(p_type), ' ', '_') as slug, replace(lower(p_name), ' ', '_') as name from part")
def slugs(spark, folder):
    parts = views.table(spark, folder, "part")
    return parts.select("p_partkey", slug(F.col("p_type")).alias("slug"), slug(F.col("p_name")).alias("name"))


@query(
    "megabytes",
    """select source, round(sum(octet_length(encode(coalesce(text, '')))) / 1048576.0::double, 6) as megabytes
       from documents group by source""",
)
def megabytes_query(spark, folder):
    """Sizes of the texts of each source."""
    documents = views.table(spark, folder, "documents")
    size = F.sum(F.octet_length(F.coalesce("text", F.lit(""))))
    return documents.groupBy("source").agg(megabytes(size).alias("megabytes"))
