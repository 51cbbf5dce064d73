from pyspark.sql import Window
from pyspark.sql import functions as F

from reviewlens import views
from reviewlens.operators import ratings, trends
from reviewlens.plans.top_lists import top_job
from reviewlens.session import scratch_path
from reviewlens.sinks import (
    export,
    write_csv,
    write_json,
    write_parquet,
    write_results,
    write_sample,
    write_tsv,
)
from reviewlens.sources import (
    dataset_inventory,
    first_readable,
    json_profile,
    preview,
    read_parquet_dir,
    read_processed,
    read_rating_pairs,
    read_report,
    read_results,
)

from registry.core import query
from registry.ratings import _sections
from registry.sql import MEASURES, RATINGS, REVIEWS, TAGGED
from registry.trends import MONTHLY

REVIEW_COLUMNS = """select product_id, category, store, title, rating, cast(ts as varchar) as timestamp,
  review_length from reviews"""


def _reviews(spark, folder):
    return views.reviews(spark, folder).select(
        "product_id", "category", "store", "title", "rating", "timestamp", "review_length"
    )


@query("roundtrip_parquet", f"with {REVIEWS} {REVIEW_COLUMNS}")
def roundtrip_parquet(spark, folder):
    path = scratch_path(spark, "parquet")
    write_parquet(_reviews(spark, folder), path, ["category"])
    return spark.read.parquet(path)


@query("roundtrip_json", f"with {REVIEWS} {REVIEW_COLUMNS}")
def roundtrip_json(spark, folder):
    path, source = scratch_path(spark, "json"), _reviews(spark, folder)
    write_json(source, path)
    return spark.read.schema(source.schema).json(path)


@query("roundtrip_csv", f"with {REVIEWS} {REVIEW_COLUMNS}")
def roundtrip_csv(spark, folder):
    path, source = scratch_path(spark, "csv"), _reviews(spark, folder)
    write_csv(source, path)
    return spark.read.schema(source.schema).option("header", True).option("escape", '"').csv(path)


@query("roundtrip_tsv", f"with {RATINGS} select product_id, rating from ratings")
def roundtrip_tsv(spark, folder):
    path = scratch_path(spark, "tsv")
    write_tsv(views.ratings(spark, folder).select("product_id", "rating"), path)
    return read_rating_pairs(spark, path)


@query(
    "roundtrip_gzjson",
    """select vec_id, label, cast(len(embedding) as int) as dimensions,
              cast(list_sum(list_transform(embedding, lambda x: cast(floor(x::double * 1000000) as bigint)))
                as bigint) as total
       from embeddings""",
)
def roundtrip_gzjson(spark, folder):
    """Array columns through gz JSON Lines."""
    source = views.table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    path = scratch_path(spark, "gzjson")
    write_json(source, path, "gzip")
    back = spark.read.schema(source.schema).json(path)
    millionths = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000000))
    total = F.aggregate(millionths, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return back.select("vec_id", "label", F.size("embedding").alias("dimensions"), total.alias("total"))


@query("roundtrip_documents", "select doc_id, lang, text from documents")
def roundtrip_documents(spark, folder):
    """Whole multi-line texts through JSON Lines."""
    source = views.table(spark, folder, "documents").select("doc_id", "lang", "text")
    path = scratch_path(spark, "documents")
    write_json(source, path)
    return spark.read.schema(source.schema).json(path)


@query("parquet_directory", f"with {REVIEWS} select category, count(*) as n from reviews group by 1")
def parquet_directory(spark, folder):
    path = scratch_path(spark, "directory")
    write_parquet(_reviews(spark, folder), path)
    files = read_parquet_dir(spark, path).filter(F.col("file_name").endswith(".parquet"))
    return files.groupBy("category").agg(F.count("*").alias("n"))


@query(
    "report_roundtrip",
    f"""with {REVIEWS}, {TAGGED}, sections as ({_sections()})
    select section, rank, item_key, avg_rating, review_count from sections""",
)
def report_roundtrip(spark, folder):
    """Top analysis written as a text report and read back with its sections."""
    path = scratch_path(spark, "top")
    top_job(views.reviews(spark, folder), path)
    return read_report(spark, f"{path}/report")


@query(
    "first_source",
    f"""with {REVIEWS}, {TAGGED}, sections as ({_sections()})
    select item_key as product_id, avg_rating as rating, 'report' as source
    from sections where section = 'TOP_PRODUCTS_BY_RATING'""",
)
def first_source(spark, folder):
    """No rating pairs table there: the pairs come from a saved report."""
    path = scratch_path(spark, "fallback")
    top_job(views.reviews(spark, folder), path)
    report = lambda: read_report(spark, f"{path}/report", ["TOP_PRODUCTS_BY_RATING"]).select(
        F.col("item_key").alias("product_id"), F.col("avg_rating").alias("rating")
    )
    return first_readable([("pairs", lambda: read_rating_pairs(spark, f"{path}/absent")), ("report", report)])


@query(
    "saved_results",
    f"""with {RATINGS}, {MONTHLY}
    select 'everything' as dataset, year, month, round(avg_rating, 6) as avg_rating, review_count from monthly""",
)
def saved_results(spark, folder):
    """Results saved as JSON folders; the dataset is read off the path."""
    path = scratch_path(spark, "results")
    frames = trends.rating_trends(views.ratings(spark, folder))
    write_results(frames, f"{path}/everything/trends")
    return read_results(
        spark, f"{path}/*/trends/monthly_json", schema=frames["monthly"].schema
    )


@query(
    "json_profile",
    """select count(*) as object_lines, cast(0 as bigint) as array_lines, cast(0 as bigint) as invalid_lines,
              'doc_id,lang,text' as first_keys from documents""",
)
def json_profile_query(spark, folder):
    path = scratch_path(spark, "profile")
    write_json(views.table(spark, folder, "documents").select("doc_id", "lang", "text"), path)
    return json_profile(spark, path).agg(
        F.sum("object_lines").alias("object_lines"),
        F.sum("array_lines").alias("array_lines"),
        F.sum("invalid_lines").alias("invalid_lines"),
        F.array_join(F.min("first_keys"), ",").alias("first_keys"),
    )


@query(
    "json_profile_whole",
    """select 'array' as format, cast(0 as bigint) as object_lines, count(*) as array_items,
              'doc_id,lang,text' as first_keys from documents where doc_id % 2 = 0
       union all select 'lines', count(*), null, 'doc_id,lang,text' from documents where doc_id % 2 = 1
       union all select 'object', 0, null, 'made,rows' """,
)
def json_profile_whole(spark, folder):
    """Files that are an array over many lines, one object over many lines, and JSON Lines."""
    path = scratch_path(spark, "profile")
    documents = views.table(spark, folder, "documents").select("doc_id", "lang", "text")
    # a file that is one value is written by one task: one for every 2**17 ids, more than a split of the scan each
    even = documents.filter(F.col("doc_id") % 2 == 0).withColumn("file", F.floor(F.col("doc_id") / (1 << 17)))
    here = Window.partitionBy("file").orderBy("doc_id")
    opening = F.when(F.row_number().over(here) == 1, "[").otherwise(",")
    closing = F.when(F.lead(F.lit(1)).over(here).isNull(), "\n]").otherwise("")
    value = F.concat(opening, F.lit("\n  "), F.to_json(F.struct("doc_id", "lang", "text")), closing)
    even.select("file", value.alias("value")).write.partitionBy("file").text(f"{path}/array")
    write_json(documents.filter(F.col("doc_id") % 2 == 1), f"{path}/lines")
    spark.sql("select '{\n  \"made\": true,\n  \"rows\": [1,\n 2]\n}' value").write.text(f"{path}/object")
    found = json_profile(spark, [f"{path}/array/file=*", f"{path}/lines", f"{path}/object"])
    return found.groupBy("format").agg(
        F.sum("object_lines").alias("object_lines"),
        F.sum("array_items").alias("array_items"),
        F.array_join(F.min("first_keys"), ",").alias("first_keys"),
    )


@query(
    "first_whole_source",
    f"""with {RATINGS} select product_id, rating, 'second' as source from ratings""",
)
def first_whole_source(spark, folder):
    """The first table has a part file that is no Parquet, which shows only when it is read."""
    path, rows = scratch_path(spark, "chain"), views.ratings(spark, folder).select("product_id", "rating")
    for name in ("first", "second"):
        write_parquet(rows, f"{path}/{name}")
    spark.range(1).selectExpr("'no such row'").write.mode("append").text(f"{path}/first")
    readers = [(n, lambda n=n: spark.read.schema(rows.schema).parquet(f"{path}/{n}")) for n in ("first", "second")]
    return first_readable(readers)


@query(
    "dataset_inventory",
    """select 'lineitem' as dataset, true as readable, count(*) as row_count from lineitem
       union all select 'part', true, count(*) from part""",
)
def dataset_inventory_query(spark, folder):
    names = ["lineitem", "part"]
    found = dataset_inventory(spark, {name: f"{folder}/{name}.parquet" for name in names})
    return found.select("dataset", "readable", "row_count")


@query(
    "processed_datasets",
    """select 'lineitem' as dataset, count(*) as row_count from lineitem
       union all select 'part', count(*) from part""",
)
def processed_datasets(spark, folder):
    """Datasets read side by side; one that cannot be read does not stop the others."""
    from reviewlens.operators.quality import row_counts
    from reviewlens.plans.datasets import union_all

    names = ["lineitem", "part", "absent"]
    frames, errors = read_processed(spark, {name: f"{folder}/{name}.parquet" for name in names})
    if set(errors) != {"absent"}:
        raise AssertionError(f"unexpected errors: {errors}")
    return row_counts(union_all({name: df.select("dataset") for name, df in frames.items()}, None))


@query(
    "export_formats",
    f"""with {REVIEWS}, totals as (select count(*) as n, cast(sum(review_length) as bigint) as total from reviews)
    select 'csv' as format, n, total from totals union all select 'json', n, total from totals""",
)
def export_formats(spark, folder):
    path = scratch_path(spark, "export")
    source = _reviews(spark, folder)
    write_parquet(source, f"{path}/reviews_processed")
    inputs = {"reviews": f"{path}/reviews_processed", "absent": f"{path}/absent_processed"}
    outcome = export(spark, inputs, path)
    frames = {
        "csv": spark.read.schema(source.schema).option("header", True).csv(outcome["reviews_csv"]),
        "json": spark.read.schema(source.schema).json(outcome["reviews_json"]),
    }
    from reviewlens.plans.datasets import union_all

    return union_all(frames, "format").groupBy("format").agg(
        F.count("*").alias("n"), F.sum("review_length").alias("total")
    )


PLAIN = "product_id, rating, cast(ts as varchar) as timestamp, review_length"


@query(
    "sample_file",
    f"""with {RATINGS}, first as (
      select {PLAIN} from ratings order by product_id, rating, timestamp, review_length limit 1000)
    select product_id, round(rating, 6) as rating, timestamp, review_length from first""",
)
def sample_file(spark, folder):
    """The first thousand rows, in order, through a JSON file."""
    path, source = scratch_path(spark, "sample"), views.ratings(spark, folder)
    write_sample(source, path)
    return spark.read.schema(source.schema).json(path)


@query(
    "preview_rows",
    f"""with {REVIEWS}, first as (
      select {PLAIN}, category, store, title from reviews
      order by product_id, rating, timestamp, review_length, category, store, title limit 2)
    select product_id, round(rating, 6) as rating, timestamp, review_length, category, store, title from first""",
)
def preview_rows(spark, folder):
    columns = ["product_id", "rating", "timestamp", "review_length", "category", "store", "title"]
    return preview(_reviews(spark, folder).select(*columns))


@query("rows_to_frame", f"with {RATINGS} select product_id, {MEASURES} from ratings group by product_id order by avg_rating desc, product_id desc limit 10")
def rows_to_frame_query(spark, folder):
    """The ten best products, as few rows as a report takes."""
    best = ratings.product_ratings(views.ratings(spark, folder))
    return best.orderBy(F.desc("avg_rating"), F.desc("product_id")).limit(10)
