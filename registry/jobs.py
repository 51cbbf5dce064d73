import os
import sys
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens import views
from reviewlens.operators import mapreduce, prepare
from reviewlens.operators.ratings import finish, product_ratings
from reviewlens.plans.analysis import COMBINED
from reviewlens.plans.staged import analyze_datasets, validate_datasets
from reviewlens.plans.scripts import run_scripts
from reviewlens.session import scratch_path, written
from reviewlens.sinks import write_parquet
from reviewlens.sources import read_processed
from reviewlens.streaming import latest_state, rating_updates, read_stream, run_available
from reviewlens.streaming.ratings import daily_ratings, monthly_ratings, read_state, update_state

from registry.core import query
from registry.sql import MEASURES, RATINGS, REVIEWS

MAP_REDUCE_SQL = f"with {RATINGS} select product_id, {MEASURES} from ratings group by product_id"


@query("map_reduce_avg", MAP_REDUCE_SQL)
def map_reduce_avg(spark, folder):
    """User functions: one state row per review, states added up per product."""

    def to_state(rows):
        return rows.assign(review_count=1).rename(columns={"rating": "rating_sum"})

    add_up = mapreduce.reduce_by(["product_id"], {"rating_sum": "sum", "review_count": "sum"})
    pairs = views.ratings(spark, folder).select("product_id", "rating")
    schema = "product_id string, rating_sum double, review_count bigint"
    return finish(mapreduce.map_reduce(pairs, to_state, ["product_id"], add_up, schema))


# Mapper: a count of one behind every pair. Reducer and combiner: add up sorted lines per key.
ADD_ONE = """awk -F'\\t' '{print $1 "\\t" $2 "\\t" 1}'"""
ADD_UP = (
    """awk -F'\\t' 'NR > 1 && $1 != k {print k "\\t" s "\\t" n; s = 0; n = 0} """
    """{k = $1; s += $2; n += $3} END {if (NR > 0) print k "\\t" s "\\t" n}'"""
)


@query("piped_map_reduce_avg", MAP_REDUCE_SQL)
def piped_map_reduce_avg(spark, folder):
    """The same through external commands that read and write text lines."""
    lines = mapreduce.lines_of(views.ratings(spark, folder), ["product_id", "rating"])
    out = mapreduce.piped_map_reduce(lines, ADD_ONE, ADD_UP, combiner=ADD_UP)
    fields = F.split("line", "\t")
    return finish(
        out.select(
            fields[0].alias("product_id"),
            fields[1].cast("double").alias("rating_sum"),
            fields[2].cast("bigint").alias("review_count"),
        )
    )


@query(
    "strategy_check",
    f"""with {RATINGS}
    select unnest(['as_is', 'kept', 'repartitioned']) as strategy, count(distinct product_id) as row_count
    from ratings""",
)
def strategy_check(spark, folder):
    """The same means over three preparations of the input: as it is, written once, spread anew.

    ``rebalance`` spreads by product and lets adaptive execution split what one product overfills.
    """
    ratings = views.ratings(spark, folder)
    ways = {
        "as_is": ratings,
        "kept": written(ratings, "kept"),
        "repartitioned": ratings.hint("rebalance", "product_id"),
    }
    counts = [
        product_ratings(df).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("strategy"), "row_count")
        for name, df in ways.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "sample_rows",
    f"""with {RATINGS}, drawn as (
      select product_id, rating, cast(ts as varchar) as timestamp, review_length, cast('0x' || substr(md5(concat_ws('|',
        '42', product_id, cast(ts as varchar), cast(review_length as varchar))), 1, 8) as bigint) as place from ratings)
    select product_id, round(rating, 6) as rating, timestamp, review_length from drawn
    where place < cast(floor(0.01 * 4294967296) as bigint)""",
)
def sample_rows(spark, folder):
    """A hundredth of the rows, drawn by a hash of their key from the whole table."""
    return prepare.row_sample(views.ratings(spark, folder), key=["product_id", "timestamp", "review_length"])


def _event_state(spark, folder):
    """All events streamed from their files into daily states per event type."""
    run = scratch_path(spark, "stream")
    schema = views.table(spark, folder, "events").schema
    # A stream reads a folder or a glob; the glob takes one file as well as a folder of them.
    events = read_stream(spark, f"{folder}/events.parquet*", schema)
    run_available(
        rating_updates(events, ["event_type"], "ts", "value"), f"{run}/out", f"{run}/checkpoint"
    )
    return latest_state(spark, f"{run}/out", ["event_type"])



@query(
    "stream_daily_ratings",
    """select event_type, cast(cast(ts as date) as varchar) as day, round(avg(value), 6) as mean_rating,
              count(*) as review_count from events group by 1, 2""",
)
def stream_daily_ratings(spark, folder):
    return daily_ratings(_event_state(spark, folder)).drop("avg_rating")


@query(
    "stream_monthly_ratings",
    """select event_type, cast(cast(date_trunc('month', ts) as date) as varchar) as month,
              round(avg(value), 6) as mean_rating, count(*) as review_count from events group by 1, 2""",
)
def stream_monthly_ratings(spark, folder):
    return monthly_ratings(_event_state(spark, folder), ["event_type"]).drop("avg_rating")


@query(
    "faulty_dataset",
    f"""with {RATINGS}, good as (select * from ratings where tenths >= 30)
    select 'good' as dataset, count(*) as total_records, 'Passed' as validation_status,
           round(avg(rating), 6) as avg_rating, false as has_error, count(*) as analysed,
           round(quantile_cont(rating, 0.5), 6) as median from good
    union all select 'spoiled', 0, 'Failed', null, true, null, null
    union all select 'all_categories', null, null, null, null, count(*), round(quantile_cont(rating, 0.5), 6) from good""",
)
def faulty_dataset(spark, folder):
    """Two datasets, one with a part file that is no Parquet: report and statistics of the other are whole."""
    run = scratch_path(spark, "faulty")
    reviews = views.ratings(spark, folder)
    for name, rows in (("good", reviews.filter("rating > 2.95")), ("spoiled", reviews.filter("rating < 2.95"))):
        write_parquet(rows, f"{run}/{name}")
    spark.range(3).selectExpr("concat('no such row ', id)").write.mode("append").text(f"{run}/spoiled")
    frames, errors = read_processed(spark, {name: f"{run}/{name}" for name in ("good", "spoiled")})
    report, report_errors = validate_datasets(spark, frames, errors)
    results, stats_errors = analyze_datasets(frames, COMBINED)
    if set(report_errors) != {"spoiled"} or not set(stats_errors) <= {"spoiled"}:
        raise AssertionError(f"errors {report_errors}, {stats_errors}")
    told = report["validation_report"].select(
        "dataset", "total_records", "validation_status", "avg_rating", F.col("error").isNotNull().alias("has_error")
    )
    stats = results["stats"]["basic_stats"].select("dataset", F.col("count").alias("analysed"), "median")
    return told.join(stats, "dataset", "full")


@query(
    "scripts",
    f"""with {REVIEWS}, named as (
      select case when cast(product_id as bigint) % 3 = 0 then 'every third' else store end as category, tenths from reviews)
    select category, round(cast(sum(tenths) as double) / 10, 6) as rating_sum, count(*) as review_count
    from named group by category""",
)
def scripts(spark, folder):
    """Script files as mapper and reducer over text files in which one key holds a third of the lines; the
    reducer has no combiner, so that key is split and reduced twice."""
    run = scratch_path(spark, "scripts")
    reviews = views.reviews(spark, folder)
    third = F.when(F.pmod(F.col("product_id").cast("bigint"), F.lit(3)) == 0, "every third").otherwise(F.col("store"))
    write_lines_of = mapreduce.lines_of(reviews.select(third.alias("category"), "rating"), ["category", "rating"])
    write_lines_of.write.text(f"{run}/in")
    here = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts")
    statistics = run_scripts(
        spark, f"{here}/category_map.py", f"{here}/category_reduce.py", f"{run}/in", f"{run}/out",
        reducers=8, interpreter=sys.executable, hot="split",
    )
    if statistics.filter("output_lines > 0 and input_lines >= output_lines").isEmpty():
        raise AssertionError("statistics of the job are missing")
    fields = F.split("value", "\t")
    return spark.read.text(f"{run}/out").select(
        fields[0].alias("category"), fields[1].cast("double").alias("rating_sum"), fields[2].cast("bigint").alias("review_count")
    )


@query(
    "stream_three_runs",
    """select event_type, cast(cast(ts as date) as varchar) as day, round(avg(value), 6) as mean_rating,
              count(*) as review_count from events group by 1, 2""",
)
def stream_three_runs(spark, folder):
    """The events in three deliveries by time, each followed by a run that updates the days it changed; a
    fourth brings one row of the first day again, too late to count."""
    run = scratch_path(spark, "runs")
    events = views.table(spark, folder, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(at), F.max(at)).first()
    third = F.least(F.floor((at - first) * 3 / (last - first + 1)), F.lit(2))
    parts = [events.filter(third == number) for number in range(3)]
    parts.append(events.orderBy("ts", "event_id" if "event_id" in events.columns else "value").limit(1))
    for number, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{run}/in")
        stream = read_stream(spark, f"{run}/in", events.schema)
        run_available(rating_updates(stream, ["event_type"], "ts", "value"), f"{run}/changes", f"{run}/checkpoint")
        if not update_state(spark, f"{run}/changes", ["event_type"], f"{run}/state") and number < 3:
            raise AssertionError("a delivery changed nothing")
    return daily_ratings(read_state(spark, f"{run}/state")).drop("avg_rating")
