"""Run existing mapper and reducer scripts over text files."""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewlens.operators.mapreduce import piped_map_reduce


def run_scripts(
    spark: SparkSession,
    mapper: str,
    reducer: str,
    input_path: str,
    output_path: str,
    combiner: str | None = None,
    reducers: int | None = None,
    interpreter: str = "python3",
    hot: str = "whole",
) -> DataFrame:
    """Map, sort by key and reduce the lines of ``input_path`` with script files.

    ``hot`` says what becomes of keys with very many lines (see ``piped_map_reduce``).

    The scripts are sent to every executor and read standard input there.
    Output lines go to ``output_path`` as text. Returns one row of job
    statistics; line counts are observed during the job itself.
    """

    def command(script: str | None) -> str | None:
        if script is None:
            return None
        spark.sparkContext.addFile(script)
        return f"{interpreter} {os.path.basename(script)}"

    read, wrote = Observation(), Observation()
    lines = spark.read.text(input_path).select(F.col("value").alias("line"))
    lines = lines.observe(read, F.count(F.lit(1)).alias("n"))
    start = time.perf_counter()
    result = piped_map_reduce(lines, command(mapper), command(reducer), command(combiner), reducers, hot)
    result.observe(wrote, F.count(F.lit(1)).alias("n")).write.mode("overwrite").text(output_path)
    seconds = time.perf_counter() - start
    return spark.createDataFrame(
        [(mapper, reducer, input_path, output_path, seconds, read.get["n"], wrote.get["n"])],
        "mapper string, reducer string, input_path string, output_path string, "
        "seconds double, input_lines bigint, output_lines bigint",
    )
