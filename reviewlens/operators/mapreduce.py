"""User code over rows: a combinable map/reduce on Arrow batches, and piped commands."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlens.session import written

#: One salt per map task.
PER_TASK = 0

Frames = Iterator[pd.DataFrame]


def _sorted_merge(keys: Sequence[str], columns: Sequence[str], reduce_fn) -> Callable[[Frames], Frames]:
    """Reduce a task's batches, which come sorted by key.

    All keys of a batch are reduced in one call. Only its last key may go on in
    the next batch, so only that key's state is carried over: memory stays at
    one batch however many rows or keys a task has.
    """

    def merge(batches: Frames) -> Frames:
        carried = None
        for batch in batches:
            rows = batch[list(columns)]
            if carried is not None:
                rows = pd.concat([carried, rows], ignore_index=True)
            last = rows[list(keys)].iloc[-1]
            state = reduce_fn(rows)
            own = state[list(keys)]
            open_key = (own.eq(last) | (own.isna() & last.isna())).all(axis=1)
            carried = state[open_key]
            if not open_key.all():
                yield state[~open_key]
        if carried is not None:
            yield carried

    return merge


def map_reduce(
    df: DataFrame,
    map_fn: Callable[[pd.DataFrame], pd.DataFrame],
    keys: Sequence[str],
    reduce_fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    reducers: int | None = None,
    salts: int | None = PER_TASK,
) -> DataFrame:
    """``map_fn`` turns a batch of rows into rows of ``schema``; ``reduce_fn`` merges those.

    ``reduce_fn`` gets rows of ``schema`` for many keys and returns one row of
    the same schema per key. It must be associative and commutative, since it
    runs on each map batch, then per (key, salt), then per key. The salt is
    the map task's number, which does not change when a task is retried: a key
    that holds a third of all rows is spread over as many sorted runs as there
    are map tasks (or over ``salts``, if given), and at most that many rows of it
    meet in the last step. ``salts=None`` leaves the middle step out, for keys
    known to be even. ``reducers`` sets how many
    tasks the last step has; without it adaptive execution decides.
    """

    def mapped(batches: Frames) -> Frames:
        for batch in batches:
            yield reduce_fn(map_fn(batch))

    combined = df.mapInPandas(mapped, schema)
    result = combined.schema
    merge = _sorted_merge(keys, combined.columns, reduce_fn)
    if salts is not None:
        task = F.spark_partition_id()
        salted = combined.withColumn("_salt", F.pmod(task, F.lit(salts)) if salts else task)
        runs = salted.repartition(*keys, "_salt").sortWithinPartitions(*keys)
        combined = runs.mapInPandas(merge, result)
    spread = combined.repartition(reducers, *keys) if reducers else combined.repartition(*keys)
    return spread.sortWithinPartitions(*keys).mapInPandas(merge, result)


def _piped(lines: DataFrame, command: str) -> DataFrame:
    """Each task's lines through one external command, as text in and text out.

    The command's pipe ends a field at U+0001, a record at a line break, and reads \\N as null. Lines that
    hold one of these, on the way in or out, would come back changed: they are an error.
    """
    line = F.col("line")
    unfit = line.contains("\x01") | line.contains("\n") | (line == "\\N")
    lines = lines.filter(line.isNotNull()).select(
        F.when(unfit, F.raise_error(F.lit("a line for a command holds U+0001, a line break or \\N"))).otherwise(line).alias("line")
    )
    quoted = command.replace("\\", "\\\\").replace("'", "\\'").replace("{", "{{").replace("}", "}}")
    out = lines.sparkSession.sql(
        f"""
        SELECT TRANSFORM (line)
          ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\u0001'
          USING '{quoted}' AS (line STRING, rest STRING)
          ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\u0001'
        FROM {{lines}}
        """,
        lines=lines,
    )
    whole = F.col("rest").isNull() & line.isNotNull()
    return out.select(
        F.when(whole, line).otherwise(F.raise_error(F.lit("a command gave a line with U+0001 or \\N"))).alias("line")
    )


class HotKey(ValueError):
    """A key with more lines than one reducer should get."""


def hot_keys(keyed: DataFrame, share: float, key: str = "key") -> dict[str, int]:
    """Keys of more than ``share`` of the rows, with their exact numbers of rows.

    Frequent-item counters of fixed size, kept per task and merged, name all that can have so many rows;
    those few are then counted. At most 1 / ``share`` keys come to the driver.
    """
    most = max(int(1 / share), 1)
    top = F.call_function("approx_top_k", F.col(key), F.lit(2 * most), F.lit(max(16 * most, 64)))
    row = keyed.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    names = [item["item"] for item in row["top"] or []]
    if not names:
        return {}
    counts = keyed.filter(F.col(key).isin(names)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return {r[key]: r["n"] for r in counts.filter(F.col("n") > share * row["n"]).collect()}


def piped_map_reduce(
    lines: DataFrame,
    mapper: str,
    reducer: str,
    combiner: str | None = None,
    reducers: int | None = None,
    hot: str = "whole",
) -> DataFrame:
    """Existing mapper and reducer commands over text lines (column ``line``).

    The text before the first tab is the key. Each reducer command sees its
    keys whole and sorted. With a ``combiner`` (same line format in and out)
    that runs on each map task's sorted output, a hot key leaves one line per
    map task.

    Without one, ``hot`` says what becomes of keys with more lines than an even
    share of a reducer: ``whole`` gives all lines of one to one reducer;
    ``refuse`` raises ``HotKey`` before anything is reduced; ``split`` deals
    their lines out evenly over all reducers, and reduces what these give for
    such a key once more, which takes a reducer that reads its own output. All
    other keys go through one shuffle. The last two write the mapped lines once.
    """
    if hot not in ("whole", "refuse", "split"):
        raise ValueError(f"hot: {hot}")

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("key", F.substring_index("line", "\t", 1))

    def reduced(df: DataFrame) -> DataFrame:
        return _piped(df.sortWithinPartitions("key", "line").select("line"), reducer)

    mapped = _piped(lines.select("line"), mapper)
    if combiner:
        mapped = _piped(keyed(mapped).sortWithinPartitions("key", "line").select("line"), combiner)
    elif hot != "whole":
        mapped = written(mapped, "mapped")
        tasks = reducers or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = hot_keys(keyed(mapped), 1 / tasks)
        if found and hot == "refuse":
            told = ", ".join(f"{k} ({n} lines)" for k, n in sorted(found.items(), key=lambda item: -item[1])[:10])
            raise HotKey(f"more lines than a {tasks}th of all on one key: {told}")
        if found:
            is_hot = F.col("key").isin(list(found))
            # a row's number in its file split is the same when a task is run again
            turn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(tasks))
            task = F.when(is_hot, turn).otherwise(F.pmod(F.xxhash64("key"), F.lit(tasks))).cast("int")
            first = keyed(written(reduced(keyed(mapped).repartitionById(tasks, task)), "reduced"))
            again = reduced(first.filter(is_hot).repartition(tasks, "key"))
            return first.filter(~is_hot).select("line").unionByName(again)
    shuffled = keyed(mapped)
    shuffled = shuffled.repartition(reducers, "key") if reducers else shuffled.repartition("key")
    return reduced(shuffled)


def reduce_by(
    keys: Sequence[str], aggregates: dict[str, str]
) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A reducer from pandas aggregate names, such as ``{"total": "sum"}``."""

    def reduce_fn(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby(list(keys), as_index=False, dropna=False).agg(aggregates)

    return reduce_fn


def lines_of(df: DataFrame, columns: Iterable[str], separator: str = "\t") -> DataFrame:
    """Columns as delimited text lines, for piping."""
    return df.select(F.concat_ws(separator, *[F.col(c).cast("string") for c in columns]).alias("line"))
