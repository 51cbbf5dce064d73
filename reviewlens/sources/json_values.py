"""Files that are one JSON value over many lines, checked in as many tasks as the scan has splits.

No token goes over a line break, since JSON strings hold none. So every stretch of a file, the lines of
one split, is read by itself: a first scan finds the brackets that a stretch closes and leaves open, from
which follow those open where each stretch begins, and a second one holds every stretch against the
grammar (RFC 8259) from there. A task keeps no more than the open brackets and the keys that are asked for.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Brackets within each other at most, as Spark's own parser has it.
DEPTH = 1000
_MARK = b"\xef\xbb\xbf"  # byte order mark
_TOKEN = re.compile(
    rb'[ \t\r]*([{}\[\],:]|"(?:[^"\\\x00-\x1f]+|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*+"'
    rb"|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|\xef\xbb\xbf)"
)
_PAIR = {"}": "{", "]": "["}


def _tokens(line: bytes) -> Iterator[tuple[str, bytes]]:
    """Kind and text of each token: the sign itself, s(tring), v(alue), m(ark); ``?`` for what is none."""
    line, at = line.strip(b" \t\r"), 0
    while at < len(line):
        found = _TOKEN.match(line, at)
        if found is None:
            yield "?", b""
            return
        at, text = found.end(), found[1]
        sign = chr(text[0])
        yield ("s" if sign == '"' else sign if sign in "{}[],:" else "m" if text == _MARK else "v"), text


def _stretches(batches: Iterator[pa.RecordBatch], begin, add, done) -> Iterator[pa.RecordBatch]:
    """Lines (path, start, value) through ``add``, with a new state for each stretch (path, start) of a file."""
    here = state = None
    for batch in batches:
        paths, starts = batch.column("path").to_pylist(), batch.column("start").to_pylist()
        for path, start, value in zip(paths, starts, batch.column("value"), strict=True):
            if (path, start) != here:
                if here:
                    yield done(here, state)
                here, state = (path, start), begin((path, start))
            add(state, value.as_py())
    if here:
        yield done(here, state)


class _Brackets:
    """What a stretch closes and leaves open, its first token and its last two."""

    def __init__(self) -> None:
        self.closed, self.open, self.head, self.tail, self.good = "", "", "", "", True

    def add(self, line: bytes) -> None:
        for kind, _ in _tokens(line) if self.good else ():
            if kind in "{[":
                self.open += kind
            elif kind in "}]":
                if self.open:
                    self.good = self.open[-1] == _PAIR[kind]
                    self.open = self.open[:-1]
                else:
                    self.closed += kind
            if kind != "m":
                self.head, self.tail = self.head or kind, self.tail[-1:] + kind
            if kind == "?" or max(len(self.open), len(self.closed)) > DEPTH:
                self.good = False
            if not self.good:
                return


class _Grammar:
    """A stretch from the brackets open before it and the state there: items of the outermost array, and the
    keys of the outermost object or of the array's first item, as far as the stretch has them."""

    def __init__(self, stack: str, last: str, top: str) -> None:
        self.stack, self.last, self.top = stack, last, top
        self.items, self.past_first, self.good = 0, False, True
        self.keyed = "{" if top == "{" else "[{"
        self.keys: list[str] | None = None

    def add(self, line: bytes) -> None:
        for kind, text in _tokens(line) if self.good else ():
            self.good = self.take(kind, text)
            if not self.good:
                return

    def take(self, kind: str, text: bytes) -> bool:
        stack, last = self.stack, self.last
        inner = stack[-1:]
        if kind in "sv{[":
            if kind == "s" and inner == "{" and last in ("{", ","):
                if stack == self.keyed and not self.past_first:
                    key = json.loads(text.decode("utf-8", "replace"))
                    self.keys = self.keys or []
                    self.keys.append(key.encode("utf-8", "replace").decode())
                self.last = "k"
                return True
            if not (last == ":" if inner == "{" else last in ("[", ",") if inner else last == ""):
                return False
            self.items += stack == "["
            self.last = "v"
            if kind in "{[":
                self.stack, self.last = stack + kind, kind
                if self.stack == self.keyed and not self.past_first:
                    self.keys = self.keys or []
        elif kind in "}]":
            if inner != _PAIR[kind] or last not in (inner, "v"):
                return False
            self.stack, self.last = stack[:-1], "v"
        elif kind == ",":
            self.past_first |= stack == "["
            self.last = kind
            return bool(stack) and last == "v"
        elif kind == ":":
            self.last = kind
            return last == "k"
        elif kind == "m":  # before the value or behind it
            return not stack
        return kind != "?"


def _scan(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    meta = F.col("_metadata")
    lines = spark.read.text(list(files))
    return lines.select(meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), F.col("value").cast("binary").alias("value"))


def _beginnings(stretches: list) -> tuple[dict[tuple[str, int], tuple[str, str, str]], set[str]]:
    """Open brackets, state and outermost bracket where each stretch begins, of the files whose brackets match."""
    out, ends, bad = {}, {}, set()
    for path, start, closed, opened, head, tail, good in sorted(tuple(row) for row in stretches):
        stack, top, before = ends.get(path, ("", "", ""))
        last = before[-1:]
        if last == "s" and stack[-1:] == "{" and before[:-1] in ("{", ","):
            last = "k"
        elif last in ("s", "}", "]"):
            last = "v"
        out[path, start] = stack, last
        at = len(stack) - len(closed)
        if not good or at < 0 or [_PAIR[c] for c in closed] != list(stack[at:][::-1]) or at + len(opened) > DEPTH:
            bad.add(path)
            continue
        ends[path] = stack[:at] + opened, top or head, (before + tail)[-2:]
    whole = {path for path, (stack, top, _) in ends.items() if path not in bad and not stack and top in ("{", "[")}
    return {key: (*begin, ends[key[0]][1]) for key, begin in out.items() if key[0] in whole}, whole


def whole_values(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Of the files that are one JSON array or object: path, whole_items (of an array), whole_keys (of the object or
    of the array's first item, if that is an object). A key that an object repeats is no fault.

    One row per split of the scan comes to the driver, which has the list of the splits anyway.
    """
    kinds = "path string, start bigint, closed string, opened string, head string, tail string, good boolean"
    names = [kind.split()[0] for kind in kinds.split(", ")]

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(at: tuple[str, int], s: _Brackets) -> pa.RecordBatch:
            row = (*at, s.closed, s.open, s.head, s.tail, s.good)
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))])

        return _stretches(batches, lambda _: _Brackets(), _Brackets.add, done)

    begins, whole = _beginnings(_scan(spark, files).mapInArrow(matched, kinds).collect())
    shared = spark.sparkContext.broadcast(begins)
    held = pa.schema(
        [("path", pa.string()), ("start", pa.int64()), ("good", pa.bool_()), ("top", pa.string()), ("items", pa.int64())]
        + [("keys", pa.list_(pa.string())), ("past_first", pa.bool_())]
    )

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        none = ("", "", "")  # of a file that is out already

        def done(at: tuple[str, int], s: _Grammar) -> pa.RecordBatch:
            row = (*at, s.good and at in known, s.top, s.items, s.keys, s.past_first)
            return pa.RecordBatch.from_pylist([dict(zip(held.names, row, strict=True))], schema=held)

        return _stretches(batches, lambda at: _Grammar(*known.get(at, none)), _Grammar.add, done)

    found = _scan(spark, files).mapInArrow(
        checked, "path string, start bigint, good boolean, top string, items bigint, keys array<string>, past_first boolean"
    )
    by_file = found.groupBy("path").agg(
        F.bool_and("good").alias("good"),
        F.max("top").alias("top"),
        F.sum("items").alias("n"),
        F.min(F.when(F.col("past_first"), F.col("start"))).alias("until"),
        F.array_sort(F.collect_list(F.when(F.col("keys").isNotNull(), F.struct("start", "keys")))).alias("parts"),
    )
    first = F.filter("parts", lambda part: F.col("until").isNull() | (part["start"] <= F.col("until")))
    return by_file.filter("good").select(
        "path",
        F.when(F.col("top") == "[", F.col("n")).alias("whole_items"),
        F.when(F.size(first) > 0, F.flatten(F.transform(first, lambda part: part["keys"]))).alias("whole_keys"),
    )
