"""Reducer over sorted lines: key, sum and count, in the form it also reads."""

import itertools
import sys

rows = (line.rstrip("\n").split("\t") for line in sys.stdin)
for key, group in itertools.groupby(rows, lambda row: row[0]):
    total, count = 0.0, 0
    for _, rating, number in group:
        total += float(rating)
        count += int(number)
    print(f"{key}\t{total!r}\t{count}")
