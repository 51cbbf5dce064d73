"""Mapper: category, tab, rating of a review to category, rating, one."""

import sys

for line in sys.stdin:
    category, _, rating = line.rstrip("\n").partition("\t")
    if category and rating:
        print(f"{category}\t{rating}\t1")
