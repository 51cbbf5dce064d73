"""License scans with an exact set-similarity join, in DataFrame functions only.

Templates are short license texts. A text block is a run of consecutive words, over line breaks too, half as
long again as the template (the whole text where that is shorter); it matches when it holds at least
``CONTAINMENT`` of the template's distinct words, among them those that tell it from its kin (a version, a
clause). Every block of every text counts. Words of templates are ordered by how many documents hold
them, rarest first. A block that holds ``need`` of a template's n words must hold one of its n - need + 1
rarest (prefix filter); where that one is the rarest it holds, the words behind it in the order must supply
the others (positional filter), within the block's length on either side (length filter). What passes is
verified block by block. Only the template side is broadcast; the parameters bound it.

Next to it stand fixed phrases, which are counted as consecutive words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.frames import identified

CONTAINMENT = (4, 5)

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-2.0": "this work is licensed under the gnu general public license version 2",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

#: Words without which a template is not matched, whatever else a block holds.
REQUIRED = {
    "apache-2.0": "apache 2",
    "cc-by-4.0": "attribution",
    "cc-by-nc-4.0": "cc by nc",
    "cc-by-sa-4.0": "cc by sa",
    "gpl-3.0": "gnu 3",
    "gpl-2.0": "gnu 2",
    "mpl-2.0": "mozilla 2",
}


def block_length(template: str) -> int:
    """Words of a block that is held against a template."""
    size = len(template.split())
    return size + (size + 1) // 2


#: Runs of characters that are in no word, after A-Z went to lower case.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case. ``lower`` also changes other letters, but none that could become part of an
    ASCII word except the two characters named here."""
    special = text.contains("\u212a") | text.contains("\u0130")
    return F.when(special, F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def spaced(text: Column) -> Column:
    """The words of a text, each between single spaces: ' w1 w2 '; a space alone if there are none."""
    return F.regexp_replace(F.concat(F.lit(" "), lower_ascii(text), F.lit(" ")), _GAPS, " ")


def _split(words: Column) -> Column:
    return F.split(F.trim(words), " ", -1)


def _places(words: Column, phrase: str) -> Column:
    """Starts of the phrase among the words, from 0."""
    parts = phrase.split()
    spots = F.sequence(F.lit(0), F.size(words) - len(parts))

    def here(i: Column) -> Column:
        found = F.lit(True)
        for shift, part in enumerate(parts):
            found &= F.get(words, i + shift) == part
        return found

    return F.when(F.size(words) >= len(parts), F.filter(spots, here)).otherwise(F.array().cast("array<int>"))


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(word) for word in words]) if words else F.array().cast("array<string>")


def word_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary by the number of documents that hold each word, rarest first, then by the word.

    One row per word of the templates comes to the driver.
    """
    held = docs.select(F.explode(F.array_intersect(_split(spaced(F.col("text"))), _literal(vocabulary))).alias("word"))
    counts = {row["word"]: row["n"] for row in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda word: (counts.get(word, 0), word))


def template_matches(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    containment: tuple[int, int] = CONTAINMENT,
    required: dict[str, str] = REQUIRED,
) -> DataFrame:
    """ord, tag, label, containment of every template that a block matches, with the best block around each
    of its rare words; perhaps repeated."""
    spark = docs.sparkSession
    part, whole = containment
    sets = {label: sorted(set(text.split())) for label, text in templates.items()}
    order = word_order(docs, sorted({word for words in sets.values() for word in words}))
    place = {word: i for i, word in enumerate(order)}
    postings = []
    for label, words in sets.items():
        words = sorted(words, key=place.__getitem__)
        need = -(-part * len(words) // whole)
        must = sorted(set(required.get(label, "").split()))
        for at, word in enumerate(words[: len(words) - need + 1]):
            postings.append((word, label, need, block_length(templates[label]), words, words[at + 1 :], must))
    prefix = spark.createDataFrame(
        postings, "word string, label string, need int, length int, words array<string>, behind array<string>, must array<string>"
    )
    rare_words = sorted({row[0] for row in postings})
    rare = _literal(rare_words)
    longest = max(row[3] for row in postings)
    listed = docs.select("ord", "tag", _split(spaced(F.col("text"))).alias("list"))
    # the words around each rare word are cut out of the list before rows are made, so no row holds the list
    spots = F.filter(F.transform("list", lambda word, i: F.struct(i.alias("spot"), word.alias("word"))), lambda x: x["word"].isin(rare_words))

    def cut(x: Column) -> Column:
        low = F.greatest(x["spot"] - longest + 1, F.lit(0))
        return F.struct(x["spot"].alias("spot"), x["word"].alias("word"), low.alias("low"), F.slice("list", low + 1, 2 * longest - 1).alias("around"))

    around = listed.filter(F.arrays_overlap("list", rare)).select(
        "ord", "tag", F.size("list").alias("size"), F.inline(F.transform(spots, cut))
    )
    joined = around.join(F.broadcast(prefix), "word").filter(F.size(F.array_intersect("behind", "around")) >= F.col("need") - 1)
    # starts of the blocks that hold the rare word, as places in ``around``
    last = F.greatest(F.least(F.col("spot"), F.col("size") - F.col("length")), F.lit(0))
    first = F.least(F.greatest(F.col("spot") - F.col("length") + 1, F.lit(0)), last)
    starts = F.sequence(first - F.col("low"), last - F.col("low"))

    def shared(start: Column) -> Column:
        block = F.slice("around", start + 1, F.col("length"))
        whole_ = F.size(F.array_intersect("must", block)) == F.size("must")
        return F.when(whole_, F.size(F.array_intersect("words", block))).otherwise(0)

    best = joined.select("ord", "tag", "label", "need", F.size("words").alias("n"), F.array_max(F.transform(starts, shared)).alias("shared"))
    return best.filter(F.col("shared") >= F.col("need")).select("ord", "tag", "label", (F.col("shared") / F.col("n")).alias("containment"))


def license_scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    containment: tuple[int, int] = CONTAINMENT,
    required: dict[str, str] = REQUIRED,
) -> DataFrame:
    """Per document: doc_id, n_words, n_base (places of all phrases), first_word and last_word (smallest and
    largest start of a phrase, or null), base_labels, labels (with those of templates), score.

    ``score`` is the largest containment that reached the threshold, 1 where a phrase stands, else 0. Labels
    are distinct, sorted and comma-joined; none give the empty text. Null texts count as empty. Rows equal
    in id and text get the same result each, whatever else they hold. No rows give no rows.
    """
    docs = identified(docs).withColumn("text", F.coalesce("text", F.lit("")))
    words = spaced(F.col("text"))
    plain = docs.select("doc_id", "ord", "tag", words.alias("words"))
    gaps = F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit("")))
    some = F.lit(False)
    for phrase in phrases:
        some |= F.col("words").contains(f" {phrase} ")
    # the list of words is a column of its own, made once and only where a phrase stands
    listed = plain.select(
        "doc_id",
        "ord",
        "tag",
        (gaps - 1).cast("bigint").alias("n_words"),
        F.when(some, _split(F.col("words"))).otherwise(F.array().cast("array<string>")).alias("parts"),
    )
    places = [_places(F.col("parts"), phrase).alias(phrase) for phrase in phrases]
    counted = listed.select("doc_id", "ord", "tag", "n_words", *places)
    found = F.concat(*[F.col(f"`{phrase}`") for phrase in phrases])
    base = F.array_compact(
        F.array(*[F.when(F.size(f"`{phrase}`") > 0, F.lit(label)) for phrase, label in phrases.items()])
    )
    scored = counted.select(
        "doc_id",
        "ord",
        "tag",
        "n_words",
        F.size(found).cast("bigint").alias("n_base"),
        F.array_min(found).cast("bigint").alias("first_word"),
        F.array_max(found).cast("bigint").alias("last_word"),
        F.array_distinct(base).alias("base"),
    )
    matched = (
        template_matches(docs, templates, containment, required)
        .groupBy("ord", "tag")
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    )
    none = F.array().cast("array<string>")
    return scored.join(matched, ["ord", "tag"], "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
