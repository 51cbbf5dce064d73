"""Registered queries of the subpackage: each applies one operator to its whole table.

Every query derives the digest columns from the operator's own results. ``SQL`` holds DuckDB SQL for
the same rows where SQL can express them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


@query(
    "op5_substring_dedup",
    r"""
    with words as (
      select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
    ), windows as (
      select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i,
        unnest(list_transform(range(1, len(w) + 1),
          lambda i: case when i + 49 <= len(w) then md5(array_to_string(w[i:i + 49], ' ')) end)) as h
      from words
    ), earliest as (
      select h, min(doc_id) as first_doc from windows where h is not null group by h
    ), marked as (
      select doc_id, word, i, coalesce(doc_id > first_doc, false) as again
      from windows left join earliest using (h)
    ), judged as (
      select doc_id, word, i,
        bool_or(again) over (partition by doc_id order by i rows between 49 preceding and current row) as gone
      from marked
    ), kept as (
      select doc_id, count(*) filter (gone) as n_removed,
        string_agg(word, ' ' order by i) filter (not gone) as kept
      from judged group by doc_id
    )
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
      sha256(coalesce(kept, '')) as kept_sha256
    from words left join kept using (doc_id)
    """,
)
def op5_substring_dedup(spark, folder):
    from reviewlens.llm.substring_dedup import substring_dedup

    found = substring_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark, folder):
    from reviewlens.llm.suffix_dedup import suffix_dedup

    found = suffix_dedup(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op7_sentencepiece")
def op7_sentencepiece(spark, folder):
    """Ids of every text and whether decoding gives the text back."""
    from reviewlens.llm import pieces

    model, docs = pieces.read_model(pieces.MODEL), table(spark, folder, "documents")
    return pieces.round_trip(docs, model).select("doc_id", "n_ids", "ids", "round_trip")


@query("op8_simhash")
def op8_simhash(spark, folder):
    from reviewlens.llm.simhash import simhash_groups

    return simhash_groups(table(spark, folder, "documents"))


@query("op9_quality")
def op9_quality(spark, folder):
    from reviewlens.llm import pieces, quality

    return quality.fitted_rules(table(spark, folder, "documents"), pieces.read_model(quality.MODEL))


@query("op10_language")
def op10_language(spark, folder):
    from reviewlens.llm import language_id

    docs = table(spark, folder, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


#: Target weights of the mix: six sources by name, one each for the others of the corpus. Rows without a
#: source, or of one that is not named, share one stream.
MIX = {"src0": 12, "src1": 6, "src2": 5, "src3": 4, "src4": 3, "src5": 2} | {f"src{i}": 1 for i in range(6, 20)}
MIX_OTHER = 1


@query("op2_mixing")
def op2_mixing(spark, folder):
    from reviewlens.llm.mixing import mix_sources

    return mix_sources(table(spark, folder, "documents"), MIX, other=MIX_OTHER)


@query(
    "op6_topk",
    """
    with valid as (
      select vec_id, list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v
      from embeddings
      where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
      select q.vec_id as query_id, c.vec_id,
        cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
      from valid q join valid c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v)
    ), ranked as (
      select query_id, vec_id, score,
        cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank
      from scored
    )
    select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
)
def op6_topk(spark, folder):
    """The five best of all vectors for every vector whose id 50 divides."""
    from reviewlens.llm.vector_search import quantized, top_k

    vectors = quantized(table(spark, folder, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def _license_sql() -> str:
    from reviewlens.llm.license_scan import CONTAINMENT, PHRASES, REQUIRED, TEMPLATES

    def places(phrase: str) -> str:
        parts = phrase.split()
        same = " and ".join(f"w[i + {k + 1}] = '{part}'" for k, part in enumerate(parts))
        return f"list_filter(range(0, len(w) - {len(parts) - 1}), lambda i: {same})"

    phrases = list(PHRASES)
    columns = ", ".join(f"{places(phrase)} as p{k}" for k, phrase in enumerate(phrases))
    every = " || ".join(f"p{k}" for k in range(len(phrases)))
    base = ", ".join(f"case when len(p{k}) > 0 then '{PHRASES[phrase]}' end" for k, phrase in enumerate(phrases))
    # size of a block: the template's words and half as many again, rounded up
    sets = ", ".join(
        f"('{label}', {sorted(set(text.split()))!r}, {len(text.split()) + -(-len(text.split()) // 2)}, "
        f"{sorted(REQUIRED.get(label, '').split())!r}::varchar[])"
        for label, text in TEMPLATES.items()
    )
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    part, whole = CONTAINMENT
    return f"""
    with lowered as (
      select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
      from documents
    ), words as (select doc_id, regexp_extract_all(t, '{word}') as w from lowered),
    counted as (select doc_id, w, {columns} from words),
    based as (
      select doc_id, len(w) as n_words, {every} as places,
        list_distinct(list_filter([{base}], lambda x: x is not null)) as base
      from counted
    ), templates(label, ws, size, must) as (values {sets}),
    candidates as (
      select doc_id, w, label, ws, size, must from words join templates
        on len(list_intersect(ws, list_distinct(w))) * {whole} >= {part} * len(ws)
    ), blocks as (
      select doc_id, label, ws, must, unnest(list_transform(
        range(1, greatest(len(w) - size, 0) + 2), lambda i: list_distinct(w[i:i + size - 1]))) as b
      from candidates
    ), hits as (
      select doc_id, label, len(list_intersect(ws, b)) / len(ws) as containment
      from blocks
      where len(list_intersect(ws, b)) * {whole} >= {part} * len(ws) and len(list_intersect(must, b)) = len(must)
    ), matched as (
      select doc_id, list(distinct label) as found, max(containment) as best from hits group by doc_id
    )
    select doc_id, cast(n_words as bigint) as n_words, cast(len(places) as bigint) as n_base,
      cast(list_min(places) as bigint) as first_word, cast(list_max(places) as bigint) as last_word,
      array_to_string(list_sort(base), ',') as base_labels,
      array_to_string(list_sort(list_distinct(base || coalesce(found, []))), ',') as labels,
      case when len(places) > 0 then 1.0::double else coalesce(best, 0.0)::double end as score
    from based left join matched using (doc_id)
    """


@query("op4_license", _license_sql())
def op4_license(spark, folder):
    from reviewlens.llm.license_scan import license_scan

    return license_scan(table(spark, folder, "documents"))


@query("op3_line_dedup")
def op3_line_dedup(spark, folder):
    """Numbers of the lines that go, per document, and the digest of what stays."""
    from reviewlens.llm.line_dedup import line_dedup

    found = line_dedup(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        F.size("removed_lines").cast("bigint").alias("n_removed"),
        "removed_lines",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


#: CRC-32 in SQL: the table of its bytes, and the steps over a text's bytes (``{}``) from its hex digits.
_CRC_TABLE = """crc_table as (
      select list(list_reduce(list_prepend(n, range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as t
      from range(256) r(n))"""
_CRC = """xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(regexp_extract_all(hex({}), '..'), lambda h: ('0x' || h)::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


@query(
    "op11_resampling",
    rf"""
    with {_CRC_TABLE}, texts as (
      select true as own, doc_id as id, text from documents
      union all select false, item_id, text from benchmark
    ), words as (
      select own, id, row_number() over () as r, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from texts
    ), features as (
      select own, r, unnest(list_concat(w,
        list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as f
      from words
    ), placed as (
      select f, {_CRC.format("f")} % 10000 as bucket from (select distinct f from features), crc_table
    ), counted as (
      select own, r, bucket, count(*) as n from features join placed using (f) group by all
    ), totals as (
      select bucket, coalesce(sum(n) filter (own), 0)::double as s, coalesce(sum(n) filter (not own), 0)::double as t
      from counted group by bucket
    ), gains as (
      select bucket,
        floor(1000 * ln((t + 1) * (sum(s) over () + 10000) / ((s + 1) * (sum(t) over () + 10000))))::bigint as gain
      from totals
    ), weights as (
      select r, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
      from counted join gains using (bucket) where own group by r
    ), scored as (
      select id as doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
          (('0x' || substr(sha256('42:' || coalesce(id::varchar, '')), 1, 8))::bigint + 0.5::double)
          / 4294967296)))::bigint as score
      from words left join weights using (r) where own
    ), ranked as (
      select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place,
        count(*) filter (n_words >= 20) over () as eligible
      from scored
    )
    select doc_id, n_features, weight, score,
      case when n_words >= 20 and place <= 5 * eligible // 100 then place end as rank
    from ranked
    """,
)
def op11_resampling(spark, folder):
    """Five in a hundred of the documents drawn towards the benchmark's texts; every document's weight."""
    from reviewlens.llm.resampling import resample

    found = resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query(
    "op13_spelling",
    rf"""
    with {_CRC_TABLE}, runs as (
      select doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) as run
      from documents
    ), distinct_runs as (
      select doc_id, run, count(*) as times from runs group by all
    ), hashed as (
      select run, times, {_CRC.format("coalesce(doc_id::varchar, '') || ':' || run")} as h from distinct_runs, crc_table
    ), words as (
      select case when h % 199 = 0 then run[:(h % length(run))] || run[(h % length(run)) + 2:] else run end as word,
        sum(times)::bigint as n
      from hashed group by 1 having length(word) >= 6 and sum(times) >= 5
    ), places as (
      select word, n, unnest(range(1, length(word) + 1)) as i from words
    ), cut as (
      select word, n, i, word[:i - 1] as head, word[i + 1:] as tail from places
    ), near as (
      select a.word, a.n, b.word as other, b.n as other_n
      from cut a join cut b on a.i = b.i and a.head = b.head and a.tail = b.tail and a.word <> b.word
      union
      select a.word, a.n, b.word, b.n from cut a join words b on a.head || a.tail = b.word
      union
      select b.word, b.n, a.word, a.n from cut a join words b on a.head || a.tail = b.word
    ), best as (
      select word, n, count(*) as n_near,
        arg_max(other, (other_n, -ord)) as top, max(other_n) as top_n
      from (select *, row_number() over (order by encode(other)) as ord from near) group by word, n
    ), formed as (
      select w.word, w.n, coalesce(n_near, 0) as n_near, case when top_n >= 5 * w.n then top end as form,
        case when top_n >= 5 * w.n then top_n end as form_n
      from words w left join best b on w.word = b.word
    ), steps(word, root) as (
      select word, word from formed
      union all
      select s.word, f.form from (select * from steps) s join formed f on s.root = f.word where f.form is not null
    ), ends as (
      select s.word, s.root from steps s join formed f on s.root = f.word where f.form is null
    )
    select word, form, root, n, n_near, form_n from formed join ends using (word)
    """.replace("with crc_table", "with recursive crc_table", 1),
)
def op13_spelling(spark, folder):
    """Words of the documents, with one misspelled in about 199, and the words they are variants of."""
    from reviewlens.llm.spelling import spelling_groups

    found = spelling_groups(table(spark, folder, "documents"), typo_every=199)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_pii")
def op12_pii(spark, folder):
    """Personal data of every document: base spans by pattern, and those that the field adds."""
    from reviewlens.llm.personal_data import KINDS, fit, personal_data, written_out

    docs = table(spark, folder, "documents")
    found = personal_data(docs, fit(docs)).withColumn("held", F.filter("spans", lambda s: s["base"]))
    kinds = F.transform("held", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(written_out(F.col("held")), 256).alias("base_sha256"), written_out(F.col("spans")).alias("spans")
    )


@query("pipeline")
def pipeline(spark, folder):
    """All stages of corpus_pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
