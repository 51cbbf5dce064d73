"""SQL fragments shared by the registered queries."""

RATING = "1 + (cast(floor(l_quantity) as bigint) % 41) / cast(10 as double)"
TENTHS = "cast(10 + cast(floor(l_quantity) as bigint) % 41 as bigint)"
LENGTH = "cast(50 + cast(floor(l_extendedprice) as bigint) % 1000 as int)"

RATINGS = f"""ratings as (
  select cast(l_partkey as varchar) as product_id, {RATING} as rating, {TENTHS} as tenths,
         cast(l_shipdate as date) as ts, {LENGTH} as review_length
  from lineitem)"""

REVIEWS = f"""reviews as (
  select cast(l_partkey as varchar) as product_id, p_type as category, p_brand as store, p_name as title,
         {RATING} as rating, {TENTHS} as tenths, cast(l_shipdate as date) as ts, {LENGTH} as review_length
  from lineitem join part on l_partkey = p_partkey)"""


def half_up_mean(tenths: str = "sum(tenths)", n: str = "count(*)") -> str:
    """Mean of ratings in tenths, half-up to two decimals in integer arithmetic."""
    return f"cast((2 * {tenths} * 10 + {n}) // (2 * {n}) as double) / 100"


MEASURES = f"""{half_up_mean()} as avg_rating,
       round(cast(sum(tenths) as double) / (10 * count(*)), 6) as mean_rating,
       count(*) as review_count"""

TAGGED = f"""tagged as (
  select 'PRODUCT' as item_type, product_id as item_key, {MEASURES} from reviews group by product_id
  union all
  select 'CATEGORY', category, {MEASURES} from reviews group by category)"""

BUCKET = """case when review_length < 100 then 'Very Short' when review_length < 300 then 'Short'
            when review_length < 600 then 'Medium' when review_length < 900 then 'Long'
            else 'Very Long' end"""
BUCKET_ORD = """case length_bucket when 'Very Short' then 1 when 'Short' then 2 when 'Medium' then 3
                when 'Long' then 4 else 5 end"""

# Nearest whole star, halves up.
STAR = "cast((tenths + 5) // 10 as int)"

TEXT_PRODUCTS = """text_products as (
  select cast(d.doc_id as varchar) as product_id,
         case when lang <> 'es' then source || ' ' || lang end as title,
         case when quality is not null then 1 + (n_chars % 41) / cast(10 as double) end as rating,
         n_chars as rating_number,
         case lang when 'en' then text when 'fr' then '' end as description,
         case lang when 'fr' then text end as features,
         cast(length(text) as int) as review_length, source as category, lang as dataset
  from documents d left join labels l on d.doc_id = l.doc_id)"""

RAW = """raw as (
  select 'A' || p_partkey as product_id, p_name as title,
         1 + (p_size % 41) / cast(10 as double) as rating, p_partkey % 97 as rating_number,
         cast(p_retailprice as varchar) as price, p_type as main_category, p_brand as store,
         p_name || ' ' || p_brand as description, p_type as features,
         p_type || ' ' || p_brand as categories,
         date '2015-01-01' + cast(p_partkey % 3000 as int) as available, p_size
  from part)"""


def missing_rows(table: str, columns: list[str]) -> str:
    """Null count and share per column of a CTE, one row each."""
    return " union all ".join(
        f"""select '{c}' as "column", count(*) - count({c}) as missing_count,
            round(100.0 * (count(*) - count({c})) / count(*), 6) as missing_pct from {table}"""
        for c in columns
    )


def summary(column: str, suffix: str) -> str:
    return f"""round(min({column}), 6) as min_{suffix}, round(max({column}), 6) as max_{suffix},
               round(avg({column}), 6) as avg_{suffix},
               round(stddev_samp({column}), 6) as stddev_{suffix}"""
