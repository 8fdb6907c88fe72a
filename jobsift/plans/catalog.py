"""Registered queries: one per operator, each with its DuckDB oracle SQL.

Every query reads the given tables (through the views of ``fixtures``) in
full, so its work grows with the data. Queries that go through files write
to a fresh folder below the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import with_views
from ..functions import rules
from ..functions.text import (compensation_gate, file_name_collisions, file_name_source, file_name_time,
                              listing_link, result_set_file_name)
from ..operators import cards as X
from ..operators import dedupe as D
from ..operators.joins import bounded_broadcast
from ..operators import quality as Q
from ..operators import relations as R
from ..operators import screen as S
from ..operators import search as J
from ..operators import trends as A
from ..schema import KEY, LISTING_COLUMNS, REQUIRED_COLUMNS, SCREEN_COLUMNS
from ..session import scratch_path
from ..sources import listing_csv as csvio
from ..sources import store as st
from ..sources.terms import load_search_terms, terms_values_sql
from . import load as L
from . import sql as Q_SQL

RECENCY_AS_OF = "2024-01-30 00:00:00"
EXCLUDED_REGIONS = ["MIDDLE EAST", "NATION_0"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in dict.fromkeys(values))


_L8 = ", ".join(LISTING_COLUMNS)
_SCREEN = ", ".join(SCREEN_COLUMNS)
_COMPANY_OK = f"company NOT IN ({_sql_list(rules.BLOCKED_COMPANIES)})"
_TITLE_SUBSTR = " OR ".join(f"title ILIKE '%{p}%'" for p in rules.TITLE_EXCLUDED_SUBSTRINGS)
_TITLE_WORDS = "regexp_matches(title, '\\b(" + "|".join(rules.TITLE_EXCLUDED_WORDS) + ")\\b', 'i')"
_TITLE_OK = f"NOT ({_TITLE_SUBSTR} OR {_TITLE_WORDS})"
_LOCATION_OK = " OR ".join(f"location ILIKE '%{p}%'" for p in rules.LOCATION_INCLUDED_SUBSTRINGS)
_JUNIOR = " OR ".join(f"title ILIKE '%{p}%'" for p in rules.JUNIOR_TITLE_SUBSTRINGS)
_WORK_MODE_SQL = ("CASE WHEN l.location ILIKE '%remote%' THEN 'remote' WHEN l.location ILIKE '%hybrid%' "
                  "THEN 'hybrid' WHEN l.location IS NOT NULL THEN 'on-site' END")
_MODE_OK_SQL = ("CASE WHEN {sl} = 'Remote' THEN {m} = 'remote' WHEN {src} = 'Indeed' THEN TRUE "
                "ELSE {m} IN ('on-site', 'hybrid') END")


def _terms_cte() -> str:
    return f"terms AS ({terms_values_sql()})"


def _listings(spark, sf_dir):
    return fx.listings(spark, sf_dir)


# --- P4-P9, O1: screening ----------------------------------------------------

@register("screen_listings", with_views(
    f"SELECT {_SCREEN} FROM listings WHERE {_COMPANY_OK} AND {_TITLE_OK} AND ({_LOCATION_OK})", "listings"))
def q_screen_listings(spark, sf_dir):
    return S.screen_listings(_listings(spark, sf_dir))


@register("company_blocklist", with_views(f"SELECT {_L8} FROM listings WHERE {_COMPANY_OK}", "listings"))
def q_company_blocklist(spark, sf_dir):
    return S.company_blocklist(_listings(spark, sf_dir))


# A blocklist that is data: customers with little on their account, and all other names.
_BLOCKLIST_SQL = """SELECT concat('Customer#', CAST(c_custkey AS STRING)) AS name FROM customer WHERE c_acctbal < 1000
UNION ALL SELECT company FROM listings WHERE company NOT LIKE 'Customer#%'"""


@register("company_blocklist_table", with_views(
    f"SELECT {_L8} FROM listings WHERE company NOT IN ({_BLOCKLIST_SQL})", "listings"))
def q_company_blocklist_table(spark, sf_dir):
    listings = _listings(spark, sf_dir)
    poor = fx.table(spark, sf_dir, "customer").filter("c_acctbal < 1000")
    names = poor.select(F.concat(F.lit("Customer#"), F.col("c_custkey").cast("string")).alias("name")).unionByName(
        listings.filter(~F.col("company").like("Customer#%")).select(F.col("company").alias("name")))
    return S.company_blocklist_table(listings, names)


@register("title_pattern_exclusion", with_views(
    f"SELECT {_L8} FROM listings WHERE NOT ({_TITLE_SUBSTR})", "listings"))
def q_title_pattern_exclusion(spark, sf_dir):
    return S.title_pattern_exclusion(_listings(spark, sf_dir))


@register("title_word_exclusion", with_views(f"SELECT {_L8} FROM listings WHERE NOT {_TITLE_WORDS}", "listings"))
def q_title_word_exclusion(spark, sf_dir):
    return S.title_word_exclusion(_listings(spark, sf_dir))


@register("location_inclusion", with_views(f"SELECT {_L8} FROM listings WHERE {_LOCATION_OK}", "listings"))
def q_location_inclusion(spark, sf_dir):
    return S.location_inclusion(_listings(spark, sf_dir))


@register("junior_quick_search", with_views(
    f"SELECT {_SCREEN} FROM listings WHERE {_COMPANY_OK} AND {_TITLE_OK} AND ({_LOCATION_OK}) AND ({_JUNIOR})",
    "listings"))
def q_junior_quick_search(spark, sf_dir):
    return S.junior_quick_search(_listings(spark, sf_dir))


@register("recency_filter", f"""
SELECT * FROM events
WHERE ts > TIMESTAMP '{RECENCY_AS_OF}' - INTERVAL 24 HOURS AND ts <= TIMESTAMP '{RECENCY_AS_OF}'""")
def q_recency_filter(spark, sf_dir):
    return S.recency_filter(fx.table(spark, sf_dir, "events"), RECENCY_AS_OF, ts_col="ts")


@register("work_mode_filter", with_views(f"""
SELECT l.listing_id, l.source, s.location AS search_location, {_WORK_MODE_SQL} AS work_mode
FROM listings l JOIN (SELECT DISTINCT source, location FROM terms) s ON l.source = s.source
WHERE {_MODE_OK_SQL.format(sl='s.location', src='l.source', m=_WORK_MODE_SQL)}""", "listings", extra=[_terms_cte()]))
def q_work_mode_filter(spark, sf_dir):
    searches = load_search_terms(spark).select("source", F.col("location").alias("search_location")).distinct()
    searches = bounded_broadcast(searches, J.TERM_BROADCAST_LIMIT)
    return (S.work_mode_filter(_listings(spark, sf_dir).join(searches, "source"),
                               F.col("search_location"))
            .select("listing_id", "source", "search_location", "work_mode"))


@register("newest_first", with_views("""
SELECT listing_id, source, time_when_scraped,
       row_number() OVER (ORDER BY time_when_scraped DESC NULLS FIRST, listing_id, source) AS rank
FROM listings""", "listings"))
def q_newest_first(spark, sf_dir):
    return S.newest_first(_listings(spark, sf_dir)).select("listing_id", "source", "time_when_scraped", "rank")


# --- A1-A4: trends -------------------------------------------------------------

@register("jobs_per_day", with_views("""
SELECT CAST(CAST(time_when_scraped AS DATE) AS TIMESTAMP) AS date_only, rpad(strftime(time_when_scraped, '%A'), 9, ' ') AS day_of_week,
       count(*) AS number_of_jobs_posted
FROM listings GROUP BY 1, 2""", "listings"))
def q_jobs_per_day(spark, sf_dir):
    return A.jobs_per_day(_listings(spark, sf_dir))


@register("jobs_per_week", with_views("""
SELECT CAST(extract(YEAR FROM time_when_scraped) AS BIGINT) AS year,
       CAST(extract(WEEK FROM time_when_scraped) AS BIGINT) AS week, count(*) AS number_of_jobs_posted
FROM listings GROUP BY 1, 2""", "listings"))
def q_jobs_per_week(spark, sf_dir):
    return A.jobs_per_week(_listings(spark, sf_dir))


@register("jobs_per_year", with_views("""
SELECT CAST(extract(YEAR FROM time_when_scraped) AS BIGINT) AS year, count(*) AS number_of_jobs_posted
FROM listings GROUP BY 1""", "listings"))
def q_jobs_per_year(spark, sf_dir):
    return A.jobs_per_year(_listings(spark, sf_dir))


# --- the same reports as Spark SQL text over a view of the table ----------------

def _sql_twin(name: str, statement):
    @register(f"{name}_sql", ORACLE[name])
    def q(spark, sf_dir):
        # one view name per query: a repeated call replaces its view instead of adding one
        return Q_SQL.run(spark, _listings(spark, sf_dir), statement, view=f"jobsift_{name}_listings")
    q.__name__ = f"q_{name}_sql"
    return q


for _name, _stmt in (("screen_listings", Q_SQL.screen_sql),
                     ("junior_quick_search", lambda t: Q_SQL.screen_sql(t, junior_only=True)),
                     ("jobs_per_day", Q_SQL.jobs_per_day_sql),
                     ("jobs_per_week", Q_SQL.jobs_per_week_sql),
                     ("jobs_per_year", Q_SQL.jobs_per_year_sql)):
    _sql_twin(_name, _stmt)


@register("estimated_row_count", "SELECT count(*) AS estimate FROM orders")
def q_estimated_row_count(spark, sf_dir):
    store = scratch_path(spark, "store")
    st.append_listings(_listings(spark, sf_dir), store, "0")
    return A.estimated_row_count(spark, store)


# --- P1-P3, C1-C3: quality ----------------------------------------------------

@register("conform_listing", with_views(f"""
SELECT listing_id, source, title, company, link, TRY_CAST(time_when_scraped AS TIMESTAMP) AS time_when_scraped,
       location, compensation
FROM delivery""", "delivery"))
def q_conform_listing(spark, sf_dir):
    return Q.conform_listing(fx.delivery(spark, sf_dir))


@register("numeric_listing_id", with_views(f"""
SELECT {_L8} FROM listings
WHERE CASE WHEN source = 'LinkedIn' THEN NOT regexp_matches(listing_id, '[^0-9]') ELSE TRUE END""", "listings"))
def q_numeric_listing_id(spark, sf_dir):
    return Q.numeric_listing_id(_listings(spark, sf_dir))


def _not_null_sql() -> str:
    parts = [f"SELECT listing_id, source, '{c}' AS column_name FROM conformed WHERE {c} IS NULL"
             for c in REQUIRED_COLUMNS]
    return "\nUNION ALL\n".join(parts)


_NULL_BAD_SQL = " OR ".join(f"{c} IS NULL" for c in REQUIRED_COLUMNS)


def _conformed_cte(view: str) -> str:
    return ("conformed AS (SELECT listing_id, source, title, company, link, "
            "TRY_CAST(time_when_scraped AS TIMESTAMP) AS time_when_scraped, location, compensation, file_name "
            f"FROM {view})")


@register("not_null_check", with_views(_not_null_sql(), "delivery", extra=[_conformed_cte("delivery")]))
def q_not_null_check(spark, sf_dir):
    return Q.not_null_check(Q.conform_listing(fx.delivery(spark, sf_dir)))


@register("primary_key_check", with_views("""
SELECT listing_id, source, count(*) AS n_rows FROM card_sequence GROUP BY listing_id, source HAVING count(*) > 1""",
                                          "card_sequence"))
def q_primary_key_check(spark, sf_dir):
    return Q.primary_key_check(fx.card_sequence(spark, sf_dir))


# The new rows of a delivery (P2, then not stored: J1) with their NOT NULL flag, per
# (file, key); then the files one after the other by name (they have no time here):
# a file is bad if it has a bad row of a key that no good file before it holds
# cleanly. ``walk`` carries the names of the bad files so far.
_NEW_ROWS_CTES = ["""
new_rows AS (
  SELECT c.*, (""" + _NULL_BAD_SQL + """) AS null_bad
  FROM conformed c
  WHERE CASE WHEN source = 'LinkedIn' THEN NOT regexp_matches(listing_id, '[^0-9]') ELSE TRUE END
    AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.listing_id = c.listing_id AND s.source = c.source))""", """
per_key AS MATERIALIZED (
  SELECT file_name, listing_id, source, count(*) AS n, count(*) FILTER (WHERE null_bad) AS n_null_bad,
         CASE WHEN count(*) > 1 THEN count(*) ELSE count(*) FILTER (WHERE null_bad) END AS bad
  FROM new_rows GROUP BY file_name, listing_id, source)""", """
ordered AS MATERIALIZED (
  SELECT file_name, row_number() OVER (ORDER BY file_name) AS i FROM (SELECT DISTINCT file_name FROM per_key))""", """
claims AS MATERIALIZED (
  SELECT p.file_name, p.listing_id, p.source, coalesce(list(q.file_name) FILTER (WHERE q.file_name IS NOT NULL), []) AS holders
  FROM per_key p LEFT JOIN per_key q ON q.listing_id = p.listing_id AND q.source = p.source
    AND q.file_name < p.file_name AND q.n = 1 AND q.n_null_bad = 0
  WHERE p.bad > 0 GROUP BY p.file_name, p.listing_id, p.source)""", """
walk AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS bad
  UNION ALL
  SELECT w.i + 1, CASE WHEN EXISTS (SELECT 1 FROM claims c WHERE c.file_name = f.file_name AND list_has_all(w.bad, c.holders))
                       THEN list_append(w.bad, f.file_name) ELSE w.bad END
  FROM walk w JOIN ordered f ON f.i = w.i + 1)""", """
bad_files AS (SELECT unnest(bad) AS file_name FROM walk WHERE i = (SELECT max(i) FROM walk))""", """
supply AS (
  SELECT listing_id, source, min(file_name) AS first_file FROM per_key
  WHERE n = 1 AND n_null_bad = 0 AND file_name NOT IN (SELECT file_name FROM bad_files)
  GROUP BY listing_id, source)""", """
stats AS (
  SELECT p.file_name,
         CAST(sum(CASE WHEN s.first_file < p.file_name THEN 0 ELSE p.n END) AS BIGINT) AS n_new,
         CAST(sum(CASE WHEN s.first_file < p.file_name THEN 0 ELSE p.bad END) AS BIGINT) AS n_bad
  FROM per_key p LEFT JOIN supply s ON s.listing_id = p.listing_id AND s.source = p.source
  GROUP BY p.file_name)""", """
to_append AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY listing_id, source ORDER BY file_name) AS rn
    FROM new_rows WHERE file_name NOT IN (SELECT file_name FROM bad_files))
  WHERE rn = 1)"""]


def _with_new_rows(sql: str, *more, view: str = "deliveries") -> str:
    text = with_views(sql, view, "stored", extra=[_conformed_cte(view), *_NEW_ROWS_CTES, *more])
    return "WITH RECURSIVE" + text.removeprefix("WITH")


def _delivery_batch(spark, sf_dir):
    rows = fx.deliveries(spark, sf_dir)
    known = fx.stored_listings(spark, sf_dir).select(*KEY)
    return rows, known


@register("file_quarantine", _with_new_rows(f"""
SELECT {_L8}, file_name FROM to_append"""))
def q_file_quarantine(spark, sf_dir):
    rows, known = _delivery_batch(spark, sf_dir)
    to_append, _ = L.plan_batch(rows, known)
    return to_append


# The run calendar: one run per site and month from its first month to the
# month after its last, so months without listings are header-only files.
_CALENDAR_SQL = """
calendar AS (
  SELECT source || '_' || strftime(m, '%Y%m%d_%H%M') || '.csv' AS file_name
  FROM (SELECT source, unnest(generate_series(date_trunc('month', min(time_when_scraped)),
                                              date_trunc('month', max(time_when_scraped)) + INTERVAL 1 MONTH,
                                              INTERVAL 1 MONTH)) AS m
        FROM listings GROUP BY source))"""


def run_calendar(spark, sf_dir) -> DataFrame:
    lst = _listings(spark, sf_dir)
    span = lst.groupBy("source").agg(F.min("time_when_scraped").alias("lo"), F.max("time_when_scraped").alias("hi"))
    months = span.select("source", F.explode(F.sequence(
        F.trunc(F.to_date("lo"), "month"),
        F.add_months(F.trunc(F.to_date("hi"), "month"), 1),
        F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return months.select(result_set_file_name(F.col("source"), F.col("m").cast("timestamp_ntz")).alias("file_name"))


@register("ingest_outcome", _with_new_rows("""
SELECT c.file_name, coalesce(r.n_rows, 0) AS n_rows, coalesce(s.n_new, 0) AS n_new, coalesce(s.n_bad, 0) AS n_bad,
       coalesce(a.n_loaded, 0) AS n_loaded,
       CASE WHEN coalesce(r.n_rows, 0) = 0 THEN 'EMPTY' WHEN coalesce(s.n_new, 0) = 0 THEN 'NO_NEW'
            WHEN s.n_bad > 0 THEN 'ERROR' WHEN coalesce(a.n_loaded, 0) = 0 THEN 'NO_NEW' ELSE 'LOADED' END AS outcome
FROM calendar c
LEFT JOIN (SELECT file_name, count(*) AS n_rows FROM conformed GROUP BY file_name) r ON r.file_name = c.file_name
LEFT JOIN stats s ON s.file_name = c.file_name
LEFT JOIN (SELECT file_name, count(*) AS n_loaded FROM to_append GROUP BY file_name) a ON a.file_name = c.file_name""",
                                      _CALENDAR_SQL))
def q_ingest_outcome(spark, sf_dir):
    rows, known = _delivery_batch(spark, sf_dir)
    _, outcomes = L.plan_batch(rows, known, files=run_calendar(spark, sf_dir))
    return outcomes


# --- J1, D1, D2: joins and dedupe -------------------------------------------------

@register("new_listings", with_views(f"""
SELECT {_L8} FROM listings l
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.listing_id = l.listing_id AND s.source = l.source)""", "stored"))
def q_new_listings(spark, sf_dir):
    return D.new_listings(_listings(spark, sf_dir), fx.stored_listings(spark, sf_dir).select(*KEY))


@register("latest_per_listing", with_views(f"""
SELECT {_L8}, run_time, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY source, run_time, listing_id ORDER BY seq DESC) AS rn
  FROM card_sequence) WHERE rn = 1""", "card_sequence"))
def q_latest_per_listing(spark, sf_dir):
    return D.latest_per_listing(fx.card_sequence(spark, sf_dir))


@register("first_file_wins", with_views(f"""
SELECT {_L8}, file_name FROM (
  SELECT *, row_number() OVER (PARTITION BY listing_id, source
                               ORDER BY strptime(regexp_extract(file_name, '_(\\d{{8}}_\\d{{4}})\\.csv$', 1),
                                                 '%Y%m%d_%H%M'), file_name) AS rn
  FROM rescraped) WHERE rn = 1""", "rescraped"))
def q_first_file_wins(spark, sf_dir):
    df = fx.rescraped(spark, sf_dir).withColumn("file_time", file_name_time(F.col("file_name")))
    return D.first_file_wins(df, "file_time").drop("file_time")


@register("member_of_array", f"""
WITH roles AS (
  SELECT 'region:' || CAST(r_regionkey AS VARCHAR) AS oid, r_name AS rolname FROM region
  UNION ALL SELECT 'nation:' || CAST(n_nationkey AS VARCHAR), n_name FROM nation),
members AS (SELECT 'region:' || CAST(n_regionkey AS VARCHAR) AS roleid,
                   'nation:' || CAST(n_nationkey AS VARCHAR) AS member FROM nation)
SELECT r.rolname,
       coalesce(array_to_string(list_sort(list(b.rolname) FILTER (WHERE b.rolname IS NOT NULL)), ','), '')
         AS memberof
FROM roles r LEFT JOIN (members m JOIN roles b ON m.roleid = b.oid) ON m.member = r.oid
WHERE r.rolname NOT IN ({_sql_list(EXCLUDED_REGIONS)})
GROUP BY r.oid, r.rolname""")
def q_member_of_array(spark, sf_dir):
    region, nation = fx.table(spark, sf_dir, "region"), fx.table(spark, sf_dir, "nation")
    roles = (region.select(F.concat(F.lit("region:"), F.col("r_regionkey").cast("string")).alias("oid"),
                           F.col("r_name").alias("rolname"))
             .unionByName(nation.select(F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("oid"),
                                        F.col("n_name").alias("rolname"))))
    members = nation.select(F.concat(F.lit("region:"), F.col("n_regionkey").cast("string")).alias("roleid"),
                            F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("member"))
    out = R.member_of_array(roles, members, EXCLUDED_REGIONS)
    return out.select("rolname", F.array_join("memberof", ",").alias("memberof"))


@register("search_term_match", with_views(f"""
SELECT l.listing_id, l.source, CAST(t.idx AS BIGINT) AS term_idx, t.keyword, t.location AS search_location,
       CASE WHEN t.source = 'BuiltIn' AND t.location = 'Remote' THEN 'United States' ELSE t.location END
         AS query_location
FROM listings l JOIN terms t ON l.source = t.source
WHERE list_bool_and(list_transform(string_split_regex(lower(trim(t.keyword)), '\\s+'),
                                   lambda tok: position(tok IN lower(l.title)) > 0))
  AND {_MODE_OK_SQL.format(sl='t.location', src='l.source', m=_WORK_MODE_SQL)}""", "listings", extra=[_terms_cte()]))
def q_search_term_match(spark, sf_dir):
    return J.search_term_match(_listings(spark, sf_dir), load_search_terms(spark))


# Every part is a listing (its name and type the title) and a term (its type's start and its name's last word).
_PART_LISTINGS = """part_listings AS (SELECT CAST(p_partkey AS VARCHAR) AS listing_id,
  CASE p_partkey % 4 WHEN 0 THEN 'LinkedIn' WHEN 1 THEN 'Indeed' WHEN 2 THEN 'BuiltIn' ELSE 'Dice' END AS source,
  p_name || ' ' || p_type || ' ' || CAST(p_size AS VARCHAR) AS title, CASE WHEN p_partkey % 3 = 0 THEN 'Remote' ELSE 'Columbus, OH' END AS location,
  p_partkey AS idx, substring(p_type, 1, 4) || ' ' || split_part(p_name, ' ', 2) || ' ' || CAST(p_partkey % 600 AS VARCHAR) AS keyword FROM part)"""


@register("search_term_match_index", f"""WITH {_PART_LISTINGS}
SELECT l.listing_id, l.source, t.idx AS term_idx, t.keyword, t.location AS search_location,
       CASE WHEN t.source = 'BuiltIn' AND t.location = 'Remote' THEN 'United States' ELSE t.location END AS query_location
FROM part_listings l JOIN part_listings t ON l.source = t.source
WHERE list_bool_and(list_transform(string_split_regex(lower(trim(t.keyword)), '\\s+'), lambda tok: position(tok IN lower(l.title)) > 0))
  AND {_MODE_OK_SQL.format(sl='t.location', src='l.source', m=_WORK_MODE_SQL)}""")
def q_search_term_match_index(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    rows = part.select(
        F.col("p_partkey").cast("string").alias("listing_id"),
        F.element_at(F.array(*[F.lit(x) for x in ("LinkedIn", "Indeed", "BuiltIn", "Dice")]), (F.col("p_partkey") % 4 + 1).cast("int")).alias("source"),
        F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string")).alias("title"),
        F.when(F.col("p_partkey") % 3 == 0, "Remote").otherwise("Columbus, OH").alias("location"), F.col("p_partkey").alias("idx"),
        F.concat_ws(" ", F.substring("p_type", 1, 4), F.element_at(F.split("p_name", " "), 2), (F.col("p_partkey") % 600).cast("string")).alias("keyword"))
    return J.search_term_match(rows.select("listing_id", "source", "title", "location"), rows.select("source", "idx", "keyword", "location"),
                               broadcast_limit=0)


# --- S1-S8: files and store -------------------------------------------------

@register("read_listings_csv", with_views(f"""
SELECT listing_id, source, title || ' "' || source || '"' AS title, company, link, time_when_scraped,
       replace(location, ', ', ',' || chr(10)) AS location, compensation
FROM delivery""", "delivery"))
def q_read_listings_csv(spark, sf_dir):
    """Round trip of awkward text: quotes in titles, line breaks in locations, NULLs, bad times."""
    d = fx.delivery(spark, sf_dir).withColumn(
        "title", F.concat(F.col("title"), F.lit(' "'), F.col("source"), F.lit('"'))).withColumn(
        "location", F.replace(F.col("location"), F.lit(", "), F.lit(",\n")))
    folder = scratch_path(spark, "drop")
    csvio.write_result_set_csv(d, folder)
    return csvio.read_listings_csv(spark, csvio.top_level_csv(folder), with_file=False)


@register("write_result_set_csv", with_views(f"""
SELECT listing_id, source, title, company, link, strftime(time_when_scraped, '%Y-%m-%d %H:%M:%S') AS time_when_scraped,
       location, compensation,
       source || '_' || strftime(date_trunc('month', time_when_scraped), '%Y%m%d_%H%M') || '.csv' AS file_name
FROM listings""", "listings"))
def q_write_result_set_csv(spark, sf_dir):
    lst = _listings(spark, sf_dir).withColumn("run_time", fx.run_time(F.col("time_when_scraped")))
    folder = scratch_path(spark, "drop")
    csvio.write_result_set_csv(lst, folder, run_time_col="run_time")
    return csvio.read_listings_csv(spark, csvio.top_level_csv(folder)).drop("file_time", "file_error")


@register("discover_listing_files", with_views(f"""
SELECT c.file_name, coalesce(d.n_rows, 0) AS n_rows
FROM calendar c LEFT JOIN (SELECT file_name, count(*) AS n_rows FROM delivery GROUP BY file_name) d
  ON d.file_name = c.file_name""", "delivery", "listings", extra=[_CALENDAR_SQL]))
def q_discover_listing_files(spark, sf_dir):
    folder = scratch_path(spark, "drop")
    d = fx.delivery(spark, sf_dir)
    csvio.write_result_set_csv(d, folder)
    # header-only files for the runs that found nothing
    cal = run_calendar(spark, sf_dir)
    empty_runs = cal.join(d.select("file_name").distinct(), "file_name", "left_anti")
    csvio.write_empty_result_sets(empty_runs, folder)
    # decoys the discovery must skip: a Processed/ sub-folder and a non-csv file
    csvio.write_result_set_csv(d.filter(F.col("source") == "Dice"), f"{folder}/Processed")
    d.select("listing_id").write.mode("overwrite").text(f"{folder}/notes.txt")
    return csvio.discover_listing_files(spark, folder).select("file_name", "n_rows")


@register("result_set_file_name", with_views("""
SELECT file_name, source, run_time, count(*) AS n_listings FROM (
  SELECT source || '_' || strftime(date_trunc('month', time_when_scraped), '%Y%m%d_%H%M') || '.csv' AS file_name,
         source, date_trunc('month', time_when_scraped) AS run_time
  FROM listings) GROUP BY 1, 2, 3""", "listings"))
def q_result_set_file_name(spark, sf_dir):
    names = _listings(spark, sf_dir).select(
        result_set_file_name(F.col("source"), fx.run_time(F.col("time_when_scraped"))).alias("file_name"))
    counted = names.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_listings"))
    return counted.select("file_name", file_name_source(F.col("file_name")).alias("source"),
                          file_name_time(F.col("file_name")).alias("run_time"), "n_listings")


@register("result_set_collisions", with_views(f"""
SELECT file_name, count(DISTINCT term_idx) AS n_result_sets FROM (
  SELECT l.source || '_' || strftime(date_trunc('month', l.time_when_scraped), '%Y%m%d_%H%M') || '.csv' AS file_name,
         t.idx AS term_idx
  FROM listings l JOIN terms t ON l.source = t.source
  WHERE list_bool_and(list_transform(string_split_regex(lower(trim(t.keyword)), '\\s+'),
                                     lambda tok: position(tok IN lower(l.title)) > 0))
    AND {_MODE_OK_SQL.format(sl='t.location', src='l.source', m=_WORK_MODE_SQL)})
GROUP BY file_name HAVING count(DISTINCT term_idx) > 1""", "listings", extra=[_terms_cte()]))
def q_result_set_collisions(spark, sf_dir):
    """Result sets are (site, search term, run); a run's sets of one site share a minute, so they
    share a file name and all but the last are overwritten."""
    lst = _listings(spark, sf_dir)
    matched = J.search_term_match(lst, load_search_terms(spark), keep=["time_when_scraped"])
    sets = matched.select(result_set_file_name(F.col("source"), fx.run_time(F.col("time_when_scraped")))
                          .alias("file_name"), "term_idx")
    return file_name_collisions(sets)


@register("read_known_keys", with_views("SELECT listing_id, source FROM stored", "stored"))
def q_read_known_keys(spark, sf_dir):
    store = scratch_path(spark, "store")
    st.append_listings(fx.stored_listings(spark, sf_dir), store, "0")
    return st.read_known_keys(spark, store)


@register("append_listings", with_views(f"SELECT {_L8} FROM listings", "listings"))
def q_append_listings(spark, sf_dir):
    store = scratch_path(spark, "store")
    stored = fx.stored_listings(spark, sf_dir)
    st.append_listings(stored, store, "0", identity="stored")
    st.append_listings(D.new_listings(_listings(spark, sf_dir), stored.select(*KEY)), store, "1")
    st.append_listings(stored, store, "0", identity="stored")  # the same batch again is not added twice
    return st.read_listings(spark, store)


@register("ingest_drop_folder", _with_new_rows(f"""
SELECT {_L8} FROM stored
UNION ALL
SELECT {_L8} FROM to_append""", view="delivery"))
def q_ingest_drop_folder(spark, sf_dir):
    from ..streaming.ingest import ingest_drop_folder

    root = scratch_path(spark, "ingest")
    store, drop = f"{root}/store", f"{root}/drop"
    st.append_listings(fx.stored_listings(spark, sf_dir), store, "initial")
    csvio.write_result_set_csv(fx.delivery(spark, sf_dir), drop)
    ingest_drop_folder(spark, drop, store, f"{root}/checkpoint", f"{root}/outcomes")
    return st.read_listings(spark, store)


# --- X1-X7: pages -> listings -------------------------------------------------

def _pages(spark, sf_dir, site):
    return fx.result_pages(spark, sf_dir).filter(F.col("source") == site)


_CARD_COLS = "listing_id, source, title, company, link, location, compensation"


@register("extract_linkedin_cards", with_views(f"""
SELECT listing_id, source, title, company, 'https://www.linkedin.com/jobs/view/' || listing_id AS link,
       location, compensation
FROM listings WHERE source = 'LinkedIn' AND compensation IS NOT NULL""", "listings"))
def q_extract_linkedin_cards(spark, sf_dir):
    return X.extract_linkedin_cards(_pages(spark, sf_dir, "LinkedIn")).select(*X.CARD_COLUMNS)


@register("extract_indeed_cards", with_views(f"""
SELECT listing_id, source, title, company, 'https://www.indeed.com/viewjob?jk=' || listing_id AS link,
       location, compensation
FROM listings WHERE source = 'Indeed'""", "listings"))
def q_extract_indeed_cards(spark, sf_dir):
    return X.extract_indeed_cards(_pages(spark, sf_dir, "Indeed")).select(*X.CARD_COLUMNS)


_GATED = "CASE WHEN compensation LIKE '%Annually%' THEN compensation END"


@register("extract_builtin_cards", with_views(f"""
SELECT listing_id, source, title, company, link, location, {_GATED} AS compensation
FROM listings WHERE source = 'BuiltIn'""", "listings"))
def q_extract_builtin_cards(spark, sf_dir):
    return X.extract_builtin_cards(_pages(spark, sf_dir, "BuiltIn")).select(*X.CARD_COLUMNS)


@register("extract_dice_cards", with_views(f"""
SELECT listing_id, source, title, company, link, location, {_GATED} AS compensation
FROM listings WHERE source = 'Dice'""", "listings"))
def q_extract_dice_cards(spark, sf_dir):
    return X.extract_dice_cards(_pages(spark, sf_dir, "Dice")).select(*X.CARD_COLUMNS)


@register("extract_listing_cards", with_views(f"""
SELECT listing_id, source, title, company,
       CASE source WHEN 'LinkedIn' THEN 'https://www.linkedin.com/jobs/view/' || listing_id
                   WHEN 'Indeed' THEN 'https://www.indeed.com/viewjob?jk=' || listing_id ELSE link END AS link,
       location, CASE WHEN source IN ('BuiltIn', 'Dice') THEN {_GATED} ELSE compensation END AS compensation
FROM listings WHERE source <> 'LinkedIn' OR compensation IS NOT NULL""", "listings"))
def q_extract_listing_cards(spark, sf_dir):
    return X.extract_listing_cards(fx.result_pages(spark, sf_dir)).select(*X.CARD_COLUMNS)


@register("listing_link", with_views("""
SELECT listing_id, source,
       CASE source WHEN 'LinkedIn' THEN 'https://www.linkedin.com/jobs/view/' || listing_id
                   WHEN 'Indeed' THEN 'https://www.indeed.com/viewjob?jk=' || listing_id ELSE link END AS link
FROM listings""", "listings"))
def q_listing_link(spark, sf_dir):
    return _listings(spark, sf_dir).select(
        "listing_id", "source", listing_link(F.col("source"), F.col("listing_id"), F.col("link")).alias("link"))


@register("compensation_gate", with_views(f"SELECT listing_id, source, {_GATED} AS compensation FROM listings",
                                          "listings"))
def q_compensation_gate(spark, sf_dir):
    return _listings(spark, sf_dir).select("listing_id", "source",
                                           compensation_gate(F.col("compensation")).alias("compensation"))


@register("next_page", with_views("""
SELECT source, page_id, NOT is_last AS has_next,
       CASE WHEN is_last THEN NULL ELSE CAST(page_id + 2 AS INTEGER) END AS next_page,
       CASE WHEN is_last OR source = 'LinkedIn' THEN NULL ELSE '?page=' || CAST(page_id + 2 AS VARCHAR) END
         AS next_link
FROM result_pages""", "result_pages"))
def q_next_page(spark, sf_dir):
    return X.with_pager(fx.result_pages(spark, sf_dir)).select("source", "page_id", "has_next", "next_page",
                                                               "next_link")


def _decoded(x: str) -> str:
    """DuckDB: decode the entities the pages use (with or without the closing ';', as
    HTML5 does for these legacy names), collapse whitespace, '' -> NULL."""
    for ent, ch in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"), ("nbsp", " "),
                    ("amp", "&")):
        x = f"regexp_replace({x}, '&{ent};?', '{ch}', 'g')"
    x = f"replace({x}, '&#39;', chr(39))"
    return f"nullif(trim(regexp_replace({x}, '\\s+', ' ', 'g')), '')"


@register("extract_page_fields", f"""
SELECT CAST(page_id AS BIGINT) AS page_id,
       {_decoded("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")} AS title,
       {_decoded("regexp_extract(html, '<article>.*?<h1>(.*?)</h1>', 1, 's')")} AS h1,
       CAST(len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a\\s[^>]*href=')) AS BIGINT)
         AS n_nav_links
FROM pages""")
def q_extract_page_fields(spark, sf_dir):
    return X.extract_page_fields(fx.table(spark, sf_dir, "pages"))
