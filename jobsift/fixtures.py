"""Views derived from the given tables, in Spark and as DuckDB SQL text.

The given tables hold no job listings, so the ``listings`` view maps each
order to one listing (id, site, title, company, location and pay come from
the order's key, customer and price). Every view is whole-table: it grows with
the data and carries the awkward cases (letters in ids, NULL location and pay,
whole-word traps, blocked companies, the company the fused literal leaves
unblocked).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import result_set_file_name
from .schema import LISTING_COLUMNS, TIME_TEXT_FORMAT

# Loads stored before this time count as already in the table.
STORED_BEFORE = "1998-01-01 00:00:00"
# Rows of the delivery with a broken value (data-derived, about 0.3 % each).
BAD_TIME_BELOW_PRICE = 2500.0
NULL_TITLE_ABOVE_PRICE = 498500.0
# Page size of the result-page view: ids [40 p, 40 p + 40) of one site form page p.
PAGE_SPAN = 40
PAGE_URL_BASE = "https://jobs.example.com/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(expr: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(expr == k, v) if out is None else out.when(expr == k, v)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def listing_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``listings`` plus the order price the delivery variants key on."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    ks = k.cast("string")
    return o.select(
        F.when(k % 20 == 0, F.concat(F.lit("search-"), ks)).otherwise(ks).alias("listing_id"),
        _case(k % 4, {0: "LinkedIn", 1: "Indeed", 2: "BuiltIn"}, "Dice").alias("source"),
        _case(k % 11, {0: "Junior Developer", 1: "Senior Software Engineer", 2: "AI Engineer",
                       3: "Email Developer", 4: "QA Tester", 5: "Data Analyst", 6: "Software Engineer",
                       7: "SR. Developer", 8: "Developer, HTML Tools", 9: "ML Developer"},
              "Tech Lead").alias("title"),
        _case(c % 9, {0: "Canonical", 1: "HII", 2: "AB Media Publishing, LLC", 3: "Opinion Focus Panel LLC"},
              F.concat(F.lit("Customer#"), c.cast("string"))).alias("company"),
        F.concat(F.lit("https://jobs.example.com/view/"), ks).alias("link"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("time_when_scraped"),
        _case(k % 5, {0: "Remote", 1: "Columbus, OH", 2: "Columbus, OH (Hybrid)", 3: F.lit(None).cast("string")},
              "Austin, TX").alias("location"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 1, F.lit("$40/hr"))
        .otherwise(F.concat(F.lit("$"), F.floor(F.col("o_totalprice") / 1000).cast("bigint").cast("string"),
                            F.lit("K Annually"))).alias("compensation"),
        F.col("o_totalprice"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``listings`` view: one listing per order, 8 columns."""
    return listing_base(spark, sf_dir).select(*LISTING_COLUMNS)


def stored_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of ``listings`` loaded before STORED_BEFORE (the stored table)."""
    return listings(spark, sf_dir).filter(F.col("time_when_scraped") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))


def run_time(ts) -> Column:
    """A scrape run per site and month: the run time is the month start (date
    arithmetic, so no session time zone is involved)."""
    return F.trunc(F.to_date(ts), "month").cast("timestamp_ntz")


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing files as delivered: text columns, a few broken rows, one file per site and month.

    Columns: the 8 text columns plus ``file_name`` (``<source>_<yyyyMMdd_HHmm>.csv``).
    """
    b = listing_base(spark, sf_dir)
    ts = F.col("time_when_scraped")
    return b.select(
        "listing_id",
        "source",
        F.when(F.col("o_totalprice") > NULL_TITLE_ABOVE_PRICE, F.lit(None).cast("string"))
        .otherwise(F.col("title")).alias("title"),
        "company",
        "link",
        F.when(F.col("o_totalprice") < BAD_TIME_BELOW_PRICE, F.lit("bad"))
        .otherwise(F.date_format(ts, TIME_TEXT_FORMAT)).alias("time_when_scraped"),
        "location",
        "compensation",
        result_set_file_name(F.col("source"), run_time(ts)).alias("file_name"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``delivery`` with keys that come again: some listings once more in the next month's
    file, some of these without a title (in three months of four, so that files hang on
    each other in chains), and some twice in their own file."""
    base = listing_base(spark, sf_dir)
    ts, k = F.col("time_when_scraped"), F.regexp_extract("link", "[0-9]+$", 0).cast("bigint")
    later = F.add_months(ts, 1).cast("timestamp_ntz")
    rest = ["company", "link", F.date_format(ts, TIME_TEXT_FORMAT).alias("time_when_scraped"), "location", "compensation"]
    next_file = result_set_file_name(F.col("source"), run_time(later)).alias("file_name")
    again = base.filter(k % 13 == 0).select("listing_id", "source", "title", *rest, next_file)
    broken = base.filter((k % 17 == 0) & (F.month(ts) % 4 != 0)).select(
        "listing_id", "source", F.lit(None).cast("string").alias("title"), *rest, next_file)
    first = delivery(spark, sf_dir)
    twice = first.filter(F.regexp_extract("link", "[0-9]+$", 0).cast("bigint") % 1999 == 0)
    return first.unionByName(again).unionByName(broken).unionByName(twice)


def rescraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing seen twice: in its own month's file and again, retitled, in the next month's."""
    b = listings(spark, sf_dir)
    ts = F.col("time_when_scraped")
    first = b.select(*LISTING_COLUMNS, result_set_file_name(F.col("source"), run_time(ts)).alias("file_name"))
    again_ts = F.add_months(ts, 1).cast("timestamp_ntz")
    again = b.select(
        "listing_id", "source", F.upper("title").alias("title"), "company", "link",
        again_ts.alias("time_when_scraped"), "location", "compensation",
        result_set_file_name(F.col("source"), run_time(again_ts)).alias("file_name"),
    )
    return first.unionByName(again)


def card_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards in the order a site shows them within a run: remote listings show up twice
    (the second sighting retitled), as when a list re-renders while scrolling."""
    b = listings(spark, sf_dir)
    run = run_time(F.col("time_when_scraped"))
    first = b.select(*LISTING_COLUMNS, run.alias("run_time"), F.lit(0).alias("seq"))
    again = (b.filter(F.col("location") == "Remote")
             .select("listing_id", "source", F.concat(F.col("title"), F.lit(" (updated)")).alias("title"),
                     "company", "link", "time_when_scraped", "location", "compensation",
                     run.alias("run_time"), F.lit(1).alias("seq")))
    return first.unionByName(again)


def card_html(source: Column) -> Column:
    """One job card as each site marks it up (same text as CARDS_SQL)."""
    lid, title, company = F.col("listing_id"), F.col("title"), F.col("company")
    loc = F.coalesce(F.col("location"), F.lit(""))
    comp = F.col("compensation")
    linkedin = F.concat(
        F.lit('<div data-job-id="'), lid, F.lit('"><a class="job-card-container__link" aria-label="'), title,
        F.lit('" tabindex="0"></a><span class="job-card-container__primary-description">'), company,
        F.lit('</span><div class="artdeco-entity-lockup__caption">'), loc, F.lit("</div>"),
        F.coalesce(F.concat(F.lit('<div class="artdeco-entity-lockup__metadata">'), comp, F.lit("</div>")), F.lit("")),
        F.lit("</div>"))
    indeed = F.concat(
        F.lit('<div class="cardOutline job_'), lid, F.lit('"><h2><a data-jk="'), lid,
        F.lit('"><span id="jobTitle-'), lid, F.lit('" title="'), title, F.lit('">'), title,
        F.lit('</span></a></h2><span data-testid="company-name">'), company,
        F.lit('</span><div data-testid="text-location">'), loc, F.lit("</div>"),
        F.coalesce(F.concat(F.lit('<div class="salary-snippet-container">'), comp, F.lit("</div>")), F.lit("")),
        F.lit("</div>"))
    builtin = F.concat(
        F.lit('<div data-id="job-card"><div data-id="company-title" data-builtin-track-job-id="'), lid,
        F.lit('">'), company, F.lit('</div><h2><a href="'), F.col("link"), F.lit('">'), title,
        F.lit('</a></h2><div class="bounded-attribute-section"><div><div><div>at</div><div>'), loc,
        F.lit("</div></div>"),
        F.coalesce(F.concat(F.lit("<div><div>pay</div><div>"), comp, F.lit("</div></div>")), F.lit("")),
        F.lit("</div></div></div>"))
    return F.when(source == "LinkedIn", linkedin).when(source == "Indeed", indeed).otherwise(builtin)


def _pager(source: Column, n: Column, is_last: Column) -> Column:
    nxt = (n + 1).cast("string")
    ns = n.cast("string")
    linkedin = F.concat(
        F.lit('<ul class="pager"><li><button aria-current="true" aria-label="Page '), ns, F.lit('">'), ns,
        F.lit("</button></li>"),
        F.when(~is_last, F.concat(F.lit('<li><button aria-label="Page '), nxt, F.lit('">'), nxt,
                                  F.lit("</button></li>"))).otherwise(F.lit("")),
        F.lit("</ul>"))
    label = F.when(source == "Indeed", F.lit("Next Page")).otherwise(F.lit("Go to Next Page"))
    others = F.concat(
        F.lit('<nav class="pagination">'),
        F.when(~is_last, F.concat(F.lit('<a aria-label="'), label, F.lit('" href="?page='), nxt,
                                  F.lit('">next</a>'))).otherwise(F.lit("")),
        F.lit("</nav>"))
    return F.when(source == "LinkedIn", linkedin).otherwise(others)


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-result pages: ``(source, page_id, url, html)``, about ten cards a page.

    A page is bounded by construction (at most PAGE_SPAN ids), so gathering its
    cards is a bounded group. The last page of each site has no next-page link.
    """
    b = listings(spark, sf_dir)
    seq = F.regexp_replace(F.col("link"), ".*/", "").cast("bigint")
    cards = b.select("source", F.floor(seq / PAGE_SPAN).cast("bigint").alias("page_id"), seq.alias("seq"),
                     card_html(F.col("source")).alias("card_html"))
    # One exchange on the page key, sized by the session's shuffle-partition
    # count (a cluster sets it to its scale); the group-by reuses it. An explicit
    # count is not coalesced by AQE, so the CPU-bound parsing that follows keeps
    # its parallelism even when the compressed shuffle is small.
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = cards.repartition(n_parts, "source", "page_id").groupBy("source", "page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "card_html"))),
                                 lambda x: x["card_html"]), "").alias("cards_html"))
    # each site's last page, from the ids directly (one partial aggregate, no second pass over the pages); four rows,
    # broadcast whatever their estimated size: joined by shuffle, all pages of a site would meet in one task
    last = b.groupBy("source").agg(F.floor(F.max(seq) / PAGE_SPAN).cast("bigint").alias("last_page_id"))
    n = F.col("page_id") + 1
    return (pages.join(F.broadcast(last), "source")
            .select("source", "page_id",
                    F.concat(F.lit(PAGE_URL_BASE), F.lower("source"), F.lit("/search?page="), n.cast("string"))
                    .alias("url"),
                    F.concat(F.lit('<!DOCTYPE html><html><head><title>Jobs</title></head><body>'
                                   '<div class="results">'), F.col("cards_html"), F.lit("</div>"),
                             _pager(F.col("source"), n, F.col("page_id") == F.col("last_page_id")),
                             F.lit("</body></html>")).alias("html")))


# ---------------------------------------------------------------------------
# The same views as DuckDB SQL, for the oracle queries.
# ---------------------------------------------------------------------------

LISTING_BASE_SQL = """
SELECT
  CASE WHEN o_orderkey % 20 = 0 THEN concat('search-', CAST(o_orderkey AS VARCHAR))
       ELSE CAST(o_orderkey AS VARCHAR) END AS listing_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'LinkedIn' WHEN 1 THEN 'Indeed' WHEN 2 THEN 'BuiltIn' ELSE 'Dice' END AS source,
  CASE o_orderkey % 11 WHEN 0 THEN 'Junior Developer' WHEN 1 THEN 'Senior Software Engineer'
       WHEN 2 THEN 'AI Engineer' WHEN 3 THEN 'Email Developer' WHEN 4 THEN 'QA Tester'
       WHEN 5 THEN 'Data Analyst' WHEN 6 THEN 'Software Engineer' WHEN 7 THEN 'SR. Developer'
       WHEN 8 THEN 'Developer, HTML Tools' WHEN 9 THEN 'ML Developer' ELSE 'Tech Lead' END AS title,
  CASE o_custkey % 9 WHEN 0 THEN 'Canonical' WHEN 1 THEN 'HII' WHEN 2 THEN 'AB Media Publishing, LLC'
       WHEN 3 THEN 'Opinion Focus Panel LLC'
       ELSE concat('Customer#', CAST(o_custkey AS VARCHAR)) END AS company,
  concat('https://jobs.example.com/view/', CAST(o_orderkey AS VARCHAR)) AS link,
  CAST(o_orderdate AS TIMESTAMP) AS time_when_scraped,
  CASE o_orderkey % 5 WHEN 0 THEN 'Remote' WHEN 1 THEN 'Columbus, OH' WHEN 2 THEN 'Columbus, OH (Hybrid)'
       WHEN 3 THEN CAST(NULL AS VARCHAR) ELSE 'Austin, TX' END AS location,
  CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS VARCHAR)
       WHEN o_orderkey % 7 = 1 THEN '$40/hr'
       ELSE concat('$', CAST(CAST(floor(o_totalprice/1000) AS BIGINT) AS VARCHAR), 'K Annually') END AS compensation,
  o_totalprice
FROM orders
"""

LISTINGS_SQL = ("SELECT listing_id, source, title, company, link, time_when_scraped, location, compensation "
                "FROM listing_base")

STORED_SQL = f"SELECT * FROM listings WHERE time_when_scraped < TIMESTAMP '{STORED_BEFORE}'"

_FILE_NAME_SQL = "source || '_' || strftime(date_trunc('month', {ts}), '%Y%m%d_%H%M') || '.csv'"

DELIVERY_SQL = f"""
SELECT listing_id, source,
  CASE WHEN o_totalprice > {NULL_TITLE_ABOVE_PRICE} THEN NULL ELSE title END AS title,
  company, link,
  CASE WHEN o_totalprice < {BAD_TIME_BELOW_PRICE} THEN 'bad'
       ELSE strftime(time_when_scraped, '%Y-%m-%d %H:%M:%S') END AS time_when_scraped,
  location, compensation,
  {_FILE_NAME_SQL.format(ts='time_when_scraped')} AS file_name
FROM listing_base
"""

_SEQ_SQL = "CAST(regexp_extract(link, '[0-9]+$') AS BIGINT)"
_NEXT_FILE_SQL = _FILE_NAME_SQL.format(ts="(time_when_scraped + INTERVAL 1 MONTH)")
_REST_SQL = "company, link, strftime(time_when_scraped, '%Y-%m-%d %H:%M:%S') AS time_when_scraped, location, compensation"

DELIVERIES_SQL = f"""
SELECT * FROM delivery
UNION ALL
SELECT listing_id, source, title, {_REST_SQL}, {_NEXT_FILE_SQL} AS file_name
FROM listing_base WHERE {_SEQ_SQL} % 13 = 0
UNION ALL
SELECT listing_id, source, NULL AS title, {_REST_SQL}, {_NEXT_FILE_SQL} AS file_name
FROM listing_base WHERE {_SEQ_SQL} % 17 = 0 AND month(time_when_scraped) % 4 <> 0
UNION ALL
SELECT * FROM delivery WHERE {_SEQ_SQL} % 1999 = 0
"""

RESCRAPED_SQL = f"""
SELECT listing_id, source, title, company, link, time_when_scraped, location, compensation,
       {_FILE_NAME_SQL.format(ts='time_when_scraped')} AS file_name
FROM listings
UNION ALL
SELECT listing_id, source, upper(title) AS title, company, link,
       time_when_scraped + INTERVAL 1 MONTH AS time_when_scraped, location, compensation,
       {_FILE_NAME_SQL.format(ts="(time_when_scraped + INTERVAL 1 MONTH)")} AS file_name
FROM listings
"""

CARD_SEQUENCE_SQL = """
SELECT *, date_trunc('month', time_when_scraped) AS run_time, 0 AS seq FROM listings
UNION ALL
SELECT listing_id, source, title || ' (updated)' AS title, company, link, time_when_scraped, location,
       compensation, date_trunc('month', time_when_scraped) AS run_time, 1 AS seq
FROM listings WHERE location = 'Remote'
"""

PAGES_SQL = f"""
SELECT source, page_id, page_id = max(page_id) OVER (PARTITION BY source) AS is_last
FROM (SELECT DISTINCT source,
             CAST(floor(CAST(regexp_replace(link, '.*/', '') AS BIGINT) / {PAGE_SPAN}) AS BIGINT) AS page_id
      FROM listings)
"""

_VIEW_SQL = {
    "listing_base": LISTING_BASE_SQL,
    "listings": LISTINGS_SQL,
    "stored": STORED_SQL,
    "delivery": DELIVERY_SQL,
    "deliveries": DELIVERIES_SQL,
    "rescraped": RESCRAPED_SQL,
    "card_sequence": CARD_SEQUENCE_SQL,
    "result_pages": PAGES_SQL,
}
_VIEW_DEPS = {
    "listing_base": [],
    "listings": ["listing_base"],
    "stored": ["listings"],
    "delivery": ["listing_base"],
    "deliveries": ["delivery"],
    "rescraped": ["listings"],
    "card_sequence": ["listings"],
    "result_pages": ["listings"],
}


def with_views(sql: str, *names: str, extra=()) -> str:
    """Prefix ``sql`` with the CTEs for the named views (and what they need),
    followed by the ``extra`` CTEs (``"name AS (...)"`` strings) in order."""
    order: list[str] = []

    def visit(n):
        for d in _VIEW_DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = [f"{n} AS ({_VIEW_SQL[n].strip()})" for n in order] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(ctes) + "\n" + sql.strip()
