"""The screening query and its side reports as Spark SQL text.

The reference's users paste SQL into a client; here the same statements run
through ``spark.sql`` over a view of the stored table. PostgreSQL's ``~*``
becomes ``RLIKE`` with a case-insensitive, Unicode word boundary; the rest
(``ILIKE``, ``NOT IN``, ``EXTRACT``) is Spark SQL as is. Catalyst plans these
exactly like the DataFrame forms in ``operators.screen`` / ``operators.trends``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions import rules
from ..functions.dates import DAY_NAMES
from ..functions.text import whole_word_pattern


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in dict.fromkeys(values))


def screen_sql(table: str = "job_listings", junior_only: bool = False) -> str:
    title_subs = "\n    OR ".join(f"title ILIKE '%{p}%'" for p in rules.TITLE_EXCLUDED_SUBSTRINGS)
    word_re = whole_word_pattern(rules.TITLE_EXCLUDED_WORDS).replace("\\", "\\\\")
    loc = " OR ".join(f"location ILIKE '%{p}%'" for p in rules.LOCATION_INCLUDED_SUBSTRINGS)
    junior = ""
    if junior_only:
        junior = "\n  AND (" + " OR ".join(f"title ILIKE '%{p}%'" for p in rules.JUNIOR_TITLE_SUBSTRINGS) + ")"
    return f"""
SELECT time_when_scraped, link, title, company, compensation, location, source, listing_id
FROM {table}
WHERE company NOT IN ({_quoted(rules.BLOCKED_COMPANIES)})
  AND NOT (
    {title_subs}
    OR title RLIKE '{word_re}')
  AND ({loc}){junior}
ORDER BY time_when_scraped DESC NULLS FIRST, listing_id, source"""


def jobs_per_day_sql(table: str = "job_listings") -> str:
    names = " ".join(f"WHEN {i} THEN '{n.ljust(9)}'" for i, n in enumerate(DAY_NAMES, 1))
    return f"""
SELECT CAST(day AS TIMESTAMP_NTZ) AS date_only,
       CASE dayofweek(day) {names} END AS day_of_week,
       number_of_jobs_posted
FROM (SELECT to_date(time_when_scraped) AS day, count(*) AS number_of_jobs_posted FROM {table} GROUP BY 1)
ORDER BY date_only"""


def jobs_per_week_sql(table: str = "job_listings") -> str:
    return f"""
SELECT CAST(EXTRACT(YEAR FROM time_when_scraped) AS BIGINT) AS year,
       CAST(EXTRACT(WEEK FROM time_when_scraped) AS BIGINT) AS week,
       count(*) AS number_of_jobs_posted
FROM {table}
GROUP BY 1, 2
ORDER BY year, week"""


def jobs_per_year_sql(table: str = "job_listings") -> str:
    return f"""
SELECT CAST(EXTRACT(YEAR FROM time_when_scraped) AS BIGINT) AS year, count(*) AS number_of_jobs_posted
FROM {table}
GROUP BY 1
ORDER BY year"""


def as_view(df: DataFrame, name: str | None = None) -> str:
    """Register ``df`` as a temporary view; a unique name unless one is given."""
    name = name or f"job_listings_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(name)
    return name


def register_store(spark: SparkSession, store_path: str, name: str = "job_listings") -> str:
    """The stored table as a temporary view ``name`` (8 columns), for ad-hoc SQL."""
    from ..sources.store import read_listings

    return as_view(read_listings(spark, store_path), name)


def run(spark: SparkSession, df: DataFrame, statement, view: str | None = None) -> DataFrame:
    """Run ``statement(view_name)`` over ``df`` registered as a view (named ``view``,
    or a unique name)."""
    return spark.sql(statement(as_view(df, view)))
