"""Search terms: a JSON object of ``<Site>_Search_Terms`` arrays of ``{keyword, location}``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules

SUFFIX = "_Search_Terms"

_TERM = T.StructType([T.StructField("keyword", T.StringType()), T.StructField("location", T.StringType())])
# The whole document as a map: any site keys, empty arrays and extra fields parse alike.
_DOC = T.MapType(T.StringType(), T.ArrayType(_TERM))


def default_terms_document() -> str:
    """The configured terms (``rules.SEARCH_TERMS``) as a search-terms JSON document."""
    doc: dict[str, list] = {}
    for site, keyword, location in rules.SEARCH_TERMS:
        doc.setdefault(f"{site}{SUFFIX}", []).append({"keyword": keyword, "location": location})
    return json.dumps(doc)


def _explode_doc(docs: DataFrame) -> DataFrame:
    """``docs(doc string)`` -> ``(source, idx, keyword, location)``: ``from_json`` to a
    map, one row per ``<Site>_Search_Terms`` key, ``posexplode`` of its terms."""
    sites = docs.select(F.explode(F.from_json("doc", _DOC)).alias("key", "terms"))
    return (sites.filter(F.col("key").endswith(SUFFIX))
            .select(F.expr(f"substring(key, 1, length(key) - {len(SUFFIX)})").alias("source"),
                    F.posexplode("terms").alias("idx", "term"))
            .select("source", F.col("idx").cast("bigint").alias("idx"),
                    F.col("term.keyword").alias("keyword"), F.col("term.location").alias("location")))


def load_search_terms(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``(source, idx, keyword, location)``, one row per term, in file order per site.

    ``path`` is a search-terms JSON file on the driver (a few kilobytes of
    configuration, so it need not be on the executors' file system); without
    it the configured terms are used. The document is parsed by Spark.
    """
    if path:
        with open(path, encoding="utf-8") as fh:
            text = fh.read()
    else:
        text = default_terms_document()
    return _explode_doc(spark.createDataFrame([(text,)], "doc string"))


def read_search_terms_json(spark: SparkSession, path: str) -> DataFrame:
    """S7 for a file on shared storage: read whole as text, then the same parse."""
    return _explode_doc(spark.read.text(path, wholetext=True).select(F.col("value").alias("doc")))


def _sql_text(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def terms_values_sql(path: str | None = None) -> str:
    """The terms as a SQL ``VALUES`` list ``(source, idx, keyword, location)`` (for the oracle)."""
    if path:
        with open(path, encoding="utf-8") as fh:
            doc = json.load(fh)
    else:
        doc = json.loads(default_terms_document())
    rows = []
    for key, arr in doc.items():
        if not key.endswith(SUFFIX):
            continue
        site = key[: -len(SUFFIX)]
        for i, t in enumerate(arr):
            rows.append(f"({_sql_text(site)}, {i}, {_sql_text(t.get('keyword'))}, {_sql_text(t.get('location'))})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(source, idx, keyword, location)"
