"""Which search terms a listing answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import search_location_rewrite, work_mode, work_mode_allowed
from ..session import cut_lineage
from .joins import bounded_broadcast

# Search terms are configuration; beyond this many the join is not broadcast.
TERM_BROADCAST_LIMIT = 100_000
#: Characters of an index gram; a title of a HOT_SHARE-th of all listings is dealt to SALTS tasks.
GRAM, HOT_SHARE, SALTS = 3, 64, 32


def search_term_match(listings: DataFrame, terms: DataFrame, keep=(), broadcast_limit: int = TERM_BROADCAST_LIMIT) -> DataFrame:
    """``(listing_id, source, term_idx, keyword, search_location, query_location)``.

    A listing answers a term of its own site when every keyword token occurs
    in the title (case-insensitive) and its work mode is one that site's
    search returns for the term's location. Up to ``broadcast_limit`` terms are broadcast, so listings
    are never shuffled: an equi join on the site with a higher-order ``forall`` condition, evaluated
    JVM-side. Larger term tables go through an index of character grams (``_answers_by_index``). ``keep``
    names listing columns to carry along.
    """
    t = terms.select(
        F.col("source").alias("t_source"),
        F.col("idx").alias("term_idx"),
        "keyword",
        F.col("location").alias("search_location"),
        search_location_rewrite(F.col("source"), F.col("location")).alias("query_location"),
        F.split(F.lower(F.trim("keyword")), r"\s+").alias("_tokens"),
    )
    # per-listing values once, before the join (not per listing-term pair)
    lst = listings.select("listing_id", "source", *keep, F.lower(F.col("title")).alias("_title"),
                          work_mode(F.col("location")).alias("_mode"))
    small = bounded_broadcast(t, broadcast_limit)
    found = lst.join(small, (F.col("source") == F.col("t_source")) & _tokens_in_title()) if small is not t else _answers_by_index(lst, t)
    return (found.filter(work_mode_allowed(F.col("source"), F.col("search_location"), F.col("_mode")))
            .select("listing_id", "source", "term_idx", "keyword", "search_location", "query_location", *keep))


def _tokens_in_title():
    return F.forall("_tokens", lambda tok: F.instr(F.col("_title"), tok) > 0)


def _grams(text, size):
    """The distinct substrings of ``size`` characters (a column of its own per row)."""
    n = F.length(text) - size + 1
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, i, size)))) \
        .otherwise(F.array().cast("array<string>"))


def _answers_by_index(lst: DataFrame, t: DataFrame) -> DataFrame:
    """Listings joined to the terms whose tokens their titles hold, for term tables that are not broadcast.

    Titles are matched once each, whatever number of listings carry them. A title that holds a token holds all of the
    token's grams (GRAM characters, fewer for a term of short tokens): each term is looked up by the one of its grams that
    the fewest titles of its site hold, and verified on the title. A term with a gram that no title holds has no answer.
    Listings then meet the terms of their title; titles of HOT_SHARE of all listings and more are salted.
    """
    t = t.filter(F.col("_tokens").isNotNull() & F.col("t_source").isNotNull()).withColumn("_no", F.monotonically_increasing_id())
    t = t.withColumn("_size", F.least(F.lit(GRAM), F.array_max(F.transform("_tokens", F.length))))
    t = cut_lineage(t)  # the numbers hold for every use
    lst = lst.filter(F.col("_title").isNotNull() & F.col("source").isNotNull())
    titles = cut_lineage(lst.groupBy("source", "_title").agg(F.count(F.lit(1)).alias("_n")))
    sizes = [r["_size"] for r in t.select("_size").distinct().collect()]  # at most GRAM + 1 numbers
    grams = titles.select("source", "_title", F.explode(F.concat(*[_grams(F.col("_title"), F.lit(n)) for n in sizes if n > 0],
                                                                 F.array().cast("array<string>"))).alias("_gram"))
    wanted = F.array_distinct(F.flatten(F.transform("_tokens", lambda tok: _grams(tok, F.col("_size")))))
    asked = t.filter("_size > 0").select("_no", "t_source", wanted.alias("_all")).select(
        "_no", "t_source", F.size("_all").alias("_of"), F.explode("_all").alias("_gram"))
    held = grams.groupBy(F.col("source").alias("t_source"), "_gram").agg(F.count(F.lit(1)).alias("_titles"))
    # The grams of all terms are streamed past the titles' (one row a gram), whatever the estimates say, and sorted by term in
    # the session's count of tasks: by an explicit count, as AQE joins small shuffles into as many tasks as there are cores.
    n_parts = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = asked.join(held.hint("shuffle_hash"), ["t_source", "_gram"]).repartition(n_parts, "_no")
    rarest = (met.groupBy("_no").agg(
        F.count(F.lit(1)).alias("_found"), F.max("_of").alias("_of"), F.min(F.struct("_titles", "_gram")).alias("_best"))
        .filter("_found = _of").select("_no", F.col("_best._gram").alias("_gram")))
    looked_up = t.join(rarest.withColumnRenamed("_gram", "_key"), "_no").drop("_size")
    pairs = grams.join(looked_up, (F.col("source") == F.col("t_source")) & (F.col("_gram") == F.col("_key"))).filter(_tokens_in_title())
    pairs = pairs.select("source", "_title", "term_idx", "keyword", "search_location", "query_location")
    if 0 in sizes:  # an empty keyword is answered by every title of its site
        blank = t.filter("_size = 0").join(titles, F.col("source") == F.col("t_source"))
        pairs = pairs.unionByName(blank.select(*pairs.columns))
    total = titles.agg(F.sum("_n")).first()[0] or 0
    hot = titles.filter(F.col("_n") >= F.lit(max(2, -(-total // HOT_SHARE)))).select("source", "_title", F.lit(SALTS).alias("_salts"))
    hot = F.broadcast(hot)  # fewer than HOT_SHARE + 1 rows
    salt = F.pmod(F.xxhash64("listing_id"), F.coalesce("_salts", F.lit(1))).cast("int")
    lst = lst.join(hot, ["source", "_title"], "left").withColumn("_salt", salt).drop("_salts")
    pairs = pairs.join(hot, ["source", "_title"], "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return lst.join(pairs, ["source", "_title", "_salt"])
