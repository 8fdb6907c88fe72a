"""Text predicates and per-site text rules as Column expressions (JVM-side)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ilike_any(c, substrings) -> Column:
    """``c ILIKE '%s1%' OR c ILIKE '%s2%' ...``, NULL for a NULL text.

    The text is lower-cased once, inside the array: as a plain disjunction each
    pattern would lower it again.
    """
    wanted = [s.lower() for s in dict.fromkeys(substrings)]
    return F.exists(F.array(F.lower(_col(c))), lambda t: reduce(or_, [t.contains(s) for s in wanted]))


def whole_word_pattern(words) -> str:
    """Case-insensitive whole-word regex.

    The boundary treats any Unicode letter, digit or underscore as a word
    character, like the word-boundary escape of the screening query.
    """
    alt = "|".join(words)
    return rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{alt})(?![\p{{L}}\p{{N}}_])"


def has_whole_word(c, words) -> Column:
    return _col(c).rlike(whole_word_pattern(words))


def non_numeric(c) -> Column:
    """TRUE when the text holds any character that is not an ASCII digit."""
    return _col(c).rlike("[^0-9]")


def compensation_gate(c) -> Column:
    """Keep the pay text only when it states an annual amount, else NULL."""
    c = _col(c)
    return F.when(c.contains(rules.ANNUAL_PAY_MARKER), c)


def listing_link(source, listing_id, href) -> Column:
    """LinkedIn and Indeed build the link from the id; the other sites keep the card's href."""
    source, listing_id, href = _col(source), _col(listing_id), _col(href)
    return (
        F.when(source == "LinkedIn", F.concat(F.lit(rules.LINKEDIN_VIEW_BASE), listing_id))
        .when(source == "Indeed", F.concat(F.lit(rules.INDEED_VIEW_BASE), listing_id))
        .otherwise(href)
    )


def search_location_rewrite(source, location) -> Column:
    """BuiltIn cannot search 'Remote': it is sent as 'United States' (remote is a filter there)."""
    source, location = _col(source), _col(location)
    return (
        F.when((source == "BuiltIn") & (location == rules.REMOTE_SEARCH_LOCATION),
               F.lit(rules.BUILTIN_REMOTE_QUERY_LOCATION))
        .otherwise(location)
    )


def work_mode(location) -> Column:
    """'remote' / 'hybrid' / 'on-site' from the location text; NULL when unknown."""
    loc = _col(location)
    return (
        F.when(loc.ilike("%remote%"), F.lit("remote"))
        .when(loc.ilike("%hybrid%"), F.lit("hybrid"))
        .when(loc.isNotNull(), F.lit("on-site"))
    )


def work_mode_allowed(source, search_location, mode) -> Column:
    """Which work modes a site search returns.

    A 'Remote' search keeps remote only. Local searches: LinkedIn ticks on-site
    and hybrid, BuiltIn / Dice untick remote, Indeed applies no mode filter.
    """
    source, search_location, mode = _col(source), _col(search_location), _col(mode)
    return (
        F.when(search_location == rules.REMOTE_SEARCH_LOCATION, mode == "remote")
        .when(source == "Indeed", F.lit(True))
        .otherwise(mode.isin("on-site", "hybrid"))
    )


def result_set_file_name(source, ts) -> Column:
    """``<source>_<yyyyMMdd_HHmm>.csv``: the name a result set is written under."""
    return F.concat(_col(source), F.lit("_"), F.date_format(_col(ts), "yyyyMMdd_HHmm"), F.lit(".csv"))


def file_name_collisions(result_sets, set_cols=("term_idx",)):
    """File names that more than one result set maps to (minute grain: a later
    set of the same site and minute overwrites the earlier file).

    ``result_sets`` has ``file_name`` and the columns naming a result set.
    """
    ident = F.struct(*[F.col(c) for c in set_cols])
    return (result_sets.groupBy("file_name")
            .agg(F.count_distinct(ident).alias("n_result_sets"))
            .filter(F.col("n_result_sets") > 1))


FILE_NAME_PATTERN = r"^(.*)_(\d{8}_\d{4})\.csv$"


def file_name_source(file_name) -> Column:
    return F.regexp_extract(_col(file_name), FILE_NAME_PATTERN, 1)


def file_name_time(file_name) -> Column:
    """The run time in a result-set file name, as wall-clock time (no time zone is
    involved, so no daylight-saving shift); NULL when the name has none or it is
    not a valid time (``try_`` functions: one odd name never fails a whole job)."""
    txt = F.regexp_extract(_col(file_name), FILE_NAME_PATTERN, 2)
    part = lambda a, b: F.substring(txt, a, b).cast("int")
    return F.when(F.length(txt) == 13, F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(10, 2),
                                                                  part(12, 2), F.lit(0)))


def _unescape(c: Column) -> Column:
    """Undo %XX escaping (of a URI, or of a partition value); a '+' stays a '+'."""
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def in_result_set_folder(path) -> Column:
    """Whether a path is a part file of a result set Spark wrote as a folder
    (``file_name=X.csv/part-*`` or ``X.csv/part-*``)."""
    last, parent = path_last(path), path_parent(path)
    return parent.startswith("file_name=") | (parent.endswith(".csv") & last.startswith("part-"))


def path_dir(path) -> Column:
    """The path without its last component."""
    p = _col(path)
    return F.substring(p, F.lit(1), F.length(p) - F.length(path_last(p)) - 1)


def file_name_of_path(path) -> Column:
    """Name of the listing file a path belongs to.

    A flat file ``<drop>/X.csv`` is named ``X.csv``. A result set Spark wrote as
    ``<drop>/file_name=X.csv/part-*`` is named ``X.csv``, and so is a folder
    ``<drop>/X.csv/part-*`` written by ``df.write.csv``.
    """
    last, parent = path_last(path), path_parent(path)
    # a partition value is %XX-escaped on disk (e.g. '#' is '%23')
    return (F.when(parent.startswith("file_name="), _unescape(F.substring(parent, len("file_name=") + 1, 1 << 20)))
            .when(parent.endswith(".csv") & last.startswith("part-"), parent)
            .otherwise(last))


def path_last(path) -> Column:
    """Last component of a path (string functions, no regex: evaluated per row)."""
    return F.substring_index(_col(path), "/", -1)


def path_parent(path) -> Column:
    """Second-to-last component of a path."""
    return F.substring_index(F.substring_index(_col(path), "/", -2), "/", 1)


def metadata_file_path() -> Column:
    """``_metadata.file_path`` decoded to the plain path (the metadata column is a
    URI with %-escapes; the file listing of the ``binaryFile`` source is not).
    A '+' is kept as is."""
    return _unescape(F.col("_metadata.file_path"))
