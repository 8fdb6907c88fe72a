"""New-listing detection and duplicate resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KEY
from ..session import cut_lineage
from .joins import bounded_broadcast

# Up to this many incoming keys the stored table is probed by broadcast joins
# and never shuffled.
BROADCAST_KEY_LIMIT = 500_000


def new_listings(incoming: DataFrame, known: DataFrame, key=KEY,
                 broadcast_key_limit: int = BROADCAST_KEY_LIMIT) -> DataFrame:
    """Incoming rows whose key is not stored yet (left anti join on the key).

    A NULL key matches nothing, so such a row is kept (and later fails the
    NOT NULL rule). When the batch is small next to the store, the store is
    first cut to the keys that also arrive (semi join against the broadcast
    batch keys), and the batch is then anti-joined against that broadcast cut:
    two broadcast joins, no shuffle of the stored table. Beyond the limit the
    plain anti join runs as a shuffle join.
    """
    key = list(key)
    keys = cut_lineage(incoming.select(*key).distinct())  # counted, then joined
    small = bounded_broadcast(keys, broadcast_key_limit)
    if small is keys:  # too many incoming keys to broadcast
        return incoming.join(known.select(*key), key, "left_anti")
    # distinct: the store may hold a key more than once (nothing enforces it), and
    # the broadcast must stay bounded by the incoming keys
    hits = known.select(*key).join(small, key, "left_semi").distinct()
    return incoming.join(F.broadcast(hits), key, "left_anti")


def load_order(file_time_col: str = "file_time", file_col: str = "file_name"):
    """The order files load in: by file time, then name; files without a time
    come after every dated file. Shared by first-file-wins and the quarantine's
    load-order shadowing, which must agree."""
    return F.struct(F.col(file_time_col).isNull(), F.col(file_time_col), F.col(file_col))


def latest_per_listing(df: DataFrame, order_col: str = "seq",
                       group=("source", "run_time", "listing_id")) -> DataFrame:
    """Within one result set the last card seen for an id wins.

    ``max_by`` over the group: partially aggregated on the map side, so a hot
    id never lands whole in one task (a row_number window would).
    """
    group = list(group)
    rest = [c for c in df.columns if c not in group]
    picked = df.groupBy(*group).agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_w"))
    return picked.select(*group, *[F.col("_w")[c].alias(c) for c in rest]).select(*df.columns)


def first_file_wins(df: DataFrame, file_time_col: str, file_col: str = "file_name", key=KEY) -> DataFrame:
    """A listing delivered in several files is taken from the earliest file.

    Files load in (file time, file name) order; a later file's copy would be
    cut by the anti join against the store. ``min_by`` keeps this a partially
    aggregated group-by.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*rest), load_order(file_time_col, file_col)).alias("_w"))
    return picked.select(*key, *[F.col("_w")[c].alias(c) for c in rest]).select(*df.columns)
