"""Membership arrays: for each role, the roles it is a member of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules


def member_of_pairs(roles: DataFrame, members: DataFrame, exclude=None) -> DataFrame:
    """``(r_oid, rolname, member_of)``: one row per membership of each kept role, and one
    row with ``member_of`` NULL for a role that belongs to nothing.

    ``roles(oid, rolname)``, ``members(roleid, member)``; the correlated subquery
    becomes two equi-joins. No grouping: this long form has no hot group.
    """
    if exclude is None:
        exclude = rules.EXCLUDED_ROLE_NAMES
    exclude = [exclude] if isinstance(exclude, str) else list(exclude)
    r = roles.filter(~F.col("rolname").isin(exclude)).select(F.col("oid").alias("r_oid"), F.col("rolname"))
    b = roles.select(F.col("oid").alias("b_oid"), F.col("rolname").alias("member_of"))
    m = members.select("roleid", "member").join(b, F.col("roleid") == F.col("b_oid"))
    return r.join(m, F.col("member") == F.col("r_oid"), "left").select("r_oid", "rolname", "member_of")


def member_of_array(roles: DataFrame, members: DataFrame, exclude=None) -> DataFrame:
    """``(rolname, memberof)`` with ``memberof`` the sorted names of the roles
    each role belongs to (an empty array when none), excluded names left out.

    The array is the report's shape: one role's array holds that role's
    memberships (a catalog-sized list); ``member_of_pairs`` is the same result
    without the grouping.
    """
    return (member_of_pairs(roles, members, exclude)
            .groupBy("r_oid", "rolname")
            .agg(F.sort_array(F.collect_list("member_of")).alias("memberof"))
            .select("rolname", "memberof")
            .orderBy("rolname"))
