"""Groups with their members in long form: one row per member, the group's counts repeated.

A list of all members in one cell has to fit in one task; rows do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.skew import lookup_join


def with_group_counts(members: DataFrame, groups: DataFrame, keys: list[str], size: str,
                      member: str, **join_limits) -> DataFrame:
    """The members of the groups that are there, each with its group's columns.

    ``groups`` is computed already and has one row per ``keys``, which are never
    NULL; ``size`` is its column with the number of members, and ``member`` a
    column of ``members`` that varies within a group. A group with very many
    members is spread over tasks.
    """
    return lookup_join(
        members, groups, keys,
        lambda: groups.select(*keys, F.col(size).alias("weight")), row_id=member, **join_limits,
    )
