"""Equi-joins between per-address facts and member lists.

Member lists (contracts, registry entries) are *not* de-duplicated: an address
listed twice contributes twice. Joins are inner joins, never semi-joins.

Scale notes. There is one plan for every list size: facts (transactions) are
summed per address first, with a map-side combine, so no raw row is ever
shuffled by an address and a hot address cannot skew the join; the list then
meets one row per address (and further key). Adaptive execution picks the join
from measured bytes: a small list is broadcast, a large one is sort-merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.exact import again, exact_float_sum, exact_sum


def members_join(facts: DataFrame, members: DataFrame, fact_key: str, member_key: str) -> DataFrame:
    """Inner equi-join keeping the multiplicity of ``members``.

    ``members`` columns other than the key ride along; the result keeps the
    fact key's name.
    """
    m = members.withColumnRenamed(member_key, "_member_key")
    joined = facts.join(m, facts[fact_key] == m["_member_key"], "inner")
    return joined.drop("_member_key")


#: How a fact column is summed per fact key, and how those sums are summed.
WHOLE = (exact_sum, again)
FLOAT = (exact_float_sum, lambda total: again(total, floats=True))
COUNT = (F.sum, F.sum)
#: Not a sum: the least of the codes of what is wrong with a row. It waits here,
#: so that rows which the join drops never stop a job.
FAULT = (F.min, F.min)


def join_then_aggregate(
    facts: DataFrame,
    members: DataFrame,
    fact_key: str,
    member_key: str,
    keys,
    sums: dict[str, tuple[str, tuple]],
    pre_keys=(),
) -> DataFrame:
    """Sum fact columns per ``keys`` over facts joined to a member list
    (member multiplicity kept): facts are summed per (fact key, ``pre_keys``),
    joined to the list and summed again. ``sums`` maps an output name to a fact
    column and how it is summed. Sums of sums, so the result is that of joining
    row by row; a ``FAULT`` is for the caller to raise.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    partial = facts.groupBy(fact_key, *pre_keys).agg(*[first(c).alias(n) for n, (c, (first, _)) in sums.items()])
    joined = members_join(partial, members, fact_key, member_key)
    return joined.groupBy(*keys).agg(*[second(n).alias(n) for n, (_, (_, second)) in sums.items()])
