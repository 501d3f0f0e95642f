"""A Bloom bitmap of a member list, tested where the facts are scanned.

Facts that a join with a short list would drop are dropped before they are
summed and shuffled: the list becomes a bitmap (one Spark aggregate over its
hashes), a scalar subquery hands it to the scan, and what passes is joined
exactly, which removes the false hits. Nothing is collected while a plan is
built; the bitmap is made when the query runs.

Size. The bitmap is an array of 64-bit words; a key sets ``PROBES`` bits of one
word. A list of n rows gets ``BITS_PER_MEMBER`` * n bits, measured when the
query runs, for one or two false hits in a hundred; beyond ``MAX_MEMBERS`` rows
(a bitmap of 8 MB) there is no bitmap and all facts pass, as the join alone
would have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_MEMBER, PROBES = 16, 4
MAX_MEMBERS = 4_000_000
#: Words that even an empty list gets.
MIN_WORDS = 16


def _mask(key: str) -> Column:
    """The bits of a key within its word."""
    h = f"xxhash64({key}, 1)"
    return F.expr(" | ".join(f"shiftleft(1L, CAST(shiftrightunsigned({h}, {6 * k}) & 63 AS INT))" for k in range(PROBES)))


def bitmap(members: DataFrame, key: str, max_members: int = MAX_MEMBERS) -> DataFrame:
    """One row ``words``: the bitmap of the list, or null for a list of more
    than ``max_members`` rows."""
    keys = members.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    size = keys.select(F.lit(1)).agg(F.expr(f"CASE WHEN count(*) <= {max_members} THEN greatest({MIN_WORDS}, CAST(ceil(count(*) * {BITS_PER_MEMBER} / 64) AS INT)) END").alias("words"))
    own = keys.select(F.pmod(F.xxhash64("k"), size.scalar()).cast("int").alias("word"), _mask("k").alias("bits")).where("word IS NOT NULL")
    every = size.where("words IS NOT NULL").select(F.expr("explode(sequence(0, words - 1))").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    filled = own.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # At most MAX_MEMBERS * BITS_PER_MEMBER / 64 words meet here.
    row = filled.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))
    return row.select(F.expr("CASE WHEN size(w) > 0 THEN transform(w, x -> x.bits) END").alias("words"))


def may_be_listed(key: str, members: DataFrame, member_key: str, max_members: int = MAX_MEMBERS) -> Column:
    """False only for keys that are not in the list (a null key is not)."""
    words = bitmap(members, member_key, max_members).scalar()
    word = F.get(words, F.pmod(F.xxhash64(key), F.size(words)).cast("int"))
    mask = _mask(key)
    return F.col(key).isNotNull() & F.coalesce(word.bitwiseAND(mask) == mask, F.lit(True))
