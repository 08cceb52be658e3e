"""Joining rows to facts about their group when one group may hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def join_facts(rows: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row per ``keys``.

    Facts are often an aggregate on the very keys, so they sit on their shuffle and AQE
    cannot split the join for a hot key.  A salt from the row's other values spreads a
    group over ``SALTS`` tasks, each fact is repeated once per salt, and because both sides
    then need a shuffle of their own AQE can split what is still uneven.  Below the
    broadcast threshold neither side is shuffled at all.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    repeated = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
