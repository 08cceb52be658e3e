"""One contract for observations of several source lanes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import normalize_name
from tallymart.operators.matrix import MATRIX_COLUMNS


def union_lanes(lanes: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of all lanes with their ``source``; columns a lane lacks are null, names are canonical."""
    stamped = [df.withColumn("source", F.lit(source)) for source, df in lanes.items()]
    union = stamped[0]
    for part in stamped[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union.withColumn("geography", normalize_name(F.col("geography"))).select(*MATRIX_COLUMNS)
