"""A fixed-size filter over ids: never misses an id it was given, and lets few others pass.

Its size does not depend on the data, so it may be sent to every task. With more ids than bits it
lets more pass, which costs time and not results: an exact join always follows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.llm.tables import shuffles_removed

BITS = 1 << 24


def id_filter(ids: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """One bit per id modulo ``bits``, 2 MB unless told otherwise, put together by the executors."""
    place = F.pmod(F.col(column), F.lit(bits))
    bit = F.expr("shiftleft(1L, cast(_p % 64 as int))")
    words = ids.select(place.alias("_p")).groupBy(F.floor(F.col("_p") / 64).alias("w")).agg(F.bit_or(bit).alias("bits"))
    found = np.zeros(bits // 64, np.int64)
    # as many rows as the filter has words, at most
    with shuffles_removed(ids.sparkSession):
        rows = words.toArrow()
    found[rows["w"].to_numpy()] = rows["bits"].to_numpy()
    return found


def passes(marks: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each id whether it may be one of those marked."""
    places = ids.astype(np.int64) % (64 * len(marks))
    return (marks[places // 64].view(np.uint64) >> (places % 64).astype(np.uint64)) & np.uint64(1) == 1
