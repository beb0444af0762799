"""Shannon entropy of a text, in bits per character.

Whitespace is dropped first. Code points from 0 to 255 enter the sum; every
remaining character enters the denominator, so texts in other scripts score low.
Empty text scores 0, whitespace alone has no score (NULL).
"""

from functools import cache

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from patchlens.lookups import WHITESPACE_CHARACTERS


@cache
def _arrow_entropy():
    # Nested on purpose: the function then travels to the executors by value and
    # needs no installed package there.
    import numpy as np

    narrow_blanks = [ord(blank) for blank in WHITESPACE_CHARACTERS if ord(blank) < 256]
    wide_blanks = [blank for blank in WHITESPACE_CHARACTERS if ord(blank) > 255]

    def score(text):
        if not text:
            return 0.0
        codes = np.frombuffer(text.encode("latin-1", "ignore"), dtype=np.uint8)
        counts = np.bincount(codes, minlength=256)
        wide = len(text) - len(codes)
        if wide:
            wide -= sum(text.count(blank) for blank in wide_blanks)
        counts[narrow_blanks] = 0
        counts = counts[counts > 0]
        total = int(counts.sum()) + wide
        if total == 0:
            return None
        share = counts / total
        return abs(float((share * np.log2(share)).sum()))

    def entropy(texts: pa.Array) -> pa.Array:
        return pa.array([score(text) for text in texts.to_pylist()], pa.float64())

    return F.arrow_udf(entropy, DoubleType())


def entropy_udf(c: Column) -> Column:
    """Entropy as one Arrow-batched column expression: no shuffle, whole texts."""
    return _arrow_entropy()(c)


def register_sql_functions(spark: SparkSession) -> None:
    """Offer the entropy to SQL users as ``shannon_entropy(text)``."""
    spark.udf.register("shannon_entropy", _arrow_entropy())
