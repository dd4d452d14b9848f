"""Runtime Bloom filters for joins with a wide table.

Where a few documents of many are wanted, Spark can build a Bloom filter of the wanted ids
(its size is bounded by ``spark.sql.optimizer.runtime.bloomFilter.maxNumBits``) and apply it
at the scan, so that the texts of the others are not shuffled. Spark does this by itself
above certain sizes; here it is asked for at any size. Rows that pass by chance are removed
by the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_PREFIX = "spark.sql.optimizer.runtime.bloomFilter."
_ASKED = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "1GB"}


@contextmanager
def bloom_joins(spark: SparkSession) -> Iterator[None]:
    """While this holds, joins run with Bloom filters; the settings are put back after."""
    before = {k: spark.conf.get(_PREFIX + k, None) for k in _ASKED}
    try:
        for k, v in _ASKED.items():
            spark.conf.set(_PREFIX + k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(_PREFIX + k)
            else:
                spark.conf.set(_PREFIX + k, v)
