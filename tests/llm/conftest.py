import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import make_docs  # noqa: E402


@pytest.fixture
def awkward(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and columns whose names the
    operators use themselves."""
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, "a b c d e f"), (2, None), (3, ""), (4, " \t\n"), (5, long), (6, long), (None, "x y"), (7, "one"), (7, "one")]
    docs = make_docs(spark, rows)
    clash = {c: F.lit("z") for c in ("key", "node", "size", "kind", "start", "shard", "score", "count", "rank", "a", "b")}
    clash |= {c: F.lit("z") for c in ("_s", "_hash", "_source_size", "_size", "_copies", "_d", "_h", "_kept", "_row")}
    return docs.withColumns(clash)
