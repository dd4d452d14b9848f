"""Several changes of a versioned table as one SQL script that takes effect whole or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession

from churnlake.sinks import versions

ROWS = "{rows}"


class Outcome(NamedTuple):
    state: str  # published, or rolled back
    during: str  # what ran last: writing, the name of a check, or publishing


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def run_script(spark: SparkSession, root: str, steps: Sequence[str], checks: Mapping[str, str] | None = None) -> Outcome:
    """Apply ``steps`` to the current version under ``root`` and publish the result.

    A step is a query over ``{rows}``, the rows as the step before left them; the steps are one
    plan, so rows are read and written once. A check is a query over ``{rows}``, the staged
    result, that gives one boolean; false and null fail it. A failing step (an expression's
    error on any row) or check leaves the version that was there, and what was staged is
    deleted. No step at all publishes a copy. One writer at a time, as for ``versions``.

    Errors of Spark's own that are no SQL condition, such as lost executors past all retries, and
    steps that cannot be parsed, are raised; nothing is published then either.
    """
    own = uuid.uuid4().hex
    view, staged, log = f"rows_{own}", f"staged_{own}", f"log_{own}"
    path = f"{root}/data-{own}"
    versions.read_current(spark, root).createOrReplaceTempView(view)
    names = [view, *[f"step_{i}_{own}" for i in range(len(steps))]]
    parts = ", ".join(f"{names[i + 1]} AS ({step.replace(ROWS, names[i])})" for i, step in enumerate(steps))
    checked = "".join(
        f"""
      SET during = {_text(name)};
      IF NOT COALESCE(({query.replace(ROWS, staged)}), FALSE) THEN
        SELECT raise_error({_text(name)});
      END IF;"""
        for name, query in (checks or {}).items()
    )
    script = f"""BEGIN
      DECLARE during STRING DEFAULT 'writing';
      DECLARE EXIT HANDLER FOR SQLEXCEPTION
      BEGIN
        SELECT 'rolled back' AS state, during;
      END;
      CREATE TABLE {staged} USING PARQUET LOCATION {_text(path)} AS {f'WITH {parts} ' if parts else ''}SELECT * FROM {names[-1]};{checked}
      SET during = 'publishing';
      INSERT INTO {log} SELECT COALESCE(MAX(version), 0) + 1, {_text(path)} FROM {log};
      SELECT 'published' AS state, during;
    END"""
    spark.sql(f"CREATE TABLE {log} ({versions._LOG}) USING JSON LOCATION {_text(f'{root}/_log')}")
    done = False
    try:
        row = spark.sql(script).first()
        done = row["state"] == "published"
        return Outcome(row["state"], row["during"])
    finally:
        for name in (staged, log):  # the catalog's entries; the files of both stay
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.dropTempView(view)
        if not done:
            versions.discard(spark, path)
