"""Frozen intermediate tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder for its lifetime; on a
    cluster a missing setting is an error, since a machine-local folder would be lost
    with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="churnlake-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class FrozenScope:
    """Paths that were frozen while the scope was open."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.kept: set[str] = set()

    def keep(self, *frames: DataFrame) -> None:
        """Frozen frames that the result still reads."""
        self.kept |= {path for df in frames for path in df.inputFiles() or ()}


# Open scopes of this thread, outermost first: another thread's frames are not ours to delete.
_OPEN: ContextVar[tuple[FrozenScope, ...]] = ContextVar("frozen_scopes", default=())


@contextmanager
def frozen_scope(spark: SparkSession) -> Iterator[FrozenScope]:
    """Frames frozen inside are deleted at the end, but for those kept, which pass to an
    enclosing scope. What leaves the scope must read kept frames only."""
    scope, outer = FrozenScope(), _OPEN.get()
    _OPEN.set((*outer, scope))
    try:
        yield scope
    finally:
        _OPEN.set(outer)
        for path in scope.paths:
            if any(f"/{path.rsplit('/', 1)[1]}/" in f for f in scope.kept):
                if outer:
                    outer[-1].paths.append(path)
            else:
                where = spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def freeze(df: DataFrame, name: str = "frozen", folders: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later passes see the same rows in the same assignment even when an executor is lost,
    and each pass reads only the columns it needs. ``folders`` are columns whose values get
    a folder each, so that a filter on them skips files.
    """
    path = scratch_path(df.sparkSession, name)
    if _OPEN.get():
        _OPEN.get()[-1].paths.append(path)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
