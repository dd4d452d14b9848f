"""Customer files as they arrive: validate, measure, stamp and store, each file on its own.

Every file is read under its own header, which is its first line, at any width, and quoted
fields may hold line ends. Files with one header are read together, so a batch takes one read
per distinct header. A file whose header lacks the key, or whose bytes are no UTF-8, is reported
as failed and does not stop the batch. Spark's file listing leaves out files of no bytes; one
that is asked for by path is reported with zeros. The same functions serve the stream and a scan of a given path.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from churnlake.functions.numbers import percent
from churnlake.functions.scoring import churn_flag_truthy
from churnlake.sinks.versions import discard
from churnlake.sources.files import list_files

# Columns of an arriving customer file; the first one must be in its header.
FILE_COLUMNS = ["customerID", "Contract", "MonthlyCharges", "Churn"]
KEY = FILE_COLUMNS[0]
STAMP = "auto_processed_at"
# Columns and folders that are added to a file's own.
RESERVED = ("source_file", "source", "batch", STAMP)

# Most files that one batch takes; the others follow in the next batch of the same run.
FILES_PER_BATCH = 1_000

_RESULT = (
    "source_file string, output_file string, total_records bigint, valid bigint, invalid bigint, churned bigint, "
    "churn_rate_pct double, processed_at string, status string, error string"
)


_DELIVERY = "path string, length bigint, modified timestamp, batch bigint, source string"


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, bool]]:
    """First line of each file that has one, and whether all its bytes are UTF-8, by the path
    as Spark gives it, with escapes. A file that is gone since it was listed has none."""
    lines = spark.read.option("ignoreMissingFiles", True).text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    first = lines.groupBy("path").agg(
        F.min_by("value", F.struct("block", "at")).alias("line"), F.bool_and(F.is_valid_utf8("value")).alias("sound")
    )
    return {r["path"]: (r["line"], r["sound"]) for r in first.select("path", F.make_valid_utf8("line").alias("line"), "sound").collect()}


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def header_names(line: str, reserved: Sequence[str] = RESERVED) -> list[str]:
    """Column names of a header line. Empty names get one, and names that differ in case at
    most from an earlier one or from a ``reserved`` one, which is added here, get a number,
    so no column is lost: a file's own ``source`` is stored as ``source_3``, say."""
    names: list[str] = []
    seen: set[str] = set(reserved)
    for i, name in enumerate(next(csv.reader([line.lstrip("\ufeff")]), [])):
        name = name.strip() or f"_c{i}"
        while name.lower() in seen:
            name = f"{name}_{i}"
        seen.add(name.lower())
        names.append(name)
    return names


def _read(spark: SparkSession, names: Sequence[str], paths: Sequence[str], header: bool) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema).option("header", header).option("multiLine", True).option("escape", '"')
    fields = [F.trim(_quoted(n)).alias(n) for n in names]
    return reader.csv(list(paths)).select(F.col("_metadata.file_path").alias("source_file"), *fields)


def read_files(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, list[DataFrame]]:
    """The files as ``(source_file, problem)``, and one frame of rows per distinct header.

    The frames keep every column of their files. A file without the key in its header gives
    its lines, the first one included, under numbered names. One without any line is no
    problem and has no rows; one with bytes that are no UTF-8 is not read further.
    """
    lines = _first_lines(spark, paths) if paths else {}
    groups: dict[tuple[bool, tuple[str, ...]], list[str]] = {}
    problems: dict[str, str | None] = {}
    for path, (line, sound) in sorted(lines.items()):
        names = header_names(line)
        usable = KEY in names
        problems[path] = None if usable else f"no header with {KEY}"
        if not sound:
            problems[path] = "not UTF-8"
        else:
            groups.setdefault((usable, tuple(names if usable else [f"_c{i}" for i in range(len(names) or 1)])), []).append(unquote(path))
    known = {_plain_path(unquote(p)) for p in lines}
    told = [*problems.items(), *((p, None if _exists(spark, p) else "file is gone") for p in paths if _plain_path(p) not in known)]
    files = spark.createDataFrame(sorted(told), "source_file string, problem string")
    return files, [_read(spark, names, found, ok) for (ok, names), found in groups.items()]


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _plain_path(path: str) -> str:
    """A path without its scheme's slashes, which readers write in several ways."""
    return re.sub(r"^([a-z0-9]+):/*", r"\1:/", path)


def _measured(rows: DataFrame) -> DataFrame:
    """Counts per file of one group."""
    column = lambda c: _quoted(c) if c in rows.columns else F.lit(None).cast("string")
    filled = (F.coalesce(column(KEY), F.lit("")) != "") & (F.coalesce(column("MonthlyCharges"), F.lit("")) != "")
    gone = F.coalesce(churn_flag_truthy(column("Churn")), F.lit(False))
    return rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(filled).alias("valid"),
        F.count_if(~filled).alias("invalid"),
        F.count_if(gone).alias("churned"),
    )


def file_results(files: DataFrame, groups: Sequence[DataFrame], processed_at: str, output: str = "") -> DataFrame:
    """One row per file: where its rows went, record counts, churn rate and status. A file
    without rows counts as processed, with zeros and no output."""
    counts = files.sparkSession.createDataFrame([], "source_file string, total_records bigint, valid bigint, invalid bigint, churned bigint")
    for rows in groups:
        counts = counts.unionByName(_measured(rows))
    none = F.lit(0).cast("bigint")
    joined = files.join(counts, "source_file", "left")
    failed = F.col("problem").isNotNull()
    rate = F.coalesce(percent(F.col("churned"), F.col("total_records")), F.lit(0.0))
    return joined.select(
        "source_file",
        F.when(F.col("total_records").isNotNull() & ~failed, F.concat(F.lit(f"{output}/source="), F.url_encode("source_file"))).alias("output_file"),
        *[F.coalesce(c, none).alias(c) for c in ("total_records", "valid", "invalid", "churned")],
        rate.alias("churn_rate_pct"),
        F.lit(processed_at).alias("processed_at"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("problem").alias("error"),
    )


def stamped(groups: Sequence[DataFrame], processed_at: str) -> list[DataFrame]:
    """Rows of usable files with all their columns, the processing time, and the whole path
    of their file in ``source``."""
    out = []
    for rows in groups:
        if KEY in rows.columns:
            kept = [_quoted(c) for c in rows.columns if c != "source_file"]
            out.append(rows.select(*kept, F.lit(processed_at).alias(STAMP), F.url_encode("source_file").alias("source")))
    return out


def paths_under(spark: SparkSession, path: str) -> list[str]:
    """CSV files at a path; a listing, which Spark makes on the driver anyway."""
    return [r["path"] for r in list_files(spark, path, "*.csv").select("path").collect()]


def on_demand_file_scan(spark: SparkSession, path: str) -> DataFrame:
    """Rows of one given file or folder, as the stream would process them: columns by name,
    those of other files null."""
    _, groups = read_files(spark, paths_under(spark, path))
    schema = ", ".join(f"`{c}` string" for c in ["source_file", *FILE_COLUMNS])
    out = spark.createDataFrame([], schema)
    for rows in groups:
        if KEY in rows.columns:
            out = out.unionByName(rows, allowMissingColumns=True)
    return out


def _process(spark: SparkSession, paths: Sequence[str], processed: str, results: str, batch_id: int, processed_at: str) -> None:
    """Write results and rows of some files as one batch, in place of what it had before."""
    files, groups = read_files(spark, paths)
    out = f"{processed}/batch={batch_id}"
    file_results(files, groups, processed_at, out).write.mode("overwrite").json(f"{results}/batch={batch_id}")
    discard(spark, out)
    for rows in stamped(groups, processed_at):
        rows.hint("rebalance", "source").write.mode("append").partitionBy("source").parquet(out)


def stream_incoming_files(
    spark: SparkSession,
    incoming: str,
    processed: str,
    results: str,
    checkpoint: str,
    processed_at: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Process the files that are new since the last run, then stop.

    The stream carries the paths of new files; their contents are read by header. Output
    folders are named by batch id and overwritten, so a batch that is retried after a failure
    replaces its own output. Processed rows are Parquet with every column of their file, in
    one folder per source file, named by its whole path.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        _process(spark, [r["path"] for r in batch.select("path").collect()], processed, results, batch_id, processed_at)

    # Only path and length are read here: the content column is pruned.
    found = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(incoming)
    )
    return (
        found.select("path")
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Deliveries processed so far: path, length and time of the file, its batch, and the folder
    of its rows, null if it gave none. Empty before the first one."""
    if not _exists(spark, ledger):
        return spark.createDataFrame([], _DELIVERY)
    return spark.read.schema(_DELIVERY).parquet(ledger)


def process_deliveries(
    spark: SparkSession,
    incoming: str,
    processed: str,
    results: str,
    ledger: str,
    processed_at: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> int:
    """Process the files under ``incoming`` that are new or were delivered again since the last
    run; returns the number of batches.

    A stream's file source knows files by path, so it passes over new contents at an old path.
    Here a delivery is a path with its length and modification time, and the ledger lists those
    that are done. What is in the listing and not in the ledger is taken in batches, oldest
    first. A batch enters the ledger as its last step: one that broke off is found again under
    the same number and replaces what it left. A file that changes while it is read is taken
    once more in the next run. One writer at a time. Without files nothing is written.
    """
    same = ["path", "length", "modified"]
    listed = list_files(spark, incoming, "*.csv").select("path", "length", F.col("modificationTime").alias("modified"))
    done = batches = 0
    while True:
        known = read_ledger(spark, ledger)
        if not batches:
            done = known.agg(F.max("batch")).first()[0] or 0
        pending = listed.join(known, same, "left_anti").orderBy("modified", "path").limit(files_per_batch).collect()
        if not pending:
            return batches
        batches += 1
        batch = done + batches
        _process(spark, [r["path"] for r in pending], processed, results, batch, processed_at)
        told = spark.read.schema(_RESULT).json(f"{results}/batch={batch}").filter("total_records > 0 and status = 'SUCCESS'")
        stored = {_plain_path(unquote(r["source_file"])): r["source"] for r in told.select("source_file", F.url_encode("source_file").alias("source")).collect()}
        rows = [(r["path"], r["length"], r["modified"], batch, stored.get(_plain_path(r["path"]))) for r in pending]
        spark.createDataFrame(rows, _DELIVERY).coalesce(1).write.mode("append").parquet(ledger)


def read_latest(spark: SparkSession, processed: str, ledger: str) -> DataFrame:
    """Processed rows of the last delivery of each path that gave rows, with the columns of all
    files. A delivery that failed or had no rows leaves the one before it in force. Before
    any rows are stored it is empty, with the columns of a customer file."""
    if not _exists(spark, processed):
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in ["source", *FILE_COLUMNS, STAMP]))
    told = read_ledger(spark, ledger).filter("source is not null")
    last = told.groupBy("source").agg(F.max_by("batch", F.struct("modified", "batch")).alias("batch"))
    stored = spark.read.option("mergeSchema", True).parquet(processed).withColumn("batch", F.col("batch").cast("bigint"))
    return stored.join(last, ["source", "batch"], "left_semi").drop("batch")


def read_results(spark: SparkSession, results: str) -> DataFrame:
    """Result rows of every batch."""
    return spark.read.schema(_RESULT).json(f"{results}/batch=*")


def read_processed(spark: SparkSession, processed: str) -> DataFrame:
    """Processed rows of every batch with the columns of all files; ``source`` is the encoded
    path of the file."""
    return spark.read.option("mergeSchema", True).parquet(processed).drop("batch")
