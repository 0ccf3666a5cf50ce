"""Shared relational building blocks.

* :func:`lookup` joins a fitted statistics table back onto rows.  It
  broadcasts only when the caller states a size bound that holds by
  construction (statistics keyed by fold, a parameter grid); everything else
  is left to AQE, which broadcasts at run time only under
  ``spark.sql.autoBroadcastJoinThreshold`` and keeps a shuffle join beyond it.
* :func:`ordered_index` numbers rows in a total order over the whole table
  (or inside a few large groups such as the label) without a single-partition
  window: range partitioning + per-partition counts + offsets.
* :func:`with_scalars` attaches a handful of fitted scalars as literals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str

# A statistics table is broadcast by hint only when its row count is bounded
# by a parameter (folds, grid size) below this number.
BROADCAST_ROW_BOUND = 100_000


def lookup(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    bound: int | None = None,
) -> DataFrame:
    """Join ``stats`` (one row per key) onto ``df``.

    ``null_safe`` matches null keys to null keys (a null level is a level).
    ``bound`` is the caller's proven upper bound on ``stats`` rows; when it
    is given and small the side is broadcast, otherwise AQE decides.
    """
    keys = list(keys)
    right = F.broadcast(stats) if bound is not None and bound <= BROADCAST_ROW_BOUND else stats
    if not null_safe:
        return df.join(right, keys, how)
    renamed = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [df[k].eqNullSafe(renamed[f"__k_{k}"]) for k in keys]
    out = df.join(renamed, cond, how)
    return out.drop(*[f"__k_{k}" for k in keys])


def with_scalars(df: DataFrame, stats_row: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Attach the columns of a one-row statistics frame as literals.

    The frame is an aggregate without grouping keys, so one small row comes to
    the driver (a few fitted numbers, like an ML model's parameters).
    """
    row = stats_row.first()
    names = list(columns) if columns else list(stats_row.columns)
    dtypes = dict(stats_row.dtypes)
    return df.withColumns({c: F.lit(row[c]).cast(dtypes[c]) for c in names})


@dataclass
class GlobalFit:
    """Aggregate expressions of a fit plus final expressions over their results.

    Several fits over the same rows combine into one aggregate: one job, one
    small row (or one row per ``fit_fold``).
    """

    aggs: list[Column]
    finals: list[Column]


def run_fits(src: DataFrame, fits: Sequence[GlobalFit], keys: Sequence[str] = ()) -> DataFrame:
    """Evaluate fits over ``src`` in one aggregate, grouped by ``keys``."""
    aggs = [a for f in fits for a in f.aggs]
    finals = [c for f in fits for c in f.finals]
    grouped = src.groupBy(*keys).agg(*aggs) if keys else src.agg(*aggs)
    return grouped.select(*keys, *finals)


def ordered_index(
    df: DataFrame,
    order: Sequence[ColumnOrName],
    by: Sequence[str] = (),
    name: str = "rn",
    count_name: str | None = None,
    num_partitions: int | None = None,
    many_groups: bool = False,
) -> DataFrame:
    """Add ``name`` = 1-based position in ``order`` inside each ``by`` group.

    ``order`` must be a total order (end it with a unique key).  ``by`` must
    have few distinct values (label, split): the offsets table has at most
    ``partitions + groups`` rows.  For many small groups use a window.
    Optionally adds ``count_name`` = group size.

    With ``many_groups`` the offsets are joined without a broadcast (group
    keys such as level keys); a null group key is a group.

    The rows are range-partitioned and sorted, each gets (partition, local
    index), and that sorted table is written once under the checkpoint folder
    (:func:`materialize`).  The per-partition counts and the final numbering
    both read the written table, so they agree even though range bounds are
    sampled per shuffle; a lost executor re-reads the files instead of
    re-sampling.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(b) for b in by] + [F.col(o) if isinstance(o, str) else o for o in order]
    s = (
        df.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("__mid", F.monotonically_increasing_id())
    )
    s = materialize(s, "ordered")
    s = s.withColumn("__pid", F.shiftright("__mid", 33)).withColumn("__loc", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = s.groupBy("__pid", *by).agg(F.count(F.lit(1)).alias("__c"), F.min("__loc").alias("__first"))
    w_prev = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__c").over(w_prev), F.lit(0)))
    if count_name:
        offsets = offsets.withColumn(count_name, F.sum("__c").over(Window.partitionBy(*by)))
    keep = ["__pid", *by, "__off", "__first"] + ([count_name] if count_name else [])
    # (range, group) offsets: about ranges + groups rows; broadcast only after counting them
    offsets = offsets.select(*keep)
    out = lookup(s, offsets, ["__pid", *by], how="inner", null_safe=True, bound=None if many_groups else offsets.count())
    out = out.withColumn(name, (F.col("__off") + F.col("__loc") - F.col("__first") + 1).cast("bigint"))
    return out.drop("__mid", "__pid", "__loc", "__off", "__first")


def materialize(df: DataFrame, name: str = "frame", file_rows: int | None = None) -> DataFrame:
    """Cut the lineage of a frame that several fits and the apply step all read.

    Writes a parquet table under the cluster's ``spark.checkpoint.dir`` (a
    shared folder, so it survives executor loss) and reads it back: computed
    once, columnar, and later scans prune columns and push filters.  Only a
    session without that setting, as in tests, gets a scratch folder.
    Without this every statistic re-derives its input from the source tables.
    ``file_rows`` bounds the rows of a file, so that :func:`fit_tasks` can deal them out.  The shuffle files behind the
    table go once it is written; they would else stay until the driver collects its garbage.
    """
    from tessera.session import ensure_checkpoint_dir

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    options = {"maxRecordsPerFile": file_rows} if file_rows else {}
    write_rows(df, path, compression="zstd", **options)
    MATERIALIZED.append(path)
    return spark.read.schema(df.schema).parquet(path)  # the schema is known: no job that reads it from the files


def write_rows(df: DataFrame, path: str, **options) -> None:
    """``df`` as a parquet table; the shuffle files behind it go at the end.

    Steps whose code is too long for the JIT compiler run as single expressions instead of interpreted, meanwhile.
    """
    with _setting(df.sparkSession, _SHUFFLES_GO, "true"), _setting(df.sparkSession, "spark.sql.codegen.hugeMethodLimit", "8000"):
        df.select("*").write.mode("overwrite").options(**options).parquet(path)  # a plan of its own: nothing else reads its shuffles


def settled(make: Callable[[], DataFrame], name: str = "frame", file_rows: int | None = None) -> DataFrame:
    """:func:`materialize` of the frame that ``make`` returns; scratch tables that were written on the way to it are removed.

    Use it where nothing outside ``make`` reads those tables, so that a job holds what it still needs and not every step.
    """
    mark = len(MATERIALIZED)
    out = materialize(make(), name, file_rows)
    steps = MATERIALIZED[mark:-1]
    del MATERIALIZED[mark:-1]
    _remove(out.sparkSession, steps)
    return out


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session while it is open; the one before comes back at the end."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Rows of a file of the tables that models are fitted on.
FILE_ROWS = 100_000


@contextmanager
def fit_tasks(df: DataFrame, files: int = 3) -> Iterator[None]:
    """While it is open, scans are cut into tasks of about ``files`` files each (at least one task per core).

    A fit keeps what a task has read in memory, several times as large as in the files, where a split may hold
    128 MB of them.  With tables written by ``materialize(..., file_rows=FILE_ROWS)`` a task's rows are bounded
    whatever the size of the table.  The session's setting comes back at the end.
    """
    spark = df.sparkSession
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get(_LEAST_TASKS, None) or 0), math.ceil(len(df.inputFiles()) / files))
    with _setting(spark, _LEAST_TASKS, str(least)):
        yield


def bounded_files(df: DataFrame):
    """While it is open, tables are written in files of at most ``FILE_ROWS`` rows."""
    return _setting(df.sparkSession, "spark.sql.files.maxRecordsPerFile", str(FILE_ROWS))


_LEAST_TASKS = "spark.sql.files.minPartitionNum"
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Tables written by :func:`materialize` in this process (scratch, removable after the job).
MATERIALIZED: list[str] = []


def drop_materialized(spark) -> int:
    """Delete the scratch tables this process wrote under the checkpoint folder.

    Call it once the results that read them have been written; any DataFrame
    still reading a deleted table fails afterwards.  Uses the Hadoop file
    system of the path, so it works for a shared cluster folder as well.
    """
    paths = MATERIALIZED[:]
    MATERIALIZED.clear()
    return _remove(spark, paths)


def _remove(spark: SparkSession, paths: Sequence[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).delete(p, True):
            n += 1
    return n


def explode_folds(df: DataFrame, fold_col: str, k: int, name: str = "fit_fold") -> DataFrame:
    """Copy each training row to every fold it trains (all folds but its own).

    Used for holistic statistics (medians, quantiles, modes) fitted per fold:
    one aggregation keyed by ``name`` replaces k separate fits.  Additive
    statistics should use total - own fold instead (no copies).
    """
    folds = F.array(*[F.lit(i) for i in range(k)])
    return df.withColumn(name, F.explode(F.filter(folds, lambda f: f != F.col(fold_col))))


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (a global statistic) to every row.

    The right side is a keyless aggregate, so it has exactly one row by
    construction; it is broadcast and matched on a constant key (no pairs
    are formed beyond one per row, and no driver round trip is needed).
    """
    right = one_row.withColumn("__one", F.lit(1))
    return df.withColumn("__one", F.lit(1)).join(F.broadcast(right), "__one").drop("__one")


def running_totals(
    df: DataFrame,
    order: Sequence[ColumnOrName],
    by: Sequence[str],
    columns: Sequence[str],
    prefix: str = "cum_",
    num_partitions: int | None = None,
    many_groups: bool = False,
    total_prefix: str | None = None,
) -> DataFrame:
    """Inclusive running sums of ``columns`` in ``order`` inside each ``by`` group.

    Same layout as :func:`ordered_index`: range partitioning (so one large
    group is spread over many tasks), running sums inside each range, and
    per-range totals turned into offsets by a window over the small table of
    ranges.  ``order`` must be a total order within ``by``.  With ``total_prefix`` the
    sums of the whole group come along (from the table of ranges, at no other join).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ocols = [F.col(o) if isinstance(o, str) else o for o in order]
    sort_cols = [F.col(b) for b in by] + ocols
    s = df.repartitionByRange(n, *sort_cols).withColumn("__pid", F.spark_partition_id())
    s = materialize(s, "running")
    w_in = Window.partitionBy("__pid", *by).orderBy(*ocols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumns({f"__r_{c}": F.sum(c).over(w_in) for c in columns})
    tot = s.groupBy("__pid", *by).agg(*[F.sum(c).alias(f"__t_{c}") for c in columns])
    w_prev = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = [F.sum(f"__t_{c}").over(Window.partitionBy(*by)).alias(f"{total_prefix}{c}") for c in columns] if total_prefix else []
    offs = tot.select("__pid", *by, *[F.coalesce(F.sum(f"__t_{c}").over(w_prev), F.lit(0)).alias(f"__o_{c}") for c in columns], *whole)
    out = lookup(s, offs, ["__pid", *by], how="inner", null_safe=True, bound=None if many_groups else offs.count())
    out = out.withColumns({f"{prefix}{c}": F.col(f"__r_{c}") + F.col(f"__o_{c}") for c in columns})
    return out.drop("__pid", *[f"__{k}_{c}" for c in columns for k in ("r", "o")])
