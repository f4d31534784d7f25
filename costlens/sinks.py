"""Sinks (K1-K3): stored tables, layout clustering, table comments."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.session import checkpoint_dir

# Bits of the interleaved ranks, over all keys: the layout knows up to 4096 cells.
CELL_BITS = 12
RANK_BITS = 6  # of one key, at most
FILE_BYTES = 128 << 20


def rank_bounds(df: DataFrame, key: str, bits: int = RANK_BITS) -> list[tuple]:
    """At most ``2^bits`` ranges of the values of ``key``: (largest value, rank), rising.

    Spark's range partitioning cuts the distinct values evenly (from a sample; it steers
    the layout only), and a range's rank is the share of rows below it, so every bit of
    the ranks halves the rows, whatever the skew.  One row per range comes to the driver.
    """
    values = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    ranges = values.repartitionByRange(2**bits, key).groupBy(F.spark_partition_id().alias("_at"))
    found = ranges.agg(F.max(key).alias("top"), F.sum("_n").alias("n")).collect()
    total, below, out = sum(r["n"] for r in found), 0, []
    for r in sorted(found, key=lambda r: r["top"]):
        out.append((r["top"], (below << bits) // total))
        below += r["n"]
    return out


def rank(key: str, bounds: list[tuple]) -> Column:
    """The rank of the value's range, found by halving; a null ranks first."""

    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(bounds[lo][1])
        mid = (lo + hi) // 2
        return F.when(F.col(key) <= F.lit(bounds[mid][0]), between(lo, mid)).otherwise(between(mid + 1, hi))

    if not bounds:
        return F.lit(0)
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(between(0, len(bounds) - 1))


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """The bits of the ranks taken in turn, highest first (Z-order)."""
    if bits * len(ranks) > 62:
        raise ValueError("too many keys to interleave")
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, r in enumerate(ranks):
            place = bit * len(ranks) + len(ranks) - 1 - i
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(one, place))
    return out


def boxes(cells: dict[int, int], most: int, bits: int) -> list[tuple[list[int], int]]:
    """Cells gathered in boxes of at most ``most`` rows: (cells, files of the box).

    The space is halved at one bit after the other, so along each key in turn, until a
    half holds few enough rows.  A single cell with more rows is cut into files.
    """
    out, open_ = [], [(sorted(cells), bits - 1)]
    while open_:
        some, bit = open_.pop()
        n = sum(cells[c] for c in some)
        if n <= most or bit < 0:
            out.append((some, max(1, -(-n // most))))
            continue
        halves = [c for c in some if c >> bit & 1], [c for c in some if not c >> bit & 1]
        open_ += [(half, bit - 1) for half in halves if half]
    return out


def _z_ordered(
    df: DataFrame, partition_by: Sequence[str], keys: Sequence[str], files: int | None, size: int
) -> DataFrame:
    """Rows gathered in boxes of the key space, one task and file per box and directory.

    A file lies in one box, so its minima and maxima are narrow in every key.  A cell
    that holds more than a file's rows is cut by a hash of the row.  ``df`` should be a
    stored table: it is read once per key (that column only), once to count the cells
    (at most 4096 on the driver) and once to write.
    """
    bits = min(RANK_BITS, CELL_BITS // len(keys))
    if not bits:
        raise ValueError("too many keys to interleave")
    z = interleaved([rank(k, rank_bounds(df, k, bits)) for k in keys], bits)
    cells = {r["z"]: r["n"] for r in df.groupBy(z.alias("z")).agg(F.count("*").alias("n")).collect()}
    rows = max(1, sum(cells.values()))
    folders = max(1, df.select(*partition_by).distinct().count()) if partition_by else 1
    files = files or max(1, size // FILE_BYTES // folders)
    first, pieces, n = [0] * (1 << bits * len(keys)), [1] * (1 << bits * len(keys)), 0
    for some, cut in boxes(cells, -(-rows // files), bits * len(keys)):
        for c in some:
            first[c], pieces[c] = n, cut
        n += cut

    def at(numbers: list[int]) -> Column:  # one literal after constant folding
        return F.get(F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>"), F.col("_z").cast("int"))

    n = max(n, 1)
    box = at(first) + F.pmod(F.xxhash64(*df.columns), at(pieces)).cast("int")
    folder = F.pmod(F.xxhash64(*partition_by), F.lit(folders)).cast("int") if partition_by else F.lit(0)
    out = df.withColumn("_z", z)
    out = out.withColumn("_task", folder * n + box).repartitionById(folders * n, F.col("_task"))
    return out.sortWithinPartitions(*partition_by, "_z").drop("_z", "_task")


def write_table(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    comment: str | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    z_order_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Materialize ``df`` to a path or a catalog table.

    ``cluster_by`` (K2) gathers rows by the partition and clustering keys and
    sorts them within each task, so files are laid out by those keys;
    ``partition_by`` adds directory partitions.  Rows are rebalanced on the keys:
    adaptive execution splits hot keys and merges small ones, so tasks write few,
    similar-sized files, and nothing is computed twice (a range partitioning
    would sample its input first).
    ``z_order_by`` (K2) lays rows out by several keys at once instead: each key is
    ranked, the bits of the ranks are interleaved and a file holds a box of the cells,
    so a filter on any one of the keys skips most files by their minima and maxima.
    ``files`` bounds a file's rows to that part of a directory's (default: by size).  The
    rows are staged in the checkpoint folder first, as they are read several times.
    ``comment`` (K3) is set as the table comment (catalog tables only).
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    if cluster_by and z_order_by:
        raise ValueError("give at most one of cluster_by and z_order_by")
    if z_order_by:
        staged = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/costlens/staged-{uuid.uuid4().hex}"
        df.write.parquet(staged)
        stored = df.sparkSession.read.schema(df.schema).parquet(staged)
        by = [k for k in z_order_by if k not in partition_by]
        try:
            out = _z_ordered(stored, partition_by, by, files, _size(df, staged))
            _write(out, path, table, partition_by, comment, mode, fmt)
        finally:
            _remove(df, staged)
        return
    keys = [*partition_by, *[k for k in cluster_by if k not in partition_by]]
    out = df
    if keys:
        out = out.hint("rebalance", *keys)
    if cluster_by:
        out = out.sortWithinPartitions(*keys)
    _write(out, path, table, partition_by, comment, mode, fmt)


def _size(df: DataFrame, path: str) -> int:
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def _remove(df: DataFrame, path: str) -> None:
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def _write(out: DataFrame, path, table, partition_by, comment, mode, fmt) -> None:
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is not None:
        w.save(path)
        return
    w.saveAsTable(table)
    if comment:
        escaped = comment.replace("'", "\\'")
        out.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{escaped}'")
