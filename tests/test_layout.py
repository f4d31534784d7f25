"""K2: layout by several keys at once, read by any one of them."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from costlens import sinks
from costlens.sinks import interleaved, rank, rank_bounds, write_table

KEYS = ["workspace_id", "cluster_id", "job_id"]


@pytest.fixture(scope="module")
def rows(spark):
    spread = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    return spark.range(40_000).select(
        F.when(spread(9, 3) == 0, 7).otherwise(spread(1, 500)).cast("long").alias("workspace_id"),  # a third on one
        F.concat(F.lit("cluster-"), F.lpad(spread(2, 900).cast("string"), 4, "0")).alias("cluster_id"),
        F.when(spread(3, 50) > 0, spread(4, 3000)).alias("job_id"),
        F.col("id").alias("value"),
    )


def files_holding(folder, key, value):
    """Files that a reader cannot skip by the key's minimum and maximum, and all files."""
    met = every = 0
    for f in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        i = meta.schema.names.index(key)
        every += 1
        stats = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
        met += any(s.has_min_max and s.min <= value <= s.max for s in stats)
    return met, every


def test_a_filter_on_any_key_skips_two_thirds(spark, rows, tmp_path):
    write_table(rows, path=f"{tmp_path}/z", z_order_by=KEYS, files=64)
    write_table(rows.repartitionByRange(64, *KEYS), path=f"{tmp_path}/plain")
    for key in KEYS:
        values = [r[0] for r in rows.select(key).where(F.col(key).isNotNull()).distinct().orderBy(F.xxhash64(key)).limit(40).collect()]
        held = [files_holding(f"{tmp_path}/z", key, v) for v in values]
        assert held[0][1] > 50
        share = sum(a for a, _ in held) / sum(b for _, b in held)
        assert share <= 1 / 3, (key, share)
    # sorted by the leading key only, a filter on the last key reads nearly all files
    met, every = files_holding(f"{tmp_path}/plain", "job_id", 1500)
    assert met > 0.9 * every


def test_rows_are_unchanged_and_even(spark, rows, tmp_path):
    write_table(rows, path=f"{tmp_path}/z", z_order_by=KEYS, files=32)
    back = spark.read.parquet(f"{tmp_path}/z").select(*rows.columns)
    assert back.exceptAll(rows).count() == 0 and back.count() == rows.count()
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/z/*.parquet")]
    assert max(sizes) < 3 * rows.count() / 32  # the hot workspace is cut


def test_one_combination_of_keys_is_cut(spark, tmp_path):
    same = spark.range(20_000).selectExpr("1L as workspace_id", "'c' as cluster_id", "2L as job_id", "id as value")
    write_table(same, path=f"{tmp_path}/z", z_order_by=KEYS, files=16)
    assert len(glob.glob(f"{tmp_path}/z/*.parquet")) > 10
    assert spark.read.parquet(f"{tmp_path}/z").count() == 20_000


def test_ranks_rise_with_values(spark, rows):
    for key in KEYS:
        bounds = rank_bounds(rows, key, 4)
        tops = [t for t, _ in bounds]
        assert 8 <= len(bounds) <= 16 and tops == sorted(tops)
        got = rows.select(key, rank(key, bounds).alias("r"))
        seen = got.distinct().orderBy(F.col(key).asc_nulls_first()).collect()
        ranks = [r.r for r in seen]
        assert ranks == sorted(ranks) and 0 <= ranks[0] and ranks[-1] < 16
        assert all(r.r == bounds[min(sum(t < r[0] for t in tops), len(bounds) - 1)][1] for r in seen if r[0] is not None)
        half = got.where("r < 8").count() / rows.count()
        assert 0.4 < half < 0.6  # the highest bit halves the rows


def test_bits_are_taken_in_turn(spark):
    df = spark.createDataFrame([(0b101, 0b011), (0, 7), (7, 0)], "a int, b int")
    got = [r[0] for r in df.select(interleaved([F.col("a"), F.col("b")], 3)).collect()]
    assert got == [0b100111, 0b010101, 0b101010]


def test_boxes_hold_every_cell_once():
    cells = {c: 1 + c % 7 for c in range(0, 64, 3)} | {5: 1000}
    found = sinks.boxes(cells, 20, 6)
    assert sorted(c for some, _ in found for c in some) == sorted(cells)
    for some, cut in found:
        assert sum(cells[c] for c in some) <= 20 * cut and (cut == 1 or len(some) == 1)
    assert sinks.boxes({}, 5, 6) == [([], 1)]


def test_edges(spark, rows, tmp_path):
    write_table(rows.limit(0), path=f"{tmp_path}/none", z_order_by=KEYS)
    assert spark.read.schema(rows.schema).parquet(f"{tmp_path}/none").count() == 0
    nulls = rows.select(*[F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in KEYS], "value").limit(10)
    write_table(nulls, path=f"{tmp_path}/nulls", z_order_by=KEYS)
    assert spark.read.parquet(f"{tmp_path}/nulls").count() == 10
    by_day = rows.withColumn("date", F.to_date(F.lit("2024-01-01")))
    write_table(by_day, path=f"{tmp_path}/d", partition_by=("date",), z_order_by=("date", *KEYS))
    assert spark.read.parquet(f"{tmp_path}/d").count() == rows.count()
    with pytest.raises(ValueError):
        write_table(rows, path=f"{tmp_path}/x", z_order_by=KEYS, cluster_by=KEYS)
    with pytest.raises(ValueError):
        sinks.interleaved([F.lit(1)] * 11, 6)


def test_no_staged_rows_stay(spark, rows, tmp_path):
    from costlens.session import checkpoint_dir

    write_table(rows.limit(100), path=f"{tmp_path}/t", z_order_by=KEYS)
    assert not glob.glob(f"{checkpoint_dir(spark)}/costlens/staged-*")
