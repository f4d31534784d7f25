"""Shared helpers of the corpus operators: tables, shared storage, Arrow batches.

All helpers work on whole tables and keep nothing on the driver but bounded
aggregates.  Intermediate tables go to the shared folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.session import checkpoint_dir

# Arrow batches handed to Python: bounded by rows and, for long texts, by bytes.
BATCH_BYTES = 4 << 20
# Bytes tokenized at once inside a batch (bounds the 8-byte work arrays).
CHUNK_BYTES = 1 << 20

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of ``sf_dir`` (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows, so long texts cannot pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


class Workspace:
    """Intermediate tables of one run, in the shared checkpoint folder.

    ``keep`` writes a DataFrame as Parquet and reads it back: the lineage is cut,
    the rows survive lost executors and are not computed again.  ``drop`` removes
    tables that no later plan reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/costlens-llm/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.path}/{self._n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._kept_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._kept_path)
            path.getFileSystem(conf).delete(path, True)


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, with signs added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sha256_hex(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


RUN_BLOCK = 128


def running_totals(sizes: Column) -> Column:
    """For every number of an int array the sum of those before it, as long.

    An array grown step by step is copied at each step, so it is grown in blocks of
    ``RUN_BLOCK`` numbers, beginning at the running totals of the blocks.
    """

    def totals(numbers: Column, first: Column) -> Column:
        return F.aggregate(
            numbers, F.array(first), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))
        )

    def all_of(s: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(s), F.lit(RUN_BLOCK))
        blocks = F.transform(starts, lambda at: F.slice(s, at, F.lit(RUN_BLOCK)))
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda t, x: t + x))
        # the totals of large blocks of blocks need no further level: they are few
        pair = F.struct(blocks.alias("blocks"), totals(sums, F.lit(0).cast("long")).alias("before"))
        return let(
            pair,
            lambda p: F.flatten(
                F.transform(
                    p["blocks"], lambda b, i: F.slice(totals(b, F.get(p["before"], i)), F.lit(1), F.size(b))
                )
            ),
        )

    none = F.array().cast("array<long>")
    return let(sizes, lambda s: F.when(F.size(s) > 0, all_of(s)).otherwise(none))


# ---------------------------------------------------------------- text bytes


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n+1 row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_table(separators: bytes) -> np.ndarray:
    """Lookup of 256 bytes: 0 for a separator, else the byte with A-Z lower-cased."""
    t = np.arange(256, dtype=np.uint8)
    t[ord("A") : ord("Z") + 1] += 32
    t[np.frombuffer(separators, np.uint8)] = 0
    return t


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_WEIGHTS = mix64(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_GRAM = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def _chunks(raw: np.ndarray, table_: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of about ``CHUNK_BYTES`` that end at a row bound or before a separator."""
    at, n = 0, len(raw)
    while at < n:
        end = min(n, at + CHUNK_BYTES)
        while end < n:
            row = bounds[np.searchsorted(bounds, end)]  # next row bound at or after end
            seps = np.flatnonzero(table_[raw[end : end + 4096]] == 0)
            if len(seps):
                end = int(min(row, end + seps[0]))
                break
            if row <= end + 4096:
                end = int(row)
                break
            end = min(n, end + 4096)
        yield at, end
        at = end


def hash_words(
    raw: np.ndarray, offsets: np.ndarray, table_: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a batch, with their byte spans and row bounds.

    Returns ``(hashes, starts, ends, first)``: row r owns words first[r]:first[r+1].
    """
    hashes, starts, ends = [], [], []
    for lo, hi in _chunks(raw, table_, offsets):
        t = table_[raw[lo:hi]]
        word = t != 0
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        cuts = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)] - lo
        begin[cuts] = word[cuts]  # a word never runs over a row bound
        s = np.flatnonzero(begin)
        if not len(s):
            continue
        letters = t[word].astype(np.uint64)
        inner = np.cumsum(word)[s] - 1  # index of each word's first byte among word bytes
        length = np.diff(np.append(inner, len(letters)))
        within = np.arange(len(letters)) - np.repeat(inner, length)
        within &= len(_WEIGHTS) - 1
        h = np.add.reduceat(letters * _WEIGHTS[within], inner)
        hashes.append(mix64(h + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        starts.append(s + lo)
        ends.append(s + lo + length)
    if not hashes:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    starts_ = np.concatenate(starts)
    first = np.searchsorted(starts_, offsets)
    return np.concatenate(hashes), starts_, np.concatenate(ends), first


def hash_grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-grams of a word-hash sequence (empty when it is shorter)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = words[:n] * _GRAM[0]
    for i in range(1, k):
        g = g + words[i : i + n] * _GRAM[i]
    return mix64(g + np.uint64(k))


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``fn`` over every Arrow batch of ``df`` (bounded by ``bound_batches``)."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


# ------------------------------------------------------- bounded membership


class KeyFilter:
    """A bitmap of hashed keys, small enough to broadcast whatever the key count.

    It holds ``per_key`` bits per key up to ``MAX_BITS`` bits (8 MB); beyond that it
    only lets more foreign keys through.  Users join its survivors with the keys, so
    results never depend on it.
    """

    MAX_BITS = 1 << 26

    def __init__(self, keys: DataFrame, column: str, per_key: int = 16):
        spark = keys.sparkSession
        bits = 1 << 12
        n = keys.count()
        while bits < min(per_key * n, self.MAX_BITS):
            bits *= 2
        self.bits = bits
        place = F.pmod(F.col(column), F.lit(bits))
        words = (
            keys.select(place.alias("p"))
            .groupBy((F.col("p") / 64).cast("int").alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"))
            .toArrow()  # at most MAX_BITS / 64 rows
        )
        bitmap = np.zeros(bits // 64, np.int64)
        bitmap[words["w"].to_numpy()] = words["b"].to_numpy()
        self.shared = spark.sparkContext.broadcast(bitmap.tobytes())

    def lookup(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function telling which of some int64 keys may be held (false for others)."""
        shared, bits = self.shared, self.bits

        def held(keys: np.ndarray) -> np.ndarray:
            bitmap = np.frombuffer(shared.value, np.uint64)
            place = np.mod(keys, bits).astype(np.uint64)
            word = bitmap[(place >> np.uint64(6)).astype(np.int64)]
            return (word >> (place & np.uint64(63))) & np.uint64(1) == 1

        return held


def rows_where(
    docs: DataFrame, key: Column, test: Callable[[np.ndarray], np.ndarray], nulls: bool = False
) -> DataFrame:
    """The rows whose key (a long) passes ``test``, and with ``nulls`` those without a key.

    Columns stay as they came, whatever their names; a scan, nothing is shuffled.
    """
    names, schema = docs.columns, docs.schema
    own = [docs[c].alias(f"column_{i}") for i, c in enumerate(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tested = batch.column(0)
            passed = test(tested.fill_null(0).to_numpy(zero_copy_only=False))
            valid = tested.is_valid().to_numpy(zero_copy_only=False)
            rest = pa.RecordBatch.from_arrays(batch.columns[1:], names=names)
            yield rest.filter(pa.array(np.where(valid, passed, nulls)))

    bound_batches(docs.sparkSession)
    return docs.select(key.cast("long").alias("tested"), *own).mapInArrow(run, schema)


def split_by_keys(
    docs: DataFrame, key: str | Column, keys: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` is surely not in ``keys``, all other rows), columns as they came.

    ``key`` is a column of ``docs`` or made of its columns; ``keys`` has one long column.
    Both parts are cut out in scans, so the rows of the first, nearly all when the keys
    are few, are never shuffled.  Null keys are in the first part.
    """
    held = KeyFilter(keys, keys.columns[0]).lookup()
    tested = docs[key] if isinstance(key, str) else key
    return rows_where(docs, tested, lambda k: ~held(k), nulls=True), rows_where(docs, tested, held)
