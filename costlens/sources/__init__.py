"""Logical sources: schemas, adapters, and the test-table mapping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from costlens.sources.schemas import SCHEMAS, conform, key_types

SOURCE_NAMES = tuple(SCHEMAS)


class Sources:
    """The ten logical inputs, each checked against its schema on first use.

    Built from DataFrames or from zero-argument factories; a source is only
    planned (and its schema checked) when a dataset needs it.
    """

    def __init__(self, frames: dict[str, DataFrame | Callable[[], DataFrame]]):
        missing = [n for n in SOURCE_NAMES if n not in frames]
        if missing:
            raise ValueError(f"missing logical sources {missing}")
        self._frames = dict(frames)
        self._done: dict[str, DataFrame] = {}
        self._key_types: dict[str, tuple[str, str]] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SOURCE_NAMES:
            raise AttributeError(name)
        if name not in self._done:
            f = self._frames[name]
            df = conform(f() if callable(f) else f, name)
            for key, kind in key_types(df).items():
                # a key joins sources, so it must have one type in all of them
                other, first = self._key_types.setdefault(key, (name, kind))
                if first != kind:
                    raise ValueError(f"{key} is {first} in {other} but {kind} in {name}")
            self._done[name] = df
        return self._done[name]

    @classmethod
    def of(cls, frames: dict) -> "Sources":
        return cls(frames)

    @classmethod
    def from_paths(cls, spark, paths: dict, fmt: str = "parquet") -> "Sources":
        """Read each logical source from a path (or a catalog table name)."""

        def reader(loc):
            if "/" in loc:
                return lambda: spark.read.format(fmt).load(loc)
            return lambda: spark.read.table(loc)

        return cls({n: reader(paths[n]) for n in SOURCE_NAMES})

    @classmethod
    def from_test_tables(cls, spark, sf_dir: str) -> "Sources":
        from costlens.sources.testdata import TestTables

        t = TestTables(spark, sf_dir)
        return cls({n: getattr(t, n) for n in SOURCE_NAMES})
