"""A named graph of views: built in dependency order, listed, dropped with dependents."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession


class ViewGraph:
    """Views by name, each a function of the views it reads."""

    def __init__(self) -> None:
        self._views: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {}

    def add(self, name: str, build: Callable[..., DataFrame], reads: Sequence[str] = ()) -> "ViewGraph":
        if name in self._views:
            raise ValueError(f"view {name} exists")
        self._views[name] = (tuple(reads), build)
        return self

    def order(self) -> list[str]:
        unknown = {r for reads, _ in self._views.values() for r in reads} - set(self._views)
        if unknown:
            raise ValueError(f"unknown views: {sorted(unknown)}")
        return list(TopologicalSorter({n: reads for n, (reads, _) in self._views.items()}).static_order())

    def build(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Create a temporary view per node; nothing runs until a view is queried."""
        frames: dict[str, DataFrame] = {}
        for name in self.order():
            reads, build = self._views[name]
            frames[name] = build(*[frames[r] for r in reads])
            frames[name].createOrReplaceTempView(name)
        return frames

    def names(self) -> list[str]:
        return sorted(self._views)

    def drop(self, spark: SparkSession, name: str, cascade: bool = False) -> list[str]:
        """Drop a view; with ``cascade`` also everything that reads it."""
        gone = {name}
        for n in self.order():
            if gone & set(self._views[n][0]):
                gone.add(n)
        if len(gone) > 1 and not cascade:
            raise ValueError(f"{sorted(gone - {name})} read {name}; drop with cascade")
        for n in gone:
            del self._views[n]
            spark.catalog.dropTempView(n)
        return sorted(gone)
