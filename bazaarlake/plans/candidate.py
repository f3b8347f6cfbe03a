"""Candidate tables: what a build has made and nobody sees until its tests have passed."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import Lake


def among(column: Column, values: list[Any]) -> Column:
    """Whether a column is one of ``values``, of which None stands for NULL."""
    known = [v for v in values if v is not None]
    found = F.coalesce(column.isin(known), F.lit(False)) if known else F.lit(False)
    return found | column.isNull() if None in values else found


class Candidate:
    """The tables of a layer as they would be after a build.

    ``write`` stages a table whole and ``replace`` some partitions of it; ``read`` shows a table with what is staged, for the tests and for
    the tables built from it. ``commit`` makes all of it the lake's. A build whose tests fail is simply left, and the lake stays as it was.
    """

    def __init__(self, lake: Lake, layers: dict[str, str]):
        self.lake = lake
        self.layers = layers
        self._views: dict[str, DataFrame] = {}
        self._commits: list[Callable[[], None]] = []

    def layer(self, name: str) -> str:
        return next(layer for prefix, layer in self.layers.items() if name.startswith(prefix))

    def current(self, name: str) -> DataFrame:
        return self.lake.read(self.layer(name), name)

    def read(self, name: str) -> DataFrame:
        return self._views[name] if name in self._views else self.current(name)

    def write(self, name: str, df: DataFrame, **layout) -> None:
        """Stage a table whole."""
        layer = self.layer(name)
        folder = self.lake.stage(layer, name, df, **layout)
        self._views[name] = self.lake.spark.read.schema(df.schema).parquet(folder)
        self._commits.append(lambda: self.lake.switch(layer, name, folder))

    def replace(self, name: str, df: DataFrame, column: str, values: list[Any]) -> None:
        """Stage ``df`` as all rows of a table whose ``column`` is one of ``values``; the other partitions are not touched."""
        layer, current = self.layer(name), self.current(name)
        staged = materialize(df.select(*[F.col(f.name).cast(f.dataType) for f in current.schema]), name)
        self._views[name] = current.where(~among(F.col(column), values)).unionByName(staged)
        self._commits.append(lambda: self.lake.replace_values(layer, name, staged, column, values))

    def commit(self) -> None:
        for step in self._commits:
            step()
