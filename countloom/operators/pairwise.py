"""Sums of products between columns of a sparse long matrix.

Each task keeps only an n x n block for the columns it sees (numpy, fed by
sorted Arrow batches), never the rows; the blocks are then summed by a shuffle.
No pair of entries is ever emitted as a row.  ``tiles`` splits the columns when
n x n does not fit a task: every tile pair is then its own partial product.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gram(
    df: DataFrame, by: Sequence[str], row: str, column: str, value: str, tiles: int = 1
) -> DataFrame:
    """(by, col_i <= col_j, dot): dot = sum over rows of value_i * value_j."""
    by = list(by)
    tile = F.pmod(F.hash(column), F.lit(tiles)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    pairs = df.select(*by, row, column, F.col(value).cast("double").alias("_x"), tile.alias("_t"), other.alias("_o"))
    pairs = pairs.select(
        *by,
        F.least("_t", "_o").alias("_a"),
        F.greatest("_t", "_o").alias("_b"),
        "_t",
        F.col(row).cast("string").alias("_row"),
        F.col(column).cast("string").alias("_c"),
        "_x",
    )
    keys = [*by, "_a", "_b"]
    laid_out = pairs.repartition(*keys, "_row").sortWithinPartitions(*keys, "_row")
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema.fields]
        + ["col_i string", "col_j string", "dot double"]
    )
    partial = laid_out.mapInPandas(_block_products(by), schema)
    return partial.groupBy(*by, "col_i", "col_j").agg(F.sum("dot").alias("dot"))


def _block_products(by: list[str]):
    keys = [*by, "_a", "_b"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, block, rest = None, None, None
        for batch in batches:
            whole = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            # The last row may continue in the next batch: hold it back.
            last = whole[[*keys, "_row"]].iloc[-1]
            held = (whole[[*keys, "_row"]] == last).all(axis=1)
            rest = whole[held]
            for key, part in whole[~held].groupby(keys, sort=False):
                if key != current:
                    if block is not None:
                        yield _emit(by, current, block)
                    current, block = key, _Block()
                block.add(part)
        if rest is not None and len(rest):
            for key, part in rest.groupby(keys, sort=False):
                if key != current:
                    if block is not None:
                        yield _emit(by, current, block)
                    current, block = key, _Block()
                block.add(part)
        if block is not None:
            yield _emit(by, current, block)

    return run


class _Block:
    """Running product of the columns seen so far for one tile pair."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.tile: list[int] = []
        self.index: dict[str, int] = {}
        self.total = np.zeros((0, 0))

    def add(self, part: pd.DataFrame) -> None:
        for name, tile in zip(part["_c"], part["_t"]):
            if name not in self.index:
                self.index[name] = len(self.names)
                self.names.append(name)
                self.tile.append(tile)
        n = len(self.names)
        if n > len(self.total):
            grown = np.zeros((n, n))
            grown[: len(self.total), : len(self.total)] = self.total
            self.total = grown
        rows = pd.factorize(part["_row"])[0]
        dense = np.zeros((rows.max() + 1, n))
        np.add.at(dense, (rows, part["_c"].map(self.index).to_numpy()), part["_x"].to_numpy())
        self.total += dense.T @ dense


def _emit(by: list[str], key: tuple, block: _Block) -> pd.DataFrame:
    names = np.array(block.names, dtype=object)
    tile = np.array(block.tile)
    i, j = np.triu_indices(len(names))
    if key[-2] != key[-1]:
        cross = tile[i] != tile[j]
        i, j = i[cross], j[cross]
    a, b = names[i], names[j]
    swap = a > b
    out = pd.DataFrame({"col_i": np.where(swap, b, a), "col_j": np.where(swap, a, b), "dot": block.total[i, j]})
    for name, value in zip(by, key):
        out.insert(0, name, value)
    return out[[*by, "col_i", "col_j", "dot"]]


def mirrored(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Both (i, j) and (j, i), the diagonal once."""
    flipped = pairs.where(F.col("col_i") != F.col("col_j")).select(
        *by, F.col("col_j").alias("col_i"), F.col("col_i").alias("col_j"), "dot"
    )
    return pairs.unionByName(flipped)
