"""Operators on blocks with a halo: a function of arrays applied to each tile of layers (granule, y, x, values...).

Pixels go to every tile that they lie in or within `depth` of (one shuffle); each tile becomes arrays, and what the
function returns for its own cells comes back as pixels. A tile's group has a fixed size, (tile + 2 depth)^2 cells, at
any extent of the image and any number of granules.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .resample import halo_tiles, place

TILE = 610


@dataclass(frozen=True)
class Block:
    """Where the arrays of a block lie in the image."""

    granule: object
    tile_y: int
    tile_x: int
    y: int  # of the first row, halo included
    x: int
    own: tuple[slice, slice]  # the tile's own cells among those of the arrays
    present: np.ndarray  # the cells that the image has


def map_blocks(
    pixels: DataFrame, layers: list[str], change: Callable[[dict[str, np.ndarray], Block], dict[str, np.ndarray]], schema: str, depth: int = 0, tile: int = TILE, scale: tuple[int, int] = (1, 1), missing: dict | None = None
) -> DataFrame:
    """(granule, y, x, and the columns of schema): change(arrays by layer, block) for each tile with a halo of `depth` cells.

    Its arrays are shaped like those given; of these the tile's own cells come back, of those only the ones that the image
    has. With a scale (p, q) they are those of the own cells at p / q of the resolution instead, all of which come back, and
    a tile is a multiple of q. Cells that the image lacks hold missing[layer], 0 if none is given. Nulls are NaN in layers
    of floating point and an error in others; so are two pixels at one place."""
    by, (p, q) = place(pixels)[:-2], scale
    if tile % q:
        raise ValueError(f"tiles of {tile} cells cannot be scaled by {p}/{q}")
    kinds = dict(pixels.dtypes)
    fields = _arrow(schema)
    names = [f.name for f in fields]
    gaps = {n: (missing or {}).get(n, 0) for n in layers}

    def run(key: tuple, table: pa.Table) -> pa.Table:
        key = [k.as_py() for k in key]
        granule, ty, tx = (key[0] if by else None), *key[-2:]
        y, x = table["y"].to_numpy(), table["x"].to_numpy()
        top, left = max(int(ty) * tile - depth, 0), max(int(tx) * tile - depth, 0)
        shape = int(max(y.max(), ty * tile)) - top + 1, int(max(x.max(), tx * tile)) - left + 1
        at = (y - top) * shape[1] + (x - left)
        present = np.zeros(shape, bool)
        present.ravel()[at] = True
        if int(present.sum()) != len(at):
            raise ValueError(f"two pixels at one place in tile {ty}, {tx} of {granule}")
        arrays = {}
        for n in layers:
            values = table[n].combine_chunks()
            if values.null_count and not pa.types.is_floating(values.type):
                raise ValueError(f"nulls in the layer {n}")
            values = values.to_numpy(zero_copy_only=False)
            arrays[n] = np.full(shape, gaps[n], values.dtype)
            arrays[n].ravel()[at] = values
        y0, x0 = int(ty) * tile - top, int(tx) * tile - left
        own = slice(y0, min(y0 + tile, shape[0])), slice(x0, min(x0 + tile, shape[1]))
        out = change(arrays, Block(granule, int(ty), int(tx), top, left, own, present))
        if scale == (1, 1):
            r, c = np.nonzero(present[own])
            found = {n: np.asarray(out[n])[own][r, c] for n in names}
        else:
            found = {n: np.asarray(out[n]) for n in names}
            r, c = (k.ravel() for k in np.indices(found[names[0]].shape))
            found = {n: v.ravel() for n, v in found.items()}
        columns = {"y": r.astype(np.int64) + int(ty) * tile * p // q, "x": c.astype(np.int64) + int(tx) * tile * p // q, **found}
        head = {"granule": pa.array([granule] * len(r), table["granule"].type)} if by else {}
        return pa.table({**head, **{n: pa.array(v) for n, v in columns.items()}}).cast(pa.schema([*[pa.field(n, table[n].type) for n in head], pa.field("y", pa.int64()), pa.field("x", pa.int64()), *fields]))

    tiles = halo_tiles(pixels.selectExpr(*by, "cast(y as long) as y", "cast(x as long) as x", *layers), tile, depth)
    head = [f"granule {kinds['granule']}"] if by else []
    return tiles.groupBy(*by, "ty", "tx").applyInArrow(run, ", ".join([*head, "y long, x long", schema]))


def _arrow(schema: str) -> list[pa.Field]:
    kinds = {"boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64(), "smallint": pa.int16(), "tinyint": pa.int8()}
    return [pa.field(f.name, kinds[f.dataType.simpleString()]) for f in StructType.fromDDL(schema).fields]
