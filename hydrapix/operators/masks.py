"""Static masks: geodesic dilation, zones and distance labels on grids (y, x, code).

A dilation of n steps reaches n cells, so each tile needs a border of n cells and no more: pixels go to every tile
that they are a border of (one shuffle), each tile dilates its own array, and only its own cells come back (blocks.py).
Grids of several granules have a column granule.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import forgotten, settled
from .blocks import TILE, Block, map_blocks
from .resample import place


def _grown(on: np.ndarray, eight: bool) -> np.ndarray:
    p = np.pad(on, 1)
    out = p[1:-1, 1:-1] | p[:-2, 1:-1] | p[2:, 1:-1] | p[1:-1, :-2] | p[1:-1, 2:]
    return out | p[:-2, :-2] | p[:-2, 2:] | p[2:, :-2] | p[2:, 2:] if eight else out


def _by_tile(mask: DataFrame, depth: int, change) -> DataFrame:
    """Applies change(codes array) to each tile with a border of `depth` cells; -1 where the mask has no cell."""
    codes = mask.withColumn("code", F.col("code").cast("int"))
    return map_blocks(codes, ["code"], lambda arrays, _: {"code": change(arrays["code"])}, "code int", depth, missing={"code": -1})


def _step(codes: np.ndarray, on: np.ndarray, dest: int, insert: int, eight: bool) -> None:
    """Cells of value dest next to a cell that is on become `insert`."""
    codes[(codes == dest) & _grown(on, eight)] = insert


def _reached(codes: np.ndarray, source: tuple[int, int], dest: int, insert: int, steps: int, eight: bool, insert_grows: bool) -> np.ndarray:
    on = (codes >= source[0]) & (codes <= source[1])
    if insert_grows:
        on |= codes == insert
    free = codes == dest
    reached = on.copy()
    for _ in range(steps):
        reached |= _grown(reached, eight) & free
    return np.where(free & reached, insert, codes)


def dilate(mask: DataFrame, source: tuple[int, int], dest: int, insert: int, steps: int, eight: bool = False, insert_grows: bool = True) -> DataFrame:
    """Cells of value dest within `steps` of a source value (an interval, and the inserted value too unless told
    otherwise), by way of dest cells, become `insert`. With steps = 0 that goes on until nothing changes, at any length of
    the way (see flooded)."""
    if steps:
        return _by_tile(mask, steps, lambda codes: _reached(codes, source, dest, insert, steps, eight, insert_grows))
    return flooded(mask, source, dest, insert, eight, insert_grows)


def areas(on: np.ndarray, eight: bool) -> np.ndarray:
    """For each cell that is on the flat index of the first cell of its connected area, -1 for others: the ends of all links
    between neighbours point at the smaller root until none is left, so long ways take few rounds."""
    label = np.arange(on.size).reshape(on.shape)
    links = []
    for dy, dx in ((0, 1), (1, 0), *(((1, 1), (1, -1)) if eight else ())):
        a = (slice(0, on.shape[0] - dy), slice(max(-dx, 0), on.shape[1] - max(dx, 0)))
        b = (slice(dy, None), slice(max(dx, 0), on.shape[1] + min(dx, 0)))
        both = on[a] & on[b]
        links.append(np.stack([label[a][both], label[b][both]]))
    u, v = np.concatenate(links, 1)
    root = label.ravel().copy()
    while len(u):
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root[root] != root).any():
            root = root[root]
        u, v = root[u], root[v]
        u, v = u[u != v], v[u != v]
    return np.where(on, root.reshape(on.shape), -1)


def _packed(y, x):
    """A cell as one number, in the order of rows and columns."""
    return (np.asarray(y, np.int64) << 32) | np.asarray(x, np.int64)


def _border_links(eight: bool):
    """Of a tile with a halo of one cell: the area of each own cell, packed by its first cell, and whether it touches what is
    on; across its upper and left border the neighbours that are dest too (each pair of tiles is looked at from one side)."""
    ways = [(-1, 0), (0, -1), *([(-1, -1), (-1, 1), (1, -1)] if eight else [])]

    def change(arrays: dict, block: Block) -> dict:
        dest, on = arrays["dest"], arrays["on"]
        mine = np.zeros(dest.shape, bool)
        mine[block.own] = True
        label = areas(dest & mine, eight)
        cell = _packed(block.y + label // dest.shape[1], block.x + label % dest.shape[1])
        area = np.where(label >= 0, cell, -1)
        out = {"area": area, "touched": (label >= 0) & _grown(on, eight)}
        places = _packed(*(k + o for k, o in zip(np.indices(dest.shape), (block.y, block.x), strict=True)))
        for i in range(5):
            link = np.full(dest.shape, -1, np.int64)
            if i < len(ways):
                dy, dx = ways[i]
                y, x = np.nonzero(dest & mine)
                ny, nx = y + dy, x + dx
                inside = (ny >= 0) & (ny < dest.shape[0]) & (nx >= 0) & (nx < dest.shape[1])
                y, x, ny, nx = (k[inside] for k in (y, x, ny, nx))
                across = dest[ny, nx] & ~mine[ny, nx]
                link[y[across], x[across]] = places[ny[across], nx[across]]
            out[f"link{i}"] = link
        return out

    return change


def flooded(mask: DataFrame, source: tuple[int, int], dest: int, insert: int, eight: bool = False, insert_grows: bool = True) -> DataFrame:
    """All cells of value dest that a source value reaches by way of dest cells, at any distance, become `insert`.

    Each tile labels its own connected areas of dest cells once. Areas that meet at a tile's border are links of a graph,
    which is as small as the borders; whether an area is reached is settled on that graph alone, and comes back to the pixels
    by one join on the area. So pixels are shuffled a fixed number of times, however long and winding the way is."""
    by = place(mask)[:-2]
    code = F.col("code").cast("int")
    on = code.between(*source) | (code == insert) if insert_grows else code.between(*source)
    cells = mask.select(*by, "y", "x", code.alias("code"), (code == dest).alias("dest"), (on & (code != dest)).alias("on"))
    layers = map_blocks(cells, ["code", "dest", "on"], lambda a, b: _border_links(eight)(a, b) | {"code": a["code"]}, "code int, area long, touched boolean, " + ", ".join(f"link{i} long" for i in range(5)), depth=1)
    layers = settled(layers)
    one = layers.where("area >= 0")
    ends = F.array_distinct(F.filter(F.array(*[F.col(f"link{i}") for i in range(5)]), lambda v: v >= 0))
    links = one.select(*by, "area", F.explode(ends).alias("cell")).distinct()
    met = one.select(*by, F.expr("(y << 32) | x").alias("cell"), F.col("area").alias("other"))
    links = links.join(met, [*by, "cell"]).select(*by, "area", "other").distinct()
    seeds = one.where("touched").select(*by, "area").distinct()
    reached = connected(links, seeds, by)
    out = layers.join(reached.withColumn("hit", F.lit(True)), [*by, "area"], "left")
    return out.select(*by, "y", "x", F.when(F.col("hit"), insert).otherwise(F.col("code")).alias("code"))


def connected(links: DataFrame, seeds: DataFrame, by: list[str]) -> DataFrame:
    """(area) of all areas that links (area, other) join to a seed. Every area points at the smallest neighbour that it knows
    of, pointers are doubled, and links move to where their ends point, until none is left between different ends: a
    number of rounds that grows with the logarithm of the graph, each settled."""
    rest = settled(links.where("area <> other"))
    ends = rest.select(*by, "area").unionByName(rest.select(*by, F.col("other").alias("area"))).distinct()
    root = settled(ends.withColumn("root", F.col("area")))
    while not rest.isEmpty():
        low = rest.select(*by, F.greatest("area", "other").alias("u"), F.least("area", "other").alias("v"))
        hook = settled(low.groupBy(*by, "u").agg(F.min("v").alias("v"), F.lit(True).alias("moved")))
        while not hook.where("moved").isEmpty():  # u points at v < u; chains of pointers are halved until each ends at what points nowhere
            jump = hook.select(*by, F.col("u").alias("v"), F.col("v").alias("next"))
            before, hook = hook, settled(hook.join(jump, [*by, "v"], "left").select(*by, "u", F.coalesce("next", "v").alias("v"), F.col("next").isNotNull().alias("moved")))
            forgotten(before)
        to = hook.select(*by, F.col("u").alias("root"), "v")
        before, root = root, settled(root.join(to, [*by, "root"], "left").select(*by, "area", F.coalesce("v", "root").alias("root")))
        forgotten(before)
        now = rest
        for k in ("area", "other"):
            now = now.join(hook.select(*by, F.col("u").alias(k), F.col("v").alias("to")), [*by, k], "left").withColumn(k, F.coalesce("to", k)).drop("to")
        before, rest = rest, settled(now.where("area <> other").distinct())
        forgotten(before, hook)
    roots = root.join(seeds, [*by, "area"]).select(*by, "root").distinct()
    return root.join(roots, [*by, "root"]).select(*by, "area").unionByName(seeds).distinct()


def opened(mask: DataFrame, a: int, b: int, steps: int, by: int | None = None, rest: int | None = None) -> DataFrame:
    """a grows into b (as `by`, a itself if none is given), then b grows back, which also takes from what was `by`
    before; what b does not take back becomes `rest`, if one is given (cells of b themselves where by is a). One border
    of twice the steps serves both ways."""
    mark = a if by is None else by

    def change(codes: np.ndarray) -> np.ndarray:
        codes = _reached(codes, (a, a), b, mark, steps, False, True)
        codes = _reached(codes, (b, b), mark, b, steps, False, True)
        return codes if rest is None else np.where(codes == (b if by is None else mark), rest, codes)

    return _by_tile(mask, 2 * steps, change)


def distance_labels(mask: DataFrame, source: int = 64, dest: int = 96, most: int = 32, four: int = 2) -> DataFrame:
    """Cells of value dest get source + their distance from source, up to `most` steps; the first `four` steps go
    to 4 neighbours, later ones to 8."""

    def change(codes: np.ndarray) -> np.ndarray:
        codes = codes.copy()
        for i in range(most):
            _step(codes, (codes == source + i) | (codes == source + i + 1), dest, source + i + 1, i >= four)
        return codes

    return _by_tile(mask, most, change)


def shore_labels(mask: DataFrame, width: int = 4, most: int = 32) -> DataFrame:
    """Coastal cells (160) within `width` of the transition zone (65 to 95), and nearer to it than to inland water (96),
    get 160 + their distance from the ocean (64) along that shore, up to `most`."""
    transition, inland = 2, 1  # marks that do not last

    def change(codes: np.ndarray) -> np.ndarray:
        codes = codes.copy()
        for i in range(width):
            _step(codes, codes == transition if i else (codes >= 65) & (codes <= 95), 160, transition, True)
            _step(codes, (codes == 96) | (codes == inland), 160, inland, True)
        for i in range(most):
            _step(codes, codes == (160 + i if i else 64), transition, 160 + i + 1, True)
        return np.where((codes == transition) | (codes == inland), 160, codes)

    return _by_tile(mask, width + most, change)


def repair_border(mask: DataFrame, rounds: int = 4) -> DataFrame:
    """Invalid cells (0) take the value of a neighbour, up to `rounds` cells deep for each value in turn."""
    values = (192, 64, 64, 160, 128)

    def change(codes: np.ndarray) -> np.ndarray:
        codes = codes.copy()
        for v in values * rounds:
            _step(codes, codes == v, 0, v, False)
        return codes

    return _by_tile(mask, len(values) * rounds, change)


def fill_invalid(mask: DataFrame) -> DataFrame:
    """All invalid cells (0) that land (192) reaches by way of invalid ones become land, then the same with ocean (64)."""
    return dilate(dilate(mask, (192, 192), 0, 192, 0, eight=True), (64, 64), 0, 64, 0, eight=True)


def inland_within(code: Column, land: Column) -> Column:
    """Land and coastal cells that the binned land mask calls water (0) are inland water."""
    return F.when(code.isin(192, 160) & (land == 0), 96).otherwise(code)


def combine(land: Column, inland: Column, ocean: Column) -> Column:
    """Zone of a cell from binned masks: land 192, inland 96, ocean 64, else river 3."""
    return F.when(land, 192).when(inland, 96).when(ocean, 64).otherwise(3)


def overlay(code: Column, fallback: Column) -> Column:
    """A mask with gaps (0) filled from another; 1 over 3 is 3."""
    return F.when(F.coalesce(code, F.lit(0)) == 0, F.coalesce(fallback, F.lit(0))).when((code == 1) & (fallback == 3), 3).otherwise(code)


def recode(code: Column) -> Column:
    return F.when(code == 1, 192).when(code == 2, 64).when(code == 3, 160).when(code == 4, 128).otherwise(0)


def majority_land(cells: DataFrame, full: DataFrame) -> DataFrame:
    """Land where at least half of a cell's points are; also where it has none."""
    n = cells.groupBy("j", "i").agg(F.count("*").alias("n"), F.count_if("land").alias("n1"))
    return full.join(n, ["j", "i"], "left").select("j", "i", F.expr("2 * coalesce(n1, 0) >= coalesce(n, 0)").alias("land"))


def majority_tie(cells: DataFrame, full: DataFrame) -> DataFrame:
    """1 where half or more of a cell's points are land, 0 also where it has none."""
    n = cells.groupBy("j", "i").agg(F.count("*").alias("n"), F.count_if("land").alias("n1"))
    return full.join(n, ["j", "i"], "left").select("j", "i", F.expr("cast(coalesce((n1 + n div 2) div n, 0) as int)").alias("land"))
