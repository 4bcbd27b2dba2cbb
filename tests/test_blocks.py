"""Blocks with a halo, areas that go through many tiles, several granules in one table."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrapix.operators import blocks, masks, resample


def pixels(spark, image, granule=None):
    rows = [(*(() if granule is None else (granule,)), y, x, v.item()) for (y, x), v in np.ndenumerate(image)]
    return spark.createDataFrame(rows, ("" if granule is None else "granule string, ") + "y long, x long, code int")


def image_of(rows, shape):
    out = np.full(shape, -9)
    for r in rows:
        out[r["y"], r["x"]] = r["code"]
    return out


def flood(image, source, dest, insert, eight):
    image, todo = image.copy(), [tuple(p) for p in np.argwhere((image >= source[0]) & (image <= source[1]) | (image == insert))]
    ways = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (eight or not (a and b))]
    while todo:
        y, x = todo.pop()
        for a, b in ways:
            if 0 <= y + a < image.shape[0] and 0 <= x + b < image.shape[1] and image[y + a, x + b] == dest:
                image[y + a, x + b] = insert
                todo.append((y + a, x + b))
    return image


def winding(n):
    """One way that winds through all rows, from a single source cell."""
    out = np.full((n, n), 7)
    out[::2] = 0
    for k, y in enumerate(range(1, n, 2)):
        out[y, -1 if k % 2 == 0 else 0] = 0
    out[0, 0] = 192
    return out


@pytest.mark.parametrize("eight", [False, True])
@pytest.mark.parametrize("kind", ["winding", "random", "none", "all"])
def test_flooded_through_many_tiles(spark, monkeypatch, eight, kind):
    whole = masks.map_blocks
    monkeypatch.setattr(masks, "map_blocks", lambda *a, **k: whole(*a, **k, tile=8))
    image = {"winding": winding(41), "random": np.random.default_rng(3).choice([0, 0, 0, 7, 7, 192], (45, 37), p=[0.2, 0.2, 0.19, 0.2, 0.2, 0.01]), "none": np.full((9, 9), 7), "all": np.zeros((20, 20), int)}[kind]
    if kind == "all":
        image[19, 19] = 192
    got = masks.dilate(pixels(spark, image), (192, 192), 0, 192, 0, eight)
    assert (image_of(got.collect(), image.shape) == flood(image, (192, 192), 0, 192, eight)).all()


def test_sources_that_do_not_grow(spark, monkeypatch):
    whole = masks.map_blocks
    monkeypatch.setattr(masks, "map_blocks", lambda *a, **k: whole(*a, **k, tile=4))
    image = np.array([[1, 0, 0, 9, 0, 0, 2, 0, 0]])
    got = lambda grows: image_of(masks.dilate(pixels(spark, image), (1, 1), 0, 2, 0, insert_grows=grows).collect(), image.shape).tolist()
    assert got(True) == [[1, 2, 2, 9, 2, 2, 2, 2, 2]] and got(False) == [[1, 2, 2, 9, 0, 0, 2, 0, 0]]


def test_granules_in_one_table_keep_apart(spark):
    a, b = winding(12), np.zeros((12, 12), int)
    both = pixels(spark, a, "A").unionByName(pixels(spark, b, "B"))
    for change in (lambda m: masks.dilate(m, (192, 192), 0, 192, 0), lambda m: masks.dilate(m, (192, 192), 0, 192, 3), masks.shore_labels, masks.repair_border):
        got = change(both).collect()
        for g, image in (("A", a), ("B", b)):
            alone = image_of(change(pixels(spark, image)).collect(), image.shape)
            assert (image_of([r for r in got if r["granule"] == g], image.shape) == alone).all()


def test_two_pixels_at_one_place(spark):
    twice = pixels(spark, np.zeros((3, 3), int)).unionByName(pixels(spark, np.ones((1, 1), int)))
    with pytest.raises(Exception, match="two pixels at one place"):
        masks.dilate(twice, (1, 1), 0, 1, 1).collect()


def test_layers_of_several_types(spark):
    image = np.arange(30 * 20).reshape(30, 20)
    df = pixels(spark, image).withColumns({"f": F.when(F.col("code") % 7 != 0, F.col("code") / 2), "b": F.col("code") % 3 == 0})

    def change(arrays, block):
        assert arrays["f"].dtype == float and arrays["b"].dtype == bool and np.isnan(arrays["f"][block.present]).any()
        around = np.pad(arrays["code"], 1)
        y, x = (k + o for k, o in zip(np.indices(arrays["code"].shape), (block.y, block.x), strict=True))
        return {"s": sum(around[a : a + y.shape[0], c : c + y.shape[1]] for a in (0, 1, 2) for c in (0, 1, 2)), "at": y * 100 + x, "n": arrays["b"] & np.isnan(arrays["f"])}

    got = blocks.map_blocks(df, ["code", "f", "b"], change, "s long, at long, n boolean", depth=1, tile=7).collect()
    wide = np.pad(image, 1)
    assert len(got) == 600
    for r in got:
        assert r["s"] == wide[r["y"] : r["y"] + 3, r["x"] : r["x"] + 3].sum() and r["at"] == r["y"] * 100 + r["x"]
        assert r["n"] == (image[r["y"], r["x"]] % 21 == 0)


def test_bilinear_as_a_block_operator(spark):
    """A change of shape: the interpolation by blocks with a halo of one cell is that of the whole image."""
    rows, cols, f = 14, 21, 3
    image = np.random.default_rng(5).integers(1, 99, (rows, cols))
    df = pixels(spark, image)
    off = int(f / 2 + 0.5)

    def lines(first, n, size):
        """Indices in a line with a border of one, and weights, of the fine cells of n cells from `first` on."""
        at = np.arange(first * f, (first + n) * f)
        r = (at + off) // f
        return r, (at - r * f + (f / 2 + 0.5)) / f

    def change(arrays, block):
        code, own = arrays["code"].astype(float), block.own
        y, x = block.y + own[0].start, block.x + own[1].start
        n = code[own].shape
        wide = np.pad(code, 1, mode="edge")
        wide[0], wide[-1] = 2 * wide[1] - wide[2], 2 * wide[-2] - wide[-3]
        wide[:, 0], wide[:, -1] = 2 * wide[:, 1] - wide[:, 2], 2 * wide[:, -2] - wide[:, -3]
        (r, wy), (c, wx) = lines(y, n[0], rows), lines(x, n[1], cols)
        r, c, wy, wx = r - block.y, c - block.x, wy[:, None], wx[None]
        at = lambda a, b: wide[np.ix_(r + a, c + b)]
        return {"code": (1 - wy) * ((1 - wx) * at(0, 0) + wx * at(0, 1)) + wy * ((1 - wx) * at(1, 0) + wx * at(1, 1))}

    got = blocks.map_blocks(df, ["code"], change, "code double", depth=2, tile=6, scale=(f, 1))
    want = {(r["y"], r["x"]): r["code"] for r in resample.upsample_bilinear(df, f, "code", rows, cols).collect()}
    got = {(r["y"], r["x"]): r["code"] for r in got.collect()}
    assert got.keys() == want.keys() and len(got) == rows * cols * f * f
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9
    coarse = blocks.map_blocks(df, ["code"], lambda a, b: {"code": a["code"][b.own][: len(a["code"][b.own]) // 7 * 7 : 7, ::7]}, "code int", tile=7, scale=(1, 7)).collect()
    assert sorted((r["y"], r["x"], r["code"]) for r in coarse) == [(y, x, image[7 * y, 7 * x]) for y in range(2) for x in range(3)]
