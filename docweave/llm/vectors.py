"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are rotated so that the leading coordinates carry most of their
length (the rotation is fitted on ``SAMPLE`` vectors and changes no cosine,
so a poor fit costs time, never a link) and dealt over tiles, boxes in the
leading coordinates. Unit vectors at cosine t are sqrt(2 - 2t) apart, so a
vector visits only tiles of lower number whose box is that near. In a tile,
block products accumulate the leading coordinates first; the product of the
rests is at most the product of their norms, and a pair whose sum cannot
reach the threshold is dropped before the remaining coordinates are touched.
Survivors are checked in double precision on the vectors as given.

Equal vectors are one class and compared once. A work unit holds one sub-tile
and the visitors from ``VISIT`` sub-tiles; it goes block by block, adds a
block's links to the sums, joins them into the forest and lets the pairs go.
It returns per class a number of links and one edge of a spanning forest, so a
group of copies or of near vectors of any size gives rows in proportion to its
members, not to its pairs. There are at most ``MAX_TILES`` tiles (their boxes
are what is broadcast); one of more than ``TILE`` vectors is cut by a hash of
the class into sub-tiles of about ``TILE``, so no unit grows with the input.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths do not link;
repeated rows are vectors of their own, linked to each other; a null vec_id
takes part and its component is the smallest id that is not null, else null;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import materialize, prepare, table
from docweave.llm.components import connected_components, min_labels
from docweave.llm.shingles import mix

THRESHOLD = 0.95
SAMPLE = 20_000
TILE = 2048
MAX_TILES = 4096
VISIT = 16
LEAD = 8
BLOCK = 1024
CELLS = 1 << 22  # vector components gathered at a time
EMIT = 1 << 14   # rows of a frame of visits
SLACK = 1e-9


def classes_of(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """rows (vec_id, ck: null if not comparable) and classes (cid, ck, rep, n, v)."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v"))
    rows = rows.withColumn("ck", F.when(F.coalesce(fine, F.lit(False)), F.md5(F.array_join("v", ","))))
    groups = rows.where("ck IS NOT NULL").groupBy("ck").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    return rows.select("vec_id", "ck"), materialize(groups.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")


def units(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(1)[:, None]  # keeps squares of huge and tiny components finite
    return scaled / np.sqrt((scaled * scaled).sum(1))[:, None]


def fit_rotation(sample: np.ndarray) -> np.ndarray:
    """Columns: principal directions, the longest first."""
    values, directions = np.linalg.eigh(sample.T @ sample)
    return directions[:, np.argsort(-values)]


def fit_splits(points: np.ndarray, tiles: int) -> list[tuple[int, float]]:
    """A balanced tree of median cuts as an array: node k has children 2k + 1, 2k + 2;
    each cuts the coordinate with the largest spread."""
    cuts: list[tuple[int, float]] = []
    level = [points]
    for _ in range(int(np.log2(tiles))):
        below = []
        for p in level:
            axis = int(np.argmax(p.max(0) - p.min(0))) if len(p) else 0
            cut = float(np.median(p[:, axis])) if len(p) else 0.0
            cuts.append((axis, cut))
            below += [p[p[:, axis] < cut], p[p[:, axis] >= cut]] if len(p) else [p, p]
        level = below
    return cuts


def tile_of(points: np.ndarray, cuts: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    if not cuts:
        return node
    axes, at = np.array([c[0] for c in cuts]), np.array([c[1] for c in cuts])
    for _ in range(int(np.log2(len(cuts) + 1))):
        right = points[np.arange(len(points)), axes[node]] >= at[node]
        node = 2 * node + 1 + right
    return node - len(cuts)


def _cosines(a: np.ndarray, p: np.ndarray, b: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Products of the rows p of a with the rows q of b, CELLS components at a time."""
    step = max(1, CELLS // max(1, a.shape[1]))
    parts = [np.einsum("ij,ij->i", a[p[k:k + step]], b[q[k:k + step]]) for k in range(0, len(p), step)]
    return np.concatenate(parts) if parts else np.empty(0)


def linked(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of rotated unit vectors whose cosine can reach the
    threshold (i < j if ``same``), of one block of at most BLOCK x BLOCK after another."""
    dims = a.shape[1]
    steps = [s for s in (8, 16, 32, 64, 128, 256, 512, 1024) if s < dims] + [dims]
    rest_a = [np.sqrt((a[:, s:] ** 2).sum(1)) for s in steps]
    rest_b = [np.sqrt((b[:, s:] ** 2).sum(1)) for s in steps]
    for i in range(0, len(a), BLOCK):
        for j in range(i if same else 0, len(b), BLOCK):
            x, y, last = a[i:i + BLOCK], b[j:j + BLOCK], steps[0]
            part = x[:, :last] @ y[:, :last].T
            live = part + rest_a[0][i:i + BLOCK, None] * rest_b[0][None, j:j + BLOCK] >= threshold - SLACK
            if same and i == j:
                live &= np.triu(np.ones(live.shape, bool), 1)
            p, q = np.nonzero(live)
            dot = part[p, q]
            for k, s in enumerate(steps[1:], 1):
                if not len(p):
                    break
                if len(p) > live.size // 8:  # many: one product for the block is cheaper
                    dot = dot + (x[:, last:s] @ y[:, last:s].T)[p, q]
                else:
                    dot = dot + _cosines(x[:, last:s], p, y[:, last:s], q)
                ok = dot + rest_a[k][i + p] * rest_b[k][j + q] >= threshold - SLACK
                p, q, dot, last = p[ok], q[ok], dot[ok], s
            if len(p):
                yield i + p, j + q


def unit_links(unit: np.ndarray, turned: np.ndarray, n: np.ndarray, own: np.ndarray, inside: bool,
               threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of a work unit's vectors, as given and rotated, with ``n`` copies each: the links
    of each and the smallest vector of its component, by the pairs of ``own`` ones with
    the others and, if ``inside``, with each other."""
    own_at, other_at = np.flatnonzero(own), np.flatnonzero(~own)
    links, root = np.zeros(len(unit)), np.arange(len(unit))
    sides = [(other_at, own_at, False)] if len(other_at) else []
    sides += [(own_at, own_at, True)] if inside else []
    for left, right, same in sides:
        for p, q in linked(turned[left], turned[right], threshold, same):
            a, b = left[p], right[q]
            ok = _cosines(unit, a, unit, b) >= threshold
            a, b = a[ok], b[ok]
            links += np.bincount(a, n[b], len(unit)) + np.bincount(b, n[a], len(unit))
            a, b = root[a], root[b]
            apart = a != b
            if apart.any():
                root = min_labels(len(unit), a[apart], b[apart])[root]
    return links, root


def work_units(classes: DataFrame, dim: int, count: int, threshold: float) -> tuple[DataFrame, object]:
    """(tile, part, home, cid, n, v) rows, a work unit for each (tile, part), with tile
    and home numbers of sub-tiles; and the rotation as a broadcast."""
    spark = classes.sparkSession
    sample = classes.select("v").orderBy(F.xxhash64("ck"), "ck").limit(SAMPLE).toPandas()
    unit = units(np.array(sample["v"].tolist()))
    rotation = fit_rotation(unit)
    tiles = 1
    while tiles < min(MAX_TILES, count / TILE):
        tiles *= 2
    cuts = fit_splits((unit @ rotation)[:, :LEAD], tiles)
    fitted = spark.sparkContext.broadcast((rotation, cuts))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rotation, cuts = fitted.value
        for f in frames:
            if len(f):
                lead = (units(np.array(f["v"].tolist())) @ rotation)[:, :LEAD]
                yield pd.DataFrame({"cid": f["cid"], "n": f["n"], "v": f["v"], "tile": tile_of(lead, cuts), "lead": list(lead)})

    placed = materialize(classes.select("cid", "n", "v").mapInPandas(
        place, "cid long, n long, v array<double>, tile long, lead array<double>"), "vector-tiles")
    sides = range(min(LEAD, dim))
    boxes = placed.groupBy("tile").agg(*[f(F.get("lead", F.lit(d))).alias(f"{f.__name__}{d}") for f in (F.min, F.max) for d in sides],
                                         F.count(F.lit(1)).alias("held"))
    box = np.full((2, tiles, len(sides)), np.inf)
    box[1] = -np.inf
    cut = np.zeros(tiles, np.int64)  # sub-tiles of a tile
    for r in boxes.collect():
        cut[r["tile"]] = -(-r["held"] // TILE)
        box[0, r["tile"]] = [r[f"min{d}"] for d in sides]
        box[1, r["tile"]] = [r[f"max{d}"] for d in sides]
    first = np.concatenate(([0], np.cumsum(cut)))
    shared = spark.sparkContext.broadcast((box, cut, first))
    reach = 2 - 2 * threshold + SLACK

    def visits(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """(home, tiles, parts, cid, n, v): the units a vector is in."""
        (lo, hi), cut, first = shared.value
        parts_of: dict[int, np.ndarray] = {}

        def parts(tile: int, sub: int) -> np.ndarray:
            """The units of a sub-tile: its own and those that may have visitors."""
            if sub not in parts_of:
                gap = np.maximum(0, np.maximum(lo - hi[tile], lo[tile] - hi))
                near = np.flatnonzero(((gap ** 2).sum(1) <= reach + SLACK) & (np.arange(len(cut)) >= tile) & (cut > 0))
                spans = [np.arange(max(first[t], sub) // VISIT, (first[t + 1] - 1) // VISIT + 1) for t in near]
                parts_of[sub] = np.unique(np.concatenate([*spans, [sub // VISIT]]))
            return parts_of[sub]

        for f in frames:
            for at in range(0, len(f), 512):
                g = f.iloc[at:at + 512]
                lead = np.array(g["lead"].tolist())[:, None, :]
                gap = np.maximum(0, np.maximum(lo - lead, lead - hi))
                near = (gap ** 2).sum(2) <= reach
                tile, cid = g["tile"].to_numpy(), g["cid"].to_numpy()
                home = first[tile] + (mix(cid.astype(np.uint64)) % cut[tile].astype(np.uint64)).astype(np.int64)
                near &= (np.arange(len(cut))[None, :] <= tile[:, None]) & (cut > 0)
                for i in range(len(g)):
                    to = np.flatnonzero(near[i])
                    to = np.repeat(first[to + 1] - np.cumsum(cut[to]), cut[to]) + np.arange(cut[to].sum())
                    to = to[to < home[i]]  # sub-tiles of lower number
                    mine = parts(tile[i], home[i])
                    yield home[i], np.concatenate([to, np.full(len(mine), home[i])]), np.concatenate(
                        [np.full(len(to), home[i] // VISIT), mine]), cid[i], g["n"].iat[i], g["v"].iat[i]

    def frames_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        rows = 0

        def frame() -> pd.DataFrame:
            size = [len(h[1]) for h in held]
            home, cid, n = (np.repeat(np.array([h[k] for h in held], np.int64), size) for k in (0, 3, 4))
            v = np.empty(len(held), object)
            v[:] = [h[5] for h in held]
            return pd.DataFrame({"tile": np.concatenate([h[1] for h in held]), "part": np.concatenate([h[2] for h in held]),
                                 "home": home, "cid": cid, "n": n, "v": np.repeat(v, size)})

        for home, to, part, *rest in visits(frames):
            for k in range(0, len(to), EMIT):
                held.append((home, to[k:k + EMIT], part[k:k + EMIT], *rest))
                rows += len(held[-1][1])
                if rows >= EMIT:
                    yield frame()
                    held, rows = [], 0
        if held:
            yield frame()

    work = placed.mapInPandas(frames_of, "tile long, part long, home long, cid long, n long, v array<double>")
    return work, fitted


def link_classes(classes: DataFrame, dim: int, count: int, threshold: float) -> DataFrame:
    """(cid, links, root) rows: links of a class found in one unit (in vectors of
    other classes) and a class of the same component."""
    work, fitted = work_units(classes, dim, count, threshold)

    def compare(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["home", "cid"], kind="stable").reset_index(drop=True)
        own = (f["home"] == key[0]).to_numpy()
        if not own.any():
            return pd.DataFrame({"cid": [], "links": [], "root": []}).astype("int64")
        unit = units(np.array(f["v"].tolist()))
        turned = unit @ fitted.value[0]
        links, root = unit_links(unit, turned, f["n"].to_numpy(), own, key[1] == key[0] // VISIT, threshold)
        hit = links > 0
        cid = f["cid"].to_numpy()
        return pd.DataFrame({"cid": cid[hit], "links": links[hit].astype("int64"), "root": cid[root[hit]]})

    return work.groupBy("tile", "part").applyInPandas(compare, "cid long, links long, root long")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                           threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    prepare(vectors.sparkSession)
    rows, classes = classes_of(vectors, id_col, vec_col)
    found = None
    for dim, count in classes.groupBy(F.size("v")).count().collect():
        links = link_classes(classes.where(F.size("v") == dim), dim, count, threshold)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "cid long, links long, root long")
    found = materialize(found, "vector-links")
    group = connected_components(found, "cid", "root").withColumnRenamed("node", "cid")
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    c = classes.select("cid", "ck", "rep", "n").join(sums, "cid", "left").join(group, "cid", "left")
    c = materialize(c.withColumn("component", F.coalesce("component", "cid")), "vector-components")
    first = materialize(c.groupBy("component").agg(F.min("rep").alias("first")), "vector-firsts")  # so that a large component's join is split
    c = c.join(first, "component").select("ck", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "first")
    out = rows.join(c, "ck", "left")
    component = F.when(F.col("ck").isNull(), F.col("vec_id")).otherwise(F.col("first"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op7_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
