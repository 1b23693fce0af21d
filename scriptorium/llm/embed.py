"""Embedding near-dedup by a subspace pigeonhole join.

Two unit vectors with cosine >= c are at most sqrt(2 - 2c) apart.  After a rotation,
split into low-dimensional blocks, the squared distance is the sum of the blocks'
squared distances, so that at least one block is within its proportional share,
(2 - 2c) * size / dim.  Each block is range-joined under that budget:

* Cells are chosen by occupancy.  A label of at most ``cell_rows`` vectors is one cell for
  all blocks.  A larger one is cut, block by block, at quantiles of each axis (from the
  label's means and deviations over all its vectors) until a cell holds about that many;
  a vector lies in its own cell and is also sent to the neighbouring cells of a lower
  number that the block's radius touches, so that each pair meets once in a block.
* Within a cell every axis has a table of bit sets: which of the cell's vectors may be within
  the radius of a coordinate in this bin.  And-ing a vector's eight sets leaves about
  three in ten thousand of unrelated vectors; only those have their block distance
  computed, and those within the budget are verified exactly, by cosine in double
  precision of the given vectors.

A pair within budget in several blocks counts in the first of them.  A cell gives one
row for each of its linked vectors (links, least partner), never a row for each pair, so a
dense group of g vectors costs g rows.  A cell of more than ``most`` vectors (near copies
that no cut parts) is dealt in chunks, each of which meets the whole cell.

Equal vectors under one label are one class; its size counts as links of its members.

Defined results
---------------
* null labels, and vectors that are null, empty, zero or hold null or non-finite
  components: linked with nothing; they are their own component and are kept.
* vectors of different lengths are never linked.
* repeated rows are equal vectors, linked by cosine 1; rows with equal ids keep a row
  each, with the links of their own vector.
* a row without an id is linked like any other; a component's id is the least one that any
  of its rows has, null if none has one.
* an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .graph import components

#: Slack on squared distances for the rounding of the rotation.
EPS = 1e-9
#: Bins of an axis's table of bit sets, and pairs that one step of a probe may find.
BINS, STEP = 32, 1 << 22
#: Cuts of one axis at most: beyond that, sending vectors to neighbours costs more than it saves.
MOST_CUTS = 3


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, so that no block holds more of the spread than others."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int, size: int) -> list[tuple[int, int]]:
    return [(a, min(a + size, dim)) for a in range(0, dim, size)]


def turned(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The rows, normed and rotated.  Element by element, column after column: a row's
    result is the same to the last bit in whatever batch it stands."""
    x = x / np.abs(x).max(axis=1)[:, None]
    square = np.zeros(len(x))
    for j in range(x.shape[1]):
        square += x[:, j] * x[:, j]
    x = x / np.sqrt(square)[:, None]
    out = np.zeros_like(x)
    for j in range(x.shape[1]):
        out += x[:, j, None] * q[j]
    return out


def cuts_by_axis(n: int, axes: int, cell_rows: int) -> list[int]:
    """Cuts of each axis of a block, as even as possible, for cells of about ``cell_rows``."""
    cuts, cells = [0] * axes, 1
    for k in itertools.count():
        if cells * cell_rows >= n or k == axes * MOST_CUTS:
            return cuts
        cells = cells // (cuts[k % axes] + 1) * (cuts[k % axes] + 2)
        cuts[k % axes] += 1


class Near:
    """The parameters that tasks share."""

    def __init__(self, threshold: float, block: int, cell_rows: int, most: int, seed: int):
        self.threshold, self.block, self.cell_rows, self.most, self.seed = threshold, block, cell_rows, most, seed
        self.turns: dict[int, np.ndarray] = {}

    def turn(self, x: np.ndarray) -> np.ndarray:
        dim = x.shape[1]
        if dim not in self.turns:
            self.turns[dim] = rotation(dim, self.seed)
        return turned(x, self.turns[dim])

    def share(self, a: int, b: int, dim: int) -> float:
        return (2 - 2 * self.threshold) * (b - a) / dim + EPS

    # ------------------------------------------------------------ cells

    def cells(self, y: np.ndarray, n: int, mean: np.ndarray, spread: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(block, rows, cells, whether the cell is the row's own) for rows of one label."""
        dim, all_rows = y.shape[1], np.arange(len(y))
        for part, (a, b) in enumerate(blocks_of(dim, self.block)):
            radius = self.share(a, b, dim) ** 0.5
            own, tries, name = np.zeros(len(y), np.int64), all_rows, np.zeros(len(y), np.int64)
            for axis, cuts in zip(range(a, b), cuts_by_axis(n, b - a, self.cell_rows)):
                if not cuts:
                    continue
                at = mean[axis] + spread[axis] * np.array([NormalDist().inv_cdf((k + 1) / (cuts + 1)) for k in range(cuts)])
                own = own * (MOST_CUTS + 1) + np.searchsorted(at, y[:, axis])
                lo = np.searchsorted(at, y[tries, axis] - radius)
                hi = np.searchsorted(at, y[tries, axis] + radius)
                reach = hi - lo + 1
                base = np.repeat(lo - np.concatenate([[0], np.cumsum(reach)[:-1]]), reach)
                name = np.repeat(name, reach) * (MOST_CUTS + 1) + base + np.arange(reach.sum())
                tries = np.repeat(tries, reach)
            keep = name <= own[tries]
            tries, name = tries[keep], name[keep]
            yield part, tries, name, name == own[tries]

    # ------------------------------------------------------------ pairs

    def candidates(self, home: np.ndarray, probe: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of (home, probe) rows that are near on every axis of the block, by bit sets."""
        words = -(-len(home) // 64) * 8
        left = None
        for axis in range(home.shape[1]):
            h = home[:, axis]
            low, high = h.min(), h.max()
            width = (high - low) / BINS or 1.0
            edge = low + width * np.arange(BINS)[:, None]
            table = np.zeros((BINS, words), np.uint8)
            # The bins' ends are widened a little for the rounding of a probe's place.
            bits = np.packbits((h >= edge - radius - 1e-6 * width) & (h <= edge + width * (1 + 1e-6) + radius), axis=1)
            table[:, : bits.shape[1]] = bits
            at = np.clip(np.floor((probe[:, axis] - low) / width), 0, BINS - 1).astype(np.int64)
            found = table.view(np.uint64)[at]
            left = found if left is None else left & found
        rows, cols = np.nonzero(left)
        bits = np.unpackbits(left[rows, cols].view(np.uint8).reshape(-1, 8), axis=1)
        k, bit = np.nonzero(bits)
        return cols[k] * 64 + bit, rows[k]

    def links(self, home: tuple, probe: tuple, part: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked (home, probe) rows; ``same``: both are the same rows, each pair once."""
        (hx, hy), (px, py) = home, probe
        dim = hy.shape[1]
        blocks = blocks_of(dim, self.block)
        probes = max(1, STEP // len(hx))
        for at in range(0, len(px), probes):
            here = slice(at, at + probes)
            for p in range(len(blocks)) if part < 0 else (part,):
                a, b = blocks[p]
                share = self.share(a, b, dim)
                i, j = self.candidates(hy[:, a:b], py[here, a:b], (share + EPS) ** 0.5)
                j = j + at
                if same:
                    i, j = i[i < j], j[i < j]
                for k in range(0, len(i), 1 << 15):
                    u, v = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
                    ok = self._first(hy[u], py[v], blocks, p)
                    u, v = u[ok], v[ok]
                    x, z = hx[u], px[v]
                    dot = lambda m, n: np.einsum("ij,ij->i", m, n)
                    ok = dot(x, z) / (np.sqrt(dot(x, x)) * np.sqrt(dot(z, z))) >= self.threshold
                    if ok.any():
                        yield u[ok], v[ok]

    def _first(self, y: np.ndarray, z: np.ndarray, blocks: list[tuple[int, int]], p: int) -> np.ndarray:
        """Is block ``p`` the pair's first one within its budget?"""
        ok = np.ones(len(y), bool)
        for q in (p, *range(p)):
            a, b = blocks[q]
            square = np.zeros(len(y))
            for axis in range(a, b):
                gap = y[:, axis] - z[:, axis]
                square += gap * gap
            near = square <= self.share(a, b, y.shape[1])
            ok &= near if q == p else ~near
        return ok


def _roots(u: np.ndarray, v: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Least row of each row's component, for links (u, v) added to ``root``."""
    while True:
        low = np.minimum(root[u], root[v])
        after = root.copy()
        np.minimum.at(after, root[u], low)
        np.minimum.at(after, root[v], low)
        while True:
            jumped = after[after]
            if (jumped == after).all():
                break
            after = jumped
        if (after == root).all():
            return root
        root = after


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def _moments(near: Near):
    """(label, dim, n, sums and squares of the rotated axes), one row a batch and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table({"label": batch.column(0), "dim": batch.column(1)}).append_column("i", pa.array(range(batch.num_rows)))
            for group in table.group_by(["label", "dim"]).aggregate([("i", "list")]).to_pylist():
                y = near.turn(_matrix(batch.column(2).take(pa.array(group["i_list"]))))
                sums = np.concatenate([y.sum(axis=0), (y * y).sum(axis=0)])
                yield pa.record_batch(
                    [pa.array([group["label"]], batch.schema.field(0).type), pa.array([group["dim"]], pa.int32()), pa.array([len(y)], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.float64()))],
                    names=["label", "dim", "n", "sums"],
                )

    return run


def _place(near: Near, count: bool):
    """Rows of a large label (label, dim, n, sums, node, copies, vector) in their cells; or,
    for ``count``, (label, dim, part, cell, n) of the rows' own cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table({"label": batch.column("label"), "dim": batch.column("dim")}).append_column("i", pa.array(range(batch.num_rows)))
            for group in table.group_by(["label", "dim"]).aggregate([("i", "list")]).to_pylist():
                rows = np.array(group["i_list"])
                first = int(rows[0])
                n, dim = batch.column("n")[first].as_py(), group["dim"]
                sums = np.array(batch.column("sums")[first].as_py())
                mean = sums[:dim] / n
                spread = np.sqrt(np.maximum(sums[dim:] / n - mean * mean, 0))
                y = near.turn(_matrix(batch.column("vector").take(pa.array(rows))))
                for part, at, cell, own in near.cells(y, n, mean, spread):
                    if count:
                        cell, size = np.unique(cell[own], return_counts=True)
                        m = len(cell)
                        columns = {"label": pa.array([group["label"]] * m, batch.schema.field("label").type), "dim": np.full(m, dim, np.int32), "part": np.full(m, part, np.int32), "cell": cell, "n": size}
                        yield pa.record_batch({k: pa.array(v) for k, v in columns.items()})
                        continue
                    index = pa.array(rows[at])
                    columns = {"label": batch.column("label").take(index), "dim": batch.column("dim").take(index), "part": np.full(len(at), part, np.int32), "cell": cell, "own": own}
                    columns |= {k: batch.column(k).take(index) for k in ("node", "copies", "vector")}
                    yield pa.record_batch({k: pa.array(v) if isinstance(v, np.ndarray) else v for k, v in columns.items()})

    return run


def _join(near: Near):
    """Rows sorted by (label, dim, part, cell, chunk, home first): one row (u, v, n) for
    each linked vector of a chunk's meeting with its cell; v is the least partner's row."""

    def meet(home: list, probe: list | None, part: int) -> Iterator[pa.RecordBatch]:
        """Homes with each other, or with a batch of probes."""
        nodes, copies, x, y = home
        n = len(copies)
        if probe is not None:
            nodes = pa.concat_arrays([nodes, probe[0]])
            copies = np.concatenate([copies, probe[1]])
            pairs = near.links((x, y), (probe[2], probe[3]), part, False)
        else:
            pairs = near.links((x, y), (x, y), part, True)
        root, total, met = np.arange(len(copies)), np.zeros(len(copies), np.int64), np.zeros(len(copies), bool)
        for u, v in pairs:
            v = v if probe is None else v + n
            np.add.at(total, u, copies[v])
            np.add.at(total, v, copies[u])
            met[u] = met[v] = True
            root = _roots(u, v, root)
        at = np.flatnonzero(met)
        if len(at):
            yield pa.record_batch([nodes.take(pa.array(at)), nodes.take(pa.array(root[at])), pa.array(total[at])], names=["u", "v", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, home = None, [], None

        def close() -> list | None:
            if not held:
                return None
            whole = [pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[k] for h in held]) for k in (1, 2, 3))]
            held.clear()
            return whole

        for batch in batches:
            names = ("label", "dim", "part", "cell", "chunk", "home")
            keys = list(zip(*[batch.column(c).to_pylist() for c in names]))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                *group, is_home = keys[a]
                if group != key:
                    if (last := close()) is not None:
                        yield from meet(last, None, key[2])
                    key, home = group, None
                x = _matrix(batch.column("vector").slice(a, b - a))
                rows = [batch.column("node").slice(a, b - a), np.array(batch.column("copies").slice(a, b - a)), x, near.turn(x)]
                if is_home:
                    held.append(rows)
                    continue
                if (last := close()) is not None:
                    yield from meet(last, None, key[2])
                    home = last
                if home is not None:
                    yield from meet(home, rows, key[2])
        if (last := close()) is not None:
            yield from meet(last, None, key[2])

    return run


class NearVectors:
    def __init__(self, rows: DataFrame, threshold: float = 0.98, block: int = 8, cell_rows: int = 8192, most: int = 32768, seed: int = 7, id_col: str = "vec_id", vector: str = "embedding", label: str = "label"):
        self.rows = rows.select(F.col(id_col).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
        self.near = Near(threshold, block, cell_rows, most, seed)
        self.scratch = Scratch(rows.sparkSession, "nearvectors")

    def _cells(self, reps: DataFrame) -> DataFrame:
        """Rows (label, dim, part, cell, chunk, home, node, copies, vector) of all cells."""
        near, kind = self.near, {f.name: f.dataType.simpleString() for f in reps.schema}
        counts = reps.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
        large = self.scratch.write(counts.where(F.col("n") > near.cell_rows).select("label", "dim"), "large")
        same = lambda a, b: (a["label"] == b["label"]) & (a["dim"] == b["dim"])
        rest = ["node", "copies", "vector"]
        whole = reps.join(large, ["label", "dim"], "left_anti")
        whole = whole.select("label", "dim", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("cell"), F.lit(0).alias("chunk"), F.lit(True).alias("home"), *rest)
        if large.isEmpty():
            return whole
        parts = reps.join(large, ["label", "dim"], "left_semi").select("label", "dim", "vector")
        parts = parts.mapInArrow(_moments(near), f"label {kind['label']}, dim int, n bigint, sums array<double>")
        axis = parts.select("label", "dim", "n", F.posexplode("sums").alias("axis", "s")).groupBy("label", "dim", "axis").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        facts = axis.groupBy("label", "dim").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("axis", "s"))), lambda x: x["s"]).alias("sums"))
        facts = self.scratch.write(facts, "facts").alias("f")
        told = reps.join(facts, same(reps, facts)).select(reps["label"], reps["dim"], "n", "sums", *rest)
        told = self.scratch.write(told, "told")
        sizes = told.mapInArrow(_place(near, True), f"label {kind['label']}, dim int, part int, cell bigint, n bigint")
        full = sizes.groupBy("label", "dim", "part", "cell").agg(F.sum("n").alias("n")).where(F.col("n") > near.most)
        full = full.select("label", "dim", "part", "cell", F.ceil(F.col("n") / near.most).cast("int").alias("chunks"))
        placed = told.mapInArrow(_place(near, False), f"label {kind['label']}, dim int, part int, cell bigint, own boolean, node {kind['node']}, copies bigint, vector {kind['vector']}")
        placed = placed.join(self.scratch.write(full, "full"), ["label", "dim", "part", "cell"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        # A vector is home in one chunk of its own cell and a probe in all that come before;
        # a visitor from another cell is a probe in all of the cell's chunks.
        mine = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
        chunk = F.explode(F.when(F.col("own"), F.sequence(F.lit(0), mine)).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1)))
        placed = placed.select("label", "dim", "part", "cell", chunk.alias("chunk"), "own", mine.alias("mine"), *rest)
        cut = placed.select("label", "dim", "part", "cell", "chunk", (F.col("own") & (F.col("chunk") == F.col("mine"))).alias("home"), *rest)
        return whole.unionByName(cut)

    def run(self) -> DataFrame:
        """vec_id, n_links, component_id, kept for every row."""
        put = self.scratch.write
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        usable = F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0)
        marked = self.rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
        plain = F.transform("vector", lambda x: F.when(x == 0, F.abs(x)).otherwise(x))  # no negative zeros
        good = marked.where("usable").withColumn("vector", plain)
        kind = {f.name: f.dataType.simpleString() for f in good.schema}
        classes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        # A class is known by 128 bits of its label and vector; the least id leads, so that the
        # least node of a component holds the component's id.
        node = F.struct(F.col("rep").isNull().alias("unnamed"), "rep", F.xxhash64("label", "vector").alias("hi"), F.xxhash64(F.lit(1), "label", "vector").alias("lo"))
        reps = put(classes.select("label", F.size("vector").alias("dim"), node.alias("node"), "copies", "vector"), "reps")
        cells = self._cells(reps)
        order = ["label", "dim", "part", "cell", "chunk"]
        dealt = cells.repartition(*order).sortWithinPartitions(*order, F.col("home").desc())
        found = {f.name: f.dataType.simpleString() for f in reps.schema}
        links = put(dealt.mapInArrow(_join(self.near), f"u {found['node']}, v {found['node']}, n bigint"), "links")
        degree = links.groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("others"))
        comp = components(links.select("u", "v"), self.scratch)
        facts = reps.join(degree, "node", "left").join(comp, "node", "left")
        facts = facts.select("label", "vector", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"), F.coalesce("component.rep", "node.rep").alias("component"))
        done = good.join(facts, ["label", "vector"], "left").select("vec_id", "n", "component")
        rest = marked.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n"), F.col("vec_id").alias("component"))
        out = done.unionByName(rest)
        return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.col("component").cast(kind["vec_id"]).alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))


def near_vectors(rows: DataFrame, threshold: float = 0.98) -> DataFrame:
    return NearVectors(rows, threshold).run()
