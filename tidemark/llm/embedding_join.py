"""Near copies among embeddings: a range join of chunks of vectors, in cells and caps.

For unit vectors, a cosine of at least c means a squared distance of at most 2 - 2c. All
vectors are rotated onto the main axes of a sample. A tree of planes cuts the space into
cells, where a cut pays; two vectors that link lie in one cell, or one of them reaches the
other's, which is numbered below its own. Vectors of a cell go to the nearest of its
centres, which are sampled vectors, and centres that lie close together to one chunk.

Each distinct vector is written once, in its chunk. Chunks whose cells meet are read in
pairs, so nothing is copied on disk, however many cells a vector reaches. In a pair of
chunks, a cap of vectors about a centre is compared only with those whose angle to the
centre exceeds the cap's by no more than that of a link: first by the main axes, then on
the whole vectors in double precision. Of two vectors, the one closer to its centre brings
the pair about, so a pair counts once.

Pairs never become rows: two chunks return the number of links of each vector and a few
edges that hang together what its links do. Copies of one vector are one vector with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemark.llm.common import stored
from tidemark.llm.ngram_join import components
from tidemark.session import setting

COSINE = 0.95
#: Axes in a block; vectors are first compared by those of the main one.
AXES = 16
#: Vectors of its own that a cell should have; one that twice as many reach is dealt into tiles.
CELL = 16_384
#: Bytes of vectors that ``CELL`` stands for at most, and vectors it is not lowered to for the sake of more tasks.
_BYTES, _FEWEST = 1 << 22, 2048
#: Distinct vectors, by hash, that rotation and cells are drawn from. They decide what is compared where, never a result.
SAMPLE = 32_768
#: Sampled vectors in a cell at least, and the share of them within reach of a plane above which a cut does not pay.
LEAST_SAMPLED = 32
MOST_WITHIN = 0.48
#: Covers the rounding of rotated coordinates, which are kept in single precision.
SLACK = 1e-6
#: Vectors to a centre, sampled ones to a centre, vectors in a cap, others compared with it at a time, pairs decided at a time.
_ABOUT, _SAMPLED, _CAP, _OTHERS, _PAIRS = 128, 4, 48, 2048, 1 << 16
#: Cells of an array of single precision that stay in a few MB.
_SOME = 1 << 22
#: Share of vectors near each other from which all of them are compared as a whole, not pair by pair.
_DENSE = 0.1
#: Partitions of chunks are paired; they are as many at least, if there are as many chunks, and hold about so many each.
_PARTS, _CHUNKS = 32, 8
#: Members of a component in a pair of chunks that hang on one of them.
_FAN = 32


class Block(NamedTuple):
    """Axes from ``start`` to ``stop``, the squared distance they may differ by, and the planes that cut them.

    A plane is (axis, cut, below, above), where below and above name planes or, as -1 - cell, cells.
    ``tiles`` has the number of parts that each cell is dealt into.
    """

    start: int
    stop: int
    budget: float
    planes: list[tuple[int, float, int, int]]
    tiles: np.ndarray


class Space(NamedTuple):
    """Rotation (columns are axes) and blocks for vectors of one length."""

    axes: np.ndarray
    blocks: list[Block]


class Caps(NamedTuple):
    """Where vectors of one length lie: cells of the one block of ``space``, numbered from ``first``, and their centres.

    Cell c has the ``centres`` (rotated) from ``bounds[c]`` to ``bounds[c + 1]``; each has ``parts`` tiles of the cell from ``tile`` on.
    """

    space: Space
    first: int
    centres: np.ndarray
    bounds: np.ndarray
    tile: np.ndarray
    parts: np.ndarray


# --- geometry -------------------------------------------------------------------------


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that squares stay finite."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def reach(budget: float) -> float:
    return math.sqrt(budget + 2 * SLACK) + 1e-5


def within_reach(block: Block, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, own) of each cell that a point lies in (own) or is within reach of."""
    limit = reach(block.budget) ** 2
    rows: list[np.ndarray] = []
    cells: list[np.ndarray] = []
    own: list[np.ndarray] = []
    root = 0 if block.planes else -1
    every = np.arange(len(points))
    todo = [(root, every, np.zeros(points.shape, dtype=np.float64), np.ones(len(points), dtype=bool))]
    while todo:
        place, at, offsets, inside = todo.pop()
        if not len(at):
            continue
        if place < 0:
            rows.append(at)
            cells.append(np.full(len(at), -1 - place))
            own.append(inside)
            continue
        axis, cut, below, above = block.planes[place]
        gap = points[at, axis].astype(np.float64) - cut
        for child, beyond in ((below, gap >= 0), (above, gap < 0)):
            # Points on the other side of the plane come along while the cell's corner is within reach.
            far = offsets.copy()
            far[beyond, axis] = gap[beyond]
            near = ~beyond | (np.einsum("ij,ij->i", far, far) <= limit)
            todo.append((child, at[near], far[near], (inside & ~beyond)[near]))
    return tuple(map(np.concatenate, (rows, cells, own))) if rows else (every, every, every.astype(bool))


def located(block: Block, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, own) of each cell that a point lies in (own) or is within reach of, the latter only below its own."""
    row, cell, mine = within_reach(block, points)
    home = np.zeros(len(points), dtype=np.int64)
    home[row[mine]] = cell[mine]
    kept = mine | (cell < home[row])
    return row[kept], cell[kept], mine[kept]


def _planes(sample: np.ndarray, radius: float, depth: int) -> list[tuple[int, float, int, int]]:
    """Planes through the median of the widest axis, level by level, where a cut pays."""
    planes: list[list] = []
    cells = 0

    def grow(points: np.ndarray, left: int) -> int:
        nonlocal cells
        if left > 0 and len(points) >= 2 * LEAST_SAMPLED:
            for axis in np.argsort(-points.var(axis=0), kind="stable")[:4]:
                cut = float(np.median(points[:, axis]))
                side = points[:, axis] < cut
                within = np.mean(np.abs(points[:, axis] - cut) <= radius) / 2
                if within <= MOST_WITHIN and min(side.sum(), len(side) - side.sum()) >= LEAST_SAMPLED:
                    place = len(planes)
                    planes.append([int(axis), cut, 0, 0])
                    planes[place][2] = grow(points[side], left - 1)
                    planes[place][3] = grow(points[~side], left - 1)
                    return place
        cells += 1
        return -cells

    grow(sample, depth)
    return [tuple(p) for p in planes]


def space_of(sample: np.ndarray, total: int, cosine: float, axes: int = AXES, cell: int = CELL) -> Space:
    """Rotation, shares and cells for ``total`` vectors, from unit vectors of a sample."""
    centred = sample - sample.mean(axis=0)
    variances, turned = np.linalg.eigh(centred.T @ centred / max(len(sample), 1))
    turned = np.ascontiguousarray(turned[:, ::-1])
    variances = np.maximum(variances[::-1], 0.0)
    bounds = [(at, min(at + axes, len(variances))) for at in range(0, len(variances), axes)]
    shares = np.array([variances[a:b].sum() for a, b in bounds])
    # A block with next to no variance would let all pairs through. Without a share it need not be joined.
    shares[shares < 1e-3 * shares.max()] = 0.0
    if not shares.any():
        shares[0] = 1.0
    budgets = (2.0 - 2.0 * cosine + 1e-9) * shares / shares.sum()
    rotated = (sample @ turned).astype(np.float32)
    depth = max(math.ceil(math.log2(max(total, 1) / cell)), 0)
    blocks = []
    for (start, stop), budget in zip(bounds, budgets, strict=True):
        if budget > 0:
            points = rotated[:, start:stop]
            block = Block(start, stop, float(budget), _planes(points, reach(budget), depth), np.ones(0, dtype=np.int64))
            _, cells, _ = located(block, points)
            expected = np.bincount(cells, minlength=len(block.planes) + 1) * (total / max(len(sample), 1))
            blocks.append(block._replace(tiles=np.maximum(np.ceil(expected / (2 * cell)), 1).astype(np.int64)))
    return Space(turned, blocks)


def turned(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return (units @ axes).astype(np.float32)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(_SOME // len(centres), 1)
    return np.concatenate([np.argmax(points[at : at + step] @ centres.T, axis=1) for at in range(0, len(points), step)])


def homes(block: Block, points: np.ndarray) -> np.ndarray:
    """The cell that each point lies in."""
    row, cell, own = located(block, points)
    home = np.zeros(len(points), dtype=np.int64)
    home[row[own]] = cell[own]
    return home


def caps_of(sample: np.ndarray, total: int, cosine: float, cell: int, first: int) -> Caps:
    """Cells, centres and tiles for ``total`` vectors, from unit vectors of a sample."""
    space = space_of(sample, total, cosine, max(sample.shape[1], 1), cell)
    block = space.blocks[0]
    points = turned(sample, space.axes)
    home = homes(block, points)
    each = total / max(len(sample), 1)
    centres, bounds, tile, parts = [], [0], [], []
    for number in range(len(block.planes) + 1):
        mine = points[home == number]
        taken = max(min(len(mine) // _SAMPLED, int(len(mine) * each / _ABOUT), _SOME // points.shape[1]), 1)
        picked = mine[np.linspace(0, len(mine), taken, endpoint=False).astype(int)] if len(mine) else np.eye(1, points.shape[1], dtype=np.float32)
        # Centres that lie close together come one after another.
        coarse = picked[:: max(math.isqrt(len(picked)), 1)]
        picked = picked[np.argsort(nearest(picked, coarse), kind="stable")]
        expected = np.bincount(nearest(mine, picked), minlength=len(picked)) * each if len(mine) else np.ones(1)
        room = expected.sum() / block.tiles[number]
        at, load = 0, 0.0
        for share in expected:
            if load and load + share > room * 1.01:
                at, load = at + 1, 0.0
            tile.append(at)
            parts.append(max(math.ceil(share / (room * 1.01)), 1))
            at, load = at + parts[-1] - 1, load + share
        centres.append(picked)
        bounds.append(bounds[-1] + len(picked))
    return Caps(space, first, np.concatenate(centres), np.array(bounds), np.array(tile), np.array(parts))


# --- a pair of chunks -----------------------------------------------------------------


def _hang_together(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of the pairs; a root is its component's first row."""
    while True:
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(roots, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := roots[roots]).tobytes() != roots.tobytes():
            roots[:] = up


@dataclass
class Chunk:
    """Vectors by centre, the closest to theirs first; caps are rows from ``begin`` to ``end`` about the same ``centre``."""

    node: np.ndarray
    weight: np.ndarray
    close: np.ndarray
    vectors: np.ndarray
    rotated: np.ndarray
    #: The product of a row of one and a row of the other is minus the squared distance of their points on the main axes.
    one: np.ndarray
    other: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    centre: np.ndarray

    @cached_property
    def units(self) -> np.ndarray:
        return unit(self.vectors.astype(np.float64))


def by_centre(caps: Caps, points: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, close): the order of rows in a chunk, and the cosine of each to its centre, in that order."""
    close = np.einsum("ij,ij->i", points, caps.centres[centre])
    order = np.lexsort((-close, centre))
    return order, close[order]


def chunk_of(caps: Caps, axes: int, node: np.ndarray, weight: np.ndarray, centre: np.ndarray, close: np.ndarray, vectors: np.ndarray) -> Chunk:
    """A chunk of rows in the order of ``by_centre``."""
    # In single precision, which is what candidates are found by.
    rotated = unit(vectors).astype(np.float32) @ caps.space.axes.astype(np.float32)
    points = rotated[:, :axes]
    squares = np.einsum("ij,ij->i", points, points)[:, None]
    ones = np.ones_like(squares)
    starts = np.flatnonzero(np.r_[True, centre[1:] != centre[:-1]])
    stops = np.r_[starts[1:], len(centre)]
    pieces = -(-(stops - starts) // _CAP)
    begin = np.repeat(starts, pieces) + _CAP * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    end = np.minimum(begin + _CAP, np.repeat(stops, pieces))
    one, other = np.hstack([points, squares, ones]), np.hstack([2 * points, -ones, -squares])
    return Chunk(node, weight, close, vectors, rotated, one, other, begin, end, centre[begin])


def compared(caps: Caps, one: Chunk, other: Chunk | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, roots) of the rows of a chunk, or of two, one after the other: links weighted by the copies of the other row.

    Rows of one chunk are compared with each other, those of two with the other chunk's.
    """
    size = len(one.node) + (len(other.node) if other else 0)
    links = np.zeros(size, dtype=np.int64)
    roots = np.arange(size)
    limit = 2.0 - 2.0 * cosine
    angle = math.acos(max(min(cosine - SLACK, 1.0), -1.0))
    # Covers what single precision does to products of so many parts.
    slack = SLACK + 2e-6 * one.rotated.shape[1]
    far = np.float32(-limit - slack)

    def meet(left: Chunk, right: Chunk, start: int, stop: int) -> None:
        """The caps of one chunk and the rows of the other that are no closer to their centres; results from ``start`` and ``stop`` on."""
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def count(a: np.ndarray, b: np.ndarray) -> None:
            np.add.at(links, start + a, right.weight[b])
            np.add.at(links, stop + b, left.weight[a])
            _hang_together(roots, start + a, stop + b)

        def first(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Whether it is the left row that brings the pair about."""
            same = left.close[a] == right.close[b]
            return (left.close[a] > right.close[b]) | (same & (left.node[a] < right.node[b]))

        def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            sure = np.einsum("ij,ij->i", left.rotated[a], right.rotated[b]) >= cosine - slack
            likely = np.flatnonzero(sure)
            if len(likely):
                sure[likely] = np.einsum("ij,ij->i", left.units[a[likely]], right.units[b[likely]]) >= cosine
            return sure

        def decide() -> None:
            nonlocal waiting, held
            if waiting:
                a, b = (np.concatenate(side) for side in zip(*waiting, strict=True))
                waiting, held = [], 0
                for at in range(0, len(a), _PAIRS):
                    x, y = a[at : at + _PAIRS], b[at : at + _PAIRS]
                    kept = first(x, y)
                    x, y = x[kept], y[kept]
                    sure = linked(x, y)
                    count(x[sure], y[sure])

        def whole(rows: np.ndarray, columns: np.ndarray) -> None:
            near = left.units[rows] @ right.units[columns].T
            found = np.flatnonzero(near >= cosine - 1e-9)
            a, b = rows[found // len(columns)], columns[found % len(columns)]
            # A product is not summed in the order of a single pair, which decides.
            kept = first(a, b)
            close = np.flatnonzero(kept & (near.ravel()[found] <= cosine + 1e-9))
            kept[close] = linked(a[close], b[close])
            count(a[kept], b[kept])

        # How close to a centre the other rows are at least that a cap about it needs; from its first cap to its last it falls.
        widest = np.arccos(np.clip(left.close[left.end - 1].astype(np.float64) - slack, -1.0, 1.0)) + angle
        least = np.where(widest < math.pi, np.cos(widest) - slack, -2.0).astype(np.float32)
        about, begins, many = np.unique(left.centre, return_index=True, return_counts=True)
        step = max(_SOME // max(len(right.node), 1), 1)
        begin, end = left.begin.tolist(), left.end.tolist()
        for place, (begun, ended) in enumerate(zip(begins.tolist(), (begins + many).tolist(), strict=True)):
            if place % step == 0:
                cosines = caps.centres[about[place : place + step]] @ right.rotated.T
            towards = cosines[place % step]
            reached = np.flatnonzero(towards >= least[ended - 1])
            towards, closest = towards.take(reached), right.close.take(reached)
            for cap in range(begun, ended):
                first_row, width = begin[cap], end[cap] - begin[cap]
                rows = left.one[first_row : first_row + width].T
                meets = reached.take(np.flatnonzero((towards >= least[cap]) & (closest <= left.close[first_row])))
                for at in range(0, len(meets), _OTHERS):
                    others = meets[at : at + _OTHERS]
                    near = right.other.take(others, axis=0) @ rows
                    found = np.flatnonzero(near >= far)
                    if len(found) > _DENSE * near.size:
                        whole(np.arange(first_row, first_row + width), others)
                    elif len(found):
                        which, row = np.divmod(found, width)
                        waiting.append((first_row + row, others.take(which)))
                        held += len(found)
                        if held >= _PAIRS:
                            decide()
        decide()

    if other is None:
        meet(one, one, 0, 0)
    else:
        meet(one, other, 0, len(one.node))
        meet(other, one, len(one.node), 0)
    return links, roots


def _edges(nodes: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A few edges that hang together the nodes with equal roots, none with very many of them."""
    order = np.lexsort((nodes, roots))
    grouped, members = roots[order], nodes[order]
    starts = np.flatnonzero(np.r_[True, grouped[1:] != grouped[:-1]])
    first = np.repeat(starts, np.diff(np.r_[starts, len(grouped)]))
    place = np.arange(len(grouped)) - first
    child = place > 0
    return members[child], members[(first + (place - 1) // _FAN)[child]]


# --- the join -------------------------------------------------------------------------


def usable(embedding: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, and not all of them zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def _caps(reps: DataFrame, cosine: float, cell: int, sample: int, width: int) -> dict[int, Caps]:
    """The cells of each length of vectors (one number each), from the sampled vectors of that length."""
    caps: dict[int, Caps] = {}
    cells = 0
    for row in reps.groupBy("size").count().orderBy("size").collect():
        size, total = row["size"], row["count"]
        # Hashes are even: about twice the sample lies below this one, and no other vectors need to be shuffled to be ordered.
        below = -(1 << 63) + (1 << 64) * 2 * sample // max(total, 2 * sample)
        drawn = reps.where((F.col("size") == size) & (F.col("h1") <= min(below, (1 << 63) - 1)))
        drawn = drawn.orderBy("h1", "h2").select("embedding").limit(sample).toArrow()
        vectors = unit(_matrix(drawn.column("embedding")).astype(np.float64))
        own = max(min(cell, _BYTES // (width * size), max(total // 16, _FEWEST)), 1)
        caps[size] = caps_of(vectors, total, cosine, own, cells)
        cells += len(caps[size].bounds) - 1
    return caps


def _chunks(reps: DataFrame, caps: dict[int, Caps], kind: str) -> DataFrame:
    """A row for each chunk: its cell, its tile of the cell, the cells that its vectors lie in or reach, and its vectors as bytes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Vectors of one length at a time.
            sizes = np.diff(batch.column("embedding").offsets.to_numpy())
            for size in np.unique(sizes):
                mine = batch.filter(pa.array(sizes == size))
                of = caps[int(size)]
                points = turned(unit(_matrix(mine.column("embedding")).astype(np.float64)), of.space.axes)
                home = homes(of.space.blocks[0], points)
                centre = np.zeros(len(points), dtype=np.int64)
                for cell in np.unique(home):
                    low, high = of.bounds[cell], of.bounds[cell + 1]
                    centre[home == cell] = low + nearest(points[home == cell], of.centres[low:high])
                hashed = (mine.column("node").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                tile = of.tile[centre] + hashed % of.parts[centre]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(points), size, dtype=np.int32)),
                        pa.array((of.first + home).astype(np.int32)),
                        pa.array(tile.astype(np.int32)),
                        pa.array(centre.astype(np.int32)),
                        *mine.columns,
                    ],
                    names=["size", "cell", "tile", "centre", *mine.schema.names],
                )

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        size, cell, tile = (k.as_py() for k in key)
        of = caps[size]
        vectors = _matrix(table.column("embedding")).astype(kind)
        points = turned(unit(vectors.astype(np.float64)), of.space.axes)
        # Of all cells, as a point on a plane might count for the other side here; the pairs are picked later.
        reached = [np.array([cell - of.first])]
        reached += [np.unique(within_reach(of.space.blocks[0], points[at : at + 4096])[1]) for at in range(0, len(points), 4096)]
        centre = table.column("centre").to_numpy()
        order, close = by_centre(of, points, centre)
        node, copies = (table.column(n).to_numpy()[order] for n in ("node", "copies"))
        return pa.table(
            {
                "size": pa.array([size], pa.int32()),
                "cell": pa.array([cell], pa.int32()),
                "tile": pa.array([tile], pa.int32()),
                "reached": pa.array([of.first + np.unique(np.concatenate(reached))], pa.list_(pa.int32())),
                "nodes": pa.array([node.astype("<i8").tobytes()], pa.binary()),
                "copies": pa.array([copies.astype("<i8").tobytes()], pa.binary()),
                "centres": pa.array([centre[order].astype("<i4").tobytes()], pa.binary()),
                "close": pa.array([close.astype("<f4").tobytes()], pa.binary()),
                "vectors": pa.array([vectors[order].tobytes()], pa.binary()),
            }
        )

    schema = "size int, cell int, tile int, centre int, node long, copies long, embedding " + reps.schema["embedding"].dataType.simpleString()
    dealt = reps.select("node", "copies", "embedding").mapInArrow(deal, schema)
    packed = "size int, cell int, tile int, reached array<int>, nodes binary, copies binary, centres binary, close binary, vectors binary"
    return stored(dealt.groupBy("size", "cell", "tile").applyInArrow(pack, packed), "chunks")


def _met(chunks: DataFrame, caps: dict[int, Caps], kind: str, axes: int, cosine: float) -> DataFrame:
    """(node, links, next) of all pairs of chunks that meet: numbers of links, and edges, which have no links."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None)
        for batch in batches:
            for at in range(batch.num_rows):
                size = batch.column("size")[at].as_py()

                def read(prefix: str, batch: pa.RecordBatch = batch, at: int = at, size: int = size) -> Chunk:
                    kinds = {"nodes": "<i8", "copies": "<i8", "centres": "<i4", "close": "<f4", "vectors": kind}
                    parts = [np.frombuffer(batch.column(prefix + n)[at].as_buffer(), dtype=k) for n, k in kinds.items()]
                    return chunk_of(caps[size], axes, *parts[:-1], parts[-1].reshape(-1, size))

                one, other = (tuple(batch.column(p + n)[at].as_py() for n in ("cell", "tile")) for p in ("", "other_"))
                if held[0] != one:
                    held = one, read("")
                left, right = held[1], None if one == other else read("other_")
                links, roots = compared(caps[size], left, right, cosine)
                nodes = left.node if right is None else np.concatenate([left.node, right.node])
                found = np.flatnonzero(links)
                a, b = _edges(nodes[found], roots[found])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([nodes[found], a]), pa.int64()),
                        pa.array(np.concatenate([links[found], 0 * a]), pa.int64()),
                        pa.array(np.concatenate([np.full(len(found), -1), b]), pa.int64()),
                    ],
                    names=["node", "links", "next"],
                )

    most = sum(int(np.maximum.reduceat(c.tile + c.parts, c.bounds[:-1]).sum()) for c in caps.values())
    left = chunks.coalesce(max(_PARTS, most // _CHUNKS))
    right = left.select(*(F.col(c).alias(f"other_{c}") for c in left.columns if c != "size"))
    within = (F.col("cell") == F.col("other_cell")) & (F.col("tile") <= F.col("other_tile"))
    across = (F.col("cell") < F.col("other_cell")) & F.array_contains("other_reached", F.col("cell"))
    pairs = left.crossJoin(right).where(within | across).drop("reached", "other_reached")
    # Two chunks are some MB: they go to Python pair by pair.
    with setting(chunks.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"):
        return stored(pairs.mapInArrow(meet, "node long, links long, next long"), "links")


def _classes(reps: DataFrame, met: DataFrame) -> DataFrame:
    """(h1, h2, n_links, component_id) of each distinct vector."""
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.where("next >= 0").select(F.col("node").alias("a"), F.col("next").alias("b")))
    placed = (
        reps.select("h1", "h2", "copies", "lowest", "node")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .select("h1", "h2", "lowest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    )
    smallest = placed.groupBy("root").agg(F.min("lowest").alias("component_id"))
    return stored(placed.join(smallest, "root").select("h1", "h2", "n_links", "component_id"), "classes")


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, axes: int = AXES, cell: int = CELL, sample: int = SAMPLE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``vectors`` (vec_id, embedding).

    Two rows link when the cosine of their vectors, in double precision, is at least
    ``cosine``; ``component_id`` is the smallest vec_id that links reach, the row's own
    included; ``kept`` marks the row with that id. Vectors that are null, empty or zero, or
    hold nulls, NaN or infinities, link with nothing, and so do vectors of different
    lengths. Copies of a vector link with each other, so rows that repeat an id are other
    vectors. A null vec_id is never the smallest; a component of null ids has a null id and keeps all.
    Other columns are ignored. Copies are told apart by 128 bits.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine has to be above 0, and at most 1")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    good = usable(F.col("embedding"))
    hashed = rows.select(
        "vec_id",
        F.when(good, F.xxhash64("embedding")).alias("h1"),
        F.when(good, F.xxhash64(F.lit(1), "embedding")).alias("h2"),
        F.when(good, F.col("embedding")).alias("embedding"),
    )
    groups = hashed.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("lowest")
    )
    spark = vectors.sparkSession
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    kind, width = ("<f4", 4) if single else ("<f8", 8)
    # What a step shuffled goes when the step is stored.
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        # Numbered as they are written, so the numbers stay.
        reps = stored(groups.withColumns({"size": F.size("embedding"), "node": F.monotonically_increasing_id()}), "vectors")
        caps = _caps(reps, cosine, cell, sample, width)
        met = _met(_chunks(reps, caps, kind), caps, kind, axes, cosine)
        result = _classes(reps, met)
    linked = hashed.drop("embedding").join(result, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return linked.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
