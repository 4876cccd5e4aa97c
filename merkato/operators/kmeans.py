"""K-Means whose result does not depend on how the rows are partitioned.

Sums over floating-point numbers change with the order of the rows, and with them centres and, now and then, labels. Here
coordinates are added up as whole numbers (36 bits for the largest), which is exact in any order. Starting centres come
from a reservoir: the ``SAMPLE`` different vectors with the smallest hashes, whatever partition they are in; k-means++
picks from it for every start.

Starts run side by side: one pass over the rows for each round moves the centres of every start that still
moves. The cheapest start then goes on until its centres are the exact means of their clusters. Where vectors are so wide
that the centres of all starts would fill a task, starts run in groups, one after the other, with the same result.

Vectors are ``array<double>``, or ``struct<at: array<int>, value: array<double>>`` where most positions are 0. They are
written once in blocks, whose numbers every round reads as they are instead of turning each row into Arrow
values again. Parquet's reader holds 4,096 rows at once and an Arrow batch 10,000, so a block is a few KB, not a task's fill;
the numbers of all blocks of a batch lie one after the other, and are used in steps of ``ROWS`` vectors. Tasks return one sum for
each centre and position.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato.session import store

#: Seed, number of starts, and the most rounds of a start.
SEED, STARTS, ROUNDS = 42, 10, 300
#: Vectors in the reservoir, bits of the largest coordinate, rows whose distances are held at once.
SAMPLE, BITS, ROWS = 1024, 36, 2048
#: Bytes of a block, about; numbers in the centres of the starts that run side by side, unless one start has more.
BYTES, HELD = 1 << 12, 1 << 22
#: Rows whose distances to all centres are added up at once, rows of a result that a task returns at once.
SLAB, RETURNED = 128, 1 << 16
#: Squared movement below which a start counts as settled while starts are compared.
SETTLED = 1e-8


@dataclass
class Model:
    """Centres by label: larger clusters first, then by centre. ``cost`` is the sum of squared distances."""

    centres: np.ndarray
    sizes: list[int]
    cost: float


#: A block of vectors: how many, their numbers one after the other, and, where they are sparse, positions and each row's count of these.
#: Width and largest number are those of the block and its neighbours.
_BLOCK = "rows int, width int, largest double, value binary, at binary, sizes binary"


def _cut(numbers: np.ndarray, borders: np.ndarray) -> pa.Array:
    """The bytes between each two borders, without copying them."""
    ends = pa.py_buffer((borders * numbers.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(borders) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(numbers))])


def _joined(column: pa.Array, kind) -> np.ndarray | None:
    """The numbers of all blocks of a column; None where they have none."""
    if column.null_count == len(column):
        return None
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1]
    first, last = int(ends[0]), int(ends[-1])
    return np.frombuffer(data, kind, (last - first) // np.dtype(kind).itemsize, first) if last > first else np.empty(0, kind)


def _blocks(batches):
    """The vectors of Arrow batches in blocks."""
    for batch in batches:
        sparse = pa.types.is_struct(batch.column(0).type)
        for first in range(0, batch.num_rows, ROWS):
            part = batch.column(0).slice(first, ROWS)
            value = part.field("value") if sparse else part
            sizes = value.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
            numbers = value.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            at = part.field("at").flatten().to_numpy(zero_copy_only=False).astype(np.int32) if sparse else None
            # Positions that nothing takes are not known; rows without any say nothing of the width.
            width = (int(at.max()) + 1 if len(at) else None) if sparse else int(sizes.max(initial=0))
            # NaN is larger than any number, as it is for Spark.
            largest = float(np.abs(numbers).max(initial=0.0))
            taken = numbers.nbytes + (at.nbytes + sizes.nbytes if sparse else 0)
            borders = np.append(np.arange(0, len(part), max(1, BYTES * len(part) // max(1, taken))), len(part))
            entries, count = np.append(0, np.cumsum(sizes, dtype=np.int64))[borders], len(borders) - 1
            none = pa.nulls(count, pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.diff(borders), pa.int32()), pa.array([width] * count, pa.int32()), pa.array([largest] * count, pa.float64()),
                _cut(numbers, entries), _cut(at, entries) if sparse else none, _cut(sizes, borders) if sparse else none],
                names=["rows", "width", "largest", "value", "at", "sizes"])


def _stored(batches, width: int):
    """The ``Vectors`` of stored blocks, ``ROWS`` at a time."""
    for batch in batches:
        rows = int(batch.column("rows").to_numpy(zero_copy_only=False).sum())
        value, at, sizes = (_joined(batch.column(name), kind) for name, kind in (("value", np.float64), ("at", np.int32), ("sizes", np.int32)))
        ends = np.append(0, np.cumsum(sizes, dtype=np.int64)) if sizes is not None else np.arange(rows + 1) * width
        for first in range(0, rows, ROWS):
            last = min(first + ROWS, rows)
            own = slice(ends[first], ends[last])
            yield Vectors.of(width, last - first, value[own], None if sizes is None else at[own], None if sizes is None else sizes[first:last])


class Held:
    """The centres that rows are compared with, one after the other, and by position where the rows are sparse."""

    def __init__(self, starts: list[np.ndarray]):
        self.starts, self.width = starts, starts[0].shape[1]
        self.borders = np.append(0, np.cumsum([len(c) for c in starts]))

    @cached_property
    def norms(self) -> np.ndarray:
        return np.array([(centre * centre).sum() for c in self.starts for centre in c])

    @cached_property
    def by_position(self) -> np.ndarray:
        """A row for each position, and one of zeros for the places that a row does not use."""
        table = np.zeros((self.width + 1, self.borders[-1]))
        for c, first, last in zip(self.starts, self.borders, self.borders[1:], strict=False):
            table[:-1, first:last] = c.T
        return table


class Vectors:
    """The vectors of one Arrow column as a matrix, or as positions and values of each row."""

    def __init__(self, column: pa.Array, width: int):
        sparse = pa.types.is_struct(column.type)
        values = column.field("value") if sparse else column
        sizes = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        value = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        at = column.field("at").flatten().to_numpy(zero_copy_only=False) if sparse else None
        self._set(width, len(column), value, at, sizes)

    @classmethod
    def of(cls, width: int, rows: int, value: np.ndarray, at: np.ndarray | None, sizes: np.ndarray | None) -> "Vectors":
        made = cls.__new__(cls)
        made._set(width, rows, value, at, sizes)
        return made

    def _set(self, width: int, rows: int, value: np.ndarray, at: np.ndarray | None, sizes: np.ndarray | None) -> None:
        self.width, self.rows, self.value, self.dense = width, rows, value, None
        if at is None:
            self.dense = value.reshape(rows, width)
            return
        self.at = at.astype(np.int64)
        self.ends = np.cumsum(sizes, dtype=np.int64)
        self.starts = self.ends - sizes

    def part(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, position, value)`` of all entries of some rows, which count from 0."""
        a, b = (self.starts[first], self.ends[last - 1]) if last > first else (0, 0)
        row = np.repeat(np.arange(last - first), self.ends[first:last] - self.starts[first:last])
        return row, self.at[a:b], self.value[a:b]

    def distances(self, held: Held, first: int, last: int) -> np.ndarray:
        """Squared distances of some rows to all centres; each row's come from its own numbers alone."""
        out = np.zeros((last - first, held.borders[-1]))
        if self.dense is not None:
            for k, centre in enumerate(centre for c in held.starts for centre in c):
                difference = self.dense[first:last] - centre
                out[:, k] = np.einsum("ij,ij->i", difference, difference)
            return out
        row, at, value = self.part(first, last)
        own = np.bincount(row, value * value, last - first)
        for a in range(0, last - first, SLAB):
            b = min(a + SLAB, last - first)
            self._products(held, first + a, first + b, out[a:b])
        out *= -2
        out += own[:, None]
        out += held.norms
        return np.maximum(out, 0.0, out=out)

    def _products(self, held: Held, first: int, last: int, out: np.ndarray) -> None:
        """Adds the products of some rows with all centres to ``out``, entry after entry."""
        row, at, value = self.part(first, last)
        sizes = self.ends[first:last] - self.starts[first:last]
        most = int(sizes.max(initial=0))
        if most * (last - first) > 2 * len(at) + SLAB:  # a few rows are much longer than the others
            for k in range(out.shape[1]):
                out[:, k] = np.bincount(row, value * held.by_position[at, k], last - first)
            return
        used = np.arange(most) < sizes[:, None]
        places, numbers = np.full(used.shape, held.width), np.zeros(used.shape)
        places[used], numbers[used] = at, value
        places, numbers, product = np.ascontiguousarray(places.T), np.ascontiguousarray(numbers.T), np.empty(out.shape)
        for place, number in zip(places, numbers, strict=True):
            np.take(held.by_position, place, axis=0, out=product, mode="clip")
            product *= number[:, None]
            out += product

    def add(self, sums: list[np.ndarray], labels: list[np.ndarray], first: int, last: int, scale: float) -> None:
        """Adds whole numbers to the sums of every start by label and position."""
        if self.dense is not None:
            whole = np.rint(self.dense[first:last] * scale).astype(np.int64)
            for total, label in zip(sums, labels, strict=True):
                for k in np.unique(label):
                    total[k] += whole[label == k].sum(axis=0)
            return
        row, at, value = self.part(first, last)
        whole = np.rint(value * scale).astype(np.int64)
        for total, label in zip(sums, labels, strict=True):
            np.add.at(total.reshape(-1), (label * self.width)[row] + at, whole)

    def matrix(self, rows: list[int]) -> np.ndarray:
        if self.dense is not None:
            return self.dense[rows]
        out = np.zeros((len(rows), self.width))
        for k, r in enumerate(rows):
            out[k, self.at[self.starts[r]:self.ends[r]]] = self.value[self.starts[r]:self.ends[r]]
        return out

    def entries(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and values of a row, copied."""
        if self.dense is not None:
            return np.arange(self.width), self.dense[row].copy()
        own = slice(self.starts[row], self.ends[row])
        return self.at[own].copy(), self.value[own].copy()

    def digests(self, seed: int) -> list[bytes]:
        """A hash of every row's numbers, the same wherever the row lies; zeros do not count where rows are sparse."""
        salt = str(seed).encode()[:16]
        if self.dense is not None:
            parts, ends = [(self.dense + 0.0).tobytes()], np.arange(self.rows + 1) * self.width
        else:
            used = self.value != 0
            parts = [x[used].tobytes() for x in (self.at, self.value)]
            ends = np.append(0, np.cumsum(used))[np.append(0, self.ends)]
        borders = (ends * 8).tolist()
        return [hashlib.blake2b(b"".join([x[first:last] for x in parts]), digest_size=8, salt=salt).digest()
                for first, last in zip(borders, borders[1:], strict=False)]

    def digest(self, row: int, seed: int) -> bytes:
        return self.digests(seed)[row]


def _reservoir(vectors: DataFrame, width: int, seed: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions that the vectors in the reservoir use, and the vectors at these."""
    def run(batches):
        held: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        for own in _stored(batches, width):
            # Nothing enters a full reservoir behind its last digest.
            last = max(held) if len(held) >= sample else None
            found = {d: r for r, d in enumerate(own.digests(seed)) if last is None or d < last}
            held.update((d, own.entries(found[d])) for d in sorted(found.keys() - held.keys())[:sample])
            held = {d: held[d] for d in sorted(held)[:sample]}
        yield pa.RecordBatch.from_arrays([
            pa.array(list(held), pa.binary()), pa.array([at for at, _ in held.values()], pa.list_(pa.int32())),
            pa.array([value for _, value in held.values()], pa.list_(pa.float64()))], names=["d", "at", "value"])

    found = vectors.mapInArrow(run, "d binary, at array<int>, value array<double>").groupBy("d").agg(F.first(F.struct("at", "value")).alias("v"))
    rows = [r.v for r in found.orderBy("d").limit(sample).collect()]
    used = np.unique([p for r in rows for p in r["at"]]).astype(np.int64)
    points = np.zeros((len(rows), len(used)))
    for point, r in zip(points, rows, strict=True):
        point[np.searchsorted(used, r["at"])] = r["value"]
    return used, points


def _squares(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of the points, of some of them at once."""
    return np.concatenate([((points[i:i + SLAB] - centre) ** 2).sum(axis=1) for i in range(0, len(points), SLAB)])


def _spread(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: each next centre drawn by its squared distance to those chosen."""
    chosen = [int(rng.integers(len(points)))]
    nearest = _squares(points, points[chosen[0]])
    while len(chosen) < min(k, len(points)):
        if nearest.sum() == 0:
            break
        chosen.append(int(np.searchsorted(np.cumsum(nearest), rng.random() * nearest.sum(), side="right").clip(0, len(points) - 1)))
        nearest = np.minimum(nearest, _squares(points, points[chosen[-1]]))
    return points[chosen]


def _round(vectors: DataFrame, starts: list[np.ndarray], largest: float) -> list[tuple[np.ndarray, list[int], float]]:
    """For every start: the means of its clusters (an empty one keeps its centre), their sizes, and the cost before moving."""
    width = starts[0].shape[1]
    scale = 2.0 ** (BITS - 1 - int(np.ceil(np.log2(largest)))) if largest else 1.0
    cost_scale = 2.0 ** (BITS - 1 - int(np.ceil(np.log2(4 * width * largest * largest)))) if largest else 1.0
    shared = vectors.sparkSession.sparkContext.broadcast(starts)

    def run(batches):
        held = Held(shared.value)
        sums = [np.zeros((len(c), width), np.int64) for c in held.starts]
        sizes, costs = [np.zeros(len(c), np.int64) for c in held.starts], [0] * len(held.starts)
        for own in _stored(batches, width):
            distance, labels = own.distances(held, 0, own.rows), []
            for s, (first, last) in enumerate(zip(held.borders, held.borders[1:], strict=False)):
                near = distance[:, first:last]
                labels.append(near.argmin(axis=1))
                sizes[s] += np.bincount(labels[s], minlength=last - first)
                costs[s] += int(np.rint(near[np.arange(own.rows), labels[s]] * cost_scale).astype(np.int64).sum())
            own.add(sums, labels, 0, own.rows, scale)
        for s, (total, size) in enumerate(zip(sums, sizes, strict=True)):
            (some,) = np.nonzero(size)
            yield _returned(s, np.append(-1, some), -1, np.append(costs[s], size[some]))
            for c in range(len(total)):
                (taken,) = np.nonzero(total[c])
                for i in range(0, len(taken), RETURNED):
                    part = taken[i:i + RETURNED]
                    yield _returned(s, c, part, total[c][part])

    # One row for each centre and position; the sums are exact until they become the numbers that are divided.
    rows = vectors.mapInArrow(run, "s long, c long, p long, total long").groupBy("s", "c", "p").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).cast("double").alias("total")).toArrow()
    shared.destroy()
    s, c, p, total = (rows.column(name).to_numpy() for name in ("s", "c", "p", "total"))
    found = []
    for k, centres in enumerate(starts):
        cost, size, mean = ((s == k) & at for at in (c < 0, (c >= 0) & (p < 0), p >= 0))
        sizes = np.zeros(len(centres))
        sizes[c[size]] = total[size]
        means = np.where(sizes[:, None] > 0, 0.0, centres)
        means[c[mean], p[mean]] = total[mean] / (sizes[c[mean]] * scale)
        found.append((means, [int(n) for n in sizes], float(total[cost].sum() / cost_scale)))
    return found


def _returned(*columns) -> pa.RecordBatch:
    """Arrow rows of whole numbers, some of them the same in every row."""
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in np.broadcast_arrays(*columns)], names=["s", "c", "p", "total"])


def _vectors(df: DataFrame, vector: str):
    """``vector`` alone, as doubles; a missing number counts as 0."""
    number = lambda c: F.transform(c, lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))
    column = F.col(vector)
    if isinstance(df.schema[vector].dataType, T.StructType):
        return F.struct(column["at"].cast("array<int>").alias("at"), number(column["value"]).alias("value"))
    return number(column)


def _placed(used: np.ndarray, points: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(points), width))
    out[:, used] = points
    return out


def _settled(vectors: DataFrame, starts: list[np.ndarray], largest: float) -> list[list]:
    """``[centres, sizes, cost]`` of every start once it moves no more."""
    runs, moving = [[centres, [], float("inf")] for centres in starts], list(range(len(starts)))
    for _ in range(ROUNDS):
        for s, (means, sizes, cost) in zip(list(moving), _round(vectors, [runs[s][0] for s in moving], largest), strict=True):
            moved = ((means - runs[s][0]) ** 2).sum(axis=1).max()
            runs[s] = [means, sizes, cost]
            if moved <= SETTLED:
                moving.remove(s)
        if not moving:
            break
    return runs


def fit(df: DataFrame, vector: str, k: int, seed: int = SEED, starts: int = STARTS, sample: int = SAMPLE) -> Model:
    """The cheapest of ``starts`` fits. Fewer than ``k`` clusters come back only where the reservoir has fewer vectors."""
    if k < 1:
        raise ValueError("k must be at least 1")
    vectors = store(df.where(F.col(vector).isNotNull()).select(_vectors(df, vector).alias("v")).mapInArrow(_blocks, _BLOCK), "vectors")
    seen = vectors.agg(F.max("largest").alias("largest"), F.max("width").alias("width")).first()
    if seen.width is None:
        raise ValueError("no vectors to cluster")
    largest = float(seen.largest or 0.0)
    used, points = _reservoir(vectors, seen.width, seed, sample)
    best, together = None, max(1, HELD // (k * seen.width or 1))
    for first in range(0, starts, together):
        for run in _settled(vectors, [_placed(used, _spread(points, k, np.random.default_rng(seed + i)), seen.width)
                                      for i in range(first, min(first + together, starts))], largest):
            if best is None or run[2] < best[2]:
                best = run
    centres, sizes, cost = best
    for _ in range(ROUNDS):
        means, sizes, cost = _round(vectors, [centres], largest)[0]
        if (means == centres).all():
            break
        centres = means
    order = sorted(range(len(centres)), key=lambda c: (-sizes[c], tuple(centres[c])))
    return Model(centres[order], [sizes[c] for c in order], cost)


def assign(df: DataFrame, vector: str, model: Model) -> DataFrame:
    """``df`` with ``cluster``: the label of the nearest centre, the lower label in a tie; NULL without a vector."""
    shared = df.sparkSession.sparkContext.broadcast(model.centres)
    present = df.where(F.col(vector).isNotNull()).withColumn("_vector", _vectors(df, vector))
    names, width = [*df.columns, "cluster"], model.centres.shape[1]
    at = len(df.columns)

    def run(batches):
        held = Held([shared.value])
        for batch in batches:
            own, label = Vectors(batch.column(at), width), np.empty(batch.num_rows, np.int32)
            for first in range(0, own.rows, ROWS):
                last = min(first + ROWS, own.rows)
                label[first:last] = own.distances(held, first, last).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(label)], names=names)

    schema = T.StructType([*df.schema.fields, T.StructField("cluster", T.IntegerType())])
    missing = df.where(F.col(vector).isNull()).withColumn("cluster", F.lit(None).cast("int"))
    return present.mapInArrow(run, schema).unionByName(missing)
