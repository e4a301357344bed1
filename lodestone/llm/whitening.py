"""Embedding whitening by a bidiagonal qd solver.

Entries become integers ``floor(256 c)``.  The fit uses each distinct integer
vector once (one shuffle of the vectors, copies merged before it).  Sums per
dimension are exact.  Every partition reduces its centred rows block by block
to a triangular factor by QR, the factors are stacked and reduced again in
rounds of bounded groups, and the last one, dimension squared numbers, is
bidiagonalised on the driver: dqds gives its singular values, twisted
factorisations the directions (``bidiagonal.py``).  The covariance itself,
whose condition number is the square, is never formed.

Rows are then projected where they are scanned, by a broadcast of ``k``
directions; no row meets another.

Defined results: rows whose vector is null, empty or holds a null, a NaN or an
infinite entry, or an entry too large for a 64-bit integer, are dropped.
Vectors of other lengths than the most frequent one among distinct vectors (ties: the
smaller length) are dropped too.  Components whose singular value is 0 at
double precision do not exist: fewer than ``k`` are returned, none where all
vectors are equal.  A deviation beyond a 64-bit integer is null.  Repeated rows are each returned, null ids too; empty
tables give an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrays import text_buffer
from lodestone.llm.bidiagonal import right_vectors
from lodestone.llm.common import narrow, stored

SCALE = 256
COMPONENTS = 4
BLOCK_CELLS = 1 << 20
#: Bytes of the triangular factors that one task stacks.
GROUP_BYTES = 64 << 20


@dataclass
class Whitening:
    n: int
    sums: list[int]           # exact, per dimension
    vectors: np.ndarray       # a column per component
    values: np.ndarray        # eigenvalues of the covariance
    trace: float
    identity_error: float = 0.0


def integer_rows(col) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of a batch's list column: the rows that hold a usable vector, and those
    vectors as integers."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    some = np.flatnonzero(~np.asarray(col.is_null()))
    held = col.take(pa.array(some))
    size = np.asarray(held.value_lengths()).astype(np.int64)
    c = held.flatten().to_numpy(zero_copy_only=False).astype(float)  # a null entry is NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * c)
        usable = np.abs(x) < 2.0 ** 63  # False for NaN
    row = np.repeat(np.arange(len(some)), size)
    good = (size > 0) & (np.bincount(row[~usable], minlength=len(some)) == 0)
    at = np.cumsum(size) - size
    x = np.where(usable, x, 0).astype(np.int64)
    return some[good], [x[s:s + n] for s, n in zip(at[good].tolist(), size[good].tolist())]


def _packed(x: np.ndarray) -> bytes:
    """A vector in the narrowest integers that hold it: equal vectors, equal bytes."""
    top = max(int(x.max()), -int(x.min()) - 1)
    return x.astype("<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8").tobytes()


def _unpacked(col, d: int) -> np.ndarray:
    """Packed vectors of ``d`` entries as rows."""
    buf, offs = text_buffer(col)
    out = np.empty((len(offs) - 1, d), np.int64)
    width = np.diff(offs) // d
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        raw = buf[offs[own][:, None] + np.arange(w * d)]
        out[own] = np.ascontiguousarray(raw).view(f"<i{w}")
    return out


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(d, x): every integer vector once, of ``rows`` (key, vec)."""
    def run(batches):
        for b in batches:
            vectors = integer_rows(b.column(0))[1]
            yield pa.RecordBatch.from_arrays([pa.array([len(v) for v in vectors], pa.int32()),
                                              pa.array([_packed(v) for v in vectors], pa.binary())], names=["d", "x"])
    return rows.select("vec").mapInArrow(run, "d int, x binary").distinct()


def exact_sums(fit: DataFrame, d: int) -> list[int]:
    """The sum of each dimension, in two halves so that nothing overflows."""
    def run(batches):
        high, low = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            x = _unpacked(b.column(0), d)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(high), pa.array(low)], names=["k", "high", "low"])
    total = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]
    got = fit.select("x").mapInArrow(run, "k long, high long, low long").groupBy("k").agg(*total).collect()
    sums = [0] * d
    for r in got:  # a row per dimension
        sums[r["k"]] = (int(r["high"]) << 32) + int(r["low"])
    return sums


def centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S/n; the whole part is taken off exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole).astype(float) - np.array([s % n / n for s in sums])


def triangular_factor(fit: DataFrame, sums: list[int], n: int) -> np.ndarray:
    """R with R'R = sum over the fit list of centred rows times themselves."""
    d = len(sums)
    step = max(d, BLOCK_CELLS // d)

    def reduce_rows(batches):
        r = np.zeros((0, d))
        for b in batches:
            x = centred(_unpacked(b.column(0), d), sums, n)
            for at in range(0, len(x), step):
                r = np.linalg.qr(np.vstack([r, x[at:at + step]]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())],
                                             names=["part", "r"])

    def stack(table):
        r = np.zeros((0, d))
        for raw in table.column("r"):
            r = np.linalg.qr(np.vstack([r, np.frombuffer(raw.as_py()).reshape(-1, d)]), mode="r")
        return pa.table({"part": table.column("g")[:1], "r": pa.array([r.tobytes()], pa.binary())})
    fan = max(2, min(64, GROUP_BYTES // (8 * d * d)))
    factors = stored(fit.select("x").mapInArrow(reduce_rows, "part long, r binary"), "factors")
    while factors.count() > 1:
        factors = stored(factors.withColumn("g", F.floor(F.col("part") / fan)).groupBy("g").applyInArrow(stack, "part long, r binary"), "factors")
    r = np.frombuffer(factors.first()["r"]).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def fit(rows: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (key, vec), None where no vector is usable."""
    each = stored(distinct_vectors(rows), "vectors")
    sizes = each.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return None
    d, n = sizes["d"], sizes["n"]
    own = each.where(F.col("d") == d)
    sums = exact_sums(own, d)
    r = triangular_factor(own, sums, n)
    values, vectors = right_vectors(r, k)
    model = Whitening(n, sums, vectors, values ** 2 / n, float((r ** 2).sum()) / n)
    model.identity_error = identity_error(own, model)
    return model


def whitened(x: np.ndarray, m: Whitening) -> np.ndarray:
    return centred(x, m.sums, m.n) @ m.vectors / np.sqrt(m.values)


def identity_error(fit_list: DataFrame, m: Whitening) -> float:
    """Largest entry of (covariance of the whitened fit list - identity)."""
    k, d = len(m.values), len(m.sums)
    if not k:
        return 0.0
    names = [f"w{i}" for i in range(k)]

    def run(batches):
        for b in batches:
            w = whitened(_unpacked(b.column(0), d), m)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(w[:, i])) for i in range(k)], names=names)
    w = fit_list.select("x").mapInArrow(run, ", ".join(f"{c} double" for c in names))
    # covar_pop merges centred products
    off = [F.abs(F.covar_pop(a, b) - F.lit(float(a == b))) for i, a in enumerate(names) for b in names[i:]]
    return float(max(w.agg(*[c.alias(f"c{i}") for i, c in enumerate(off)]).first()))


def deviations(x: np.ndarray, m: Whitening) -> list:
    """sum (n x - S)^2 per row, exact; None beyond a 64-bit integer."""
    top = m.n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, m.sums))
    if len(m.sums) * top * top < 1 << 63:
        return ((m.n * x - np.array(m.sums, np.int64)) ** 2).sum(axis=1).tolist()
    total = ((m.n * x.astype(object) - np.array(m.sums, object)) ** 2).sum(axis=1)
    return [int(t) if t < 1 << 63 else None for t in total]


def vectors_of(df: DataFrame, key: str, vector: str) -> DataFrame:
    return narrow(df, key=F.col(f"`{key}`").cast("long"), vec=F.col(f"`{vector}`").cast("array<double>"))


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error):
    a row per usable vector and component, components by falling eigenvalue."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors_of(df, key, vector)
    model = fit(rows, k)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        k, d = len(m.values), len(m.sums)
        for b in batches:
            at, vectors = integer_rows(b.column(1))
            own = [i for i, v in enumerate(vectors) if len(v) == d]
            x = np.array([vectors[i] for i in own], np.int64).reshape(-1, d)
            count = len(x) * k
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(at[own], k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(count, m.n)),
                pa.array([v for v in deviations(x, m) for _ in range(k)], pa.int64()),
                pa.array(np.ascontiguousarray(whitened(x, m)).reshape(-1)),
                pa.array(np.tile(m.values / m.trace if k else m.values, len(x))),
                pa.array(np.full(count, m.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, schema)
