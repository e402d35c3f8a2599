"""Whitening of embeddings by the leading eigenvectors of their covariance, by Jacobi-Davidson.

Vectors become whole numbers, floor(256 * c); each distinct one counts once. Of them only
products are formed: a task centres its rows, multiplies them with a few columns, and sends back one
small matrix, which are added up in a tree. The covariance itself is never built.

The search space grows by what corrects the wanted eigenpairs. Rayleigh-Ritz gives the best pairs
of the space; for each one that is not settled, MINRES solves

    (I - W W') (V - e I) (I - W W') t = -r,    W: the settled vectors and the pairs at hand

roughly, with one joint product a step for all of them, and t joins the space. A pair whose residual
is down at rounding level is locked: it leaves the search, which stays orthogonal to it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.tables import written
from termtide.session import drop_folder

SCALE, COMPONENTS = 256, 4
BLOCK_BYTES = 4 << 20
#: A residual that counts as zero, as a share of the greatest eigenvalue; and one that may stay if
#: three rounds don't lessen it.
ZERO, STUCK = 32 * np.finfo(np.float64).eps, 1e-12
#: Eigenvalues below this share of the trace are no components: their direction is rounding.
LEAST = 1e-12
#: MINRES steps of a correction, and how far it lowers its residual.
STEPS, LOWER = 12, 1e-3
#: Pairs beside the wanted ones that are corrected with them: a product with more columns costs little more.
GUARD = 6
#: Columns of the search space, and how many are kept when it is full.
MOST, KEPT, ROUNDS = 48, 16, 60


def whole_numbers(rows: DataFrame, vector: str) -> DataFrame:
    """Usable rows only, with the vector as ``x``, an array of long."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return rows.where(v.isNotNull() & finite).withColumn(
        "x", F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    )


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of whole numbers; where a list is shorter, 0."""
    size = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten())
    out = np.zeros((len(column), width), np.int64)
    row = np.arange(len(column)).repeat(size)
    out[row, np.arange(len(flat)) - (np.cumsum(size) - size)[row]] = flat
    return out


def blocks_of(fit: DataFrame, width: int) -> DataFrame:
    """Rows packed by the hundreds: n, and the numbers as little-endian 64-bit ones."""
    most = max(1, BLOCK_BYTES // (8 * max(width, 1)))

    def packed(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                x = matrix_of(batch.slice(a, most).column(0), width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)], pa.int64()), pa.array([x.astype("<i8").tobytes()], pa.binary())],
                    ["n", "block"],
                )

    return fit.select("x").mapInArrow(packed, "n bigint, block binary")


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums without overflow."""
    if len(x) and max(-int(x.min()), int(x.max())) >= (1 << 62) // len(x):
        x = x.astype(object)
    return [int(s) for s in x.sum(axis=0)]


class Fit:
    """The distinct vectors, and products with them."""

    def __init__(self, blocks: DataFrame, width: int):
        self.width = width
        # Kept in memory or on disk; what a lost executor held is read again from the table.
        self.rows = blocks.rdd.persist(StorageLevel.MEMORY_AND_DISK)
        self.blocks = self.rows.map(lambda r: np.frombuffer(r["block"], "<i8").reshape(r["n"], width))
        add = lambda a, b: (a[0] + b[0], [x + y for x, y in zip(a[1], b[1])])
        sums = self._total(lambda x: (len(x), exact_sums(x)), add, (0, [0] * width))
        self.n, self.sums = sums
        # A quotient of whole numbers is rounded once.
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(width)

    def _total(self, of, add, none):
        def part(blocks):
            out = None
            for x in blocks:
                own = of(x)
                out = own if out is None else add(out, own)
            return [] if out is None else [out]

        parts = self.blocks.mapPartitions(part)
        if parts.getNumPartitions() == 0:
            return none
        both = lambda a, b: a if b is None else b if a is None else add(a, b)
        # The matrices of a few tasks are added up on the driver, those of many in a tree before.
        total = parts.treeAggregate(None, both, both, 1 if parts.getNumPartitions() <= 64 else 2)
        return none if total is None else total

    def trace(self) -> float:
        mean = self.mean
        total = self._total(lambda x: float(((x - mean) ** 2).sum()), lambda a, b: a + b, 0.0)
        return total / self.n if self.n else 0.0

    def product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times some columns."""
        mean = self.mean

        def of(x):
            centred = x - mean
            return centred.T @ (centred @ columns)

        return self._total(of, np.add, np.zeros(columns.shape)) / self.n

    def second_moments(self, white) -> np.ndarray:
        """Covariance of what ``white`` makes of the rows."""
        def of(x):
            y = white(x)
            return np.vstack([y.T @ y, y.sum(axis=0)])

        k = white(np.zeros((1, self.width), np.int64)).shape[1]
        total = self._total(of, np.add, np.zeros((k + 1, k))) / self.n
        # The rows are centred before, so this mean is a rounding error and nothing cancels.
        return total[:k] - np.outer(total[k], total[k])


def orthonormal(new: np.ndarray, old: np.ndarray) -> np.ndarray:
    """What the new columns add to the old ones, which are orthonormal."""
    kept = []
    for v in new.T:
        v = v / max(np.linalg.norm(v), 1e-300)
        for _ in range(3):
            before = np.linalg.norm(v)
            for base in (old, np.array(kept).T if kept else None):
                if base is not None and base.shape[1]:
                    v = v - base @ (base.T @ v)
            if np.linalg.norm(v) > 0.7 * before:
                break
        size = np.linalg.norm(v)
        if size > 1e-10:
            kept.append(v / size)
    return np.array(kept).T if kept else np.zeros((old.shape[0], 0))


def minres(right: np.ndarray, steps: int, lower: float):
    """MINRES as a coroutine: gives the vector to be multiplied, takes the product, returns the solution."""
    x, beta = np.zeros_like(right), np.linalg.norm(right)
    if beta == 0:
        return x
    v_old, v, first = np.zeros_like(right), right / beta, beta
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    c, s, c_old, s_old, eta = 1.0, 0.0, 1.0, 0.0, beta
    below = 0.0
    for _ in range(steps):
        u = yield v
        alpha = v @ u
        u = u - alpha * v - below * v_old
        u = u - (v @ u) * v
        above = np.linalg.norm(u)
        turn = c * alpha - c_old * s * below
        pivot = np.hypot(turn, above)
        if pivot == 0:
            break
        second, third = s * alpha + c_old * c * below, s_old * below
        c_old, s_old, c, s = c, s, turn / pivot, above / pivot
        w, w_old = (v - third * w_old - second * w) / pivot, w
        x = x + c * eta * w
        eta = -s * eta
        if above <= 1e-14 * first or abs(eta) <= lower * first:
            break
        v_old, v, below = v, u / above, above
    return x


@dataclass
class Pairs:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int


def jacobi_davidson(product, width: int, wanted: int, seed: int = 5) -> Pairs:
    """The greatest eigenpairs of a symmetric matrix, of which only ``product`` with a few columns is
    known. Signs are those that make each vector's greatest entry positive."""
    wanted, calls = min(wanted, width), 0
    locked, values, residuals = np.zeros((width, 0)), [], []
    space = np.zeros((width, 0))
    image = np.zeros((width, 0))
    new = np.random.default_rng(seed).normal(size=(width, min(width, wanted + GUARD)))
    top, last = 0.0, []
    for _ in range(ROUNDS):
        new = orthonormal(new, np.hstack([locked, space]))
        if not new.shape[1] and locked.shape[1] + space.shape[1] < width:
            # A correction inside the space adds nothing; a random direction does.
            new = orthonormal(np.random.default_rng(seed + calls).normal(size=(width, 1)), np.hstack([locked, space]))
        if new.shape[1]:
            image = np.hstack([image, product(new)])
            space = np.hstack([space, new])
            calls += 1
        small = space.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        top = max(top, ritz[0] if len(ritz) else 0.0)
        need = wanted - locked.shape[1]
        u = space @ turn[:, : need + GUARD]
        r = image @ turn[:, : need + GUARD] - u * ritz[: u.shape[1]]
        size = np.linalg.norm(r, axis=0)
        last.append(size[:need].max(initial=0))
        stuck = len(last) > 3 and last[-1] > 0.5 * last[-4] and last[-1] <= STUCK * top
        whole = locked.shape[1] + space.shape[1] == width and not new.shape[1]
        done = 0
        while done < need and (size[done] <= ZERO * top or stuck or whole):
            done += 1
        if done:
            locked = np.hstack([locked, u[:, :done]])
            values += ritz[:done].tolist()
            residuals += size[:done].tolist()
            space, image = space @ turn[:, done:], image @ turn[:, done:]
            u, r, ritz, last = u[:, done:], r[:, done:], ritz[done:], []
            turn = np.eye(space.shape[1])
        need -= done
        if not need:
            break
        basis = space @ turn
        if basis.shape[1] > MOST:
            space, image = basis[:, :KEPT], (image @ turn)[:, :KEPT]
            basis = space
        beside = np.hstack([locked, orthonormal(basis[:, : need + GUARD], locked)])
        away = lambda y: y - beside @ (beside.T @ y)
        solving, asked, found = {}, {}, {}
        for i in range(r.shape[1]):
            solving[i] = minres(away(-r[:, i]), STEPS, LOWER)
            try:
                asked[i] = next(solving[i])
            except StopIteration as end:
                found[i] = end.value
        while asked:
            names = list(asked)
            multiplied = product(away(np.array([asked[i] for i in names]).T))
            calls += 1
            for k, i in enumerate(names):
                answer = away(multiplied[:, k] - ritz[i] * away(asked[i]))
                try:
                    asked[i] = solving[i].send(answer)
                except StopIteration as end:
                    found[i] = end.value
                    del asked[i]
        new = np.hstack([np.array([found[i] for i in range(r.shape[1])]).T, r[:, :need]])
        new = new[:, np.linalg.norm(new, axis=0) > 0]
    else:
        raise RuntimeError(f"{wanted - locked.shape[1]} of {wanted} eigenpairs have not settled")
    order = np.argsort(values)[::-1]
    vectors = locked[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]) if len(order) else np.ones(0)
    return Pairs(np.array(values)[order], vectors * sign, np.array(residuals)[order], calls)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over columns of (n * x - sum) ** 2, exactly; None where it is no 64-bit number."""
    most = max([1, *(abs(s) for s in sums)]) + n * max(1, int(np.abs(x).max(initial=0)))
    if x.shape[1] * most * most < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    whole = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in whole]


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
) -> DataFrame:
    """Per usable row: id (long), n, deviation, whitened (array, one entry per component), and the
    same in every row: explained (array), residuals (array, as a share of the greatest eigenvalue), identity_error.

    A null vector and one with a null or non-finite entry is dropped. Vectors may differ in length;
    what is missing at the end is 0. Repeated rows and null ids each give a row. There are fewer components where there
    are fewer dimensions or fewer eigenvalues over `LEAST` of the trace: with one distinct vector
    none, so ``whitened`` is empty and identity_error 0. An empty table gives no rows. A deviation
    over 64 bits is null. Other columns are not read.
    """
    usable = whole_numbers(rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")), "v")
    usable = usable.select("id", "x")
    width = usable.agg(F.max(F.size("x"))).first()[0] or 0
    padded = F.when(F.size("x") == width, F.col("x")).otherwise(
        F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    )
    blocks = written(blocks_of(usable.select(padded.alias("x")).distinct(), width), "whitening")
    fit = Fit(blocks, width)
    trace = fit.trace()
    pairs = (
        jacobi_davidson(fit.product, width, components) if trace > 0
        else Pairs(np.zeros(0), np.zeros((width, 0)), np.zeros(0), 0)
    )
    real = pairs.values > LEAST * max(trace, 1e-300)
    values, vectors = pairs.values[real], pairs.vectors[:, real]
    mean, onto = fit.mean, vectors / np.sqrt(values)
    white = lambda x: (x - mean) @ onto
    error = 0.0
    if len(values):
        error = float(np.abs(fit.second_moments(white) - np.eye(len(values))).max())
    fit.rows.unpersist()
    for path in {f.rsplit("/", 1)[0] for f in blocks.inputFiles()}:
        drop_folder(rows.sparkSession, path)
    n, sums = fit.n, fit.sums

    def projected(batches):
        for batch in batches:
            x = matrix_of(batch.column(1), width)
            y = white(x)
            k = y.shape[1]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(y.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviations(x, n, sums), pa.int64()), lists],
                ["id", "deviation", "whitened"],
            )

    found = usable.mapInArrow(projected, "id bigint, deviation bigint, whitened array<double>")
    doubles = lambda x: F.array(*[F.lit(float(v)) for v in x]).cast("array<double>")
    top = pairs.values[0] if len(pairs.values) else 1.0
    return found.select(
        "id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        doubles(values / trace if trace else values).alias("explained"),
        doubles(pairs.residuals[real] / top).alias("residuals"), F.lit(error).alias("identity_error"),
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """One row for each row and component, numbered from 1."""
    return whitened.select("*", F.posexplode("whitened").alias("place", "value")).select(
        "id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("value").alias("whitened"),
        F.expr("explained[place]").alias("explained"), "identity_error", F.expr("residuals[place]").alias("residual"),
    )
