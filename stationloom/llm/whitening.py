"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

Vectors become whole numbers; the covariance is that of the distinct ones and is never formed. A product with it is one
pass over the packed distinct vectors, which are centred before they are multiplied; several columns share a pass.

Ritz pairs come from a small search space (Rayleigh-Ritz on the driver). Each pair that has not converged gives a
correction equation, projected off that pair and all locked ones, which MINRES solves without a matrix; the equations of
all pairs take their steps together, so that one pass serves them all. Solutions widen the space, converged pairs are
locked, and it ends when all residuals are down to rounding. A block of random directions off the locked pairs is then
searched for a larger eigenvalue that might have been passed over.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B

#: One entry is ``floor(SCALE * c)``.
SCALE = 256
_LIMIT = 1 << 62
#: Bytes of packed vectors that one task of a pass reads, about.
TASK_BYTES = 64_000_000
START, SPACE, INNER_STEPS, OUTER_STEPS, SEARCH_STEPS = 8, 24, 12, 60, 5
#: A residual is at rounding when it is this small beside the largest eigenvalue, and must stop falling below the second.
ROUNDING, LOOSE = 5e-14, 1e-11


def _whole(vector: Column) -> Column:
    """Entries as whole numbers; null for a vector that is null, empty, or has entries that are no finite numbers in range."""
    scaled = F.transform(vector, lambda c: c.cast("double") * F.lit(float(SCALE)))
    fine = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float(_LIMIT))))
    return F.when(fine & (F.size(vector) > 0), F.transform(scaled, lambda c: F.floor(c)))


@dataclass
class Fit:
    """Distinct vectors, packed, with their number and sums."""

    packed: DataFrame
    n: int
    sums: np.ndarray
    passes: int = 0

    @property
    def d(self) -> int:
        return len(self.sums)

    def _totals(self, part, size: int) -> np.ndarray:
        """The sum over all packed rows of ``part(centred)``, an array of ``size`` numbers."""
        n, sums = self.n, self.sums

        def totals(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out = np.zeros(size)
            for frame in frames:
                for raw in frame["vectors"]:
                    out += part(centred(np.frombuffer(raw, dtype=np.int64).reshape(-1, len(sums)), n, sums)).reshape(-1)
            yield pd.DataFrame({"i": np.arange(size, dtype=np.int32), "v": out})

        self.passes += 1
        found = np.zeros(size)
        for row in self.packed.mapInPandas(totals, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            found[row["i"]] = row["v"]
        return found

    def products(self, block: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``block``."""
        return self._totals(lambda c: c.T @ (c @ block), block.size).reshape(block.shape) / self.n

    def trace(self) -> float:
        return float(self._totals(lambda c: np.array([(c * c).sum()]), 1)[0]) / self.n

    def identity_error(self, transform: np.ndarray) -> float:
        """The largest absolute entry of the covariance of the transformed vectors minus the identity."""
        k = transform.shape[1]
        mean = self._totals(lambda c: (c @ transform).sum(axis=0), k) / self.n
        found = self._totals(lambda c: (c @ transform - mean).T @ (c @ transform - mean), k * k).reshape(k, k) / self.n
        return float(np.abs(found - np.eye(k)).max())


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - sums / n`` with one rounding where the whole numbers allow."""
    most = int(np.abs(x).max(initial=0))
    if n * most + int(np.abs(sums).max(initial=0)) < _LIMIT:
        return (n * x - sums) / n
    return ((n * x.astype(object) - sums.astype(object)) / n).astype(float)


def _pack(vectors: DataFrame) -> DataFrame:
    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.stack(frame["x"].to_numpy()).astype(np.int64)
                yield pd.DataFrame({"n": [len(x)], "sums": [x.sum(axis=0)], "vectors": [x.tobytes()]})

    return vectors.mapInPandas(packed, "n long, sums array<long>, vectors binary")


def fit_list(vectors: DataFrame) -> Fit | None:
    """Each distinct ``x`` once; all have one length."""
    packed = B.checkpointed(_pack(vectors.select("x").distinct()))
    total = packed.agg(F.sum("n").alias("n"), F.sum(F.octet_length("vectors")).alias("bytes")).first()
    if not total["n"]:
        return None
    each = packed.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s"))
    sums = np.array([r["s"] for r in sorted(each.collect(), key=lambda r: r["i"])], dtype=np.int64)
    tasks = max(packed.sparkSession.sparkContext.defaultParallelism, -(-total["bytes"] // TASK_BYTES))
    return Fit(packed.select("vectors").coalesce(tasks), total["n"], sums)


def minres(right: np.ndarray, project, shift: float, steps: int, least: float) -> Generator[np.ndarray, np.ndarray, np.ndarray]:
    """MINRES for the projected equation ``P (A - shift) P t = right``: yields vectors, is sent their products with A, returns t."""
    solution = np.zeros_like(right)
    beta = first = float(np.linalg.norm(right))
    before, now = np.zeros_like(right), right / beta if beta else right
    w_before, w = np.zeros_like(right), np.zeros_like(right)
    c_before = c = 1.0
    s_before = s = 0.0
    eta = beta
    for _ in range(steps):
        if not beta or abs(eta) <= least * first:
            break
        image = yield now
        image = project(image - shift * now) - (beta * before if before.any() else 0)
        alpha = float(now @ image)
        image = image - alpha * now
        following = float(np.linalg.norm(image))
        r0 = c * alpha - c_before * s * beta
        r1 = math.hypot(r0, following)
        r2, r3 = s * alpha + c_before * c * beta, s_before * beta
        if r1 == 0:
            break
        w_before, w = w, (now - r3 * w_before - r2 * w) / r1
        c_before, s_before, c, s = c, s, r0 / r1, following / r1
        solution = solution + c * eta * w
        eta = -s * eta
        before, now, beta = now, (image / following if following else image), following
    return solution


def _together(products, equations: list[Generator]) -> list[np.ndarray]:
    """Run all equations step by step; each step is one pass for all that are still under way."""
    done: list[np.ndarray | None] = [None] * len(equations)
    waiting = {}

    def go(i: int, image: np.ndarray | None) -> None:
        try:
            waiting[i] = next(equations[i]) if image is None else equations[i].send(image)
        except StopIteration as end:
            waiting.pop(i, None)
            done[i] = end.value

    for i in range(len(equations)):
        go(i, None)
    while waiting:
        turn = sorted(waiting)
        images = products(np.stack([waiting[i] for i in turn], axis=1))
        for k, i in enumerate(turn):
            go(i, images[:, k])
    return done


def _off(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of ``block`` off some orthonormal bases; columns that lie in them vanish."""
    out = []
    for v in block.T:
        size = np.linalg.norm(v)
        for _ in range(3):
            for base in (*bases, *[o[:, None] for o in out]):
                v = v - base @ (base.T @ v)
        left = np.linalg.norm(v)
        if size > 0 and left > 1e-12 * size:
            out.append(v / left)
    return np.stack(out, axis=1) if out else np.zeros((len(block), 0))


def leading_pairs(products, d: int, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their vectors, of a symmetric positive operator given by its products."""
    k = min(k, d)
    rng = np.random.default_rng(seed)
    locked, images_locked = np.zeros((d, 0)), np.zeros((d, 0))
    space = _off(rng.standard_normal((d, min(d, max(START, 2 * k)))), locked)
    images = products(space)
    # two steps of a block Krylov space, so that the pairs sought are in sight
    for _ in range(2):
        more = _off(images[:, -START:], space)
        if more.shape[1]:
            space, images = np.hstack([space, more]), np.hstack([images, products(more)])
    searched, last = False, math.inf
    for _ in range(OUTER_STEPS):
        values, turn = np.linalg.eigh((space.T @ images + images.T @ space) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        want = k - locked.shape[1]
        residuals = images[:, :want] - space[:, :want] * values[:want]
        residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        top = max([abs(values[0]), *np.abs((locked * images_locked).sum(axis=0))])
        full = locked.shape[1] + space.shape[1] == d  # nothing is left to widen the space with
        stuck = sizes.max(initial=0) > last / 2
        last = sizes.max(initial=0)
        fine = sizes <= (LOOSE if full or stuck else ROUNDING) * top
        n = int(np.argmin(np.append(fine, False)))
        if n:
            locked, images_locked = np.hstack([locked, space[:, :n]]), np.hstack([images_locked, images[:, :n]])
            space, images, residuals, values, sizes = space[:, n:], images[:, n:], residuals[:, n:], values[n:], sizes[n:]
            last = math.inf
        if locked.shape[1] == k:
            if searched or full:
                break
            # is there a larger one off the locked pairs?
            searched, probe = True, _off(rng.standard_normal((d, min(d - k, k))), locked)
            found, seen = probe, products(probe)
            for _ in range(SEARCH_STEPS):
                more = _off(seen[:, -probe.shape[1]:], locked, found)
                if more.shape[1]:
                    found, seen = np.hstack([found, more]), np.hstack([seen, products(more)])
            least = float(np.min((locked * images_locked).sum(axis=0)))
            if np.linalg.eigvalsh((found.T @ seen + seen.T @ found) / 2)[-1] <= least + 1e-10 * top:
                break
            space, images = np.hstack([locked, found]), np.hstack([images_locked, seen])
            locked = images_locked = np.zeros((d, 0))
            continue
        if full:
            break
        if space.shape[1] + len(sizes) > SPACE:
            space, images = space[:, :max(START, 2 * k)], images[:, :max(START, 2 * k)]
        base = np.hstack([locked, space[:, :len(sizes)]])

        def project(v: np.ndarray, base: np.ndarray = base) -> np.ndarray:
            return v - base @ (base.T @ v)

        solved = _together(products, [minres(-project(r), project, float(e), INNER_STEPS, 1e-4) for r, e in zip(residuals.T, values, strict=False)])
        wider = _off(np.stack(solved, axis=1), locked, space)
        if not wider.shape[1]:  # the corrections are in the space already: go on with a fresh direction
            wider = _off(rng.standard_normal((d, 1)), locked, space)
        space, images = np.hstack([space, wider]), np.hstack([images, products(wider)])
    if locked.shape[1] < k:
        rest = k - locked.shape[1]
        locked, images_locked = np.hstack([locked, space[:, :rest]]), np.hstack([images_locked, images[:, :rest]])
    # the pairs of the locked space by products of their own
    values, turn = np.linalg.eigh(_symmetric(locked.T @ products(locked)))
    return values[::-1], locked @ turn[:, ::-1]


def _symmetric(a: np.ndarray) -> np.ndarray:
    return (a + a.T) / 2


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Exact sums of ``(n * x - sums) ** 2``; an error if one is beyond 64 bits."""
    most = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if most * most * max(1, x.shape[1]) < 1 << 63:
        return ((n * x - sums) ** 2).sum(axis=1)
    exact = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    if len(exact) and max(exact) >= 1 << 63:
        raise ArithmeticError("a deviation does not fit 64 bits")
    return exact.astype(np.int64)


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component.

    Rows whose vector is null, empty, or holds a null, a NaN, an infinity or a number of 2**54 and more are left out; so
    are those of another length than the most frequent one (the longer of two as frequent). Equal vectors count once in
    the fit, but every row has its result, whatever its id. Directions without variance are no components: one distinct
    vector, or none, gives no rows. Other columns are not read. A deviation beyond 64 bits is an error.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), _whole(F.col(vector_col)).alias("x")).filter(F.col("x").isNotNull())
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    none = vectors.sparkSession.createDataFrame([], schema)
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if usual is None:
        return none
    rows = rows.filter(F.size("x") == usual["d"])
    fit = fit_list(rows)
    trace = fit.trace()
    if trace <= 0:
        return none
    values, directions = leading_pairs(fit.products, fit.d, components)
    real = values > fit.d * np.finfo(float).eps * trace
    values, directions = values[real], directions[:, real]
    transform = directions / np.sqrt(values)
    error, explained, n, sums = fit.identity_error(transform), values / trace, fit.n, fit.sums
    k = len(values)

    def applied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["x"].to_numpy()).astype(np.int64)
            yield pd.DataFrame({
                "vec_id": frame["vec_id"].astype("Int64").array.repeat(k), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), "n": n,
                "deviation": np.repeat(_deviations(x, n, sums), k), "whitened": (centred(x, n, sums) @ transform).reshape(-1),
                "explained": np.tile(explained, len(x)), "identity_error": error})

    return rows.mapInPandas(applied, schema)
