"""Truncated SVD of a sparse matrix by block Golub-Kahan bidiagonalization with thick restart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from pairloom.functions import dot, required
from pairloom.operators import blocks as bl
from pairloom.operators.blocks import BlockStore, Grid
from pairloom.operators.jacobi import all_triplets, chosen_columns
from pairloom.operators.journal import Journal
from pairloom.scratch import BROADCAST_BYTES, Staged, free_shuffles, of_large_rows, small_batches, stage

# A block holds so many columns more than are wanted; they speed up the last of the wanted ones.
OVERSAMPLE = 11
# Those of large matrices hold fewer: what a pass moves, keeps and writes grows with the columns, and more passes make up for it.
NARROW = 3
# Blocks of small matrices are wider, up to this many columns and bytes: a pass costs its jobs, not its columns.
WIDE, WIDE_BYTES = 64, 8 * 1024 * 1024
# The driver holds square matrices of this side at most.
MOST_BASIS = 4096

# Accepted solver names. "lapack" finds all triplets, the others stand for the bidiagonalization.
SOLVERS = ("auto", "cross", "lapack", "cyclic", "lanczos", "trlanczos", "krylov")

# Directions of a new block below this share of its norm (squared) are rounding noise.
_NOISE = 1e-13
# Singular values below this share of the largest are rounding noise.
_ZERO = 1e-13
# The smallest components are measured against no less than this share of the largest (squared): rounding in a pass.
_FLOOR = 1e-7


class ConvergenceError(RuntimeError):
    """The solver stopped before every wanted component had converged."""


@dataclass(frozen=True)
class SvdResult:
    """Factors as tables: ``u`` and ``v`` are ``(i, features)``, ``sigma`` is ``(component, sigma)``.

    Only converged components are in the factors. ``v`` is None unless asked for. ``report`` has one
    row: which, n, cells, k, passes, restarts, tolerance, converged components and the largest
    relative residual. ``components`` has the residual and the convergence flag of each component
    that was found.
    """

    u: DataFrame
    v: DataFrame | None
    sigma: DataFrame
    report: DataFrame
    components: DataFrame
    values: list[float]


def svd(
    matrix: DataFrame,
    k: int,
    value_col: str = "ppmi",
    n: int | None = None,
    which: str = "largest",
    method: str = "auto",
    tol: float = 1e-8,
    max_passes: int = 100,
    block: int | None = None,
    max_basis: int | None = None,
    right_vectors: bool = False,
    allow_unconverged: bool = False,
    seed: int = 7,
    resume: str | None = None,
    release: Callable[[], None] | None = None,
) -> SvdResult:
    """The ``k`` largest (or smallest) singular triplets of the square matrix ``(i, j, value)``.

    Fewer than ``k`` of the largest come back when the matrix has a lower rank. If others have not
    converged after ``max_passes`` a :class:`ConvergenceError` says so; with ``allow_unconverged``
    the converged ones come back without them. Every order takes the same way. ``method`` accepts
    the names of solvers that callers may know: ``lapack`` rotates all columns against each other until all are
    orthogonal (:func:`pairloom.operators.jacobi.all_triplets`), which gives every triplet and is dense work; all
    other names mean the bidiagonalization.

    ``matrix`` should be a stored table with unique cells; rows without cells are allowed. ``n``
    defaults to the highest index plus one. The basis of left vectors ``V`` grows by one block of ``block``
    columns a pass, and the images ``W = A' V`` are kept beside it. The triangle ``R`` of ``W = U R`` is the block
    bidiagonal matrix of that basis up to rounding; it is measured by a tree of QR steps, not summed up from squares, so
    the small singular values are as exact as the large ones, to rounding of the largest. When no new direction is left, a
    random block outside of the basis shows whether anything but zero lies there. A component has
    converged when ``|A A' u - s^2 u|``, measured on the final vectors, is at most ``tol * s^2`` (for the smallest,
    at most ``tol`` times the larger of ``s^2`` and 1e-7 of the largest squared). The basis restarts at ``max_basis``
    columns from its best vectors. Signs are fixed: the entry of largest magnitude of each left
    vector is positive.

    The smallest triplets: up to an order of 4,096 the basis may grow to the whole space, so they are always found.
    Of larger matrices they converge when they stand apart from the rest; else the error says so, and
    ``lapack`` is the other way.

    With ``resume``, a folder that every executor can reach and that outlives the application, the solver keeps its
    state there before each pass. When the folder holds a state, the call goes on from it, so a lost driver or too few
    passes cost one pass; ``passes`` in the report counts those of all calls. Matrix, ``k``, ``which``, ``block`` and ``seed`` must be the
    same, or it is an error; ``max_passes``, ``tol`` and ``max_basis`` may change. The folder also holds the factors. It
    is never removed here, and two calls may not use it at once. ``lapack`` keeps no state.

    ``release`` is called once ``matrix`` has been packed and is read no more, so a caller can remove a table that was made
    for it before the passes write theirs (``lapack`` does not call it).
    """
    if which not in ("largest", "smallest"):
        raise ValueError(f"unknown which {which!r}")
    if method not in SOLVERS:
        raise ValueError(f"unknown method {method!r}")
    if resume and method == "lapack":
        raise ValueError("lapack keeps no state to resume from")
    spark = matrix.sparkSession
    index = [required(F.col(name), name).alias(name) for name in ("i", "j")]
    cells = matrix.select(*index, required(F.col(value_col), value_col).alias("value"))
    facts = cells.agg(
        F.count_if(F.col("value") != 0).alias("cells"),
        F.greatest(F.max("i"), F.max("j")).alias("top"),
        F.least(F.min("i"), F.min("j")).alias("bottom"),
        F.sum(F.col("value") * F.col("value")).alias("squares"),
    ).first()
    cells = cells.filter(F.col("value") != 0)
    top = -1 if facts["top"] is None else facts["top"]
    n = top + 1 if n is None else n
    if top >= n or (facts["bottom"] or 0) < 0:
        raise ValueError(f"index outside 0..{n - 1}: {facts['bottom']}..{top}")
    if not 1 <= k <= n:
        raise ValueError(f"k must be between 1 and the matrix order {n}")

    if method == "lapack":
        return _from_all(cells, n, facts["cells"], facts["squares"] or 0.0, k, which, tol, max_passes, right_vectors)
    log = Journal(spark, resume) if resume else None
    state = log.last() if log else None
    width = min(n, block or (int(state["of"][4]) if state else _width(n, k)))
    basis = max(max_basis or 16 * (width if block else max(width, k + OVERSAMPLE)), k + 2 * width)
    if which == "smallest" and not max_basis:
        basis = max(basis, n)
    basis = min(basis, MOST_BASIS)
    if min(n, k + 2 * width) > basis:
        raise ValueError(f"k = {k} with blocks of {width} columns needs a basis of more than {MOST_BASIS} columns")
    parallelism = spark.sparkContext.defaultParallelism
    of = np.array([n, facts["cells"], facts["squares"] or 0.0, k, width, which == "smallest", seed], dtype=float)
    if state is not None and not np.allclose(state["of"], of, rtol=1e-9, atol=0):
        raise ValueError(f"{resume} holds the state of another matrix or of other settings")
    grid = Grid.plan(n, facts["cells"], width, parallelism) if state is None else Grid(n, int(state["side"]))
    store = BlockStore(spark, grid, f"{log.folder}/blocks" if log else None)
    # Rows of tiles and blocks are large: as many as fit a batch would be held several times over by a task.
    with small_batches(spark):
        return _solved(cells, facts, store, k, which, width, basis, tol, max_passes, seed, right_vectors, allow_unconverged, parallelism, log, state, of, release)


def _width(n: int, k: int) -> int:
    """Columns of a block."""
    wide = max(k + OVERSAMPLE, min(WIDE, WIDE_BYTES // (8 * n)))
    return wide if 8 * n * wide <= BROADCAST_BYTES else k + NARROW


def _solved(
    cells: DataFrame,
    facts: Row,
    store: BlockStore,
    k: int,
    which: str,
    width: int,
    basis: int,
    tol: float,
    max_passes: int,
    seed: int,
    right_vectors: bool,
    allow_unconverged: bool,
    parallelism: int,
    log: Journal | None,
    state: dict | None,
    of: np.ndarray,
    release: Callable[[], None] | None,
) -> SvdResult:
    """The triplets by bidiagonalization; see :func:`svd`."""
    spark, grid, packed = store.spark, store.grid, None
    if not log and bl.shuffled(grid, facts["cells"], parallelism, max(width, k)):
        tiles = bl.cells_laid_out(cells, grid, facts["cells"], parallelism)
    else:
        packed = _packed_tiles(cells, grid, facts["cells"], parallelism, log, state)
        tiles = bl.laid_out(packed.df, grid, facts["cells"], parallelism, max(width, k))
    if release:
        release()
    if _leaves_much(grid, width):
        free_shuffles(spark)
    try:
        solver = _Bidiagonal(tiles, store, width, k, which, tol, seed, parallelism)
        if log:
            solver.keep_in(log, of)
        if state is not None:
            solver.restore(state)
        else:
            solver.start()
        solver.run(max_passes, basis)
        sigma, factors = solver.components()
        found, residual = len(sigma), np.empty(0)
        left = image = None
        if found:
            left = store.write(store.combine(solver.by_block(solver.basis, factors)), found)
            image = store.write(store.combine(solver.by_block(solver.images, factors)), found)
            residual = solver.measured_residual(left, image, sigma)
        done = residual <= tol
        wanted = k if which == "smallest" or not solver.exhausted else found
        if not allow_unconverged and (found < wanted or not done.all()):
            raise ConvergenceError(
                f"{int(done.sum())} of {wanted} components converged to {tol} in {solver.passes} passes; "
                "raise max_passes, block or tol, or take the converged ones with allow_unconverged"
            )
        if done.any() and not done.all():
            chosen = np.eye(found)[:, done]
            left, image = (store.write(store.combine({x: chosen}), int(done.sum())) for x in (left, image))
        store.drop(*solver.basis, *solver.images)
        facts = (which, grid.n, facts["cells"], solver.k, solver.passes, solver.restarts, max_passes, float(tol))
        return _result(store, left, image, right_vectors, sigma, residual, tol, solver.top, facts)
    finally:
        tiles.release()
        if packed is not None and not log:
            packed.drop()


def _leaves_much(grid: Grid, width: int) -> bool:
    """Whether passes shuffle enough to look after the files; those of small blocks leave little behind."""
    return 8 * grid.n * width > WIDE_BYTES


def _packed_tiles(cells: DataFrame, grid: Grid, count: int, parallelism: int, log: Journal | None, state: dict | None) -> Staged:
    """Written tiles; those of a resumed computation are there already."""
    tiles = bl.tile_table(cells, grid, count, parallelism)
    if not log:
        return stage(tiles, "svd-tiles", large_rows=True)
    path = f"{log.folder}/tiles"
    if state is None:
        of_large_rows(tiles.write.mode("overwrite")).parquet(path)
    return Staged(cells.sparkSession.read.schema(tiles.schema).parquet(path), path)


def _result(
    store: BlockStore,
    left: int | None,
    image: int | None,
    right_vectors: bool,
    sigma: np.ndarray,
    residual: np.ndarray,
    tol: float,
    top: float,
    facts: tuple,
) -> SvdResult:
    """Tables of the converged components; ``left`` and ``image`` hold these only, ``sigma`` and ``residual`` all that were found."""
    spark, grid = store.spark, store.grid
    done = residual <= tol
    values, k = sigma[done], int(done.sum())
    none = spark.createDataFrame([], "i int, features array<double>")
    signs = bl.column_signs(store.read(left), grid, k) if k else np.empty(0)
    right = none if right_vectors else None
    if right_vectors and k:
        floor = max(top, 1e-300) * _ZERO
        scale = np.where(values > floor, signs / np.maximum(values, floor), 0.0)
        every = store.read(image).select("block", "data").unionByName(bl.random_blocks(spark, grid, k, 0.0, 0))
        right = bl.vectors(bl._sum_blocks(every), grid, scale)
    rows = [(c, float(s), float(r), bool(r <= tol)) for c, (s, r) in enumerate(zip(sigma, residual, strict=True))]
    report_schema = (
        "which string, n int, cells long, k int, passes int, restarts int, max_passes int, "
        "tol double, converged int, max_residual double"
    )
    return SvdResult(
        u=bl.vectors(store.read(left), grid, signs) if k else none,
        v=right,
        sigma=spark.createDataFrame([(c, float(s)) for c, s in enumerate(values)], "component int, sigma double"),
        report=spark.createDataFrame([(*facts, k, float(residual.max(initial=0.0)))], report_schema),
        components=spark.createDataFrame(rows, "component int, sigma double, residual double, converged boolean"),
        values=[float(s) for s in values],
    )


def _from_all(cells: DataFrame, n: int, count: int, squares: float, k: int, which: str, tol: float, max_passes: int, right_vectors: bool) -> SvdResult:
    """The wanted of all triplets; see :func:`pairloom.operators.jacobi.all_triplets`."""
    spark = cells.sparkSession
    held, columns, sigma, places = all_triplets(cells, n, squares)
    top = float(sigma.max(initial=0.0))
    if which == "smallest":
        sigma, places = sigma[::-1][:k], places[::-1][:k]
    else:
        some = sigma[:k] > max(top, 1e-300) * _ZERO
        sigma, places = sigma[:k][some], places[:k][some]
    store = BlockStore(spark, Grid.plan(n, count, max(1, len(sigma)), spark.sparkContext.defaultParallelism))
    left = image = None
    if len(sigma):
        left, image = (store.write(chosen_columns(held.df, columns, places, store.grid, rotations), len(sigma)) for rotations in (True, False))
    held.drop()
    # Columns that overlap no more are singular vectors to rounding.
    facts = (which, n, count, k, 0, 0, max_passes, float(tol))
    return _result(store, left, image, right_vectors, sigma, np.zeros(len(sigma)), tol, top, facts)


class _Bidiagonal:
    """Left basis vectors with their images, the basis' Gram matrix and its projection of ``A A'``.

    Basis and images are written tables. The Gram matrix is measured, not assumed to be the identity, so rounding in
    a block's orthogonalization is corrected in the small problems. The projection only guides the
    iteration; values and vectors that leave it come from the measured triangle of the images.
    """

    def __init__(self, tiles: bl.Tiles, store: BlockStore, width: int, k: int, which: str, tol: float, seed: int, parallelism: int):
        self.tiles, self.store, self.k, self.which, self.tol = tiles, store, k, which, tol
        self.width, self.seed, self.parallelism = width, seed, parallelism
        self.basis, self.images = [], []
        self.gram = np.zeros((0, 0))
        self.projection = np.zeros((0, 0))
        self.passes = self.restarts = 0
        self.exhausted = False
        self.log = None

    def start(self) -> None:
        """A random block as the whole basis."""
        self.basis = [self.store.write(self._noise(self.seed), self.width)]

    def _noise(self, seed: int, width: int | None = None) -> DataFrame:
        grid, width = self.store.grid, width or self.width
        noise = bl.random_blocks(self.store.spark, grid, width, 1.0 / np.sqrt(grid.n), seed)
        if self.which == "largest":
            # Rows without cells stay exactly zero.
            touched = bl.multiply(self.tiles, noise, grid, width, transposed=False, every_block=True)
            noise = bl.random_rows(touched, grid, width, seed + 1)
        return noise

    def keep_in(self, log: Journal, of: np.ndarray) -> None:
        """Write the state before every pass; ``of`` tells what it is the state of."""
        self.log, self.of = log, of

    def _keep(self) -> None:
        tables = [*self.basis, *self.images]
        whole = {
            "of": self.of,
            "side": self.store.grid.side,
            "basis": self.basis,
            "images": self.images,
            "widths": [self.store.widths[seq] for seq in tables],
            "counts": [self.store.next, self.passes, self.restarts, self.fresh, self.exhausted],
            "gram": self.gram,
            "projection": self.projection,
        }
        self.log.write({name: np.asarray(value) for name, value in whole.items()})
        # Tables of earlier states are read by nothing any more.
        self.store.forget_dropped()

    def restore(self, state: dict[str, np.ndarray]) -> None:
        self.basis, self.images = ([int(seq) for seq in state[name]] for name in ("basis", "images"))
        self.store.widths = {seq: int(w) for seq, w in zip([*self.basis, *self.images], state["widths"], strict=True)}
        self.store.next, self.passes, self.restarts, self.fresh, exhausted = (int(x) for x in state["counts"])
        self.exhausted = bool(exhausted)
        self.gram, self.projection = state["gram"], state["projection"]

    def components(self) -> tuple[np.ndarray, np.ndarray]:
        """Singular values to return, and their vectors in terms of the basis: of the largest only those that are not zero."""
        sigma, vectors = self._measured()
        self.top = float(sigma.max(initial=0.0))
        count = min(self.k, len(sigma))
        if self.which == "largest":
            count = min(count, int((sigma > max(self.top, 1e-300) * _ZERO).sum()))
        return sigma[:count], vectors[:, :count]

    def _measured(self) -> tuple[np.ndarray, np.ndarray]:
        """All singular values of the basis from the triangle of its images, wanted ones first, and their vectors."""
        whiten = _whitening(self.gram, np.diag(self.gram))
        if not whiten.shape[1]:
            return np.empty(0), whiten
        triangle = self.store.triangular(self.images, self.parallelism) @ whiten
        _, sigma, vectors = np.linalg.svd(triangle)
        order = np.argsort(sigma) if self.which == "smallest" else np.argsort(-sigma)
        return sigma[order], (whiten @ vectors.T)[:, order]

    def _scale(self, theta: np.ndarray) -> np.ndarray:
        return np.maximum(theta, max(self.top_theta, 1e-300) * (_FLOOR if self.which == "smallest" else 1e-14))

    def measured_residual(self, left: int, image: int, sigma: np.ndarray) -> np.ndarray:
        """``|A A' u - s^2 u|`` of the final vectors against ``s^2``, by half a pass more."""
        store, count = self.store, len(sigma)
        back = store.write(bl.multiply(self.tiles, store.read(image), store.grid, count, transposed=False, every_block=True), count)
        rest = store.write(store.combine({back: np.eye(count), left: -np.diag(sigma**2)}), count)
        squares = np.diag(store.inner([rest], [rest])[rest, rest])
        store.drop(back, rest)
        return np.sqrt(np.maximum(squares, 0.0)) / self._scale(sigma**2)

    def run(self, max_passes: int, max_basis: int) -> None:
        while True:
            if self.log:
                self._keep()
            self._tidy()
            image, coefficients, norm, remainder = self._extend()
            full = len(self.theta) == self.k
            if full and (self.residual <= self.tol * self._scale(self.theta)).all() and (self.which == "smallest" or self.theta.min() > self.top_theta * _NOISE):
                break
            whiten = _whitening(remainder, norm)
            self.exhausted = whiten.shape[1] == 0
            if self.passes >= max_passes:
                break
            if self.exhausted:
                self.store.drop(image)
                image = None
                # What the fresh block maps to tells what is left outside; nothing new means that there is no outside.
                if self._is_null() or not self._append_fresh(max_basis):
                    break
                continue
            if len(self.gram) + whiten.shape[1] > max_basis:
                block = self._new_block(image, coefficients, whiten)
                self._restart()
            else:
                block = self._new_block(image, coefficients, whiten)
            self.basis.append(block)
        if image is not None:
            self.store.drop(image)

    def _tidy(self) -> None:
        if _leaves_much(self.store.grid, self.width):
            free_shuffles(self.store.spark)

    def _new_block(self, image: int, coefficients: np.ndarray, whiten: np.ndarray) -> int:
        factors = self.by_block(self.basis, -coefficients @ whiten) | {image: whiten}
        block = self.store.write(self.store.combine(factors), whiten.shape[1])
        self.store.drop(image)
        return block

    def _is_null(self) -> bool:
        """Whether the newest block maps to nothing but rounding noise."""
        width = self.store.widths[self.basis[-1]]
        newest = np.diag(self.projection)[-width:] / np.maximum(np.diag(self.gram)[-width:], 1e-300)
        return self.fresh == self.basis[-1] and newest.max(initial=0.0) <= self.top_theta * len(self.gram) * 1e-28

    fresh = -1

    def _append_fresh(self, max_basis: int) -> bool:
        """Random vectors outside of the basis as its next block; False when it spans the whole space."""
        store, grid = self.store, self.store.grid
        width = min(self.width, grid.n - len(self.gram), max_basis - len(self.gram))
        if width <= 0:
            return False
        block = store.write(self._noise(self.seed + 100 + self.passes, width), width)
        inverse = _whitening(self.gram, np.diag(self.gram))
        for _ in range(2):
            products = store.inner([*self.basis, block], [block])
            overlap = np.vstack([products[s, block] for s in self.basis])
            coefficients = inverse @ (inverse.T @ overlap)
            norm = products[block, block]
            remainder = norm - overlap.T @ coefficients
            whiten = _whitening((remainder + remainder.T) / 2, np.diag(norm))
            if not whiten.shape[1]:
                store.drop(block)
                return False
            block = self._new_block(block, coefficients, whiten)
        self.basis.append(block)
        self.fresh = block
        return True

    def _extend(self) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """Map the newest block by ``A'`` and back by ``A``, and solve the small eigenproblem again."""
        store, last = self.store, self.basis[-1]
        width = store.widths[last]
        half = store.write(bl.multiply(self.tiles, store.read(last), store.grid, width, transposed=True), width)
        self.images.append(half)
        self._tidy()
        image = store.write(bl.multiply(self.tiles, store.read(half), store.grid, width, transposed=False), width)
        self.passes += 1
        products = store.inner([*self.basis, image], [last, image])
        self.gram = _border(self.gram, np.vstack([products[s, last] for s in self.basis]))
        overlap = np.vstack([products[s, image] for s in self.basis])
        self.projection = _border(self.projection, overlap)

        whiten = _whitening(self.gram, np.diag(self.gram))
        small = whiten.T @ self.projection @ whiten
        theta, vectors = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(theta) if self.which == "smallest" else np.argsort(-theta)
        ritz = whiten @ vectors[:, order]
        self.theta, self.top_theta = np.maximum(theta[order][: self.k], 0.0), float(theta.max(initial=0.0))

        coefficients = whiten @ (whiten.T @ overlap)
        norm = products[image, image]
        remainder = norm - overlap.T @ coefficients
        # The basis spans all earlier images, so the newest one's remainder is the whole residual.
        newest = ritz[-width:, : self.k]
        squares = np.einsum("ak,ab,bk->k", newest, remainder, newest)
        self.residual = np.sqrt(np.maximum(squares, 0.0))
        return image, coefficients, np.diag(norm), (remainder + remainder.T) / 2

    def _restart(self) -> None:
        """Replace the basis by its best vectors, and the images by theirs."""
        sigma, vectors = self._measured()
        keep = min(len(sigma), self.k + self.store.widths[self.basis[-1]])
        best = [self.store.write(self.store.combine(self.by_block(tables, vectors[:, :keep])), keep) for tables in (self.basis, self.images)]
        self.store.drop(*self.basis, *self.images)
        self.basis, self.images = [best[0]], [best[1]]
        self.gram, self.projection = np.eye(keep), np.diag(sigma[:keep] ** 2)
        self.restarts += 1

    def by_block(self, tables: list[int], factors: np.ndarray) -> dict[int, np.ndarray]:
        ends = np.cumsum([self.store.widths[seq] for seq in tables])[:-1]
        return dict(zip(tables, np.split(factors, ends)))


def _border(square: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Extend a symmetric matrix by new columns and their mirror image."""
    old = len(square)
    out = np.zeros((len(columns), len(columns)))
    out[:old, :old] = square
    out[:, old:] = columns
    out[old:, :old] = columns[:old].T
    out[old:, old:] = (columns[old:] + columns[old:].T) / 2
    return out


def _whitening(gram: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """``F`` with ``F' gram F = I``, leaving out directions that are noise against ``squares``."""
    scale = 1.0 / np.sqrt(np.maximum(squares, 1e-300))
    values, vectors = np.linalg.eigh(gram * scale[:, None] * scale[None, :])
    kept = values > _NOISE
    return scale[:, None] * vectors[:, kept] / np.sqrt(values[kept])


def matrix_size(matrix: DataFrame) -> int:
    """Highest index plus one, zero for an empty matrix."""
    top = matrix.agg(F.greatest(F.max("i"), F.max("j")).alias("top")).first()["top"]
    return 0 if top is None else top + 1


def embeddings(result: SvdResult, power: float = 0.0) -> DataFrame:
    """Left vectors ``(i, features)``, column ``c`` times ``sigma[c] ** power``; 0.5 weights by the root."""
    if power == 0:
        return result.u
    weights = F.array(*[F.lit(float(s) ** power) for s in result.values])
    return result.u.select("i", F.zip_with("features", weights, lambda x, w: x * w).alias("features"))


def to_long(vectors: DataFrame) -> DataFrame:
    """``(component, i, value)`` form of an embedding table."""
    return vectors.select("i", F.posexplode("features").alias("component", "value")).select("component", "i", "value")


def reconstruct(cells: DataFrame, result: SvdResult) -> DataFrame:
    """Value of ``U S V'`` at the given cells: the cell columns plus ``approximation``."""
    if result.v is None:
        raise ValueError("reconstruct needs svd(..., right_vectors=True)")
    left = embeddings(result, 1.0).select("i", F.col("features").alias("left"))
    right = result.v.select(F.col("i").alias("j"), F.col("features").alias("right"))
    joined = cells.join(left, "i").join(right, "j")
    return joined.select(*cells.columns, dot(F.col("left"), F.col("right")).alias("approximation"))
