from __future__ import annotations

import importlib
import os

import numpy as np
import pyarrow.parquet as pq
import pytest

import pairloom as pl
from pairloom.operators import blocks
from pairloom.scratch import stage

# The package's own name of the module is the function.
svd = importlib.import_module("pairloom.operators.svd")


def frame(spark, a):
    i, j = np.nonzero(a)
    rows = [(int(x), int(y), float(a[x, y])) for x, y in zip(i, j)]
    return spark.createDataFrame(rows, "i int, j int, ppmi double").repartition(4).cache()


def dense(vectors):
    return np.array([r["features"] for r in vectors.orderBy("i").collect()])


def random_sparse(n, density, seed):
    rng = np.random.default_rng(seed)
    return rng.random((n, n)) * (rng.random((n, n)) < density)


def check(spark, a, result, k, which="largest", tol=1e-7):
    u, sigma, v = dense(result.u), np.array(result.values), dense(result.v)
    exact = np.linalg.svd(a, compute_uv=False)
    want = exact[:k] if which == "largest" else exact[::-1][:k]
    np.testing.assert_allclose(sigma, want, atol=tol * exact[0])
    np.testing.assert_allclose(u.T @ u, np.eye(k), atol=1e-8)
    np.testing.assert_allclose(a @ v, u * sigma, atol=10 * tol * exact[0])
    np.testing.assert_allclose(a.T @ u, v * sigma, atol=10 * tol * exact[0])
    assert (u[np.abs(u).argmax(axis=0), range(k)] > 0).all()


@pytest.mark.parametrize("method", ["cross", "trlanczos"])
def test_largest(spark, method):
    a = random_sparse(150, 0.1, 1)
    result = pl.svd(frame(spark, a), 6, n=150, method=method, block=24, right_vectors=True)
    check(spark, a, result, 6)
    report = result.report.first()
    assert report["converged"] == 6 and report["n"] == 150 and report["max_residual"] <= 1e-8


def test_shuffled_blocks_give_the_same(spark, monkeypatch):
    """Without broadcasts, with many blocks, tiny tiles and tiny combine buffers."""
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(blocks, "SMALL_TILE_CELLS", 200)
    monkeypatch.setattr(blocks, "TILE_CELLS", 150)
    monkeypatch.setattr(blocks, "COMBINE_BYTES", 1)
    monkeypatch.setattr(blocks, "DRIVER_BYTES", 0)
    monkeypatch.setattr(blocks, "_PRODUCT_TERMS", 100)
    a = random_sparse(131, 0.2, 2)
    result = pl.svd(frame(spark, a), 4, n=131, method="lanczos", block=16, right_vectors=True)
    check(spark, a, result, 4)


@pytest.mark.parametrize("transposed", [False, True])
def test_only_rows_that_tiles_refer_to_are_sent(spark, transposed, monkeypatch):
    """What a pass moves follows the cells, not the square of the order."""
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(blocks, "SEND_BYTES", 2000)
    n, columns, side = 3000, 3, 12
    rng = np.random.default_rng(5)
    i, j = rng.integers(0, n, 400), np.concatenate([rng.integers(0, n, 200), np.full(200, 7)])
    a = np.zeros((n, n))
    a[i, j] = rng.random(400)
    i, j = np.nonzero(a)
    grid = blocks.Grid(n, side)
    cells = spark.createDataFrame([(int(x), int(y), float(a[x, y])) for x, y in zip(i, j)], "i int, j int, value double")
    packed = blocks.tile_table(cells, grid, len(i), 4).cache()
    tiles = blocks.laid_out(packed, grid, len(i), 4, columns)
    store = blocks.BlockStore(spark, grid)
    x = store.write(blocks.random_blocks(spark, grid, columns, 1.0, 3), columns)
    dense_x = dense(blocks.vectors(store.read(x), grid, np.ones(columns)))

    inward, outward = (i, j) if transposed else (j, i)
    wanted = len({(int(r), int(c) % side) for r, c in zip(inward, outward)})
    sent = blocks.sent_rows(tiles, store.read(x), grid, columns, transposed).collect()
    assert sum(len(r["slots"]) // 4 for r in sent) == tiles.wanted_rows[transposed] == wanted <= len(i)
    assert sum(len(r["data"]) for r in sent) == wanted * columns * 8
    assert len({(r["source"], r["target"]) for r in sent}) == len(sent)

    product = blocks.multiply(tiles, store.read(x), grid, columns, transposed, every_block=True)
    have = dense(blocks.vectors(product, grid, np.ones(columns)))
    np.testing.assert_allclose(have, (a.T if transposed else a) @ dense_x, atol=1e-12)
    some = blocks.multiply(tiles, store.read(x), grid, columns, transposed)
    assert {r["block"] for r in some.collect()} == {int(o) % side for o in outward}
    tiles.release()


def test_partial_rows_in_limited_memory(monkeypatch):
    monkeypatch.setattr(blocks, "COMBINE_BYTES", 400)
    rng = np.random.default_rng(6)
    terms, want = [], np.zeros((3, 20, 2))
    for _ in range(60):
        block, slots = int(rng.integers(3)), np.sort(rng.choice(20, 5, replace=False)).astype(np.int32)
        terms.append((block, slots, rng.random((5, 2))))
        want[block, slots] += terms[-1][2]
    have, rows = np.zeros((3, 20, 2)), 0
    for batch in blocks._partial_rows(iter(terms)):
        block, slots, data = (c[0].as_py() for c in batch.columns)
        have[block, np.frombuffer(slots, np.int32)] += np.frombuffer(data).reshape(-1, 2)
        rows += 1
    np.testing.assert_allclose(have, want)
    assert rows < 60


def test_resume_after_a_stop(spark, tmp_path):
    a = random_sparse(200, 0.1, 6)
    cells, folder = frame(spark, a), str(tmp_path / "state")
    options = {"n": 200, "block": 8, "max_basis": 40, "right_vectors": True}
    whole = pl.svd(cells, 4, **options)
    assert whole.report.first()["restarts"] > 0
    with pytest.raises(pl.ConvergenceError):
        pl.svd(cells, 4, max_passes=5, resume=folder, **options)
    # A half-written table of the stopped run is in the way, and its last state was never finished.
    (tmp_path / "state" / "blocks" / "seq=13").mkdir(exist_ok=True)
    (tmp_path / "state" / "state-00000099").mkdir()
    result = pl.svd(cells, 4, resume=folder, **options)
    check(spark, a, result, 4)
    first, second = whole.report.first(), result.report.first()
    assert (first["passes"], first["restarts"]) == (second["passes"], second["restarts"])
    np.testing.assert_allclose(result.values, whole.values, rtol=1e-10)
    # A finished computation gives its result again after one pass.
    again = pl.svd(cells, 4, resume=folder, **options)
    assert again.report.first()["passes"] == second["passes"]
    np.testing.assert_allclose(again.values, whole.values, rtol=1e-10)


def test_resume_wants_the_same_matrix(spark, tmp_path):
    a = random_sparse(60, 0.2, 6)
    folder = str(tmp_path / "state")
    pl.svd(frame(spark, a), 2, n=60, resume=folder)
    with pytest.raises(ValueError, match="another matrix"):
        pl.svd(frame(spark, a * 1.001), 2, n=60, resume=folder)
    with pytest.raises(ValueError, match="another matrix"):
        pl.svd(frame(spark, a), 3, n=60, resume=folder)
    with pytest.raises(ValueError, match="no state"):
        pl.svd(frame(spark, a), 2, n=60, method="lapack", resume=folder)


def test_restart(spark):
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.standard_normal((120, 120)))
    p, _ = np.linalg.qr(rng.standard_normal((120, 120)))
    a = q @ np.diag(10 * 0.93 ** np.arange(120)) @ p
    result = pl.svd(frame(spark, a), 2, n=120, method="krylov", block=8, max_basis=24, right_vectors=True)
    assert result.report.first()["restarts"] > 0
    check(spark, a, result, 2)


def test_unconverged_components_are_no_result(spark):
    a = random_sparse(200, 0.1, 6)
    cells = frame(spark, a)
    with pytest.raises(pl.ConvergenceError):
        pl.svd(cells, 5, n=200, block=8, max_passes=2)
    # The first stands apart and needs fewer passes than the others.
    result = pl.svd(cells, 5, n=200, block=8, max_passes=11, allow_unconverged=True, right_vectors=True)
    report = result.report.first()
    assert report["passes"] == 11 and 0 < report["converged"] < 5 and report["max_residual"] > 1e-8
    flags = [r["converged"] for r in result.components.orderBy("component").collect()]
    assert len(flags) == 5 and flags.count(True) == report["converged"] == len(result.values)
    u = dense(result.u)
    assert u.shape == (200, len(result.values))
    np.testing.assert_allclose(u.T @ u, np.eye(u.shape[1]), atol=1e-8)


def test_residuals_are_measured(spark):
    a = random_sparse(50, 0.4, 15)
    result = pl.svd(frame(spark, a), 50, n=50, tol=1e-5)
    u, sigma = dense(result.u), np.array(result.values)
    rest = np.linalg.norm(a @ (a.T @ u) - u * sigma**2, axis=0) / sigma**2
    told = np.array([r["residual"] for r in result.components.orderBy("component").collect()])
    assert (told > 0).all() and (told < 1e-5).all()
    assert (np.abs(np.log10(told + 1e-14) - np.log10(rest + 1e-14)) < 2).all()


@pytest.mark.parametrize("n", [200, 1000, 1100])
@pytest.mark.parametrize("method", ["auto", "cross", "lapack", "cyclic", "lanczos", "trlanczos", "krylov"])
def test_fewer_triplets_than_asked_for(spark, n, method):
    if n != 200 and method not in ("auto", "lapack"):
        pytest.skip("every name stands for the same solver")
    rng = np.random.default_rng(11)
    a = np.zeros((n, n))
    a[:150, :150] = rng.random((150, 3)) @ rng.random((3, 150))
    result = pl.svd(frame(spark, a), 5, n=n, method=method, right_vectors=True)
    assert len(result.values) == 3
    check(spark, a, result, 3)


def test_smallest(spark):
    a = random_sparse(60, 0.3, 7)
    result = pl.svd(frame(spark, a), 4, n=60, which="smallest", right_vectors=True)
    check(spark, a, result, 4, "smallest")
    wide = pl.svd(frame(spark, a), 2, n=60, which="smallest", block=60)
    np.testing.assert_allclose(wide.values, result.values[:2], atol=1e-6)


def test_smallest_that_stand_apart(spark):
    n = 1500
    rng = np.random.default_rng(17)
    values = np.concatenate([[0.5, 0.9, 1.3], 4 + rng.random(n - 3)])
    a = np.diag(rng.permutation(values))
    a[np.arange(n - 1), np.arange(1, n)] = 1e-3 * rng.random(n - 1)
    result = pl.svd(frame(spark, a), 3, n=n, which="smallest", right_vectors=True)
    check(spark, a, result, 3, "smallest")


@pytest.mark.parametrize("which", ["smallest", "largest"])
def test_both_ends_of_a_random_sparse_matrix(spark, which):
    a = random_sparse(400, 0.05, 21)
    result = pl.svd(frame(spark, a), 3, n=400, which=which, right_vectors=True)
    check(spark, a, result, 3, which, tol=1e-9)
    exact = np.linalg.svd(a, compute_uv=False)
    want = exact[:3] if which == "largest" else exact[::-1][:3]
    np.testing.assert_allclose(result.values, want, rtol=1e-7)


def test_smallest_that_do_not_converge(spark, monkeypatch):
    """With a basis that may not hold the whole space."""
    a = random_sparse(300, 0.1, 8)
    with pytest.raises(pl.ConvergenceError):
        pl.svd(frame(spark, a), 3, n=300, which="smallest", block=8, max_basis=40, max_passes=12)


def test_values_far_below_the_largest(spark):
    """Nothing is squared: values down to 1e-12 of the largest are right."""
    rng = np.random.default_rng(3)
    q, r = (np.linalg.qr(rng.standard_normal((90, 90)))[0] for _ in range(2))
    sigma = np.concatenate([[1.0, 1e-3, 1e-5, 1e-7, 1e-9, 1e-11, 1e-12], np.zeros(83)])
    a = (q * sigma) @ r.T
    for method in ("trlanczos", "lapack"):
        result = pl.svd(frame(spark, a), 7, n=90, method=method, tol=1.0)
        np.testing.assert_allclose(result.values, sigma[:7], atol=3e-15)


@pytest.mark.parametrize("n", [5, 97])
def test_all_triplets(spark, n):
    a = random_sparse(n, 0.2, 30)
    a[:, 1] = a[:, 0]
    a[2] = 0
    result = pl.svd(frame(spark, a), n, n=n, method="lapack", which="smallest", right_vectors=True)
    u, exact = dense(result.u), np.linalg.svd(a, compute_uv=False)[::-1]
    np.testing.assert_allclose(result.values, exact, atol=1e-12 * exact[-1])
    np.testing.assert_allclose(u.T @ u, np.eye(n), atol=1e-10)
    np.testing.assert_allclose((u * result.values) @ dense(result.v).T, a, atol=1e-10)
    few = pl.svd(frame(spark, a), min(4, n - 2), n=n, method="lapack")
    # Of the largest, those that are zero are left out.
    np.testing.assert_allclose(few.values, [s for s in exact[::-1][: min(4, n - 2)] if s > 1e-12], rtol=1e-10)


def test_fifty_components_of_a_flat_spectrum(spark):
    """As many as the usual embeddings have, with restarts."""
    a = random_sparse(400, 0.1, 12)
    result = pl.svd(frame(spark, a), 50, n=400, right_vectors=True, max_basis=200)
    check(spark, a, result, 50)
    assert result.report.first()["restarts"] > 0


def test_full_rank_and_reconstruction(spark):
    a = random_sparse(40, 0.4, 8)
    cells = frame(spark, a)
    result = pl.svd(cells, 40, n=40, right_vectors=True)
    check(spark, a, result, 40)
    for row in pl.reconstruct(cells, result).collect():
        assert row["approximation"] == pytest.approx(row["ppmi"], abs=1e-9)


@pytest.mark.parametrize("method", ["lapack", "krylov"])
def test_rank_deficient_with_empty_rows(spark, method):
    rng = np.random.default_rng(9)
    a = np.zeros((80, 80))
    a[10:50, 5:60] = rng.random((40, 3)) @ rng.random((3, 55))
    result = pl.svd(frame(spark, a), 3, n=80, method=method, block=12, right_vectors=True)
    check(spark, a, result, 3)
    u = dense(result.u)
    assert u.shape == (80, 3)
    np.testing.assert_allclose(u[:10], 0, atol=1e-12)


@pytest.mark.parametrize("method", ["lapack", "krylov"])
def test_blocks_without_cells(spark, method, monkeypatch):
    monkeypatch.setattr(blocks, "SMALL_TILE_CELLS", 20)
    a = np.zeros((64, 64))
    a[1::4, 2::4] = random_sparse(16, 0.9, 14)
    result = pl.svd(frame(spark, a), 3, n=64, method=method, block=8, right_vectors=True)
    assert dense(result.u).shape == dense(result.v).shape == (64, 3)
    check(spark, a, result, 3)


def test_zero_matrix(spark):
    empty = spark.createDataFrame([(0, 1, 0.0)], "i int, j int, ppmi double")
    result = pl.svd(empty, 2, n=4, right_vectors=True)
    assert result.values == [] and result.u.count() == result.v.count() == 0


def test_weighting(spark):
    a = random_sparse(30, 0.4, 10)
    result = pl.svd(frame(spark, a), 5, n=30)
    u, sigma = dense(result.u), np.array(result.values)
    np.testing.assert_allclose(dense(pl.embeddings(result, 0.5)), u * np.sqrt(sigma))
    np.testing.assert_allclose(dense(pl.embeddings(result, 1.0)), u * sigma)
    assert pl.embeddings(result) is result.u
    long = pl.to_long(result.u).collect()
    assert len(long) == 150
    assert all(r["value"] == u[r["i"], r["component"]] for r in long)


def test_same_seed_same_result(spark):
    cells = frame(spark, random_sparse(60, 0.2, 12))
    first, second = (pl.svd(cells, 3, n=60, method="krylov", block=30) for _ in range(2))
    np.testing.assert_allclose(dense(first.u), dense(second.u), atol=1e-10)


def test_bad_arguments(spark):
    a = frame(spark, random_sparse(10, 0.5, 13))
    for options in ({"which": "middle"}, {"method": "magic"}, {"n": 5}):
        with pytest.raises(ValueError):
            pl.svd(a, 2, **options)
    with pytest.raises(ValueError):
        pl.svd(a, 11, n=10)
    with pytest.raises(ValueError):
        pl.svd(a, 3000, n=5000)
    with pytest.raises(Exception, match="null in"):
        pl.svd(spark.createDataFrame([(0, 1, None), (1, 1, 2.0)], "i int, j int, ppmi double"), 1)


def test_a_tile_is_not_cut_into_many_rows(spark):
    """Each row of a tile is read together with a whole block of the dense matrix."""
    n = 500
    cells = spark.range(n * n).selectExpr(f"cast(id div {n} as int) as i", f"cast(id % {n} as int) as j", "1.0 as value")
    tiles = blocks.tile_table(cells, blocks.Grid(n, 1), n * n, 1).coalesce(1).collect()
    assert sum(len(t["rows"]) // 4 for t in tiles) == n * n
    assert len(tiles) <= blocks._tile_parts(n * n, 1) * 2 and min(len(t["rows"]) // 4 for t in tiles) < blocks.TILE_CELLS


def test_inner_products_shuffle_each_table_once(spark, monkeypatch):
    """Tables on both sides, on one side only, and one without some of the blocks."""
    grid = blocks.Grid(200, 7)
    store = blocks.BlockStore(spark, grid)
    tables = [store.write(blocks.random_blocks(spark, grid, w, 1.0, w).filter(f"block % {w} < 3"), w) for w in (2, 3, 5)]
    arrays = {}
    for seq, w in zip(tables, (2, 3, 5)):
        arrays[seq] = np.zeros((200, w))
        for r in store.read(seq).collect():
            arrays[seq][grid.indexes(r["block"])] = np.frombuffer(r["data"]).reshape(-1, w)
    for limit in (blocks.BROADCAST_BYTES, 0):
        monkeypatch.setattr(blocks, "BROADCAST_BYTES", limit)
        for left, right in ((tables, tables[1:]), (tables[:1], tables[1:]), (tables[2:], tables[2:])):
            have = store.inner(left, right)
            assert set(have) == {(a, b) for a in left for b in right}
            for (a, b), product in have.items():
                np.testing.assert_allclose(product, arrays[a].T @ arrays[b], atol=1e-12)
    plan = store._products(tables, tables[1:])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("transposed", [False, True])
def test_rows_go_to_a_tile_once(spark, transposed, monkeypatch):
    """Not with each piece of it."""
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(blocks, "TILE_CELLS", 20)
    n, columns = 60, 3
    a = random_sparse(n, 0.5, 8)
    i, j = np.nonzero(a)
    cells = spark.createDataFrame([(int(x), int(y), float(a[x, y])) for x, y in zip(i, j)], "i int, j int, value double")
    grid = blocks.Grid(n, 2)
    # Pieces are cut between batches.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        packed = stage(blocks.tile_table(cells, grid, len(i), 2), "tiles").df
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    tiles = blocks.laid_out(packed, grid, len(i), 2, columns)
    tiles.df.cache()
    store = blocks.BlockStore(spark, grid)
    x = store.write(blocks.random_blocks(spark, grid, columns, 1.0, 1), columns)
    inward, outward = ("row_block", "col_block") if transposed else ("col_block", "row_block")
    sent = blocks.sent_rows(tiles, store.read(x), grid, columns, transposed).withColumnsRenamed({"source": inward, "target": outward})
    rows = blocks.met_rows(tiles, sent).select("row_block", "col_block", "piece", "data").collect()
    starts = packed.filter("piece = 0").count()
    assert sum(r["data"] is not None for r in rows) == starts < len(rows) / 4
    dense_x = np.empty((n, columns))
    for row in store.read(x).collect():
        dense_x[grid.indexes(row["block"])] = np.frombuffer(row["data"]).reshape(-1, columns)
    product = blocks.multiply(tiles, store.read(x), grid, columns, transposed, every_block=True)
    found = np.empty((n, columns))
    for row in product.collect():
        found[grid.indexes(row["block"])] = np.frombuffer(row["data"]).reshape(-1, columns)
    np.testing.assert_allclose(found, (a.T if transposed else a) @ dense_x, atol=1e-12)
    tiles.release()


def test_cells_by_runs(monkeypatch):
    """Rows of all lengths, one of them hot, in both directions, and tiles of an older version without runs."""
    monkeypatch.setattr(blocks, "_LEAST_RUN", 3)
    rng = np.random.default_rng(4)
    a = random_sparse(60, 0.1, 4)
    a[7] = rng.random(60)
    a[:, 11] = rng.random(60)
    i, j = np.nonzero(a)
    batch = blocks._tile((0, 0), 0, [(i * 60 + j, a[i, j])], 60)
    tile = dict(zip(batch.schema.names, (column[0] for column in batch.columns)))
    x = rng.random((60, 4))
    for transposed, want in ((False, a @ x), (True, a.T @ x)):
        cells = blocks._cells(*[tile[name].as_buffer() for name in blocks._cell_columns(transposed)])
        runs, rows = cells[:2]
        assert len(runs) > 3 and (np.diff(runs) <= 0).all() and runs.min() >= 3 and runs.sum() < len(rows)
        have = np.zeros((60, 4))
        blocks._add_product(have, *cells, x)
        np.testing.assert_allclose(have, want, atol=1e-12)
    have = np.zeros((60, 4))
    old = blocks._cells(*[np.ascontiguousarray(v, t).tobytes() for v, t in ((i, np.int32), (j, np.int32), (a[i, j], float))], None)
    blocks._add_product(have, *old, x)
    np.testing.assert_allclose(have, a @ x, atol=1e-12)


def test_laid_out_tiles_are_read_as_they_lie(spark, monkeypatch):
    """Only what is sent to tiles is shuffled; tiles are neither sorted nor held by executors, and a row group has one row."""
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    n, columns = 4000, 3
    grid = blocks.Grid(n, 2)
    cells = spark.range(400_000).selectExpr(f"cast(pmod(hash(id), {n}) as int) as i", f"cast(pmod(hash(id, 1), {n}) as int) as j", "1.0 as value")
    monkeypatch.setattr("pairloom.scratch.ROW_GROUP_BYTES", 100_000)
    tiles = blocks.cells_laid_out(cells, grid, 400_000, 2)
    x = blocks.BlockStore(spark, grid)
    sent = blocks.sent_rows(tiles, x.read(x.write(blocks.random_blocks(spark, grid, columns, 1.0, 1), columns)), grid, columns, False)
    plan = blocks.met_rows(tiles, sent.withColumnsRenamed({"source": "col_block", "target": "row_block"}))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    beside = plan.split("svd_tiles_")[0]
    assert "ShuffledHashJoin" in beside and "Exchange" not in beside and "Sort " not in beside and "InMemory" not in beside
    files = [f.removeprefix("file:") for f in tiles.df.inputFiles()]
    found = [pq.ParquetFile(f).metadata for f in files]
    assert sum(f.num_rows for f in found) >= 4 and all(f.num_rows == f.num_row_groups for f in found)
    table = tiles.table
    tiles.release()
    assert not spark.catalog.tableExists(table) and not any(os.path.exists(f) for f in files)


def test_blocks_of_large_matrices_are_narrow():
    """What a pass moves grows with the square of the columns, as there are more blocks, too."""
    assert svd._width(1_000, 1) == 64 and svd._width(300_000, 5) == 16
    assert svd._width(1_200_000, 5) == 8 and svd._width(7_200_000, 1) == 4
