from __future__ import annotations

import gzip
import os
from pathlib import Path

import numpy as np
import pytest

import pairloom as pl
from pairloom import sources
from pairloom.operators import svd as solver
from pairloom.plans import add_counts, count_events, embed_matrix, reduce_matrix
from pairloom.scratch import clear_scratch, scratch_root, stage

EVENTS = [(1, 0, 5, 1), (1, 30, 7, 1), (1, 31, 9, 1), (2, 0, 5, 1), (2, 0, 7, 1)]


@pytest.fixture()
def event_path(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame(EVENTS, sources.EVENTS).write.parquet(path)
    return path


def test_events_parquet(spark, event_path):
    assert sorted(map(tuple, sources.read_events(spark, event_path).collect())) == EVENTS


@pytest.mark.parametrize("zipped", [True, False])
def test_events_text(spark, tmp_path, zipped):
    path = tmp_path / ("e.csv.gz" if zipped else "e.csv")
    text = "".join(",".join(map(str, row)) + "\n" for row in EVENTS)
    path.write_bytes(gzip.compress(text.encode()) if zipped else text.encode())
    assert sorted(map(tuple, sources.read_events(spark, str(path), "csv").collect())) == EVENTS


@pytest.mark.parametrize(
    "line", ["1,x,5,1", "1,2,7", "1,2,7,1,9", "1,2,7,x", "1,2,,1", "1,2,7,", "1,2,3000000000,1", "9999999999999999999,2,7,1", "1.5,2,7,1"]
)
def test_malformed_line_fails(spark, tmp_path, line):
    """Also when the columns that are read later are in order."""
    path = tmp_path / "bad.csv"
    path.write_text(f"1,0,5,1\n{line}\n")
    with pytest.raises(Exception, match="malformed event line"):
        sources.read_events(spark, str(path), "csv").collect()
    with pytest.raises(Exception, match="malformed event line"):
        count_events(spark, str(path), str(tmp_path / "out"), file_format="csv")


def test_text_numbers_at_their_limits(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("9223372036854775807,-2147483648, 5 ,+1\n\n-9223372036854775808,2147483647,5,1\r\n")
    have = sorted(map(tuple, sources.read_events(spark, str(path), "csv").collect()))
    assert have == [(-(2**63), 2**31 - 1, 5, 1), (2**63 - 1, -(2**31), 5, 1)]


def test_jobs_leave_no_scratch_tables(spark, tmp_path):
    events = spark.createDataFrame([(1, 0, 5, 1), (1, 1, 6, 1)], "PatientOrder long, NumDays int, WordIndex int, window int")
    events.write.parquet(str(tmp_path / "events"))
    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    assert count_events(spark, str(tmp_path / "events"), str(tmp_path / "counts")).count() == 1
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before


def test_last_line_wins_through_the_job(spark, tmp_path):
    mapping = [(0, 5, "zz", 0), (0, 1, "aa", 1), (1, 1, "bb", 2)]
    spark.createDataFrame([(0, 1, 7)], "i int, j int, count long").write.parquet(str(tmp_path / "matrix"))
    ordered = spark.createDataFrame(mapping, "WordIndex long, Source long, Code string, line long")
    ordered.write.parquet(str(tmp_path / "ordered"))
    ordered.drop("line").write.parquet(str(tmp_path / "plain"))
    paths = str(tmp_path / "matrix"), str(tmp_path / "out")
    have = reduce_matrix(spark, paths[0], str(tmp_path / "ordered"), paths[1], order_col="line")
    assert list(map(tuple, have.collect())) == [(0, 1, 7)]
    with pytest.raises(Exception, match="several rows and no order"):
        reduce_matrix(spark, paths[0], str(tmp_path / "plain"), paths[1])


def test_unconverged_embeddings_are_not_written(spark, tmp_path):
    rng = np.random.default_rng(5)
    cells = [(i, j, int(rng.integers(1, 50))) for i in range(90) for j in range(i, 90) if rng.random() < 0.3]
    spark.createDataFrame(cells, "i int, j int, count long").write.parquet(str(tmp_path / "matrix"))
    with pytest.raises(pl.ConvergenceError):
        embed_matrix(spark, str(tmp_path / "matrix"), str(tmp_path / "out"), 5, symmetric=True, max_passes=1, block=6)
    assert not os.path.exists(tmp_path / "out")


def test_triangular_input_through_the_job(spark, tmp_path):
    cells = [(0, 1, 4), (0, 2, 3), (1, 2, 2), (1, 1, 1)]
    spark.createDataFrame(cells, "i int, j int, count long").write.parquet(str(tmp_path / "matrix"))
    paths = str(tmp_path / "matrix"), str(tmp_path / "out")
    with pytest.raises(Exception, match="context without marginal"):
        embed_matrix(spark, *paths, 1)
    for options in ({"on_zero_context": "drop"}, {"context": "column", "on_zero_context": "drop"}):
        assert embed_matrix(spark, *paths, 1, **options).u.count() == 3


@pytest.mark.parametrize(
    "schema",
    [
        "PatientOrder int, NumDays int, WordIndex int, window int",
        "NumDays int, PatientOrder long, WordIndex int, window int",
        "PatientOrder long, NumDays int, WordIndex int",
        "PatientOrder long, NumDays int, WordIndex int, window int, more int",
    ],
)
def test_wrong_event_schema(spark, tmp_path, schema):
    path = str(tmp_path / "wrong")
    spark.createDataFrame([], schema).write.parquet(path)
    with pytest.raises(sources.SchemaError):
        sources.read_events(spark, path)


def test_matrix_and_mapping_schema(spark, tmp_path):
    path = str(tmp_path / "wrong")
    spark.createDataFrame([(1, 2, 3)], "i long, j long, count long").write.parquet(path)
    with pytest.raises(sources.SchemaError):
        sources.read_matrix(spark, path)
    with pytest.raises(sources.SchemaError):
        sources.read_mapping(spark, path)
    with pytest.raises(sources.SchemaError):
        sources.write_matrix(spark.read.parquet(path), str(tmp_path / "out"))


def test_scopes(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("a", "b")]
    for path, rows in zip(paths, (EVENTS[:2], EVENTS[2:])):
        spark.createDataFrame(rows, sources.EVENTS).write.parquet(path)
    together = pl.cooccurrence(sources.read_events(spark, paths))
    apart = pl.cooccurrence(sources.read_events(spark, paths, scope="directory"), scope=["input"])
    assert sorted(map(tuple, together.collect())) == [(5, 7, 2), (7, 9, 1)]
    assert sorted(map(tuple, apart.collect())) == [(5, 7, 2)]
    assert sources.read_events(spark, paths, scope="file").select("input").distinct().count() >= 2


def test_embedding_files(spark, tmp_path):
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (0, [3.0, 4.0])], "i int, features array<double>")
    sources.write_embeddings(vectors, str(tmp_path / "u"))
    assert sorted(map(tuple, sources.read_embeddings(spark, str(tmp_path / "u")).collect())) == [
        (0, [3.0, 4.0]),
        (1, [1.0, 2.0]),
    ]
    sources.write_long_embeddings(vectors, str(tmp_path / "long"))
    rows = sorted(map(tuple, spark.read.parquet(str(tmp_path / "long")).collect()))
    assert rows == [(0, 0, 3.0), (0, 1, 1.0), (1, 0, 4.0), (1, 1, 2.0)]


def test_generators_do_not_depend_on_partitions(spark):
    ids = spark.range(1, 20)
    first = sources.generate_events(spark, ids.repartition(7))
    second = sources.generate_events(spark, ids.coalesce(1))
    assert first.exceptAll(second).count() == 0 and first.count() == 19 * 99
    days = first.groupBy("PatientOrder").agg({"NumDays": "max"}).collect()
    assert all(1 <= r[1] <= 60 for r in days)


def test_jobs_from_files_to_files(spark, tmp_path):
    events = str(tmp_path / "events")
    sources.generate_events(spark, 20, 30, seed=5).selectExpr(
        "PatientOrder", "NumDays", "WordIndex % 40 AS WordIndex", "window"
    ).write.parquet(events)
    matrix = count_events(spark, events, str(tmp_path / "counts"))
    doubled = add_counts(spark, [str(tmp_path / "counts")] * 2, str(tmp_path / "sum"))
    assert pl.total_count(doubled).first()[0] == 2 * pl.total_count(matrix).first()[0]

    mapping = spark.range(40).selectExpr("id AS WordIndex", "id % 6 AS Source", "concat('c', id % 15) AS Code")
    mapping.write.parquet(str(tmp_path / "mapping"))
    reduced = reduce_matrix(
        spark, str(tmp_path / "counts"), str(tmp_path / "mapping"), str(tmp_path / "reduced"), (0, 1, 2, 3)
    )
    assert 0 < reduced.count() <= 15 * 16 / 2

    result = embed_matrix(
        spark, str(tmp_path / "counts"), str(tmp_path / "u"), 5, symmetric=True, weighted=True
    )
    vectors = sources.read_embeddings(spark, str(tmp_path / "u")).orderBy("i").collect()
    assert len(vectors) == 40
    lengths = np.array([r["features"] for r in vectors]) ** 2
    np.testing.assert_allclose(lengths.sum(axis=0), result.values, rtol=1e-8)


def test_scratch_tables_live_in_the_checkpoint_folder(spark):
    staged = stage(spark.range(5), "numbers")
    assert staged.path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert staged.path.startswith(scratch_root(spark)) and staged.count() == 5
    clear_scratch(spark)
    with pytest.raises(Exception):
        staged.df.collect()


def test_a_row_slice_opens_only_its_parts(spark, tmp_path):
    """A word with a third of all cells is spread over several parts."""
    cells = [(7, j, 1) for j in range(7, 407)] + [(i, i + d, i + d) for i in range(200) for d in range(4) if i != 7]
    path = str(tmp_path / "ranges")
    sources.write_row_ranges(spark.createDataFrame(cells, "i int, j int, count long"), path, 8)
    for start, end in ((0, 5), (7, 8), (150, 170), (500, 900), (0, 1000)):
        part = sources.read_row_slice(spark, path, start, end)
        assert sorted(map(tuple, part.collect())) == sorted(c for c in cells if start <= c[0] < end)
    everything = len(sources.read_row_slice(spark, path, 0, 1000).inputFiles())
    assert everything >= 6
    assert len(sources.read_row_slice(spark, path, 150, 170).inputFiles()) <= 2
    assert 2 <= len(sources.read_row_slice(spark, path, 7, 8).inputFiles()) < everything
    assert spark.read.parquet(path).count() == len(cells)
    sources.write_row_ranges(spark.createDataFrame([], "i int, j int, count long"), path, 8)
    assert sources.read_row_slice(spark, path, 0, 10).count() == 0


def test_a_bucketed_matrix_is_not_shuffled_by_its_rows(spark, tmp_path):
    cells = [(i, j, i + j + 1) for i in range(60) for j in range(i, 60, 3)]
    matrix = spark.createDataFrame(cells, "i int, j int, count long")
    table = sources.write_bucketed_matrix(matrix, "bucketed_counts", str(tmp_path / "bucketed"), 4)
    try:
        for df in (pl.marginals(table), pl.combine(table)):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in pl.marginals(matrix)._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, pl.marginals(table).collect())) == sorted(map(tuple, pl.marginals(matrix).collect()))
        assert sorted(map(tuple, pl.combine(table).collect())) == sorted(cells)
        scores = [sorted(map(tuple, pl.pmi(side, merge_duplicates=False, on_zero_context="drop").collect())) for side in (table, matrix)]
        assert [r[:5] for r in scores[0]] == [r[:5] for r in scores[1]]
        np.testing.assert_allclose([r[5:] for r in scores[0]], [r[5:] for r in scores[1]], rtol=1e-12)
    finally:
        spark.sql("DROP TABLE bucketed_counts")


def test_large_matrices_get_more_parts_and_buckets(spark, tmp_path, monkeypatch):
    """No task sorts and writes a share that grows with the matrix."""
    from pairloom.sources import writers

    monkeypatch.setattr(writers, "TASK_CELLS", 50)
    cells = spark.range(1000).selectExpr("cast(id % 97 as int) as i", "cast(id as int) as j", "id as count")
    sources.write_row_ranges(cells, str(tmp_path / "ranges"), 4)
    assert len(list((tmp_path / "ranges").glob("part=*"))) >= 15
    assert sources.read_row_slice(spark, str(tmp_path / "ranges"), 10, 20).count() == cells.filter("i between 10 and 19").count()
    table = sources.write_bucketed_matrix(cells, "many_buckets", str(tmp_path / "buckets"), 4)
    assert len({p.name.split("_")[-1] for p in (tmp_path / "buckets").glob("part-*")}) > 4
    assert table.count() == 1000


def test_scores_are_removed_before_the_passes(spark, tmp_path, monkeypatch):
    """What the solver writes does not come on top of the table that it has packed."""
    def scores():
        return {path for path in Path(scratch_root(spark)).rglob("ppmi-*") if path.is_dir()}

    before, start, during = scores(), solver._Bidiagonal.start, []

    def seen(self):
        during.append(scores() - before)
        start(self)

    monkeypatch.setattr(solver._Bidiagonal, "start", seen)
    cells = [(i, i, 3 + i) for i in range(4)] + [(0, 3, 2)]
    sources.write_matrix(spark.createDataFrame(cells, "i int, j int, count long"), str(tmp_path / "counts"))
    result = embed_matrix(spark, str(tmp_path / "counts"), str(tmp_path / "out"), 1, symmetric=True)
    assert during == [set()] and result.u.count() == 4
