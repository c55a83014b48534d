"""Blocks: F7 edges, F10 dense grid and >26 rows, F13 labels, intensity."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tilescope.functions.exprs import block_label, block_letters, count_label, ratio_text, share_annotation, thousands
from tilescope.operators.blocks import (
    block_counts,
    block_grid,
    block_intensity,
    block_matrix,
    block_unique_users,
    top_blocks,
)


def at(canvas, coords, users=None):
    users = users or list(range(len(coords)))
    return canvas([("2022-04-02 14:00:00", u, x, y, "#000000") for (x, y), u in zip(coords, users)])


def test_block_edges_floor(canvas):
    df = at(canvas, [(0, 0), (99, 99), (100, 0), (-1, 0), (-100, 0), (-101, 250)])
    got = rows(block_counts(df).select("block_x", "block_y", "placements"))
    assert got == sorted([(-2, 2, 1), (-1, 0, 2), (0, 0, 2), (1, 0, 1)], key=repr)


def test_dense_grid_fills_observed_rows_and_columns(canvas):
    # rows 0 and 2 observed (1 absent), columns 0 and 3 observed; cell (2,3) empty
    df = at(canvas, [(0, 0), (5, 5), (300, 0), (0, 200)])
    dense = rows(block_grid(df, dense=True))
    assert dense == [(0, 0, 2), (0, 3, 1), (2, 0, 1), (2, 3, 0)]
    sparse = rows(block_grid(df, dense=False))
    assert sparse == [(0, 0, 2), (0, 3, 1), (2, 0, 1)]


def test_matrix_pivot(canvas):
    df = at(canvas, [(0, 0), (5, 5), (300, 0), (0, 200)])
    m = block_matrix(df)
    assert m.columns == ["block_y", "0", "3"]
    assert rows(m) == [(0, 2, 1), (2, 1, 0)]
    m2 = block_matrix(df, values=[0, 1, 2, 3])
    assert rows(m2) == [(0, 2, 0, 0, 1), (2, 1, 0, 0, 0)]


def test_top_blocks_includes_empty_cells(canvas):
    df = at(canvas, [(0, 0), (5, 5), (300, 0), (0, 200)])
    got = rows(top_blocks(df, k=4), order=False)
    assert [r[:4] for r in got] == [("A0", 0, 0, 2), ("A3", 3, 0, 1), ("C0", 0, 2, 1), ("C3", 3, 2, 0)]
    assert got[0][4:] == ("2", "2")


def test_unique_users_and_intensity(canvas):
    df = at(canvas, [(0, 0), (1, 1), (2, 2), (150, 0), (150, 1), (None, None)], users=[1, 1, 2, 3, None, 4])
    uu = rows(block_unique_users(df))
    assert uu == [(0, 0, 3, 2), (1, 0, 2, 1), (None, None, 1, 1)]
    top = rows(block_intensity(df, k=2), order=False)
    assert top == [("A2", 1, 0, 2, 1, 2.0, "2.00"), ("A1", 0, 0, 3, 2, 1.5, "1.50")]


def test_many_block_rows_get_multi_letter_labels(spark):
    df = spark.createDataFrame([(y,) for y in [0, 25, 26, 27, 51, 52, 701, 702, 703]], "y int")
    got = [r[0] for r in df.select(block_letters("y")).collect()]
    assert got == ["A", "Z", "AA", "AB", "AZ", "BA", "ZZ", "AAA", "AAB"]
    lbl = spark.createDataFrame([(2, 4)], "y int, x int").select(block_label("y", "x", 1)).collect()[0][0]
    assert lbl == "C5"


F13 = [
    (0, "0"), (999, "999"), (1000, "1K"), (1234, "1.23K"), (12345, "12.35K"), (123456, "123.5K"),
    (999999, "1000K"), (1234567, "1.23M"), (98765432, "98.77M"), (100005691, "100M"),
    (1015, "1.02K"), (1005, "1.01K"), (99999, "100K"), (100000, "100K"), (9999500000, "10000M"),
]


def test_count_labels(spark):
    df = spark.createDataFrame([(n,) for n, _ in F13], "n bigint")
    got = [tuple(r) for r in df.select("n", count_label("n")).collect()]
    assert got == F13


def test_text_helpers(spark):
    df = spark.createDataFrame([(201, 200), (1, 3), (2, 3), (5, 0)], "a bigint, b bigint")
    got = [tuple(r) for r in df.select(ratio_text("a", "b", 2), thousands(F.col("a") * 10000), share_annotation("a", "b")).collect()]
    assert got[0] == ("1.01", "2,010,000", "100.5%\n201")
    assert got[1] == ("0.33", "10,000", "33.3%\n1")
    assert got[2] == ("0.67", "20,000", "66.7%\n2")
    assert got[3][0] is None


@pytest.mark.parametrize("size", [10, 100])
def test_block_size_parameter(canvas, size):
    df = at(canvas, [(0, 0), (15, 0), (150, 0)])
    got = rows(block_counts(df, size))
    expected = {10: [(0, 0, 1), (1, 0, 1), (15, 0, 1)], 100: [(0, 0, 2), (1, 0, 1)]}[size]
    assert got == expected


def test_ordered_outputs(canvas):
    df = at(canvas, [(300, 0), (0, 200), (0, 0), (5, 5)])
    got = [tuple(r) for r in block_counts(df, ordered=True).collect()]
    assert got == [(0, 0, 2), (3, 0, 1), (0, 2, 1)]
    assert [r[0] for r in block_matrix(df).collect()] == [0, 2]


def test_sparse_ranking_and_negative_blocks(canvas):
    df = at(canvas, [(-150, -1), (-150, -2), (0, 0), (250, 99)])
    dense = rows(block_grid(df))
    # observed rows -1, 0 and columns -2, 0, 2 -> 6 cells
    assert len(dense) == 6 and sum(r[2] for r in dense) == 4
    assert (-1, 0, 0) in dense and (0, -2, 0) in dense
    sparse = [r[:4] for r in top_blocks(df, k=10, dense=False).collect()]
    assert sparse[0][1:] == (-2, -1, 2)
    assert len(sparse) == 3  # empty cells do not compete without the dense grid


def test_letters_have_no_end(spark):
    df = spark.createDataFrame([(y,) for y in [18277, 18278, 2**31 - 1, -1, -27, None]], "y long")
    assert [r[0] for r in df.select(block_letters("y")).collect()] == ["ZZZ", "AAAA", "FXSHRXX", "-A", "-AA", None]


def test_top_blocks_equals_the_ranked_grid(canvas):
    df = at(canvas, [(i * 100, i * 100) for i in range(6)] + [(0, 0), (None, 5)])
    grid = sorted(rows(block_grid(df)), key=lambda r: (-r[2], r[0], r[1] is None, r[1] or 0))
    for k in (3, 7, 8, 20, 100):
        got = [(r.block_y, r.block_x, r.placements) for r in top_blocks(df, k=k).collect()]
        assert got == grid[:k]
    assert "Join" not in top_blocks(df)._jdf.queryExecution().executedPlan().toString()


def test_matrix_of_other_values(canvas):
    df = at(canvas, [(0, 0), (5, 5), (300, 0), (0, 200)], users=[1, 1, 2, 3])
    assert rows(block_matrix(df, value="ppu")) == [(0, 2.0, 1.0), (2, 1.0, 0.0)]
    assert rows(block_matrix(df, value="ppu_text")) == [(0, "2.00", "1.00"), (2, "1.00", "0.00")]
