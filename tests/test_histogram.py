"""Placements-per-user histogram (R10)."""

from conftest import rows
from pyspark.sql import functions as F

from tilescope.operators.histogram import placement_histogram, user_counts, user_histogram


def data(canvas):
    # users 1..8 with 1..8 placements at (0, 0); user 9 elsewhere
    out = [("2022-04-02 10:00:00", u, 0, 0, "a") for u in range(1, 9) for _ in range(u)]
    out.append(("2022-04-02 10:00:00", 9, 5, 5, "a"))
    return canvas(out)


def at():
    return (F.col("x_coord") == 0) & (F.col("y_coord") == 0)


def test_user_counts(canvas):
    assert rows(user_counts(data(canvas), at())) == sorted([(u, u) for u in range(1, 9)], key=repr)


def test_histogram(canvas):
    assert rows(placement_histogram(data(canvas), at())) == sorted([(n, 1) for n in range(1, 9)], key=repr)


def test_capped_histogram(canvas):
    got = sorted(rows(user_histogram(data(canvas), at(), cap=6)))
    assert [r[:3] for r in got] == [(1, "1", 1), (2, "2", 1), (3, "3", 1), (4, "4", 1), (5, "5", 1), (6, "6+", 3)]
    assert got[0][3] == 12.5 and got[5][3] == 37.5
    assert got[5][4] == "37.5%\n3"


def test_empty_histogram(canvas):
    assert rows(user_histogram(data(canvas), F.lit(False))) == []


def test_histogram_order(canvas):
    got = [r[0] for r in placement_histogram(data(canvas), at(), ordered=True).collect()]
    assert got == list(range(1, 9))
    assert [r[0] for r in user_histogram(data(canvas), at()).collect()] == [1, 2, 3, 4, 5, 6]
