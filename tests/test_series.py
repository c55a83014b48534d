"""dense hourly series, wide and long forms; point sets."""

from datetime import datetime

from conftest import rows

from tilescope.operators.points import at_points, points_frame, top_categories_at
from tilescope.operators.series import hourly_counts, hourly_melt, hourly_series, hourly_wide

F11 = [
    ("2022-04-02 10:05:00", 1, 0, 0, "a"),
    ("2022-04-02 10:06:00", 2, 0, 0, "a"),
    ("2022-04-02 10:59:59.999999", 3, 1, 1, "b"),
    # 11:00 hour: nothing anywhere
    ("2022-04-02 12:00:00", 4, 1, 1, "b"),  # 12:00 hour at (1,1) only
    ("2022-04-02 13:30:00", 5, 0, 0, "a"),
    ("2022-04-02 13:30:00", 6, 5, 5, "c"),  # not a listed point
]
POINTS = [(0, 0), (1, 1), (9, 9)]  # (9, 9) has no rows at all


def h(hour):
    return datetime(2022, 4, 2, hour)


def test_hourly_counts(canvas):
    got = rows(hourly_counts(canvas(F11), POINTS))
    assert got == sorted([(h(10), 0, 0, 2), (h(10), 1, 1, 1), (h(12), 1, 1, 1), (h(13), 0, 0, 1)], key=repr)


def test_dense_series_fills_every_hour_for_present_points(canvas):
    got = rows(hourly_series(canvas(F11), POINTS))
    expected = []
    for hour in (10, 11, 12, 13):
        expected.append((h(hour), "(0, 0)", {10: 2, 13: 1}.get(hour, 0)))
        expected.append((h(hour), "(1, 1)", {10: 1, 12: 1}.get(hour, 0)))
    assert got == sorted(expected, key=repr)


def test_series_empty(canvas):
    assert rows(hourly_series(canvas(F11), [(7, 7)])) == []


def test_wide_and_melt(canvas):
    series = hourly_series(canvas(F11), POINTS)
    wide = hourly_wide(series)
    assert wide.columns == ["hour", "(0, 0)", "(1, 1)"]
    assert rows(wide) == [(h(10), 2, 1), (h(11), 0, 0), (h(12), 0, 1), (h(13), 1, 0)]
    fixed = hourly_wide(series, ["(0, 0)", "(1, 1)", "(9, 9)"])
    assert rows(fixed)[0] == (h(10), 2, 1, 0)
    assert rows(hourly_melt(wide)) == rows(series)


def test_point_predicate_and_semi_join_agree(canvas, spark):
    df = canvas(F11)
    by_list = rows(at_points(df, POINTS))
    by_join = rows(at_points(df, points_frame(spark, POINTS), bound=3))
    many = POINTS + [(1000 + i, 0) for i in range(100)]
    by_long_list = rows(at_points(df, many))
    assert by_list == by_join == by_long_list
    assert len(by_list) == 5


def test_semi_join_is_broadcast(canvas, spark):
    plan = at_points(canvas(F11), points_frame(spark, POINTS), bound=3)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_top_categories_per_point(canvas):
    data = [("2022-04-02 10:00:00", i, 0, 0, c) for i, c in enumerate("aaabbbccd")] + [
        ("2022-04-02 10:00:00", 99, 1, 1, "z")
    ]
    got = rows(top_categories_at(canvas(data), [(0, 0), (1, 1)], k=3), order=False)
    got = sorted(got, key=lambda r: (r[0], r[1], r[5]))
    assert got == [
        (0, 0, "(0, 0)", "a", 3, 1),
        (0, 0, "(0, 0)", "b", 3, 2),
        (0, 0, "(0, 0)", "c", 2, 3),
        (1, 1, "(1, 1)", "z", 1, 1),
    ]


def test_ordered_hourly(canvas):
    got = [r[0] for r in hourly_counts(canvas(F11), POINTS, ordered=True).collect()]
    assert got == sorted(got)


def test_point_predicate_reaches_parquet_scan(spark, canvas, tmp_path):
    path = str(tmp_path / "pts.parquet")
    canvas(F11).write.parquet(path)
    plan = at_points(spark.read.parquet(path), POINTS)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(x_coord,0)" in pushed and "EqualTo(y_coord,1)" in pushed and "Or(" in pushed
