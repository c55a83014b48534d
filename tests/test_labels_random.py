"""Label rules against Python's decimal arithmetic on many random values (one Spark job)."""

import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from tilescope.functions.exprs import count_label, ratio_text


def label_rule(n: int) -> str:
    unit, suffix = (1_000_000, "M") if n >= 1_000_000 else (1_000, "K") if n >= 1_000 else (1, "")
    value = Decimal(n) / Decimal(unit)
    digits = len(str(int(value)))
    d = max(0, min(2, 4 - digits))
    text = format(value.quantize(Decimal(1).scaleb(-d), rounding=ROUND_HALF_UP), "f")
    if "." in text:
        text = text.rstrip("0").rstrip(".")
    return text + suffix


def ratio_rule(a: int, b: int) -> str:
    q = Fraction(a, b) * 100
    scaled = int(q) + (1 if q - int(q) >= Fraction(1, 2) else 0)
    return f"{scaled // 100}.{scaled % 100:02d}"


def test_count_label_matches_decimal_rule(spark):
    rnd = random.Random(7)
    values = [rnd.randrange(0, 10 ** rnd.randrange(1, 11)) for _ in range(3000)]
    values += [k * 5 * 10**e + c for k in range(1, 40) for e in range(0, 8) for c in (-1, 0, 1)]  # halves
    values = [v for v in values if v >= 0]
    df = spark.createDataFrame([(v,) for v in values], "n bigint").select("n", count_label("n").alias("l"))
    wrong = [(n, l, label_rule(n)) for n, l in df.collect() if l != label_rule(n)]
    assert not wrong, wrong[:5]


def test_ratio_text_matches_exact_rule(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randrange(0, 100000), rnd.randrange(1, 5000)) for _ in range(3000)]
    pairs += [(201, 200), (1, 8), (3, 8), (5, 8), (1, 200), (3, 400)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", ratio_text("a", "b", 2).alias("t"))
    wrong = [(a, b, t, ratio_rule(a, b)) for a, b, t in df.collect() if t != ratio_rule(a, b)]
    assert not wrong, wrong[:5]


def test_percentage_matches_oracle_expression(spark):
    import duckdb

    from tilescope.functions.exprs import percentage

    rnd = random.Random(5)
    pairs = [(rnd.randrange(0, 5000), rnd.randrange(1, 5000)) for _ in range(2000)]
    pairs += [(k, d) for d in (8, 16, 80, 400, 800, 1600, 8000) for k in range(1, 160, 3)]  # halves
    pairs += [(0, 0), (3, 0)]
    got = {
        (a, b): p
        for a, b, p in spark.createDataFrame(pairs, "a bigint, b bigint")
        .select("a", "b", percentage("a", "b").alias("p"))
        .collect()
    }
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a BIGINT, b BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    want = {
        (a, b): p
        for a, b, p in con.execute(
            "SELECT a, b, round((100.0::DOUBLE * a / nullif(b, 0)) * 100.0, 0) / 100.0 FROM t"
        ).fetchall()
    }
    assert got == want
