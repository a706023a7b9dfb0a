from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewlens.functions.exact import int_div, int_div_long, ratio_half_even, ratio_half_up


def _half_even(n, d, scale):
    x = Fraction(n * 10**scale, d)
    q, r = divmod(x.numerator, x.denominator)
    twice = 2 * r
    if twice > x.denominator or (twice == x.denominator and q % 2 == 1):
        q += 1
    return q / 10**scale


def _half_up(n, d, scale):
    x = Fraction(n * 10**scale, d)
    return ((2 * x.numerator + x.denominator) // (2 * x.denominator)) / 10**scale


pairs = st.lists(st.tuples(st.integers(0, 2**40), st.integers(1, 10**6)), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=pairs, scale=st.integers(0, 3))
def test_exact_rounding_matches_fractions(spark, rows, scale):
    df = spark.createDataFrame(rows + [(25, 10), (35, 10), (5, 2), (7, 2)], "n long, d long")
    out = df.select("n", "d", ratio_half_even(F.col("n"), F.col("d"), scale).alias("e"),
                    ratio_half_up(F.col("n"), F.col("d"), scale).alias("u"),
                    int_div(F.col("n"), F.col("d")).alias("q"), int_div_long(F.col("n"), F.col("d")).alias("ql"))
    for r in out.collect():
        assert r.e == _half_even(r.n, r.d, scale)
        assert r.u == _half_up(r.n, r.d, scale)
        assert r.q == r.ql == r.n // r.d
