"""Distribution functions as Column expressions (no Python in the tasks).

Normal tail: W. J. Cody, "Rational Chebyshev approximation for the error
function", 1969.  Normal quantile: M. J. Wichura, algorithm AS 241, 1988.
The other tails use closed forms for integer parameters.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from countloom.functions.missing import col

# Published coefficients, highest power first.
ERF_NUM = (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3)
ERF_DEN = (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3)
ERFC_NUM = (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3)
ERFC_DEN = (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3)
TAIL_NUM = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4)
TAIL_DEN = (1.0, 2.56852019228982242e0, 1.87295284992346047e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3)
QUANTILE_MID_NUM = (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0)
QUANTILE_MID_DEN = (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0)
QUANTILE_NEAR_NUM = (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0)
QUANTILE_NEAR_DEN = (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0)
QUANTILE_FAR_NUM = (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0)
QUANTILE_FAR_DEN = (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0)

SQRT_PI = math.sqrt(math.pi)
SMALLEST = 2.2250738585072014e-308


def _poly(coefficients: Sequence[float], x: Column) -> Column:
    total = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        total = total * x + F.lit(float(c))
    return total


def _with(value: Column, body) -> Column:
    """Bind a value once, so that a long expression does not repeat its subtree."""
    return F.element_at(F.transform(F.array(value.cast("double")), body), 1)


def erfc_nonneg(x: str | Column) -> Column:
    """Complementary error function for x >= 0."""

    def body(v: Column) -> Column:
        small = 1.0 - v * _poly(ERF_NUM, v * v) / _poly(ERF_DEN, v * v)
        middle = F.exp(-v * v) * _poly(ERFC_NUM, v) / _poly(ERFC_DEN, v)
        inv = 1.0 / (v * v)
        tail = F.exp(-v * v) / v * (1.0 / SQRT_PI - inv * _poly(TAIL_NUM, inv) / _poly(TAIL_DEN, inv))
        return F.when(v <= 0.46875, small).when(v <= 4.0, middle).otherwise(tail)

    return _with(col(x), body)


def norm_sf(z: str | Column) -> Column:
    """P(Z > z) for a standard normal."""

    def body(v: Column) -> Column:
        upper = 0.5 * erfc_nonneg(F.abs(v) / math.sqrt(2.0))
        return F.when(v >= 0, upper).otherwise(1.0 - upper)

    return _with(col(z), body)


def two_sided_p(z: str | Column) -> Column:
    return erfc_nonneg(F.abs(col(z)) / math.sqrt(2.0))


def norm_isf(p: str | Column) -> Column:
    """z with P(Z > z) = p; null outside (0, 1)."""

    def body(v: Column) -> Column:
        q = 0.5 - v
        r = 0.180625 - q * q
        mid = q * _poly(QUANTILE_MID_NUM, r) / _poly(QUANTILE_MID_DEN, r)
        s = F.sqrt(-F.log(F.least(v, 1.0 - v)))
        near = _poly(QUANTILE_NEAR_NUM, s - 1.6) / _poly(QUANTILE_NEAR_DEN, s - 1.6)
        far = _poly(QUANTILE_FAR_NUM, s - 5.0) / _poly(QUANTILE_FAR_DEN, s - 5.0)
        outer = F.signum(q) * F.when(s <= 5.0, near).otherwise(far)
        return F.when((v > 0) & (v < 1), F.when(F.abs(q) <= 0.425, mid).otherwise(outer))

    return _with(col(p), body)


def chi2_sf(x: str | Column, df: str | Column) -> Column:
    """Upper chi-square tail for an integer number of degrees of freedom >= 1."""
    x, df = col(x).cast("double"), col(df).cast("int")
    half = x / 2.0

    def series(first: Column, start: float, terms: Column) -> Column:
        step = F.aggregate(
            F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>")),
            F.struct(first.alias("t"), first.alias("s")),
            lambda acc, i: F.struct(
                (acc["t"] * half / (i + F.lit(start))).alias("t"),
                (acc["s"] + acc["t"] * half / (i + F.lit(start))).alias("s"),
            ),
            lambda acc: acc["s"],
        )
        return F.exp(-half) * F.when(terms >= 1, step).otherwise(F.lit(0.0))

    even = series(F.lit(1.0), 0.0, F.floor(df / 2).cast("int"))
    odd = erfc_nonneg(F.sqrt(half)) + series(
        F.sqrt(half) / (SQRT_PI / 2.0), 0.5, F.floor((df - 1) / 2).cast("int")
    )
    tail = F.when(df % 2 == 0, even).otherwise(odd)
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), tail))


def beta_cdf_int(x: str | Column, i: str | Column, k: str | Column) -> Column:
    """Beta(i, k-i+1) cdf: chance that at least i of k uniform draws are <= x."""
    x, i, k = col(x).cast("double"), col(i).cast("int"), col(k).cast("int")
    draws = F.sequence(F.lit(1), k)

    def weight(j: Column) -> Column:
        ways = F.aggregate(
            F.when(j >= 1, F.sequence(F.lit(1), j)).otherwise(F.array().cast("array<int>")),
            F.lit(1.0),
            lambda acc, m: acc * (k - j + m) / m,
        )
        return ways * F.pow(x, j.cast("double")) * F.pow(1.0 - x, (k - j).cast("double"))

    tail = F.aggregate(
        F.filter(draws, lambda j: j >= i), F.lit(0.0), lambda acc, j: acc + weight(j)
    )
    return F.when(x >= 1.0, F.lit(1.0)).when(x <= 0.0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), tail))


def log_factorial(n: str | Column) -> Column:
    """ln(n!): Stirling's series at n+11, stepped back down by the recurrence."""

    def body(v: Column) -> Column:
        y = v + 11.0
        inv = 1.0 / y
        series = (
            (y - 0.5) * F.log(y)
            - y
            + 0.5 * math.log(2.0 * math.pi)
            + inv * (1.0 / 12 - inv * inv * (1.0 / 360 - inv * inv * (1.0 / 1260 - inv * inv / 1680)))
        )
        product = v + 1.0
        for step in range(2, 11):
            product = product * (v + float(step))
        return series - F.log(product)

    return _with(col(n), body)


def hypergeom_sf(k: str | Column, total: str | Column, marked: str | Column, drawn: str | Column) -> Column:
    """P(X >= k) when ``drawn`` of ``total`` items are taken and ``marked`` carry the mark."""
    k, total, marked, drawn = (col(c).cast("double") for c in (k, total, marked, drawn))
    top = F.least(marked, drawn)

    def log_choose(n: Column, r: Column) -> Column:
        return log_factorial(n) - log_factorial(r) - log_factorial(n - r)

    first = F.exp(
        log_choose(marked, k) + log_choose(total - marked, drawn - k) - log_choose(total, drawn)
    )
    tail = F.aggregate(
        F.when(top > k, F.sequence(k.cast("long"), top.cast("long") - 1)).otherwise(
            F.array().cast("array<bigint>")
        ),
        F.struct(first.alias("t"), first.alias("s")),
        lambda acc, j: F.struct(
            (acc["t"] * _ratio(j.cast("double"), total, marked, drawn)).alias("t"),
            (acc["s"] + acc["t"] * _ratio(j.cast("double"), total, marked, drawn)).alias("s"),
        ),
        lambda acc: acc["s"],
    )
    possible = drawn - k <= total - marked
    return (
        F.when(k <= 0, F.lit(1.0))
        .when(k > top, F.lit(0.0))
        .when(possible, F.least(F.lit(1.0), tail))
        .otherwise(F.lit(1.0))
    )


def _ratio(j: Column, total: Column, marked: Column, drawn: Column) -> Column:
    return (marked - j) * (drawn - j) / ((j + 1) * (total - marked - drawn + j + 1))
