"""Tails of the binomial distribution as column expressions of a fixed number of steps, whatever the numbers are.

The probability of exactly n of N comes from Stirling's series and deviances, not from differences of large logarithms of
factorials, so it keeps its digits for large N. A tail is that probability times an integral of the incomplete beta
function, taken relative to its value at p: it falls off from 1 with a slope and a curvature known beforehand, so a fixed
set of Gauss-Legendre nodes over the stretch where it matters gives it. Of the two tails the one on the far side of the
mean is integrated, the other is what is left of 1.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Nodes of the integral, where its integrand, exp(-REACH), no longer counts, and steps to find that place.
NODES, REACH, STEPS = 96, 42.0, 5
#: Up to here errors of Stirling's formula are a table.
SMALL = 15


def stirling_error(n: Column) -> Column:
    """log(n!) less Stirling's formula for it, n whole and not negative."""
    table = [1.0] + [math.lgamma(k + 1) - (k + 0.5) * math.log(k) + k - 0.5 * math.log(2 * math.pi) for k in range(1, SMALL + 1)]
    n = F.greatest(n, F.lit(0.0))
    square = 1 / F.greatest(n * n, F.lit(1.0))
    series = (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - square / 1188) * square) * square) * square) / F.greatest(n, F.lit(1.0))
    return F.when(n <= SMALL, F.array(*map(F.lit, table))[F.least(n, F.lit(SMALL)).cast("int")]).otherwise(series)


def deviance(x: Column, mean: Column) -> Column:
    """x log(x / mean) + mean - x, also where both are nearly the same; x above 0."""
    v = (x - mean) / (x + mean)
    square = v * v
    series = F.lit(0.0)
    for k in range(12, 0, -1):
        series = (series + 1 / (2 * k + 1)) * square
    near = (x - mean) * v + 2 * x * v * series
    return F.when(F.abs(v) < 0.1, near).otherwise(x * F.log(x / mean) + mean - x)


def log_of(p: Column, q: Column) -> Column:
    """log(p) where p + q is 1, from the smaller of both."""
    return F.when(p < q, F.log(p)).otherwise(F.log1p(-q))


def log_exactly(n: Column, total: Column, p: Column, q: Column) -> Column:
    """log of the probability of exactly n of total, n above 0."""
    rest = total - n
    inside = stirling_error(total) - stirling_error(n) - stirling_error(rest) - deviance(n, total * p) - deviance(rest, total * q)
    inside += 0.5 * F.log(total / (2 * math.pi * n * F.greatest(rest, F.lit(1.0))))
    return F.when(rest <= 0, total * log_of(p, q)).otherwise(inside)


def far_tail(n: Column, total: Column, p: Column, q: Column) -> Column:
    """Probability of n or more of total, for n above the mean; q is what p leaves of 1."""
    rest = total - n
    # the exponent of the integrand at p - w; its negative is convex, so that steps of Newton's method from the left of where
    # it is REACH go over it and then stay right of it
    exponent = lambda w: (n - 1) * F.log1p(-w / p) + rest * F.log1p(w / q)
    fall = lambda w: F.try_divide(n - 1, p - w) - rest / (q + w)
    slope, bend = (n - 1) / p - rest / q, (n - 1) / (p * p) + rest / (q * q)
    begin = F.least(p, F.try_divide(F.lit(2 * REACH), slope + F.sqrt(slope * slope + 2 * REACH * bend)))  # flat: all of it
    reach = F.aggregate(F.array(*map(F.lit, range(STEPS))), begin, lambda w, _: F.least(p, w + F.try_divide(REACH + exponent(w), fall(w))))
    at, weight = np.polynomial.legendre.leggauss(NODES)
    nodes = F.array(*[F.struct(F.lit(float((a + 1) / 2)).alias("at"), F.lit(float(w / 2)).alias("weight")) for a, w in zip(at, weight)])
    given = F.struct(n.alias("n"), rest.alias("rest"), p.alias("p"), q.alias("q"), reach.alias("reach"))

    def integrand(g: Column, node: Column) -> Column:
        w = node["at"] * g["reach"]
        return node["weight"] * F.exp((g["n"] - 1) * F.log1p(-w / g["p"]) + g["rest"] * F.log1p(w / g["q"]))

    # an array of one, so that what is given is found once and not at each node
    area = F.transform(F.array(given), lambda g: F.aggregate(nodes, F.lit(0.0), lambda s, node: s + integrand(g, node)) * g["reach"] * g["n"] / g["p"])[0]
    return F.exp(log_exactly(n, total, p, q) + F.log(area))


def upper_tail(n: Column, total: Column, p: Column) -> Column:
    """Probability of n or more of total."""
    return _tail(n, total, p, True)


def lower_tail(n: Column, total: Column, p: Column) -> Column:
    """Probability of n or less of total."""
    return _tail(n, total, p, False)


def binomial_tail(n: Column, total: Column, p: Column, upper: bool) -> Column:
    return upper_tail(n, total, p) if upper else lower_tail(n, total, p)


def _tail(n: Column, total: Column, p: Column, upper: bool) -> Column:
    whole, total = n.cast("double"), total.cast("double")
    p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    q = 1 - p
    if not upper:  # as many of the other kind or more
        whole, p, q = total - whole, q, p
    many = F.greatest(total, F.lit(1.0))
    mean = many * p
    inner = F.least(F.greatest(whole, F.lit(1.0)), many)
    # below the mean the other tail is the small one: total - n + 1 or more of the other kind
    other = F.least(F.greatest(total - whole + 1, F.lit(1.0)), many)
    found = F.when(whole > mean, far_tail(inner, many, p, q)).otherwise(1 - far_tail(other, many, q, p))
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), found))
    edge = F.when(total <= 0, 1.0).when(n > total, 0.0) if upper else F.when(total <= 0, 1.0).when(n >= total, 1.0)
    return edge.when(whole <= 0, 1.0).otherwise(bounded)
