"""Least-squares coefficients from covariances, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANK_TOLERANCE = 1e-10


def first_of_three(cov: dict[str, Column], tolerance: float = RANK_TOLERANCE) -> Column:
    """First coefficient of the minimum-norm fit of y on x1, x2, x3.

    ``cov`` holds the covariances ``11 12 13 22 23 33`` of the inputs and
    ``1y 2y 3y`` with the target. With eigenvalues l1 >= l2 >= l3 of the input
    covariance S, p = trace and q = sum of the principal 2x2 minors:

    * all three directions present: Cramer's rule;
    * l3 vanishes: the pseudo-inverse on the remaining plane is (p I - S) / q;
    * l2 vanishes as well: it is 1 / p.

    A direction counts as absent when its eigenvalue falls below about
    ``tolerance`` times the largest.
    """
    a, d, e, b, f, c = (cov[k] for k in ("11", "12", "13", "22", "23", "33"))
    x, y, z = cov["1y"], cov["2y"], cov["3y"]
    p = a + b + c
    q = (a * b - d * d) + (a * c - e * e) + (b * c - f * f)
    det = a * (b * c - f * f) - d * (d * c - e * f) + e * (d * f - b * e)
    cramer = x * (b * c - f * f) - d * (y * c - f * z) + e * (y * f - b * z)
    return (
        F.when(det > q * p * tolerance, F.try_divide(cramer, det))
        .when(q > p * p * tolerance, F.try_divide(p * x - (a * x + d * y + e * z), q))
        .otherwise(F.try_divide(x, p))
    )
