"""Map projection as plain Column arithmetic (Gauss-Krueger, published series)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TransverseMercator:
    """Fixed values of a transverse Mercator grid; the defaults are SWEREF 99 TM on GRS 80."""

    semi_major: float = 6378137.0
    flattening: float = 1 / 298.257222101
    central_meridian: float = 15.0
    scale: float = 0.9996
    false_northing: float = 0.0
    false_easting: float = 500000.0

    @property
    def e2(self) -> float:
        return self.flattening * (2 - self.flattening)

    @property
    def n(self) -> float:
        return self.flattening / (2 - self.flattening)

    @property
    def radius(self) -> float:
        n = self.n
        return self.semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    @property
    def latitude_terms(self) -> list[float]:
        """Coefficients of the odd powers that lead to the conformal latitude."""
        e2 = self.e2
        return [
            e2,
            (5 * e2**2 - e2**3) / 6,
            (104 * e2**3 - 45 * e2**4) / 120,
            1237 * e2**4 / 1260,
        ]

    @property
    def series(self) -> list[float]:
        n = self.n
        return [
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
            13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
            61 * n**3 / 240 - 103 * n**4 / 140,
            49561 * n**4 / 161280,
        ]


SWEREF99TM = TransverseMercator()


def degrees(col: Column) -> Column:
    """A position cell as a number; text that is none, and NaN, give NULL."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def with_grid_position(
    df: DataFrame,
    latitude: Column,
    longitude: Column,
    easting: str,
    northing: str,
    grid: TransverseMercator = SWEREF99TM,
) -> DataFrame:
    """Add plane coordinates in metres, to the millimetre.

    Works row by row in generated code, with no shuffle. Repeated terms are evaluated once: the
    conformal pair as two helper columns, the rest by the code generator.
    """
    phi, dlon = F.radians(latitude), F.radians(longitude - F.lit(grid.central_meridian))
    a, b, c, d = (F.lit(t) for t in grid.latitude_terms)
    s2 = F.sin(phi) * F.sin(phi)
    conformal = phi - F.sin(phi) * F.cos(phi) * (a + s2 * (b + s2 * (c + s2 * d)))
    xi = F.atan(F.tan(conformal) / F.cos(dlon))
    eta = F.atanh(F.cos(conformal) * F.sin(dlon))
    north, east = F.col("_xi"), F.col("_eta")
    for i, beta in enumerate(grid.series, start=1):
        angle, stretch = F.lit(2.0 * i) * F.col("_xi"), F.lit(2.0 * i) * F.col("_eta")
        north = north + F.lit(beta) * F.sin(angle) * F.cosh(stretch)
        east = east + F.lit(beta) * F.cos(angle) * F.sinh(stretch)
    size = F.lit(grid.scale * grid.radius)

    def metres(value: Column) -> Column:
        # beyond the grid (poles, a quarter turn from the meridian) there is no position
        return F.when(F.abs(value) < 1e8, value).try_cast("decimal(12,3)")

    return (
        df.withColumns({"_xi": xi, "_eta": eta})
        .withColumns(
            {
                easting: metres(size * east + F.lit(grid.false_easting)),
                northing: metres(size * north + F.lit(grid.false_northing)),
            }
        )
        .drop("_xi", "_eta")
    )
