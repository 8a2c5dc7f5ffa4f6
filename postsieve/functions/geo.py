"""Distances and grid cells on the sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371000.0


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    dlat, dlng = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlng / 2), 2)
    return F.asin(F.least(F.lit(1.0), F.sqrt(a))) * (2 * EARTH_M)


class Grid:
    """Cells about four radii (or as many as asked for) high and wide, so that a circle meets at most two per axis and mostly one.

    A row of cells (band) sets its own cell width from its highest latitude, hence the grid needs no look
    at the data and holds everywhere; columns wrap at the date line.
    """

    def __init__(self, radius_m: float, radii: float = 4.0):
        self.reach = math.degrees(radius_m / EARTH_M) * (1 + 1e-9)
        self.radii = radii
        self.height = radii * self.reach

    def _half_width(self, lat: Column) -> Column:
        """Degrees of longitude the circle spans to either side; 180 when it holds a pole."""
        ratio = F.sin(F.radians(F.lit(self.reach))) / F.cos(F.radians(lat))
        inside = F.abs(lat) + self.reach < 90
        return F.when(inside, F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * (1 + 1e-9)).otherwise(F.lit(180.0))

    def band(self, lat: Column) -> Column:
        return F.floor((lat + 90) / self.height)

    def columns(self, band: Column) -> Column:
        """Number of cells round the globe in a band."""
        south = band * self.height - 90
        far = F.least(F.greatest(F.abs(south), F.abs(south + self.height)), F.lit(90.0))
        wide = F.greatest(self._half_width(far), F.lit(self.reach))
        return F.greatest(F.floor(F.lit(360.0 / self.radii) / wide), F.lit(1))

    def column(self, lng: Column, band: Column) -> Column:
        n = self.columns(band)
        return F.pmod(F.floor((lng + 180) * n / 360), n)

    def cell(self, lat: Column, lng: Column) -> Column:
        band = self.band(lat)
        return F.struct(band.alias("band"), self.column(lng, band).alias("col"))

    def cells_near(self, lat: Column, lng: Column) -> Column:
        """All cells a circle round the point may meet."""
        half = self._half_width(lat)

        def row(band: Column) -> Column:
            n = self.columns(band)
            first = F.floor((lng - half + 180) * n / 360)
            last = F.least(F.floor((lng + half + 180) * n / 360), first + n - 1)
            return F.transform(
                F.sequence(first, last), lambda c: F.struct(band.alias("band"), F.pmod(c, n).alias("col"))
            )

        bands = F.sequence(self.band(lat - self.reach), self.band(lat + self.reach))
        return F.flatten(F.transform(bands, row))
