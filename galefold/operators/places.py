"""Nearest stations and inverse-distance interpolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galefold.functions.columns import haversine


def nearest(stations: DataFrame, lat: float, lon: float, n: int, key: str = "station") -> DataFrame:
    """The n nearest stations (station, latitude, longitude) with distance_km; ties by station."""
    d = haversine(F.lit(lat), F.lit(lon), F.col("latitude"), F.col("longitude"))
    return stations.withColumn("distance_km", d).orderBy("distance_km", key).limit(n)


def interpolated(rows: DataFrame, time: str, value: str, hit_km: float = 0.01) -> DataFrame:
    """Value at a point for each instant with two stations and values or more; a station at the point itself decides."""
    weight = 1 / F.pow(F.col("distance_km"), 2)
    near = F.min("distance_km") < hit_km
    mean = F.try_divide(F.sum(F.when(F.col("distance_km") > 0, F.col(value) * weight)), F.sum(F.when(F.col("distance_km") > 0, weight)))
    grouped = rows.where(F.col(value).isNotNull()).groupBy(time).agg(F.count("*").alias("stations"), F.when(near, F.min_by(value, "distance_km")).otherwise(mean).alias("interpolated"))
    return grouped.where("stations >= 2")


def interpolated_all(rows: DataFrame, time: str, values: list[str], hit_km: float = 0.01, tie: str | None = None) -> DataFrame:
    """Several variables at a point for each instant with two rows or more; one with under two values is null there.

    A station at the point itself decides where it has a value (of several rows the first by ``tie``).
    """
    distance = F.col("distance_km")
    weight = F.when(distance > 0, 1 / F.pow(distance, 2))
    order = F.struct("distance_km", tie) if tie else distance

    def one(v: str) -> Column:
        there = F.col(v).isNotNull()
        mean = F.try_divide(F.sum(F.when(there, F.col(v) * weight)), F.sum(F.when(there, weight)))
        near = F.min(F.when(there, distance)) < hit_km
        return F.when(F.count(v) < 2, F.lit(None)).when(near, F.min_by(v, F.when(there, order))).otherwise(mean).alias(v)

    return rows.groupBy(time).agg(F.count("*").alias("stations"), *map(one, values)).where("stations >= 2")
