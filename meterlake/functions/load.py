"""Load-profile, seasonal and weather expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.functions.numeric import clip, round_to

# Base load in kW per usage profile.
BASE_KW = {
    "residential": 1.6,
    "night_usage": 1.7,
    "industrial": 3.4,
    "ac_heavy": 2.3,
    "commercial": 2.8,
}


def _on(cond: Column) -> Column:
    return cond.cast("double")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def weather_condition(rainfall: str, humidity: str, temperature: str) -> Column:
    return (
        F.when(F.col(rainfall) > 3.5, F.lit("Thunderstorm"))
        .when(F.col(rainfall) > 1.1, F.lit("Rain"))
        .when(F.col(humidity) > 82e0, F.lit("Clouds"))
        .when(F.col(temperature) > 31e0, F.lit("Clear"))
        .otherwise(F.lit("Haze"))
    )


def base_load(profile: str | Column) -> Column:
    p = _c(profile)
    return F.coalesce(*[F.when(p == name, F.lit(kw)) for name, kw in BASE_KW.items()])


def load_curve(profile: str | Column, hour: str | Column, weekday: str | Column, temperature: str | Column) -> Column:
    """Hour-of-day multiplier of a profile; weekday 0 is Monday."""
    p, h, t = _c(profile), _c(hour), _c(temperature)
    weekend = _on(_c(weekday) >= 5)
    curve = (
        F.when(p == "residential", F.lit(0.55) + F.lit(0.35) * _on(h.between(6, 9)) + F.lit(0.75) * _on(h.between(18, 23)) + F.lit(0.12) * weekend)
        .when(p == "night_usage", F.lit(0.45) + F.lit(0.85) * _on((h >= 20) | (h <= 4)) + F.lit(0.08) * weekend)
        .when(p == "industrial", F.lit(0.7) + F.lit(0.55) * _on(h.between(8, 18)) - F.lit(0.18) * weekend)
        .when(p == "commercial", F.lit(0.55) + F.lit(0.75) * _on(h.between(10, 21)) - F.lit(0.1) * weekend)
        .otherwise(F.lit(0.5) + F.lit(0.5) * _on(h.between(11, 19)) + F.lit(0.035) * F.greatest(t - 28e0, F.lit(0e0)))
    )
    return F.greatest(curve, F.lit(0.2))


def seasonal_factor(timestamp: str | Column) -> Column:
    ts = _c(timestamp)
    month = F.month(ts)
    yearly = F.sin(F.dayofyear(ts).cast("double") / 365e0 * F.lit(2 * math.pi))
    return (
        F.lit(1e0)
        + F.lit(0.08) * yearly
        + F.when(month.between(6, 9), F.lit(0.08)).otherwise(F.lit(0e0))
        + F.when(month.between(10, 12), F.lit(0.05)).otherwise(F.lit(0e0))
    )


def weather_effect(temperature: str, rainfall: str, humidity: str) -> Column:
    zero = F.lit(0e0)
    return (
        F.lit(1e0)
        + F.lit(0.03) * F.greatest(F.col(temperature) - 28e0, zero)
        + F.lit(0.015) * F.col(rainfall)
        + F.lit(0.005) * F.greatest(F.col(humidity) - 75e0, zero)
    )


def expected_load(
    profile: str = "usage_profile",
    timestamp: str = "timestamp",
    temperature: str = "temperature",
    rainfall: str = "rainfall",
    humidity: str = "humidity",
) -> Column:
    """Modelled consumption of a reading, never below 0.12 kWh."""
    ts = F.col(timestamp)
    load = (
        base_load(profile)
        * load_curve(profile, F.hour(ts), F.weekday(ts), temperature)
        * seasonal_factor(ts)
        * weather_effect(temperature, rainfall, humidity)
    )
    return F.greatest(load, F.lit(0.12))


def wastage_score(
    consumption: str = "consumption_kwh",
    expected: str = "expected_consumption_kwh",
    profile: str = "usage_profile",
    temperature: str = "temperature",
    power_factor: str = "power_factor",
    is_theft: str = "is_theft",
) -> Column:
    """Over-consumption share plus surcharges for cool-weather cooling and a poor power factor."""
    used, exp = F.col(consumption), F.col(expected)
    over = clip((used - exp) / F.greatest(exp, F.lit(0.1)), 0.0, 2.5)
    cooling = (F.col(profile) == "ac_heavy") & (F.col(temperature) < 24e0) & (used > exp * F.lit(1.15))
    poor_factor = (F.col(power_factor) < 0.82) & (F.col(is_theft) != 1)
    total = over + F.when(cooling, F.lit(0.18)).otherwise(F.lit(0e0)) + F.when(poor_factor, F.lit(0.12)).otherwise(F.lit(0e0))
    return round_to(clip(total, 0.0, 2.5), 3)


def current_from_power(power: str = "power", voltage: str = "voltage", power_factor: str = "power_factor") -> Column:
    amps = F.col(power) * 1e3 / F.greatest(F.col(voltage) * F.col(power_factor), F.lit(1e0))
    return F.greatest(amps, F.lit(0.4))
