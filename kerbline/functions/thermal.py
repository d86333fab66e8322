"""Radiometric conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbline.functions.geo import as_col

KELVIN = 273.15
# Factory constants of the two radiometric cameras.
RADIOMETRY = {
    "thermal1": {"R": 21324.9, "B": 1504.2, "F": 1.05, "J0": 19831.0, "J1": 33.3013,
                 "alpha1": 1.239e-08, "alpha2": 1.1095e-08, "X": 0.732,
                 "beta1": 0.00318, "beta2": 0.0031802},
    "thermal2": {"R": 23529.5, "B": 1533.8, "F": 1.05, "J0": 19525.0, "J1": 35.6463,
                 "alpha1": 1.239e-08, "alpha2": 1.1095e-08, "X": 0.732,
                 "beta1": 0.00318, "beta2": 0.0031802},
}
EMISSIVITY = 0.95
OBJECT_DISTANCE_M = 10.0
# Temperature limits per camera family, alert when above.
FAMILY_LIMIT_C = {"cooled": -150.0, "uncooled": 75.0}


def planck_celsius(raw, cal: dict, ambient_c, humidity,
                   emissivity=EMISSIVITY, distance_m=OBJECT_DISTANCE_M) -> Column:
    """raw counts to °C by the vendor's published Planck and atmosphere formula.

    Entries of ``cal`` may be numbers or columns of a joined radiometry dimension.
    """
    k = {name: as_col(value) for name, value in cal.items()}
    t, e = as_col(ambient_c), as_col(emissivity)
    water = as_col(humidity) * F.exp(
        1.5587 + 0.06939 * t - 0.00027816 * t * t + 0.00000068455 * t * t * t
    )
    root_d, root_w = F.sqrt(as_col(distance_m)), F.sqrt(water)
    tau = k["X"] * F.exp(-root_d * (k["alpha1"] + k["beta1"] * root_w)) + (1 - k["X"]) * F.exp(
        -root_d * (k["alpha2"] + k["beta2"] * root_w)
    )
    surround = k["R"] / (F.exp(k["B"] / (t + KELVIN)) - k["F"])
    radiance = (as_col(raw) - k["J0"]) / k["J1"]
    seen = (
        radiance / (e * tau)
        - ((1 - e) / e) * surround
        - ((1 - tau) / (e * tau)) * surround
    )
    return k["B"] / F.log(k["R"] / F.greatest(seen, F.lit(0.001)) + k["F"]) - KELVIN


def linear_celsius(raw, ambient_c) -> Column:
    """fallback when a camera has no radiometric constants."""
    return as_col(raw) * 0.004 + (as_col(ambient_c) - 84.0)


def to_celsius(value, unit) -> Column:
    """a reading whose unit text names kelvin becomes °C."""
    value, unit = as_col(value), F.lower(as_col(unit))
    return F.when(unit.contains("kelvin"), value - KELVIN).otherwise(value)


def temp_alert(value_c, family) -> Column:
    """is the reading above the limit of its camera family?"""
    value, family = as_col(value_c), as_col(family)
    out = F.lit(False)
    for name, limit in FAMILY_LIMIT_C.items():
        out = F.when(family == name, value > limit).otherwise(out)
    return out
