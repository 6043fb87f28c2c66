"""Extinction per photometric band as coefficient x E(B-V)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Published A_band / E(B-V) coefficients, by photometric system.
COEFFICIENTS = {
    "landolt": {"u": 4.334, "b": 3.626, "v": 2.742, "r": 2.169, "i": 1.505},
    "ctio": {"u": 4.107, "b": 3.641, "v": 2.682, "r": 2.119, "i": 1.516},
    "ukirt": {"j": 0.709, "h": 0.449, "k": 0.302, "l_pr": 0.153},
    "gunn": {"g": 2.914, "r": 2.055, "i": 1.555, "z": 1.234},
    "spinrad": {"rs": 1.921},
    "stromgren": {"u": 4.305, "b": 3.350, "v": 3.793, "beta": 3.183, "y": 2.686},
    "sdss": {"u": 4.239, "g": 3.303, "r": 2.285, "i": 1.698, "z": 1.263},
    "dss_ii": {"g": 3.381, "r": 2.088, "i": 1.487},
    "ps1": {"g": 3.172, "r": 2.271, "i": 1.682, "z": 1.322, "y": 1.087, "w": 2.341},
    "lsst": {"u": 4.145, "g": 3.237, "r": 2.273, "i": 1.684, "z": 1.323, "y": 1.088},
    "des": {"g": 3.237, "r": 2.176, "i": 1.595, "z": 1.217, "y": 1.058},
}


def extinction_columns(df: DataFrame, ebv: str = "eb_v", systems: list[str] | None = None) -> DataFrame:
    """Add one FLOAT column ``<system>_<band>`` per coefficient of the chosen systems (all by default)."""
    unknown = set(systems or ()) - set(COEFFICIENTS)
    if unknown:
        raise ValueError(f"unknown photometric systems: {sorted(unknown)}")
    added = {
        f"{system}_{band}": (F.lit(value) * F.col(ebv).cast("double")).cast("float")
        for system in systems or COEFFICIENTS
        for band, value in COEFFICIENTS[system].items()
    }
    return df.withColumns(added)
