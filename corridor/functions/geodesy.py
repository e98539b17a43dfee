"""Geodetic distance on the WGS84 spheroid (Vincenty's inverse formula).

Used only to *report* a distance after the nearest row has been chosen by
planar distance, so it runs on few rows. It is an Arrow-batched pandas UDF:
NumPy iterates all rows of a batch at once; rows that do not converge (near
antipodal points) fall back to the haversine distance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# WGS84 semi-major axis (m) and flattening.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
MAX_ITER = 200
TOL = 1e-12


def vincenty_np(lon1, lat1, lon2, lat2) -> np.ndarray:
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, dtype=float)) for v in (lon1, lat1, lon2, lat2))
    a, f = WGS84_A, WGS84_F
    b = (1 - f) * a
    L = lon2 - lon1
    U1, U2 = np.arctan((1 - f) * np.tan(lat1)), np.arctan((1 - f) * np.tan(lat2))
    sU1, cU1, sU2, cU2 = np.sin(U1), np.cos(U1), np.sin(U2), np.cos(U2)
    lam = L.copy()
    done = np.zeros(L.shape, bool)
    sig = sS = cS = c2m = cA2 = np.zeros(L.shape)
    for _ in range(MAX_ITER):
        sl, cl = np.sin(lam), np.cos(lam)
        sS = np.sqrt((cU2 * sl) ** 2 + (cU1 * sU2 - sU1 * cU2 * cl) ** 2)
        cS = sU1 * sU2 + cU1 * cU2 * cl
        sig = np.arctan2(sS, cS)
        with np.errstate(invalid="ignore", divide="ignore"):
            sA = np.where(sS == 0, 0.0, cU1 * cU2 * sl / sS)
            cA2 = 1 - sA ** 2
            c2m = np.where(cA2 == 0, 0.0, cS - 2 * sU1 * sU2 / cA2)
        C = f / 16 * cA2 * (4 + f * (4 - 3 * cA2))
        new = L + (1 - C) * f * sA * (sig + C * sS * (c2m + C * cS * (-1 + 2 * c2m ** 2)))
        done = np.abs(new - lam) < TOL
        lam = new
        if done.all():
            break
    u2 = cA2 * (a ** 2 - b ** 2) / b ** 2
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    dS = B * sS * (c2m + B / 4 * (cS * (-1 + 2 * c2m ** 2) -
                                  B / 6 * c2m * (-3 + 4 * sS ** 2) * (-3 + 4 * c2m ** 2)))
    s = b * A * (sig - dS)
    s = np.where(sS == 0, 0.0, s)
    # Near-antipodal pairs may not converge: use the spherical distance.
    h = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    hav = 2 * 6371008.8 * np.arcsin(np.sqrt(np.clip(h, 0, 1)))
    return np.where(done | (sS == 0), s, hav)


@F.pandas_udf(T.DoubleType())
def spheroid_distance_m(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    return pd.Series(vincenty_np(lon1, lat1, lon2, lat2))
