"""Active-incident queries with optional filters, and GeoJSON features.

The optional filters are ``Column`` predicates AND-combined into one
``filter``; Catalyst pushes the status/severity equalities and the box
ranges into the parquet scan of a stored incidents table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.functions import fields as fl
from corridor.functions import geometry as geo
from corridor.functions.normalize import SEVERITIES


def incident_filters(severity: str | None = None, box=None, status: str = "active") -> Column:
    """The AND of the requested predicates; argument errors raise ``ValueError``."""
    preds = [F.col("status") == F.lit(status)]
    if severity is not None:
        if severity not in SEVERITIES:
            raise ValueError(f"severity must be one of {SEVERITIES}")
        preds.append(F.col("severity") == F.lit(severity))
    if box is not None:
        if any(v is None for v in box):
            if any(v is not None for v in box):
                raise ValueError("all four bbox coordinates must be provided")
        else:
            geo.check_box(*box)
            preds.append(geo.point_in_box(F.col("longitude"), F.col("latitude"), box))
    return reduce(lambda a, b: a & b, preds)


def raw_in_box(raw: DataFrame, box) -> DataFrame:
    """Raw records whose own coordinates lie in ``box``, ahead of validation.

    Validation keeps coordinates as they are, so of the valid incidents none in
    the box is lost; the rules then run on the box's records only. On numeric
    columns of a stored table the ranges reach the parquet scan.
    """
    geo.check_box(*box)
    return raw.filter(geo.point_in_box(fl.as_double(raw, "longitude"), fl.as_double(raw, "latitude"), box))


def active_incidents(incidents: DataFrame, severity: str | None = None, box=None) -> DataFrame:
    """Active incidents, newest first (ties by id for a stable order)."""
    order = [F.col("created_at").desc()] + ([F.col("incident_id")] if "incident_id" in incidents.columns else [])
    return incidents.filter(incident_filters(severity, box)).orderBy(*order)


def point_feature(lon: Column, lat: Column, props: dict[str, Column]) -> Column:
    """A GeoJSON Point Feature as a JSON string; NULL-valued properties kept."""
    feat = F.struct(F.lit("Feature").alias("type"),
                    F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
                    F.struct(*[c.alias(k) for k, c in props.items()]).alias("properties"))
    return F.to_json(feat, {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def line_feature(pts: Column, props: dict[str, Column]) -> Column:
    coords = F.transform(pts, lambda p: F.array(p.x, p.y))
    feat = F.struct(F.lit("Feature").alias("type"),
                    F.struct(F.lit("LineString").alias("type"), coords.alias("coordinates")).alias("geometry"),
                    F.struct(*[c.alias(k) for k, c in props.items()]).alias("properties"))
    return F.to_json(feat, {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
