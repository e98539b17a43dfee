"""Vocabulary normalizers for incident severity/status and geometry type.

Each is an ordered ``when`` chain; the first matching rule wins and the
tests are substring tests, not token tests ("pending" contains "end").
The JSON type matters: integer 4 is 'critical' but the text "4" is
'medium'. Callers pass the field through ``functions.fields`` so the
right branch is chosen from the input schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.functions import fields as fl

# Severity and status vocabularies and their substring rules,
# in rule order.
SEVERITIES = ["low", "medium", "high", "critical"]
SEVERITY_CODES = {1: "low", 2: "medium", 3: "high", 4: "critical"}
SEVERITY_RULES = [(("minor", "light"), "low"),
                  (("major", "severe"), "high"),
                  (("block", "fatal", "extreme"), "critical")]
SEVERITY_DEFAULT = "medium"
STATUSES = ["active", "resolved", "cleared"]
STATUS_RULES = [(("open", "report"), "active"),
                (("close", "end"), "resolved"),
                (("clear", "done"), "cleared")]
STATUS_DEFAULT = "active"
ZONE_STATUSES = ["planned", "active", "completed"]
ZONE_STATUS_DEFAULT = "planned"


# Fixed value: characters stripped around a vocabulary word (Python's
# ``str.strip`` whitespace in the Latin-1 range).
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def clean(c: Column) -> Column:
    """Strip surrounding whitespace and lower-case (``btrim``: no regex per row)."""
    return F.lower(F.btrim(c, F.lit(WHITESPACE)))


def _text_rules(s: Column, exact: list[str], rules, default: str) -> Column:
    out = F.when(s.isin(*exact), s)
    for words, label in rules:
        hit = None
        for w in words:
            h = s.contains(w)
            hit = h if hit is None else (hit | h)
        out = out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def severity_text(c: Column) -> Column:
    return _text_rules(clean(c), SEVERITIES, SEVERITY_RULES, SEVERITY_DEFAULT)


def severity_code(d: Column) -> Column:
    """Numeric codes 1..4; any other number is the default."""
    out = None
    for code, label in SEVERITY_CODES.items():
        out = (F.when(d == code, F.lit(label)) if out is None
               else out.when(d == code, F.lit(label)))
    return out.otherwise(F.lit(SEVERITY_DEFAULT))


def normalize_severity(df: DataFrame, name: str = "severity") -> tuple[Column, Column]:
    """(normalized severity, ok). Arrays/objects are not hashable codes: not ok."""
    k = fl.kind(df, name)
    c = fl.raw(df, name)
    if k == fl.ABSENT:
        return F.lit(SEVERITY_DEFAULT), F.lit(True)
    if k == fl.STRING:
        return F.when(c.isNull(), F.lit(SEVERITY_DEFAULT)).otherwise(severity_text(c)), F.lit(True)
    if k == fl.NUMERIC:
        return F.coalesce(severity_code(c.cast("double")), F.lit(SEVERITY_DEFAULT)), F.lit(True)
    if k == fl.BOOLEAN:
        return F.when(c, F.lit("low")).otherwise(F.lit(SEVERITY_DEFAULT)), F.lit(True)
    if k == fl.VARIANT:
        t = fl.variant_type(c)
        val = (F.when(t == "STRING", severity_text(F.try_variant_get(c, "$", "string")))
               .when(t == "BOOLEAN", F.when(F.try_variant_get(c, "$", "boolean"), F.lit("low"))
                     .otherwise(F.lit(SEVERITY_DEFAULT)))
               .when(t.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"),
                     severity_code(F.try_variant_get(c, "$", "double")))
               .otherwise(F.lit(SEVERITY_DEFAULT)))
        ok = ~F.coalesce(t.rlike("^(ARRAY|OBJECT)"), F.lit(False))
        return F.when(c.isNull(), F.lit(SEVERITY_DEFAULT)).otherwise(val), ok
    return F.lit(SEVERITY_DEFAULT), F.lit(True)


def status_text(c: Column) -> Column:
    return _text_rules(clean(c), STATUSES, STATUS_RULES, STATUS_DEFAULT)


def normalize_status(df: DataFrame, name: str = "status") -> Column:
    """Incident status; anything that is not a string is 'active'."""
    s = fl.as_string(df, name)
    return F.when(fl.is_string(df, name), status_text(s)).otherwise(F.lit(STATUS_DEFAULT))


def geometry_type_text(c: Column) -> Column:
    """'Polygon' / 'LineString', or NULL (rejected) for anything else."""
    s = clean(c)
    return (F.when(s.contains("polygon"), F.lit("Polygon"))
            .when(s.contains("line"), F.lit("LineString")))


def normalize_geometry_type(df: DataFrame, name: str = "geometry_type") -> Column:
    """NULL when the field is missing, not a string, or names another shape."""
    return F.when(fl.is_string(df, name), geometry_type_text(fl.as_string(df, name)))
