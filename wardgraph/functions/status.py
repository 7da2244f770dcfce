"""Column functions that grade values: errors, thresholds, heat and colour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: substrings of an exception's type name and what they mean, in the order in which they are tested
CATEGORY_WORDS = (("network_error", ("request", "http", "connection")), ("file_operation", ("file", "io", "permission")), ("data_validation", ("json", "decode", "validation")), ("configuration", ("config", "setting")), ("database_error", ("database", "sql")))
SEVERITY_WORDS = (("critical", ("critical", "fatal", "system")), ("high", ("connection", "timeout", "api")), ("medium", ("validation", "file", "data")))
# fixed values: what the typed exceptions carry
EXCEPTION_DEFAULTS = {
    "APIError": ("api_error", "high"),
    "DataValidationError": ("data_validation", "medium"),
    "FileOperationError": ("file_operation", "medium"),
    "NetworkError": ("network_error", "high"),
    "ConfigurationError": ("configuration", "critical"),
    "DatabaseError": ("database_error", "high"),
    "ProcessingError": ("processing_error", "medium"),
}


def _first_with(c: Column, words, otherwise: str) -> Column:
    out = F.lit(otherwise)
    for label, parts in reversed(words):
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(F.lower(c), F.lit(p))
        out = F.when(hit, label).otherwise(out)
    return out


def error_category(type_name: Column) -> Column:
    return _first_with(type_name, CATEGORY_WORDS, "unknown")


def error_severity(type_name: Column) -> Column:
    return _first_with(type_name, SEVERITY_WORDS, "low")


def typed_category(type_name: Column) -> Column:
    table = F.create_map(*(F.lit(x) for k, v in EXCEPTION_DEFAULTS.items() for x in (k, v[0])))
    return F.coalesce(table[type_name], error_category(type_name))


def typed_severity(type_name: Column) -> Column:
    table = F.create_map(*(F.lit(x) for k, v in EXCEPTION_DEFAULTS.items() for x in (k, v[1])))
    return F.coalesce(table[type_name], error_severity(type_name))


def error_id(request_id: Column, category: Column, ts: Column) -> Column:
    return F.concat_ws("_", request_id, category, F.unix_timestamp(ts).cast("string"))


def threshold_status(value: Column, degraded: float, unhealthy: float, above: bool = True) -> Column:
    """healthy, degraded or unhealthy by two cut points that are exceeded, or with above=False undercut."""
    past = (lambda cut: value > cut) if above else (lambda cut: value < cut)
    return F.when(past(unhealthy), "unhealthy").when(past(degraded), "degraded").otherwise("healthy")


def worst(rank_of: Column) -> Column:
    """The worst of a group's statuses; an unknown one counts as healthy."""
    rank = F.max(F.when(rank_of == "unhealthy", 2).when(rank_of == "degraded", 1).otherwise(0))
    return F.when(rank == 2, "unhealthy").when(rank == 1, "degraded").otherwise("healthy")


def js_round(c: Column) -> Column:
    return F.floor(c + 0.5)


def heat_hsl(value: Column, most: Column) -> tuple[Column, Column, Column]:
    """Hue, saturation and lightness of a value against the most: four linear pieces; null at 0 (transparent)."""
    t = F.least(value / most, F.lit(1.0))
    # fixed values: hue, saturation, lightness at the start of each quarter, and their change over it
    pieces = ((60, -5, 70, 10, 95, -5), (55, -15, 80, 0, 90, -10), (40, -10, 85, 0, 80, -10), (30, -10, 85, -5, 70, -10))
    out = []
    for i in (0, 2, 4):
        c = F.lit(None).cast("double")
        for n, p in reversed(list(enumerate(pieces))):
            c = F.when(t <= 0.25 * (n + 1), p[i] + p[i + 1] * ((t - 0.25 * n) / 0.25)).otherwise(c)
        out.append(F.when(F.coalesce(value, F.lit(0)) == 0, None).otherwise(c))
    return tuple(out)


def gradient_colour(score: Column, colours: list[str], low: float, high: float, manual: Column | None = None) -> Column:
    """#rrggbb of a score by linear interpolation over colours spread from low to high, clamped; null if unscored. A manual colour
    that is not empty wins, scored or not."""
    n = len(colours) - 1
    at = F.greatest(F.least((score - low) / (high - low), F.lit(1.0)), F.lit(0.0)) * n
    rgb = [[int(c[1 + 2 * k : 3 + 2 * k], 16) for k in range(3)] for c in colours]
    parts = []
    for k in range(3):
        c = F.lit(float(rgb[n][k]))
        for i in reversed(range(n)):
            c = F.when(at < i + 1, rgb[i][k] + (rgb[i + 1][k] - rgb[i][k]) * (at - i)).otherwise(c)
        parts.append(F.lower(F.lpad(F.hex(js_round(c).cast("long")), 2, "0")))
    found = F.when(score.isNotNull(), F.concat(F.lit("#"), *parts))
    return found if manual is None else F.coalesce(F.nullif(manual, F.lit("")), found)
