"""Column functions on identifiers of the chain; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "NAME:ATTACK:ENTRY "
# fixed values: node prefixes with their type and colour, in the order in which they are tested
NODE_TYPES = (("CVE-", "cve", "#ff6b6b"), ("CWE-", "cwe", "#4ecdc4"), ("CAPEC-", "capec", "#45b7d1"), ("T", "technique", "#96ceb4"), ("D3F-", "countermeasure", "#feca57"), ("OWASP-", "category", "#ff9ff3"))


def is_weakness_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^CWE-[0-9]+$"), F.lit(False))


def is_pattern_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9]+$"), F.lit(False))


def is_technique_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^T?[0-9]+([.][0-9]+)?$"), F.lit(False))


def is_request_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^CVE-[0-9]{4}-[0-9]{4,}$"), F.lit(False))


def year_of_id(c: Column) -> Column:
    return F.try_element_at(F.split(c, "-"), F.lit(2)).try_cast("int")


def normalise_weakness_id(c: Column) -> Column:
    return F.regexp_replace(c, "^CWE-", "")


def weakness_ids(descriptions: Column, lang: str = "en", pattern: str = "CWE-([0-9]+)") -> Column:
    """Sorted distinct ids that the pattern's group finds in the descriptions of a language."""
    found = F.transform(F.filter(descriptions, lambda d: d["lang"] == lang), lambda d: F.regexp_extract_all(d["value"], F.lit(pattern), F.lit(1)))
    return F.sort_array(F.array_distinct(F.flatten(found)))


def taxonomy_ids(text: Column, valid: bool = True) -> Column:
    """Technique ids of a delimited taxonomy text, in order and with repeats; only well-formed ones, if so asked."""
    parts = F.split(text, SEPARATOR)
    ids = F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda e: F.try_element_at(F.split(e, ":"), F.lit(2)))
    ids = F.filter(ids, lambda x: x.isNotNull())
    return F.coalesce(F.filter(ids, is_technique_id) if valid else ids, F.array().cast("array<string>"))


def node_type(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for prefix, kind, _ in reversed(NODE_TYPES):
        out = F.when(c.startswith(prefix), kind).otherwise(out)
    return out


def node_colour(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for prefix, _, colour in reversed(NODE_TYPES):
        out = F.when(c.startswith(prefix), colour).otherwise(out)
    return out


def tactic_slug(c: Column, mode: str = "first") -> Column:
    """Lower case with the first space, or in mode `all` every space, made a hyphen."""
    return F.regexp_replace(F.lower(c), "^([^ ]*) ", "$1-") if mode == "first" else F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def label_key(labels: Column) -> Column:
    """k=v of a label map by key, joined with a bar."""
    return F.array_join(F.transform(F.sort_array(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")


def drop_empty_values(m: Column) -> Column:
    """A map of arrays without its null and empty entries."""
    return F.map_filter(m, lambda k, v: v.isNotNull() & (F.size(v) > 0))


def joined(ids: Column) -> Column:
    return F.array_join(ids, ",")
