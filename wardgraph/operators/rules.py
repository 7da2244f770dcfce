"""Data-quality rules and validation of stored records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """kind: required, type (args: a type), range (low, high), pattern (a regular expression) or enum (values)."""

    field: str
    kind: str
    args: tuple = ()
    warning: bool = False
    stage: int = 0

    def broken(self) -> Column:
        c = F.col(self.field)
        if self.kind == "required":
            return c.isNull() | (c.cast("string") == "")
        if self.kind == "type":
            return c.isNotNull() & c.cast("string").try_cast(self.args[0]).isNull()
        if self.kind == "range":
            low, high = self.args
            tests = ([c < low] if low is not None else []) + ([c > high] if high is not None else [])
            return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))
        if self.kind == "pattern":
            return F.coalesce(~c.rlike(self.args[0]), F.lit(False))
        if self.kind == "enum":
            return F.coalesce(~c.isin(*self.args), F.lit(False))
        raise ValueError(f"no such rule: {self.kind}")

    @property
    def message(self) -> str:
        return f"{self.field}: {self.kind}"


def check_rows(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rows with errors and warnings (arrays of messages). A row's later stages are not tried once a stage has an error."""
    errors, warnings = F.array().cast("array<string>"), F.array().cast("array<string>")
    for stage in sorted({r.stage for r in rules}):
        mine = [r for r in rules if r.stage == stage]
        said = lambda w: F.filter(F.array(*(F.when(r.broken(), F.lit(r.message)) for r in mine if r.warning == w)), lambda x: x.isNotNull()) if any(r.warning == w for r in mine) else F.array().cast("array<string>")  # noqa: E731, B023
        open_ = F.size(errors) == 0
        none = F.array().cast("array<string>")
        errors, warnings = F.concat(errors, F.when(open_, said(False)).otherwise(none)), F.concat(warnings, F.when(open_, said(True)).otherwise(none))
    return rows.withColumn("errors", errors).withColumn("warnings", warnings)


def report(checked: DataFrame) -> DataFrame:
    return checked.agg((F.coalesce(F.sum(F.size("errors")), F.lit(0)) == 0).alias("valid"), F.coalesce(F.sum(F.size("errors")), F.lit(0)).cast("long").alias("error_count"), F.coalesce(F.sum(F.size("warnings")), F.lit(0)).cast("long").alias("warning_count"))


LISTS = ("CWE", "CAPEC", "TECHNIQUES")


def validate_records(lines: DataFrame) -> DataFrame:
    """(cve_id, body as JSON text) -> also errors and warnings: a malformed id, a body that is no object, a list field
    that is none; a missing list is a warning."""
    v = F.try_parse_json("body")
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    errors = [F.when(~F.coalesce(F.col("cve_id").startswith("CVE-"), F.lit(False)), "id"), F.when(v.isNull() | ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), "body")]
    warnings = []
    for name in LISTS:
        k = kind(f"$.{name}")
        errors.append(F.when(k.isNotNull() & ~k.startswith("ARRAY"), name))
        warnings.append(F.when(k.isNull(), name))
    some = lambda xs: F.filter(F.array(*xs), lambda x: x.isNotNull())
    return lines.withColumn("errors", some(errors)).withColumn("warnings", some(warnings))
