"""Silver layer: cleaning rules declared per table and compiled to one filter, and the click totals.

A rule set says which columns must be present, which must lie in a fixed domain,
and which numbers, where present, must lie in a range. The compiled filter is one
predicate on the scan, which Catalyst pushes into the Parquet reader (or evaluates
while parsing CSV). NaN compares above every number in Spark, so a NaN score fails
its upper bound and is dropped while a NaN weight passes its lower bound and is kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edustar.schemas import VALID_PRESENTATIONS


@dataclass(frozen=True)
class Rules:
    required: tuple[str, ...] = ()
    domains: dict[str, tuple] = field(default_factory=dict)
    ranges: dict[str, tuple] = field(default_factory=dict)  # column -> (lowest, highest or None); null passes

    def predicate(self) -> Column:
        parts = [F.col(c).isNotNull() for c in self.required]
        parts += [F.col(c).isin(*values) for c, values in self.domains.items()]
        for c, (low, high) in self.ranges.items():
            inside = F.col(c) >= low if high is None else F.col(c).between(low, high)
            parts.append(F.col(c).isNull() | inside)
        return reduce(Column.__and__, parts)


# The cleaning rules of the six filtered tables.
_PRESENTATIONS = {"code_presentation": VALID_PRESENTATIONS}
RULES = {
    "courses": Rules(required=("code_module",)),
    "student_info": Rules(required=("id_student",), domains=_PRESENTATIONS),
    "assessments": Rules(required=("id_assessment",), ranges={"weight": (0, None)}),
    "vle": Rules(required=("id_site",)),
    "student_registration": Rules(required=("id_student",), domains=_PRESENTATIONS),
    "student_assessment": Rules(required=("id_assessment", "id_student"), ranges={"score": (0, 100)}),
}


def clean(table: str, raw: DataFrame) -> DataFrame:
    return raw.where(RULES[table].predicate())


CLEANERS = {table: partial(clean, table) for table in RULES}


def vle_clicks(raw_student_vle: DataFrame) -> DataFrame:
    """Positive clicks summed per enrolment; the partial sums run before the shuffle."""
    positive = raw_student_vle.where("sum_click > 0")  # a null click count isn't positive either
    return positive.groupBy("id_student", "code_module", "code_presentation").agg(
        F.sum("sum_click").cast("long").alias("total_clicks"))


def build(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All seven silver tables from the raw ones."""
    return {**{t: fn(bronze[t]) for t, fn in CLEANERS.items()}, "vle_clicks": vle_clicks(bronze["student_vle"])}
