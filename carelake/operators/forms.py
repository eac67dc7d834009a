"""Audit forms (D22): a declarative catalogue, one engine, and a quarantine of what could not be read.

A form is a sheet of text columns under its own headers. Its specification
names, for each field of the common table, the header and the kind of value;
the engine cleans headers, drops blank rows (F12), reads every cell and keeps,
in the same pass, each cell that holds something it cannot read:
``form, row_id, field, raw, reason``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import coerce as C
from carelake.functions.names import clean_headers
from carelake.functions.text import blank

__all__ = ["FormSpec", "KINDS", "read_form", "read_forms", "clean_rows", "quarantine_rows"]

#: Kind of a field -> its reader (text Column -> value, NULL if it cannot be read) and its type.
KINDS = {
    "text": (lambda c: F.trim(c), "string"),
    "whole": (lambda c: C.int_if_digits(c), "bigint"),
    "number": (lambda c: C.to_double(F.replace(F.trim(c), F.lit(","), F.lit("."))), "double"),
    "percent": (lambda c: C.percent(c, "null"), "double"),
    "date": (lambda c: C.coerce_date(c, "dd/MM/yyyy", "yyyy-MM-dd"), "date"),
    "yes_no": (lambda c: F.when(F.upper(F.trim(c)).isin("SI", "SÍ", "X"), 1).when(F.upper(F.trim(c)).isin("NO"), 0), "int"),
}


@dataclass(frozen=True)
class FormSpec:
    """``fields``: common field -> (header, kind); ``row_id``: header of the row's id; ``content``: fields that a row needs one of;
    ``required``: fields whose absence is a finding."""

    name: str
    row_id: str
    fields: dict[str, tuple[str, str]]
    content: tuple[str, ...]
    required: tuple[str, ...] = field(default=())



def read_form(df: DataFrame, spec: FormSpec, common: dict[str, str]) -> DataFrame:
    """``form, row_id``, the ``common`` fields (name -> type; NULL where the form has none) and ``findings`` of one form's sheet."""
    at = {clean_headers(c, lower=True): c for c in df.columns}

    def raw(header: str) -> Column:
        c = at.get(clean_headers(header, lower=True))
        return F.lit(None).cast("string") if c is None else F.col(f"`{c}`").cast("string")

    cells = {f: (raw(h), kind, clean_headers(h, lower=True) in at) for f, (h, kind) in spec.fields.items()}
    keep = ~reduce(lambda a, b: a & b, [blank(cells[f][0]) for f in spec.content])
    out, found = [], []
    for f, dtype in common.items():
        if f not in cells:
            out.append(F.lit(None).cast(dtype).alias(f))
            continue
        c, kind, there = cells[f]
        value = KINDS[kind][0](c).cast(dtype)
        out.append(F.when(~blank(c), value).alias(f))
        bad = F.when(~blank(c) & value.isNull(), F.lit(f"not a {kind}"))
        if f in spec.required:
            bad = F.when(blank(c), F.lit("missing" if there else "no such column")).otherwise(bad)
        found.append(F.when(bad.isNotNull(), F.struct(F.lit(f).alias("field"), c.alias("raw"), bad.alias("reason"))))
    findings = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array()
    return df.filter(keep).select(F.lit(spec.name).alias("form"), raw(spec.row_id).alias("row_id"), *out, findings.alias("findings"))


def read_forms(sheets: dict[str, DataFrame], catalogue) -> DataFrame:
    """All forms of a catalogue that have a sheet, in one table."""
    common: dict[str, str] = {}
    for s in catalogue:
        for f, (_, kind) in s.fields.items():
            if common.setdefault(f, KINDS[kind][1]) != KINDS[kind][1]:
                common[f] = "string" if "string" in (common[f], KINDS[kind][1]) else "double"
    return reduce(lambda a, b: a.unionByName(b), [read_form(sheets[s.name], s, common) for s in catalogue if s.name in sheets])


def clean_rows(forms: DataFrame) -> DataFrame:
    """The rows without their findings."""
    return forms.drop("findings")


def quarantine_rows(forms: DataFrame) -> DataFrame:
    """``form, row_id, field, raw, reason``: a row a finding."""
    return forms.select("form", "row_id", F.explode("findings").alias("x")).select("form", "row_id", "x.*")
