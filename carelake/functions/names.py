"""Header-name functions.

These act on column *names* (schema metadata on the driver), never on data,
and are applied with ``df.toDF(*new_names)``.
"""

from __future__ import annotations

import re

__all__ = ["camel", "camel_safe", "snake", "clean_headers", "rename_with"]

# What a word of a header is, the name of a header without one,
# and what stands before a leading digit.
_WORD = re.compile(r"[A-Za-zÀ-ÿ0-9]+")
NO_WORDS = "col"
DIGIT_PREFIX = "c_"


def _cap(w: str) -> str:
    """First character upper, the rest lower (Python ``str.capitalize``)."""
    return w[:1].upper() + w[1:].lower()


def camel(name: str, variant: str = "keep_first", sep: str = "_") -> str:
    """P9 camel-case variants.

    * ``keep_first``: first token unchanged, later tokens capitalized.
    * ``lower_all``: lower-case first, then as ``keep_first``.
    * ``strip_lower``: trim + lower, empty tokens dropped (all empty -> ``''``).
    * ``split_other``: split on ``sep`` (e.g. a space); every token
      capitalized, then the first lower-cased.
    """
    if variant == "keep_first":
        parts = name.split(sep)
        return parts[0] + "".join(_cap(p) for p in parts[1:])
    if variant == "lower_all":
        parts = name.lower().split(sep)
        return parts[0] + "".join(_cap(p) for p in parts[1:])
    if variant == "strip_lower":
        parts = [p for p in name.strip().lower().split(sep) if p]
        return (parts[0] + "".join(_cap(p) for p in parts[1:])) if parts else ""
    if variant == "split_other":
        parts = [_cap(p) for p in name.split(sep)]
        parts[0] = parts[0].lower()
        return "".join(parts)
    raise ValueError(f"unknown camel variant {variant!r}")


def _safe_base(name: str) -> str:
    """One header as an identifier: lower camel case of its words."""
    first, *rest = _WORD.findall(name) or [NO_WORDS]
    text = first.lower() + camel("_".join(["", *rest])) if rest else first.lower()
    return text if text[0].isalpha() else DIGIT_PREFIX + text


def camel_safe(names: list[str]) -> list[str]:
    """P10: unique identifiers for a list of headers, in order.

    A header that repeats an earlier name gets the next free number of that
    name (counted per name): ``x``, ``x_2``, ``x_3``.
    """
    taken: dict[str, int] = {}

    def unique(base: str) -> str:
        taken[base] = taken.get(base, 0) + 1
        if taken[base] == 1:
            return base
        name = f"{base}_{taken[base]}"
        if name in taken:  # a header of its own has that name already
            return unique(base)
        taken[name] = 1
        return name

    return [unique(_safe_base(str(n))) for n in names]


def snake(name: str, fold_enye: bool = True) -> str:
    """Drop ``-``, each double space -> one, lower, space -> ``_``, ``ñ`` -> ``n``."""
    s = name.replace("-", "").replace("  ", " ").lower().replace(" ", "_")
    return s.replace("ñ", "n") if fold_enye else s


def clean_headers(name: str, lower: bool = False) -> str:
    """Trim, newline -> space, quotes removed (optionally lower-cased)."""
    s = name.strip().replace("\r\n", " ").replace("\n", " ").replace('"', "").replace("'", "")
    return s.lower() if lower else s


def rename_with(df, fn, *args, **kw):
    """Apply a name function to every column in one projection."""
    return df.toDF(*[fn(c, *args, **kw) for c in df.columns])
