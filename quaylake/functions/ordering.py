"""Sort specifications shared by window de-duplication and top-N reports.

A spec is text such as ``"shipment_date DESC NULLS LAST"``; the same text is
turned into a Spark `Column` here and can be pasted into SQL unchanged, so a
query and its SQL check order rows identically.  Null placement defaults to
Spark's rule: ASC puts NULLs first, DESC puts them last.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize(spec: str) -> str:
    """Spell out direction and null placement: ``"x"`` -> ``"x ASC NULLS FIRST"``."""
    words = spec.split()
    name, rest = words[0], [w.upper() for w in words[1:]]
    direction = "DESC" if "DESC" in rest else "ASC"
    if "NULLS" in rest:
        nulls = rest[rest.index("NULLS") + 1]
    else:
        nulls = "LAST" if direction == "DESC" else "FIRST"
    return f"{name} {direction} NULLS {nulls}"


def sort_column(spec: str) -> Column:
    name, direction, _, nulls = normalize(spec).split()
    col = F.col(name)
    if direction == "DESC":
        return col.desc_nulls_first() if nulls == "FIRST" else col.desc_nulls_last()
    return col.asc_nulls_first() if nulls == "FIRST" else col.asc_nulls_last()


def full_order(columns: list[str], keys: list[str], order: list[str],
               tie_break: list[str] | None = None) -> list[str]:
    """`order` followed by tie-breakers: every other column ascending.

    Ties then resolve the same way in every run and in the SQL check; only
    rows equal in all columns remain tied, and those are interchangeable.
    """
    used = set(keys) | {normalize(s).split()[0] for s in order}
    rest = tie_break if tie_break is not None else [c for c in columns if c not in used]
    return [normalize(s) for s in order] + [normalize(c) for c in rest]
