"""Column-name matching rules and safe column references.

Each check family matches configured names against a table's header in its
own way; all matching is done on the driver against ``df.columns`` (schema
metadata only), and the matched physical name is then referenced with
back-quotes so names like ``PatientAR90+`` or ``Source Values`` work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=8192)
def col(name: str) -> Column:
    """Reference a column by its exact physical name. Column references are
    immutable and unresolved, so one object per name is shared (cached)."""
    return F.col("`" + name.replace("`", "``") + "`")


def loose(name) -> str:
    """Existence matching: strip, lower, no spaces, no underscores."""
    return str(name).strip().lower().replace(" ", "").replace("_", "")


def underscored(name) -> str:
    """Formula / trend matching: strip, space -> '_', '/' -> '_'."""
    return str(name).strip().replace(" ", "_").replace("/", "_")


def spaced(name) -> str:
    """Formula rule names and reconciliation: strip, space -> '_'."""
    return str(name).strip().replace(" ", "_")


def lowered(name) -> str:
    """Cross-table matching: strip, lower."""
    return str(name).strip().lower()


def exact(name) -> str:
    return name


def header_map(columns: Iterable[str], norm: Callable[[str], str]) -> dict[str, str]:
    """normalised name -> first physical column carrying it."""
    out: dict[str, str] = {}
    for c in columns:
        out.setdefault(norm(c), c)
    return out
