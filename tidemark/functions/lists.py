"""Lists and maps kept as text in a control table.

Control tables store key and time-column lists as ``|``-separated strings and
column renames as a JSON object. These helpers turn them into Spark array /
map columns so the whole schedule is parsed by one projection.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

LIST_SEPARATOR = "|"


def key_list(keys: str | Iterable[str]) -> list[str]:
    """Normalise ``"a|b"`` / ``["a", "b"]`` to a non-empty list of names."""
    if isinstance(keys, str):
        out = [k.strip() for k in keys.split(LIST_SEPARATOR)]
    else:
        out = [str(k).strip() for k in keys]
    out = [k for k in out if k]
    if not out:
        raise ValueError("at least one key column is required")
    if len(set(out)) != len(out):
        raise ValueError(f"duplicate key column in {out}")
    return out


def split_list(col: Column | str) -> Column:
    """``'a | b|'`` → ``['a', 'b']``; NULL or blank stays NULL; empty items are dropped.

    One regex split (spaces around separators are part of the separator) and
    ``array_remove`` — no lambda, so the expression stays in generated code.
    """
    c = F.col(col) if isinstance(col, str) else col
    parts = F.array_remove(F.split(F.trim(c), r" *\| *"), "")
    return F.when(F.size(parts) > 0, parts)


def parse_json_map(col: Column | str) -> Column:
    """JSON object text → ``map<string,string>``; malformed text → NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, "map<string,string>")


def json_map_error(col: Column | str) -> Column:
    """True where the text is present but is not a JSON object."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (F.trim(c) != "") & parse_json_map(c).isNull()
