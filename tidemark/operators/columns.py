"""Column renames from a control-table mapping ``{old: new}``.

All renames happen at once in one projection, so a swap ``{a: b, b: a}``
really swaps; names not in the frame are ignored; two columns ending up with
one name is an error.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_mapping(mapping: str | Mapping[str, str] | None) -> dict[str, str]:
    if mapping is None:
        return {}
    if isinstance(mapping, str):
        if not mapping.strip():
            return {}
        try:
            value = json.loads(mapping)
        except json.JSONDecodeError as exc:
            raise ValueError(f"column mapping is not valid JSON: {mapping!r}") from exc
        if not isinstance(value, dict):
            raise ValueError(f"column mapping must be a JSON object: {mapping!r}")
        mapping = value
    return {str(k): str(v) for k, v in mapping.items()}


def renamed_names(columns: list[str], mapping: str | Mapping[str, str] | None,
                  case_sensitive: bool = False) -> list[str]:
    m = parse_mapping(mapping)
    if not case_sensitive:
        m = {k.lower(): v for k, v in m.items()}
    out = [m.get(c if case_sensitive else c.lower(), c) for c in columns]
    seen: dict[str, str] = {}
    for old, new in zip(columns, out):
        if new.lower() in seen:
            raise ValueError(f"rename makes two columns named {new!r} ({seen[new.lower()]!r}, {old!r})")
        seen[new.lower()] = old
    return out


def rename_columns(df: DataFrame, mapping: str | Mapping[str, str] | None) -> DataFrame:
    """Rename by exact column name (case-insensitively unless ``spark.sql.caseSensitive`` is on)."""
    case_sensitive = str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
    names = renamed_names(df.columns, mapping, case_sensitive)
    if names == df.columns:
        return df
    return df.select(*[F.col("`" + c.replace("`", "``") + "`").alias(n) for c, n in zip(df.columns, names)])
