"""Python-literal lists that JSON can't read (trailing commas, None, mixed quotes)."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(value: object) -> str | None:
    return None if value is None else value if isinstance(value, str) else str(value)


def read_literal(body: str | None) -> list[dict] | None:
    """The list of dicts that a text spells as a Python literal; None if it spells none."""
    try:
        found = ast.literal_eval(body or "")
    except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
        return None
    if not isinstance(found, list) or not all(isinstance(x, dict) for x in found):
        return None
    return [{k: _text(x.get(k)) for k in ("SACT", "relation", "time")} for x in found]


_LINKS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("SACT", "relation", "time")]))


@F.pandas_udf(_LINKS)
def literal_tlinks(body: pd.Series) -> pd.Series:
    some = body.notna()
    if not some.any():  # the usual case: everything was JSON
        return pd.Series([None] * len(body), dtype=object)
    return body.map(read_literal)
