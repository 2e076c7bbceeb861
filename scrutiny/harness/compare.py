"""Compare a query's rows with its oracle's: columns by name, rows in any order."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame


def _plain(value: Any) -> Any:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def differences(frame: DataFrame, connection: Any, sql: str) -> list[str]:
    """Empty if names, types of values and values agree."""
    columns = sorted(frame.columns)
    ours = Counter(
        tuple(_plain(row[c]) for c in columns) for row in frame.select(*columns).collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return [f"columns differ: {columns} / {sorted(names)}"]
    order = [names.index(c) for c in columns]
    theirs = Counter(
        tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    out = []
    if sum(ours.values()) != sum(theirs.values()):
        out.append(f"rows: {sum(ours.values())} / {sum(theirs.values())}")
    if ours != theirs:
        out.append(f"only ours: {list((ours - theirs).items())[:3]}")
        out.append(f"only oracle: {list((theirs - ours).items())[:3]}")
    for value_ours, value_theirs in zip(next(iter(ours), ()), next(iter(theirs), ())):
        if (isinstance(value_ours, float)) != (isinstance(value_theirs, float)) and None not in (
                value_ours, value_theirs):
            out.append(f"kinds differ: {value_ours!r} / {value_theirs!r}")
    return out
