"""Message templates rendered as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_FIELD = re.compile(r"\{(\w+)\}")


def render(template: str, **values) -> Column:
    """``template`` with each ``{name}`` replaced by ``values[name]`` (a Column, column
    name or plain value, cast to text): one ``concat`` of literals and columns."""
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        v = values[m.group(1)]
        parts.append((v if isinstance(v, Column) else F.lit(v)).cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if len(parts) > 1 else parts[0]
