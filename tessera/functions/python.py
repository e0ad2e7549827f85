"""What needs Python: sequential state, or a library; in Arrow batches."""

from __future__ import annotations

import difflib
import json
import re

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType


def repaired(text: str | None) -> str | None:
    """A JSON object or list cut off or with commas too many, as valid JSON.

    One pass keeps the open brackets and whether a string is open; a cut text
    is closed at the last place where that gives valid JSON."""
    if text is None:
        return None
    starts = [i for i in (text.find("{"), text.find("[")) if i >= 0]
    if not starts:
        return None
    body = re.sub(r",\s*([}\]])", r"\1", text[min(starts) :])
    stack: list[str] = []
    inside = escaped = False
    cuts: list[tuple[int, str]] = []
    for i, ch in enumerate(body):
        if inside:
            inside = escaped or ch != '"'
            escaped = ch == "\\" and not escaped
            if inside:
                continue
        elif ch == '"':
            inside = True
            continue
        elif ch in "{[":
            stack.append("}" if ch == "{" else "]")
        elif ch in "}]":
            if not stack or stack.pop() != ch:
                break
            if not stack:
                cuts.append((i + 1, ""))
                break
        if ch in ',}]"' or ch.isalnum():
            cuts.append((i if ch == "," else i + 1, "".join(reversed(stack))))
    for end, tail in reversed(cuts):
        try:
            return json.dumps(json.loads(body[:end] + tail), ensure_ascii=False)
        except ValueError:
            continue
    return None


@pandas_udf(StringType())
def repair_json(text: pd.Series) -> pd.Series:
    return text.map(repaired)


@pandas_udf(DoubleType())
def title_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Likeness of two titles, 0 to 1, above 0.8 they count as one; an empty
    or unknown title is like none."""
    form = lambda x: (x or "").lower().strip()
    return pd.Series([difflib.SequenceMatcher(None, form(x), form(y)).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])
