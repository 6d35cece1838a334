"""JSON objects found in free text, repaired where they were broken."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TRAILING = re.compile(r",(\s*[}\]])")
_BARE_KEY = re.compile(r"([{,]\s*)([A-Za-z_]\w*|'[^'\"]*\"?)\s*:")


def _scan(text: str) -> tuple[int, list[str], bool]:
    """Where the first object of a text ends (-1 if it doesn't), its open brackets, and whether a string is open."""
    stack: list[str] = []
    quoted = escaped = False
    for i, c in enumerate(text):
        if quoted:
            quoted = escaped or c != '"'
            escaped = not escaped and c == "\\"
        elif c == '"':
            quoted = True
        elif c in "{[":
            stack.append("}" if c == "{" else "]")
        elif c in "}]" and stack:
            stack.pop()
            if not stack:
                return i, [], False
    return -1, stack, quoted


def _load(text: str) -> object:
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def repaired(text: str | None) -> str | None:
    """The first JSON object of a text in plain form; null if there is none and none can be made.

    Tried in this order: the object as it is; with trailing commas removed and bare or
    wrongly quoted keys quoted; cut off after its last whole member and its brackets closed.
    """
    if not text or "{" not in text:
        return None
    body = text[text.index("{") :]
    end, _, _ = _scan(body)
    whole = body[: end + 1] if end >= 0 else body
    fixed = _BARE_KEY.sub(lambda m: f'{m[1]}"{m[2].strip(chr(39) + chr(34))}":', _TRAILING.sub(r"\1", whole))
    for attempt in (whole, fixed):
        if isinstance(held := _load(attempt), dict):
            return json.dumps(held, ensure_ascii=False)
    while "," in fixed or fixed:
        _, stack, quoted = _scan(fixed)
        closed = fixed + '"' * quoted + "".join(reversed(stack))
        if isinstance(held := _load(closed), dict):
            return json.dumps(held, ensure_ascii=False)
        if "," not in fixed:
            return None
        fixed = fixed[: fixed.rindex(",")]
    return None


@F.pandas_udf(T.StringType())
def repair(texts: pd.Series) -> pd.Series:
    """``repaired`` over a column: brackets can't be balanced by expressions."""
    return texts.map(repaired)
