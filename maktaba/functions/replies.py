"""JSON from model replies: the whole text, else the first balanced object that parses, as it is or repaired."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def repair(text: Column, *, quotes: bool = True) -> Column:
    """text without commas before a closing bracket; with quotes, single ones become double if there is no double one."""
    text = F.regexp_replace(F.regexp_replace(text, r",\s*}", "}"), r",\s*]", "]")
    return F.when(~text.contains('"'), F.translate(text, "'", '"')).otherwise(text) if quotes else text


def _balanced(text: str) -> Iterator[str]:
    """The spans from a brace at depth zero to the one that closes it. Braces in strings count, and a stray one is never made up for."""
    depth, start = 0, None
    for brace in re.finditer("[{}]", text):
        if brace.group() == "{":
            start = brace.start() if depth == 0 else start
            depth += 1
        else:
            depth -= 1
            if depth == 0 and start is not None:
                yield text[start : brace.end()]


def _loaded(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return None


def find_object(text: str | None, quotes: bool = True) -> str | None:
    """The reply's object as strict JSON; null if there is none or if the reply is another kind of JSON value."""
    if text is None:
        return None
    try:
        whole = json.loads(text)
        return json.dumps(whole, ensure_ascii=False) if isinstance(whole, dict) else None
    except ValueError:
        pass
    for span in _balanced(text):
        fixed = re.sub(r",\s*]", "]", re.sub(r",\s*}", "}", span))
        if quotes and '"' not in fixed:
            fixed = fixed.replace("'", '"')
        for candidate in (span, fixed):
            found = _loaded(candidate)
            if found is not None:
                return json.dumps(found, ensure_ascii=False)
    return None


def reply_object(reply: Column, *, quotes: bool = True) -> Column:
    @F.pandas_udf("string")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([find_object(t, quotes) for t in texts], dtype=object)

    return found(reply)


def parse_reply(reply: Column, schema: str, *, quotes: bool = True) -> Column:
    """The reply as a struct of the schema. Strict JSON alone gets to from_json, which would take more than that."""
    return F.from_json(reply_object(reply, quotes=quotes), schema)
