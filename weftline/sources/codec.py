"""The compact encoding of score shards: lists of like-shaped JSON values as columns, lossless.

A shard is one row of a DataFrame, so shards are encoded and decoded in parallel; a shard's size is the bound. Rows of a
catalogue table need no such codec in Parquet, which has dictionaries and runs of its own: this is for the files that
readers of a release load.
"""

from __future__ import annotations

import json
from itertools import repeat
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The names of the kinds of nodes. plain (values), constant (value, n), dictionary (words, places), objects
# (keys, columns, n), groups of several shapes (which, nodes), raw (values).
PLAIN, CONSTANT, DICTIONARY, OBJECTS, GROUPS, RAW = "p", "c", "d", "o", "g", "r"
#: Most values of a constant column, and most objects of a node.
MOST = 1_000_000
#: No key of an object.
FORBIDDEN = "__proto__"


def _shape(value: Any) -> str | tuple[str, ...]:
    """PLAIN for single values, the keys in order for objects, RAW for what is carried as it is."""
    if isinstance(value, dict):
        return RAW if FORBIDDEN in value else tuple(value)
    return RAW if isinstance(value, list) else PLAIN


def _same(a: Any, b: Any) -> bool:
    # True and 1, and 1 and 1.0, are equal in Python but not the same JSON.
    return type(a) is type(b) and a == b


def pack(values: list) -> list:
    """The node of a list of values."""
    by_shape: dict = {}
    for v in values:
        by_shape.setdefault(_shape(v), []).append(v)
    if len(by_shape) > 1:
        order = {shape: i for i, shape in enumerate(by_shape)}
        return [GROUPS, [order[_shape(v)] for v in values], [pack(group) for group in by_shape.values()]]
    shape = next(iter(by_shape), RAW)
    if shape == RAW:
        return [RAW, values]
    if shape != PLAIN:
        return [OBJECTS, list(shape), [pack([v[k] for v in values]) for k in shape], len(values)]
    if len(values) > 1 and all(_same(v, values[0]) for v in values):
        return [CONSTANT, values[0], len(values)]
    if all(v is None or isinstance(v, str) for v in values):
        places = {w: i for i, w in enumerate(dict.fromkeys(values))}
        if 2 * len(places) <= len(values):
            return [DICTIONARY, list(places), [places[v] for v in values]]
    return [PLAIN, values]


def _need(good: bool) -> None:
    if not good:
        raise ValueError("not a compact shard")


def _whole(n: Any, least: int, most: int) -> bool:
    return type(n) is int and least <= n <= most


def unpack(node: Any) -> list:
    """The values of a node; ValueError where it is none."""
    _need(isinstance(node, list) and len(node) > 1)
    kind, *parts = node
    match kind, parts:
        case ("p" | "r", [list(values)]):
            return values
        case ("c", [value, n]):
            _need(not isinstance(value, (list, dict)) and _whole(n, 2, MOST))
            return list(repeat(value, n))
        case ("d", [list(words), list(places)]):
            _need(all(_whole(i, 0, len(words) - 1) for i in places) and all(w is None or isinstance(w, str) for w in words))
            return [words[i] for i in places]
        case ("o", [list(keys), list(columns), n]):
            _need(_whole(n, 1, MOST) and len(keys) == len(columns) == len(set(map(str, keys))))
            _need(all(isinstance(k, str) and k != FORBIDDEN for k in keys))
            read = [unpack(c) for c in columns]
            _need(all(len(c) == n for c in read))
            return [dict(zip(keys, row, strict=True)) for row in zip(*read, strict=True)] if keys else [{} for _ in range(n)]
        case ("g", [list(which), list(nodes)]):
            _need(len(nodes) > 1 and all(_whole(i, 0, len(nodes) - 1) for i in which))
            groups = [unpack(x) for x in nodes]
            _need([which.count(i) for i in range(len(nodes))] == list(map(len, groups)))
            rest = [iter(g) for g in groups]
            return [next(rest[i]) for i in which]
    raise ValueError("not a compact shard")


def _text(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def encoded(rows: Column) -> Column:
    """The compact node, as JSON text, of a JSON list of rows; carried raw where it would not come back the same. Null for null."""

    @F.pandas_udf("string")
    def encode(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            if text is None:
                return None
            values = json.loads(text)
            node = pack(values)
            return _text(node if _text(unpack(json.loads(_text(node)))) == _text(values) else [RAW, values])

        return texts.map(one)

    return encode(rows)


def decoded(node: Column) -> Column:
    """The JSON list of rows of a compact node; a malformed one fails the job. Null for null."""

    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: None if text is None else _text(unpack(json.loads(text))))

    return decode(node)
