"""Freeze-frame text -> typed array.

Landed frames are the text form of a list of dicts with single-quoted keys
and Python booleans, e.g.
``[{'location': [118.0, 39.9], 'player': {'id': 5, 'name': "O'Neil"}, ..., 'teammate': False}]``.
Turning the two boolean literals into JSON ones lets the built-in JSON reader
(single quotes allowed) parse it; names with either quote kind survive, ``[]``
gives an empty array and malformed text gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.schemas import FRAME

_JSON_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowNonNumericNumbers": "true",
    "mode": "PERMISSIVE",
}


def parse_frame(text: Column | str, fields: tuple[str, ...] | None = None) -> Column:
    """Typed frame; ``fields`` keeps only those player fields (the JSON
    reader then builds less per player, e.g. ``("location",)`` for counts)."""
    c = F.col(text) if isinstance(text, str) else text
    schema = FRAME
    if fields is not None:
        elem = FRAME.elementType
        schema = T.ArrayType(T.StructType([f for f in elem.fields if f.name in fields]))
    j = F.replace(c, F.lit("'teammate': True"), F.lit("'teammate': true"))
    j = F.replace(j, F.lit("'teammate': False"), F.lit("'teammate': false"))
    j = F.replace(j, F.lit(": None"), F.lit(": null"))
    return F.from_json(j, schema, _JSON_OPTIONS)


def frame_text(players: Column) -> Column:
    """Inverse of :func:`parse_frame` for an ``array<struct>`` built with the
    frame schema: renders the landed text form (single-quoted keys, Python
    booleans) from ``to_json`` with one regular-expression pass for the keys
    and two literal replacements, so no per-player lambda runs.  Used by the
    test binding; real frames arrive as text."""
    t = F.regexp_replace(F.to_json(players), r'"(location|player|position|teammate|id|name)":', "'$1': ")
    t = F.replace(t, F.lit("'teammate': true"), F.lit("'teammate': True"))
    return F.replace(t, F.lit("'teammate': false"), F.lit("'teammate': False"))
