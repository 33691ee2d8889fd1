"""JSON extraction with warehouse ``JSON_VALUE`` / ``JSON_QUERY_ARRAY`` semantics.

Fast path: a document is parsed once with ``from_json`` into a struct whose
fields are all STRING (raw scalar text) or ``array<string>`` (raw element
text). That parse is what the field lookups read -- no per-field re-parse.

``JSON_VALUE`` returns NULL for objects and arrays (D7). ``from_json``
returns their JSON text instead, and a genuine string may also begin with
``{`` or ``[`` (a title like ``[SALE] Hat``), so the first character cannot
decide. Only values whose text starts with ``{``/``[`` -- rare -- are
re-checked through the VARIANT form, which knows the value's real kind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_json(text) -> Column:
    """JSON text -> VARIANT; malformed text gives NULL (every field NULL)."""
    return F.try_parse_json(_c(text))


def json_value(v, path: str) -> Column:
    """Scalar text at ``path`` of a VARIANT; NULL for JSON null, objects and
    arrays (D7)."""
    v = _c(v)
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return (F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None))
            .otherwise(F.try_variant_get(v, path, "string")))


def parse_fields(doc, scalars: Sequence[str], arrays: Sequence[str] = ()) -> Column:
    """Parse ``doc`` once into a struct of top-level fields: ``scalars`` as raw
    text, ``arrays`` as arrays of raw element text (NULL unless an array)."""
    ddl = ",".join([f"`{k}`:string" for k in scalars] + [f"`{k}`:array<string>" for k in arrays])
    return F.from_json(_c(doc), f"struct<{ddl}>")


def scalar_text(parsed: Column, doc, key: str) -> Column:
    """``JSON_VALUE(doc, '$.key')`` from a ``parse_fields`` struct: exact for
    strings (objects/arrays -> NULL), with the variant re-check only for text
    starting with ``{`` or ``[``."""
    raw = parsed[key]
    first = F.substring(raw, 1, 1)
    return F.when(first.isin("{", "["), json_value(parse_json(doc), f"$.{key}")).otherwise(raw)


def number_text(parsed: Column, key: str) -> Column:
    """Raw text for a field that is cast to a number or timestamp next: an
    object/array text never passes the cast guard, so no re-check is needed."""
    return parsed[key]


def path_value(doc, path: str) -> Column:
    """``JSON_VALUE`` for an arbitrary path (slow path: variant parse)."""
    return json_value(parse_json(doc), path)


def top_level_key(path: str) -> str | None:
    """``'$.name'`` -> ``'name'``; None for nested or indexed paths."""
    if path.startswith("$.") and all(ch not in path[2:] for ch in ".[]'\""):
        return path[2:]
    return None
