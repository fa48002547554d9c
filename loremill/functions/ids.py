"""Deterministic identifiers as column expressions (no Python on the executors)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: the namespace of all name-based identifiers.
NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
_HEX, _VARIANT = "0123456789abcdef", "89ab89ab89ab89ab"
UUID_PATTERN = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def uuid5(name: Column | str, namespace: str = NAMESPACE) -> Column:
    """Name-based UUID, version 5, of a UTF-8 name; null for null."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(col(name), "UTF-8")))
    part = lambda a, b: F.substring(h, a, b - a + 1)
    variant = F.translate(part(17, 17), _HEX, _VARIANT)
    return F.concat(part(1, 8), F.lit("-"), part(9, 12), F.lit("-5"), part(14, 16), F.lit("-"), variant, part(18, 20), F.lit("-"), part(21, 32))


def text_hash(text: Column | str) -> Column:
    """SHA-256 of the UTF-8 text, in hexadecimal."""
    return F.sha2(F.encode(col(text), "UTF-8"), 256)


def _named(*parts: Column | str) -> Column:
    return uuid5(F.concat_ws(":", *(col(p).cast("string") for p in parts)))


def _if_given(value: Column, *needed: Column | str) -> Column:
    """Null unless every needed column has characters: such rows are for a reject table, never for a default."""
    ok = F.lit(True)
    for c in needed:
        ok = ok & (F.length(F.coalesce(col(c), F.lit(""))) > 0)
    return F.when(ok, value)


def document_id(tenant, project_id, content_hash) -> Column:
    return _if_given(_named(tenant, project_id, content_hash), tenant, project_id)


def chunk_id(tenant, document, index, chunk_hash) -> Column:
    return _if_given(_named(tenant, document, index, chunk_hash), tenant)


def community_id(tenant, project_id, batch_id, level, cluster_key) -> Column:
    return _if_given(_named(tenant, project_id, batch_id, level, cluster_key), tenant, project_id)


def entity_id(name) -> Column:
    """Identifier of a trimmed entity name; null for a blank one."""
    from .text import strip

    trimmed = strip(col(name))
    return F.when(trimmed != "", uuid5(F.concat(F.lit("entity:"), trimmed)))


def entity_ref(ref) -> Column:
    """An identifier stays; ``entity:name`` and a bare name are named; null for a blank reference."""
    from .text import strip

    value = strip(col(ref))
    return F.when(value.rlike(UUID_PATTERN), value).when(value.startswith("entity:"), entity_id(F.substring(value, F.lit(8), F.length(value)))).otherwise(entity_id(value))
