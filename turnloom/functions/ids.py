"""Deterministic ids, digests and UTF-16 lengths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespace of all ids, and the version of the digest scheme.
NAMESPACE = "6f1a0d3c-7b4e-5a92-8c11-2d5e9f0b4a77"
DIGEST_VERSION = 2


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def short_hash(text: Column, length: int = 16) -> Column:
    return F.substring(sha256(text), 1, length)


def uuid(name: Column) -> Column:
    """The name-based UUID of name within the namespace: SHA-1 with version 5 and RFC variant bits."""
    h = F.sha1(F.concat(F.lit(NAMESPACE).cast("binary"), F.unhex(F.lit("00")), name.cast("binary")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def target_session_id(session_id: Column, variant: Column | str = "") -> Column:
    v = F.lit(variant) if isinstance(variant, str) else variant
    suffix = F.when(F.coalesce(v, F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit("/"), v))
    return F.concat(F.lit("session-"), uuid(F.concat(F.lit("session/"), session_id, suffix)))


def message_id(session_id: Column, kind: Column, source_id: Column) -> Column:
    """kind: user, injected, assistant or tool-result."""
    return uuid(F.concat_ws("/", F.lit("message"), session_id, kind, source_id))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units: a character outside the basic plane counts two."""
    return F.shiftright(F.octet_length(F.encode(text, "UTF-16BE")), 1).cast("long")


def file_name(session_id: Column) -> Column:
    """A file name for a session: unusual characters replaced, and a short hash."""
    return F.concat(F.regexp_replace(session_id, r"[^A-Za-z0-9._-]", "_"), F.lit("-"), short_hash(session_id, 8))


def by_locale(text: Column | str) -> Column:
    """A text as languages order it, whatever its case and accents, for orderBy."""
    return F.collate(F.col(text) if isinstance(text, str) else text, "UNICODE")
