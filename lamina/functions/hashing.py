"""Pseudonymizing hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_ALGORITHMS = {
    "sha256": lambda c: F.sha2(c, 256),
    "sha512": lambda c: F.sha2(c, 512),
    "md5": F.md5,
}


def pseudonym(col: Column, algorithm: str = "sha256", empty_as_null: bool = False) -> Column:
    """Hex digest of the text form of ``col``; NULL stays NULL.

    With ``empty_as_null`` the empty string also yields NULL, so that "no value" cannot be
    recognized by its well-known digest.
    """
    try:
        digest = _ALGORITHMS[algorithm]
    except KeyError:
        raise ValueError(f"Unsupported hashing algorithm: {algorithm}") from None
    text = col.cast("string")
    if empty_as_null:
        text = F.when(text != F.lit(""), text)
    return digest(text)
