"""Content hashes and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_PREFIX = "sha256:"


def sha256_label(content: Column) -> Column:
    """Labelled SHA-256 hex digest of text (as UTF-8) or bytes."""
    return F.concat(F.lit(HASH_PREFIX), F.sha2(content, 256))


def byte_size(content: Column) -> Column:
    return F.octet_length(content).cast("bigint")
