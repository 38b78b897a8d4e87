"""HMAC-SHA256 signatures as a column expression."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64
PREFIX = "sha256="


def pads(secret: str) -> tuple[str, str]:
    """Inner and outer key pads in hex; a key longer than a block is hashed first."""
    key = secret.encode()
    if len(key) > BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def signature(body: Column, secret: str) -> Column:
    """``sha256=<hex>`` over the UTF-8 bytes of ``body``."""
    inner, outer = (F.unhex(F.lit(p)) for p in pads(secret))
    digest = F.unhex(F.sha2(F.concat(inner, F.encode(body, "UTF-8")), 256))
    return F.concat(F.lit(PREFIX), F.sha2(F.concat(outer, digest), 256))


def signed_by(body: Column, given: Column, secret: str) -> Column:
    return F.coalesce(given == signature(body, secret), F.lit(False))
