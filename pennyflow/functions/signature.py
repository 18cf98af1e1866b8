"""Keyed SHA-256 signatures, from Spark's own ``sha2``."""

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def _padded_key(secret: str, pad: int) -> bytearray:
    key = secret.encode()
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    return bytearray(b ^ pad for b in key.ljust(_BLOCK, b"\0"))


def hmac_sha256(message: Column, secret: str) -> Column:
    """Hex HMAC-SHA256; only the two padded keys are worked out on the driver."""
    inner = F.sha2(F.concat(F.lit(_padded_key(secret, 0x36)), message.cast("binary")), 256)
    return F.sha2(F.concat(F.lit(_padded_key(secret, 0x5C)), F.unhex(inner)), 256)


def signature_holds(given: Column, event_type: Column, secret: str, dry_run: bool = False) -> Column:
    if dry_run:
        return F.lit(True)
    expected = hmac_sha256(F.concat(F.lit(f"{secret}_"), event_type), secret)
    return F.coalesce(given == expected, F.lit(False))
