"""Identities and pseudonyms (P05, P06, X20, record identity)."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Author names that stand for a deleted account.
DELETED_AUTHORS = ("[deleted]", "[removed]", "")
BOT_AUTHORS = ("automoderator",)


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Hex HMAC-SHA256 from two native digests; the pads are made on the driver, so the key is in no plan as such."""
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    inner, outer = (F.unhex(F.lit(bytes(b ^ p for b in key).hex())) for p in (0x36, 0x5C))
    first = F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(outer, F.unhex(first)), 256)


def pseudonym(author: Column, key: bytes) -> tuple[Column, Column]:
    """(hash, status); a missing name is unavailable, a placeholder deleted, both without a hash."""
    name = F.lower(strip(author))
    deleted = name.isin(*DELETED_AUTHORS)
    status = F.when(author.isNull(), "unavailable").when(deleted, "deleted").otherwise("pseudonymized")
    return F.when(author.isNotNull() & ~deleted, hmac_sha256(key, name)), status


def is_bot(author: Column, author_hash: Column, bots: tuple[str, ...] = BOT_AUTHORS, key: bytes | None = None) -> Column:
    """By name, or by the digest of a bot's name."""
    import hmac

    named = F.coalesce(F.lower(author).isin(*bots), F.lit(False))
    if key is None:
        return named
    digests = [hmac.new(key, b.encode(), "sha256").hexdigest() for b in bots]
    return named | F.coalesce(author_hash.isin(*digests), F.lit(False))


def without_prefix(x: Column, prefix: str) -> Column:
    return F.when(x.startswith(prefix), F.substring(x, len(prefix) + 1, 1 << 30)).otherwise(x)


def with_prefix(x: Column, prefix: str) -> Column:
    return F.when((x != "") & ~x.startswith(prefix), F.concat(F.lit(prefix), x)).otherwise(x)


def record_identity(fullname: Column, record_type: Column, short_id: Column, other_id: Column) -> Column:
    """The full name, else the kind's prefix with the short id, else NULL."""
    short = F.coalesce(F.nullif(short_id, F.lit("")), F.nullif(other_id, F.lit("")))
    prefix = F.when(record_type == "submission", "t3_").when(record_type == "comment", "t1_")
    return F.coalesce(F.nullif(fullname, F.lit("")), F.concat(prefix, short))
