"""Keyed pseudonyms: HMAC-SHA256 composed from Spark's own sha2."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def hmac_sha256(value: Column, salt: str) -> Column:
    """Lower-case hex HMAC-SHA256 of a string column; the padded keys are constants of the plan."""
    key = salt.encode("utf-8")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    inner_pad = F.lit(bytearray(b ^ 0x36 for b in key))
    outer_pad = F.lit(bytearray(b ^ 0x5C for b in key))
    inner = F.sha2(F.concat(inner_pad, F.encode(value, "UTF-8")), 256)
    return F.sha2(F.concat(outer_pad, F.unhex(inner)), 256)


def session_hash(ip: Column, user_agent: Column, day: Column, salt: str) -> Column:
    """Links one visitor's records within one day, and no longer: the day is part of the value."""
    value = F.concat_ws(
        "|",
        F.coalesce(ip, F.lit("")),
        F.substring(F.coalesce(user_agent, F.lit("")), 1, 100),
        F.date_format(day, "yyyy-MM-dd"),
    )
    return hmac_sha256(value, salt)


def user_agent_hash(user_agent: Column, salt: str) -> Column:
    """Empty, not a hash, where there is no user agent."""
    known = user_agent.isNotNull() & (user_agent != "")
    return F.when(known, hmac_sha256(user_agent, salt)).otherwise(F.lit(""))


def visit_hash(session_id: Column, salt: str) -> Column:
    """Null where there is no session: a hash of nothing would look like one shared session."""
    known = session_id.isNotNull() & (session_id != "")
    return F.when(known, hmac_sha256(session_id, salt))
