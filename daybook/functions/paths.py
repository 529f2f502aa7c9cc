"""Percent-decoding of object paths as they arrive in storage events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_path(path: Column) -> Column:
    """Decode ``%XX`` sequences. ``+`` stays a plus, a ``%`` that starts no sequence stays as it is."""
    kept = F.regexp_replace(path, r"%(?![0-9A-Fa-f]{2})", "%25")
    kept = F.replace(kept, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(kept), path)
