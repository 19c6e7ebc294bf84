"""Join keys for long text: a 64-bit digest in front of the exact text.

The digest makes the sort/shuffle prefix discriminative (JSON records share
long common prefixes); the text equality stays in the join condition so a
digest collision can never match two different records.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGEST = "__kd"


def digest(*cols: str) -> Column:
    return F.xxhash64(*[F.col(c) for c in cols])


def stored_digest_name(key: str) -> str:
    """Name of the stored digest column of a text key (``movie_digest``)."""
    return f"{key}_digest"


#: Distinct digests that a Parquet row group's Bloom filter is sized for.
BLOOM_KEYS = 200_000


def bloom_options(columns: Iterable[str], key: str) -> dict[str, str]:
    """Writer options that give the stored digest of ``key`` a Bloom filter in each row group.

    An equality on the digest then skips the row groups that can't hold it.
    """
    name = stored_digest_name(key)
    if name not in set(columns):
        return {}
    return {f"parquet.bloom.filter.enabled#{name}": "true", f"parquet.bloom.filter.expected.ndv#{name}": str(BLOOM_KEYS)}
