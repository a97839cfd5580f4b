"""Order-sensitive digests of message lists that add up.

The digest of a message is SHA-256 over its position, role and text. A list is
summarised by the sums of eight 28-bit slices of those digests, so the digest of
every prefix is a running sum: it can be split over tasks, where a chained hash
would tie a whole conversation to one. BIGINT holds the sums of 2^35 messages. (Additive hashing: Bellare and Micciancio, 1997.)
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatlog.functions.text import as_col

LANES = tuple(f"lane{i}" for i in range(8))


def message_digest(position, role, text) -> Column:
    parts = F.concat_ws(":", as_col(position).cast("string"), as_col(role), as_col(text))
    return F.sha2(parts, 256)


def digest_lane(digest, lane: int) -> Column:
    """28 bits of a hexadecimal digest as BIGINT."""
    return F.conv(F.substring(as_col(digest), 7 * lane + 1, 7), 16, 10).cast("bigint")


def list_digest(count, lanes) -> Column:
    """Digest of a message list from its length and lane sums."""
    parts = [as_col(count).cast("string")]
    parts += [as_col(lane).cast("string") for lane in lanes]
    return F.sha2(F.concat_ws(":", *parts), 256)
