"""Which partition of a topic a message goes to, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def string_partition(key: Column, partitions: int) -> Column:
    """Stable hash partition of a string key: ``abs(h) % partitions``.

    ``h`` is the signed 32-bit little-endian number in the first four bytes of the
    MD5 digest of the key's UTF-16LE characters. The absolute value is taken in 64
    bits, so the smallest 32-bit number has a valid partition too.
    """
    return partition_of_digest(key_digest(key), partitions)


def key_digest(key: Column) -> Column:
    return F.md5(F.encode(key, "UTF-16LE"))


def partition_of_digest(digest: Column, partitions: int) -> Column:
    low_word = F.concat(*[F.substring(digest, at, 2) for at in (7, 5, 3, 1)])
    unsigned = F.conv(low_word, 16, 10).cast("bigint")
    signed = F.pmod(unsigned + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31)
    return F.pmod(F.abs(signed), F.lit(partitions)).cast("int")


def round_robin_partition(arrival: Column, partitions: int) -> Column:
    """Even spread for messages without a key, by their arrival number."""
    return F.pmod(arrival.cast("bigint"), F.lit(partitions)).cast("int")
