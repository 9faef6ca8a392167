"""Which partition a record goes to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partition_for_key(key: Column, spread: Column, partitions: int) -> Column:
    """Equal keys share a partition; records without a key follow ``spread``.

    The hash is the first 32 bits of the key's MD5, which every SQL engine can repeat.
    A real broker's own placement applies only when its sink is used.
    """
    hashed = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(hashed, F.lit(partitions)), F.pmod(spread, F.lit(partitions))).cast(
        "int"
    )


# Fixed values of the hash that log clients place keys with: seed, multiplier, shift.
_SEED, _MULTIPLIER, _SHIFT = 0x9747B28C, 0x5BD1E995, 24
_WORD = 0xFFFFFFFF


def murmur2(key: Column) -> Column:
    """The 32-bit Murmur2 hash of a key's bytes, as an unsigned number; null for no key.

    Numbers stay below 2**63: a product of 32 and 31 bits. All in built-in functions.
    """
    digits = F.hex(key.cast("binary"))
    size = F.octet_length(key.cast("binary")).cast("bigint")

    def byte(n: Column) -> Column:
        """A byte by its number; 0 beyond the end."""
        text = F.substr(digits, (2 * n + 1).cast("int"), F.lit(2))
        return F.coalesce(F.conv(F.nullif(text, F.lit("")), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))

    def times(x: Column) -> Column:
        return (x * F.lit(_MULTIPLIER)).bitwiseAND(F.lit(_WORD))

    def folded(x: Column, bits: int) -> Column:
        return x.bitwiseXOR(F.shiftrightunsigned(x, bits))

    def word(n: Column) -> Column:
        return byte(n) + byte(n + 1) * 256 + byte(n + 2) * 65536 + byte(n + 3) * 16777216

    whole = F.floor(size / 4).cast("bigint")
    zero = F.lit(0).cast("bigint")
    numbers = F.sequence(zero, F.greatest(whole - 1, zero))
    words = F.transform(F.filter(numbers, lambda k: k < whole), lambda k: word(k * 4))
    mixed = F.transform(F.transform(words, times), lambda x: times(folded(x, _SHIFT)))
    start = size.bitwiseXOR(F.lit(_SEED))
    main = F.aggregate(mixed, start, lambda h, x: times(h).bitwiseXOR(x))
    # The bytes after the last whole word, if any.
    rest = byte(whole * 4) + byte(whole * 4 + 1) * 256 + byte(whole * 4 + 2) * 65536
    tail = F.when(size % 4 > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>"))
    ended = F.aggregate(tail, main, lambda h, x: times(h.bitwiseXOR(x)))
    return F.aggregate(
        F.array(F.lit(13), F.lit(15)), ended, lambda h, bits: F.when(bits == 13, times(folded(h, 13))).otherwise(folded(h, 15))
    )


def partition_by_murmur2(key: Column, partitions: int) -> Column:
    """Where the usual log client puts a record with a key: its hash without the sign bit, modulo."""
    return (murmur2(key).bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(partitions)).cast("int")
