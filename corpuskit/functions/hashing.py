"""Deterministic hashes, shuffle keys and picture-hash comparisons as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def md5_modulus(text: Column | str, n: int) -> Column:
    """The whole 128-bit md5 modulo n (at most 2 ** 47), taken in from the left four digits at a time."""
    digest, rest = F.md5(col(text)), F.lit(0).cast("bigint")
    for k in range(8):
        piece = F.conv(F.substring(digest, 4 * k + 1, 4), 16, 10).cast("bigint")
        rest = (rest * 65_536 + piece) % F.lit(max(1, n))
    return rest


def hash_bucket(text: Column | str, n: int) -> Column:
    return F.format_string("bucket_%03d", md5_modulus(text, n))


def hash_offset(text: Column | str) -> Column:
    """The first 32 bits of md5."""
    return F.conv(F.substring(F.md5(col(text)), 1, 8), 16, 10).cast("bigint")


def seed_offset(text: Column | str, modulus: int = 100_003) -> Column:
    """Sum of place times character code, modulo modulus."""
    t = col(text)
    codes = F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: i * F.ascii(F.substring(t, i, F.lit(1))))
    total = F.aggregate(codes, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.when(F.length(t) == 0, F.lit(0)).otherwise(total % modulus)


def shuffle_key(seed: int | str, *parts: Column | str) -> Column:
    """md5 text that orders rows reproducibly in place of a random permutation."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[col(p).cast("string") for p in parts]))


def uniform(key: Column) -> Column:
    """52 bits of an md5 text as a number in [0, 1)."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def hash_to_long(c: Column | str) -> Column:
    """16 hexadecimal digits as a signed 64-bit number; null if blank or malformed."""
    t = F.trim(col(c))
    return F.when(t.rlike("^[0-9a-fA-F]{1,16}$"), F.conv(t, 16, -10).cast("bigint"))


def hamming(a: Column, b: Column, blank: int = 1 << 30) -> Column:
    """Differing bits of two 64-bit numbers; ``blank`` if one is null."""
    return F.coalesce(F.bit_count(a.bitwiseXOR(b)), F.lit(blank))


def thumb_bytes(c: Column | str) -> Column:
    """Hexadecimal bytes as numbers; null if blank."""
    t = F.trim(col(c))
    n = F.floor(F.length(t) / 2).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(F.substring(t, i * 2 + 1, F.lit(2)), 16, 10).cast("int")))


def mean_difference(a: Column, b: Column) -> Column:
    """Mean absolute difference of two byte arrays; infinite if one is null or sizes differ."""
    total = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    return F.when(F.size(a) == F.size(b), total.cast("double") / F.size(a)).otherwise(F.lit(float("inf")))


def log_aspect(width: Column | str, height: Column | str) -> Column:
    """log(width / height), either at least 1."""
    return F.log(F.greatest(F.coalesce(col(width), F.lit(0)), F.lit(1)) / F.greatest(F.coalesce(col(height), F.lit(0)), F.lit(1)))


def band(c: Column, k: int, bits: int) -> Column:
    """The k-th group of ``bits`` bits from the lowest."""
    return F.shiftrightunsigned(c, k * bits).bitwiseAND(F.lit((1 << bits) - 1))


def sign_bits(vector: Column | str) -> Column:
    """Bit i is set where element i (of at most 64) is above zero."""
    one = F.lit(1).cast("bigint")
    bits = F.transform(col(vector), lambda x, i: F.when(x > 0, F.call_function("shiftleft", one, i)).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
