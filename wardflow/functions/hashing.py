"""Repeatable pseudo-random choices built on md5 and SHA-256."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def key_text(*cols) -> Column:
    return F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


def key_hash(*cols, seed=None) -> Column:
    """md5 text of the key; its order is a repeatable shuffle of the keys."""
    parts = list(cols) if seed is None else [F.lit(str(seed)), *cols]
    return F.md5(key_text(*parts).cast("binary"))


def hash_int(*cols, seed=None, digits: int = 15) -> Column:
    """Non-negative 60-bit integer taken from the head of the md5 text."""
    return F.conv(F.substring(key_hash(*cols, seed=seed), 1, digits), 16, 10).cast("bigint")


def hash_unit(*cols, seed=None) -> Column:
    """Uniform number in [0, 1) from the key."""
    return hash_int(*cols, seed=seed, digits=12) / F.lit(float(16**12))


def sha256_mod(data: Column, modulus: Column | int, little: bool = True) -> Column:
    """SHA-256 digest read as one integer, modulo a small number.

    The digest is folded two hex digits at a time from its most significant
    byte (the last one in little-endian order), so no number wider than a long
    is ever needed.
    """
    m = F.lit(modulus) if isinstance(modulus, int) else modulus
    order = [F.lit(i) for i in ((31, 0, -1) if little else (0, 31, 1))]
    step = lambda h, acc, i: (acc * 256 + F.conv(F.substring(h, i * 2 + 1, F.lit(2)), 16, 10).cast("bigint")) % m.cast("bigint")
    fold = lambda h: F.aggregate(F.sequence(*order), F.lit(0).cast("bigint"), lambda acc, i: step(h, acc, i))
    # Binding the digest to a lambda variable computes it once per row.
    return F.transform(F.array(F.sha2(data, 256)), fold)[0]


def little_endian(value: Column, width: int) -> Column:
    """Binary of an integer, least significant byte first."""
    hexed = F.lpad(F.hex(value.cast("bigint")), width * 2, "0")
    pairs = [F.substring(hexed, 2 * i + 1, 2) for i in reversed(range(width))]
    return F.unhex(F.concat(*pairs))
