"""Hash-based column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pseudonymize(c, digits: int = 12) -> Column:
    """First ``digits`` hex digits of SHA-256 (a pseudonym; no k is enforced)."""
    return F.substring(F.sha2(_c(c).cast("string"), 256), 1, digits)


def md5_mod(text: Column, m: int) -> Column:
    """int(md5(text) as 128-bit hex) mod m, exactly, in 64-bit arithmetic.

    The hex digest is read in four 32-bit chunks, Horner style:
    acc = (acc * (2^32 mod m) + chunk) mod m. Needs m < 2^31.
    """
    if not 0 < m < 2 ** 31:
        raise ValueError("modulus must be in (0, 2^31)")
    h = F.md5(text)
    base = F.lit((2 ** 32) % m).cast("long")
    acc = F.lit(0).cast("long")
    for k in range(4):
        chunk = F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("long")
        acc = F.pmod(acc * base + chunk, F.lit(m).cast("long"))
    return acc


def bloom_positions(c, num_bits: int = 10000, num_hashes: int = 3) -> Column:
    """Bloom bit positions of an item: md5("<item>_<i>") mod num_bits, i < num_hashes."""
    item = _c(c).cast("string")
    return F.array(*[md5_mod(F.concat(item, F.lit(f"_{i}")), num_bits) for i in range(num_hashes)])


def unit_hash(c, seed: int) -> Column:
    """Deterministic pseudo-uniform value in [0, 1e6) from a key and a seed."""
    return F.pmod(F.xxhash64(_c(c), F.lit(seed)), F.lit(1_000_000))
