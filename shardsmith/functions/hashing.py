"""Routing hash (R1) and hash -> bucket (R2) as JVM-side Column expressions.

The routing hash is the classic DJB2 string hash: start at 5381 and fold
``h * 33 + unit`` over the UTF-16 code units of the key, keep the low 32 bits
and read them as a signed int.  The bucket is ``abs(h % n)`` with a truncating
remainder, so it always lies in ``[0, n)``.

Everything below is built from ``pyspark.sql.functions`` so it stays inside
the JVM.  Cost is linear in the key length: the key is encoded once to
UTF-16BE bytes and each code unit is sliced out of the *binary* value (binary
``substr`` is O(1), unlike string ``substr`` on UTF-8 data).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the hash: seed, multiplier, 32-bit mask and sign bound.
DJB2_SEED = 5381
DJB2_MULT = 33
MASK32 = 4294967295
SIGN_BIT = 2147483648
TWO_32 = 4294967296


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _units_of(raw: Column) -> Column:
    """array<bigint> of the UTF-16 code units held in a UTF-16BE binary."""
    n_units = (F.octet_length(raw) / 2).cast("int")
    idx = F.when(n_units > 0, F.sequence(F.lit(0), n_units - 1)).when(
        n_units == 0, F.array().cast("array<int>")
    )
    return F.transform(
        idx,
        lambda i: F.conv(F.hex(raw.substr(i * 2 + 1, F.lit(2))), 16, 10).cast("bigint"),
    )


def _with_utf16(key: Column | str, body) -> Column:
    """Evaluate ``body(bytes)`` with the key encoded to UTF-16BE exactly once.

    The encoding is bound to a lambda variable (via a one-element array), so
    the per-unit lambdas read it instead of re-encoding the key per unit.
    """
    raw = F.encode(_as_col(key).cast("string"), "UTF-16BE")
    return F.element_at(F.transform(F.array(raw), body), 1)


def utf16_units(key: Column | str) -> Column:
    """array<bigint> of the UTF-16 code units of ``key`` (empty for '')."""
    return _with_utf16(key, _units_of)


def djb2_hash(key: Column | str) -> Column:
    """Signed 32-bit DJB2 hash of the string form of ``key`` (NULL stays NULL)."""

    def fold(raw: Column) -> Column:
        return F.aggregate(
            _units_of(raw),
            F.lit(DJB2_SEED).cast("bigint"),
            lambda acc, unit: (acc * DJB2_MULT + unit).bitwiseAND(F.lit(MASK32)),
            # unsigned 32 bit -> signed 32 bit without a second reference
            lambda acc: (acc + SIGN_BIT).bitwiseAND(F.lit(MASK32)) - SIGN_BIT,
        )

    return _with_utf16(key, fold)


def bucket_of_hash(h: Column | str, n: int) -> Column:
    """R2: truncating remainder first, then absolute value -> ``[0, n)``."""
    _check_n(n)
    return F.abs(_as_col(h) % F.lit(n)).cast("int")


def hash_bucket(key: Column | str, n: int) -> Column:
    """R1 + R2: shard number of a routing key for ``n`` shards."""
    return bucket_of_hash(djb2_hash(key), n)


def _check_n(n: int) -> None:
    if not isinstance(n, int) or n < 1:
        raise ValueError(f"shard count must be a positive int, got {n!r}")


# --- plain-Python model, for argument checks on the driver and unit tests ---

def djb2_py(key: str) -> int:
    h = DJB2_SEED
    data = key.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * DJB2_MULT + ((data[i] << 8) | data[i + 1])) & MASK32
    return h - TWO_32 if h >= SIGN_BIT else h


def bucket_py(key: str, n: int) -> int:
    _check_n(n)
    h = djb2_py(key)
    r = abs(h) % n  # truncating remainder, then abs
    return r
