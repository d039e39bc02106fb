"""EIP-55 address checksums.

Keccak-256 has no Spark built-in. The permutation below runs on numpy lanes, one
column per distinct address of an Arrow batch, so a batch full of copies of one
contract address hashes it once and no shuffle or join is needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_RATE_BYTES = 136


def _round_constants() -> list[np.uint64]:
    """Bits of the degree-8 feedback register, placed at positions 2**j - 1."""
    register, out = 1, []
    for _ in range(24):
        value = 0
        for j in range(7):
            if register & 1:
                value |= 1 << ((1 << j) - 1)
            register = (register << 1) ^ (0x171 if register & 0x80 else 0)
        out.append(np.uint64(value))
    return out


def _lane_walk() -> list[tuple[int, int, int]]:
    """(x, y, rotation) in the order the rho and pi steps visit the lanes."""
    x, y, out = 1, 0, []
    for t in range(24):
        out.append((x, y, ((t + 1) * (t + 2) // 2) % 64))
        x, y = y, (2 * x + 3 * y) % 5
    return out


_CONSTANTS = _round_constants()
_WALK = _lane_walk()


def _rotl(v: np.ndarray, n: int) -> np.ndarray:
    if n == 0:
        return v
    return ((v << np.uint64(n)) | (v >> np.uint64(64 - n))) & _MASK


def keccak_256(messages: np.ndarray) -> np.ndarray:
    """Digest rows of an ``(n, width)`` uint8 array, width below one rate block."""
    n, width = messages.shape
    block = np.zeros((n, _RATE_BYTES), dtype=np.uint8)
    block[:, :width] = messages
    block[:, width] ^= 0x01
    block[:, -1] ^= 0x80
    words = block.view("<u8")
    state = [[np.zeros(n, dtype=np.uint64) for _ in range(5)] for _ in range(5)]
    for i in range(_RATE_BYTES // 8):
        state[i % 5][i // 5] = words[:, i].astype(np.uint64)
    for constant in _CONSTANTS:
        parity = [np.bitwise_xor.reduce(state[x]) for x in range(5)]
        for x in range(5):
            mix = parity[(x - 1) % 5] ^ _rotl(parity[(x + 1) % 5], 1)
            state[x] = [lane ^ mix for lane in state[x]]
        moved = [[state[0][0]] * 5 for _ in range(5)]
        moved[0][0] = state[0][0]
        for x, y, rotation in _WALK:
            moved[y][(2 * x + 3 * y) % 5] = _rotl(state[x][y], rotation)
        state = [
            [moved[x][y] ^ (~moved[(x + 1) % 5][y] & moved[(x + 2) % 5][y]) for y in range(5)]
            for x in range(5)
        ]
        state[0][0] = state[0][0] ^ constant
    lanes = np.stack([state[i][0] for i in range(4)], axis=1).astype("<u8")
    return np.ascontiguousarray(lanes).view(np.uint8).reshape(n, 32)


def checksum_batch(addresses: list[str]) -> list[str]:
    """Checksummed ``0x`` form of 40-digit addresses (prefix optional)."""
    if not addresses:
        return []
    digits = [a[-40:].lower() for a in addresses]
    text = np.frombuffer("".join(digits).encode("ascii"), dtype=np.uint8).reshape(len(digits), 40)
    digest = keccak_256(text)[:, :20]
    nibbles = np.stack([digest >> 4, digest & 15], axis=2).reshape(len(digits), 40)
    upper = (nibbles >= 8) & (text >= ord("a"))
    cased = np.where(upper, text - 32, text).astype(np.uint8)
    return ["0x" + row.tobytes().decode("ascii") for row in cased]


@F.arrow_udf(T.StringType())
def _checksum_udf(batch: pa.Array) -> pa.Array:
    # A plain (not iterator) function: Spark then runs several of them in one pass. Rows stay
    # in Arrow; only distinct addresses become Python objects.
    held = batch.dictionary_encode()
    return pa.array(checksum_batch(held.dictionary.to_pylist()), pa.string()).take(held.indices)


def checksum_address(c: Column) -> Column:
    """EIP-55 form of a valid address column; NULL stays NULL."""
    return _checksum_udf(c)
