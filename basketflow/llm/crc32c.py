"""CRC-32C (Castagnoli) of many byte ranges at once, with the masking that
record files use.

The checksum is linear over GF(2): every range is padded in front to whole
blocks, all blocks are summed side by side with 8-byte table steps, and the
blocks of a range are joined by the operator that appends zeros.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128


def _tables() -> np.ndarray:
    t = np.zeros((8, 256), np.uint32)
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0x82F63B78), c >> 1)
    t[0] = c
    for k in range(1, 8):
        t[k] = t[0][t[k - 1] & 255] ^ (t[k - 1] >> 8)
    return t


_T = _tables()


def _apply(op: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return op[0][crc & 255] ^ op[1][(crc >> 8) & 255] ^ op[2][(crc >> 16) & 255] ^ op[3][crc >> 24]


def _zero_operators() -> list[np.ndarray]:
    """Operators that append 1, 2, 4, ... zero bytes, as 4 x 256 tables."""
    base = np.arange(256, dtype=np.uint32)
    words = np.stack([base << np.uint32(8 * k) for k in range(4)])
    ops = [_T[0][words & 255] ^ (words >> 8)]
    for _ in range(40):
        ops.append(_apply(ops[-1], ops[-1]))
    return ops


_ZEROS = _zero_operators()
_APPEND_BLOCK = _ZEROS[BLOCK.bit_length() - 1]


def crc32c(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksums (uint32) of ``data[start:start + size]`` for every range."""
    n = len(size)
    blocks = -(-size // BLOCK)
    total = int(blocks.sum())
    ends = np.cumsum(blocks)
    padded = np.zeros(total * BLOCK, np.uint8)
    for a, k, end in zip(start.tolist(), size.tolist(), (ends * BLOCK).tolist()):
        padded[end - k:end] = data[a:a + k]
    steps = np.ascontiguousarray(padded.reshape(total, BLOCK // 8, 8).transpose(1, 2, 0))
    crc = np.zeros(total, np.uint32)
    for b in steps:
        crc = (_T[7][(crc & 255) ^ b[0]] ^ _T[6][((crc >> 8) & 255) ^ b[1]] ^ _T[5][((crc >> 16) & 255) ^ b[2]]
               ^ _T[4][(crc >> 24) ^ b[3]] ^ _T[3][b[4]] ^ _T[2][b[5]] ^ _T[1][b[6]] ^ _T[0][b[7]])
    order = np.argsort(-blocks, kind="stable")  # longest first: the open ranges are a prefix
    first, left = (ends - blocks)[order], blocks[order]
    out = np.zeros(n, np.uint32)
    for k in range(int(blocks.max(initial=0))):
        live = int(np.searchsorted(-left, -k, "left"))
        out[:live] = _apply(_APPEND_BLOCK, out[:live]) ^ crc[first[:live] + k]
    raw = np.zeros(n, np.uint32)
    raw[order] = out
    head = np.full(n, 0xFFFFFFFF, np.uint32)
    for bit in range(int(size.max(initial=0)).bit_length()):
        on = (size >> bit) & 1 == 1
        head[on] = _apply(_ZEROS[bit], head[on])
    return raw ^ head ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated right by 15 bits plus a constant, as record files store it."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)
