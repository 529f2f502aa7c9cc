"""CRC-32 of many byte spans at once, from a table by byte and distance from the span's end.

A CRC is linear but for a constant: it is the XOR of what each byte contributes, given how many bytes follow it, and of a
constant that depends on the length alone. Contributions of bytes up to ``REACH`` places from the end are in a table; one
``bitwise_xor.reduceat`` adds up all spans of a buffer. Longer spans are cut into blocks of ``REACH`` from their end; each
block's sum is moved on by the bytes after it, and the moved sums are added up in turn.
"""

from __future__ import annotations

import numpy as np

#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)
#: Bytes in a block, blocks that are looked up in one go, and doublings of a length that can be moved over.
REACH, BLOCKS, DOUBLINGS = 64, 1 << 15, 40


def _byte_table() -> np.ndarray:
    """What a byte leaves in an empty register."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(POLYNOMIAL), value >> 1).astype(np.uint32)
    return value


_BYTE = _byte_table()


def _zero_byte(register: np.ndarray) -> np.ndarray:
    return _BYTE[register & 255] ^ (register >> 8)


def _positions() -> np.ndarray:
    rows = [_BYTE]
    while len(rows) < REACH + 1:
        rows.append(_zero_byte(rows[-1]))
    return np.concatenate(rows)


#: Contribution of byte ``b`` with ``d`` bytes after it, at ``256 * d + b``.
POSITION = _positions()


def _moves() -> list[np.ndarray]:
    """For each k, four tables (by register byte) that move a register over 2**k zero bytes."""
    lanes = np.arange(256, dtype=np.uint32)
    table = np.stack([_zero_byte(lanes << np.uint32(8 * lane)) for lane in range(4)])
    moves = [table]
    for _ in range(DOUBLINGS - 1):
        table = np.stack([_through(table, lane) for lane in table])
        moves.append(table)
    return moves


def _through(table: np.ndarray, register: np.ndarray) -> np.ndarray:
    return (table[0][register & 255] ^ table[1][(register >> 8) & 255] ^ table[2][(register >> 16) & 255] ^ table[3][register >> 24])


MOVES = _moves()


def moved(registers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each register after so many zero bytes."""
    registers = registers.copy()
    for k in range(int(lengths.max(initial=0)).bit_length()):
        some = np.nonzero((lengths >> k) & 1)[0]
        registers[some] = _through(MOVES[k], registers[some])
    return registers


def constants(lengths: np.ndarray) -> np.ndarray:
    """What the length alone contributes: the register's start, moved to the end, and its inversion."""
    short = moved(np.full(REACH + 1, ONES, dtype=np.uint32), np.arange(REACH + 1)) ^ ONES
    found = short[np.minimum(lengths, REACH)]
    long = np.nonzero(lengths > REACH)[0]
    found[long] = moved(np.full(len(long), ONES, dtype=np.uint32), lengths[long]) ^ ONES
    return found


def sums(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the contributions of each span of ``codes``; spans are in order, apart, not empty, and all else is zero."""
    if not len(starts):
        return np.empty(0, dtype=np.uint32)
    lengths = ends - starts
    blocks = -(-lengths // REACH)
    first = np.cumsum(blocks) - blocks
    if len(starts) == blocks.sum():
        return _block_sums(codes, starts, ends)
    behind = np.repeat(first + blocks, blocks) - 1 - np.arange(blocks.sum())  # blocks after each block of its span
    stop = np.repeat(ends, blocks) - behind * REACH
    start = np.maximum(stop - REACH, np.repeat(starts, blocks))
    found = _block_sums(codes, start, stop)
    far = np.nonzero(behind)[0]
    found[far] = moved(found[far], behind[far] * REACH)
    return np.bitwise_xor.reduceat(found, first)


def _block_sums(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    found = np.empty(len(starts), dtype=np.uint32)
    for low in range(0, len(starts), BLOCKS):
        start, end = starts[low:low + BLOCKS], ends[low:low + BLOCKS]
        part = codes[start[0]:end[-1]]
        own = part[part != 0]
        lengths = (end - start).astype(np.int32)
        upto = np.cumsum(lengths, dtype=np.int32)
        after = np.repeat(upto - 1, lengths)
        after -= np.arange(len(own), dtype=np.int32)
        after <<= 8
        after += own
        found[low:low + BLOCKS] = np.bitwise_xor.reduceat(POSITION[after], upto - lengths)
    return found
