"""MD5 of many short messages at once, as numpy column arithmetic.

``hashlib`` hashes one message a call; MinHash needs H hashes "{i}-{shingle}" of every shingle.
Here a step of the compression runs over an array [hash, message]. Only the first four digest
bytes are kept (register A), so the last three of the 64 steps are not made.
"""

from __future__ import annotations

import hashlib

import numpy as np

_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_SINES = [int(abs(x) * 2.0**32) for x in np.sin(np.arange(1, 65, dtype=np.float64))]
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_WORD = ((1, 0), (5, 1), (3, 5), (7, 0))  # step i of a round reads word (k * i + c) % 16
_ALL = 0xFFFFFFFF

#: Messages of a tile, values of a register (the five arrays stay in a core's cache), and the blocks of 64 bytes
#: beyond which hashlib is as fast.
TILE = 4096
VALUES = 32768
MOST_BLOCKS = 16


def _begin(words: list[np.ndarray]) -> list[np.ndarray]:
    """The registers after four steps from the start, where those not yet written are numbers."""
    a, b, c, d = _START
    for i in range(4):
        x = (((c ^ d) & b) ^ d) + (words[i] + ((_SINES[i] + a) & _ALL))
        turn = _TURNS[0][i]
        y = x << np.uint32(turn)
        x >>= np.uint32(32 - turn)
        y |= x
        y += b if isinstance(b, np.ndarray) else np.uint32(b)
        a, b, c, d = d, y, b, c
    return [a, b, c, d]


def _rounds(registers: list[np.ndarray], words: list[np.ndarray], first: int, steps: int) -> list[np.ndarray]:
    """The registers after steps ``first`` to ``steps`` over one block, made in place."""
    a, b, c, d = registers
    f = np.empty_like(a)
    for i in range(first, steps):
        k, start = _WORD[i >> 4]
        turn = _TURNS[i >> 4][i & 3]
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        f += words[(k * i + start) % 16] + np.uint32(_SINES[i])
        np.left_shift(f, np.uint32(turn), out=a)
        f >>= np.uint32(32 - turn)
        a |= f
        a += b
        a, b, c, d = d, a, b, c
    return [a, b, c, d]


def _padded(data: np.ndarray, start: np.ndarray, length: np.ndarray, plen: int, blocks: int) -> np.ndarray:
    """[word, message]: the messages behind ``plen`` zero bytes, padded to ``blocks`` blocks."""
    room = 64 * blocks - plen
    message = np.zeros((len(start), 64 * blocks), dtype=np.uint8)
    last = len(data) - room
    inner = start <= last
    if last >= 0:
        message[inner, plen:] = np.lib.stride_tricks.sliding_window_view(data, room)[start[inner]]
    for j in np.flatnonzero(~inner):  # no whole row of bytes is left in the data
        tail = data[start[j]:]
        message[j, plen:plen + len(tail)] = tail
    at = np.arange(-plen, room)
    message *= at < length[:, None]
    message[np.arange(len(start)), plen + length] = 0x80
    words = np.ascontiguousarray(message.view("<u4").T)
    words[-2] = 8 * (plen + length)
    return words


def _tile(prefixes: np.ndarray, words: np.ndarray, plen: int) -> np.ndarray:
    """[prefix, message]: little-endian uint32 of the first four digest bytes."""
    state = None
    for k in range(0, len(words), 16):
        block = list(words[k:k + 16])
        if state is None:
            for w in range(-(-plen // 4)):
                block[w] = block[w] | prefixes[:, w, None]
            now, first = _begin(block), 4
            state = _START
        else:
            now, first = [x.copy() for x in state], 0
        if k + 16 == len(words):
            out = _rounds(now, block, first, 61)[1]  # B after 61 steps is A after 64
            out += np.uint32(state[0]) if k == 0 else state[0]
            return out
        now = _rounds(now, block, first, 64)
        for x, s in zip(now, state, strict=True):
            x += np.uint32(s) if k == 0 else s
        state = now
    raise ValueError("no blocks")


def minima(data: np.ndarray, start: np.ndarray, length: np.ndarray, owner: np.ndarray, owners: int,
           num_hashes: int) -> np.ndarray:
    """[owner, hash]: for hash i the least first-four-bytes value of md5("{i}-" + message) over an owner's messages.

    Message j is data[start[j]:start[j] + length[j]] and belongs to ``owner[j]`` (ascending); an
    owner without messages has zeros.
    """
    out = np.full((num_hashes, owners), 0xFFFFFFFF, dtype=np.uint32)
    texts = [f"{i}-".encode() for i in range(num_hashes)]
    for plen in sorted({len(t) for t in texts}):
        hashes = np.array([i for i, t in enumerate(texts) if len(t) == plen])
        prefixes = np.array([np.frombuffer(texts[i].ljust(-(-plen // 4) * 4, b"\0"), dtype="<u4") for i in hashes])
        blocks = (plen + length + 8) // 64 + 1
        for b in np.unique(blocks):
            rows = np.flatnonzero(blocks == b)
            size = max(1, TILE // b) if b <= MOST_BLOCKS else 1
            for part in np.split(rows, range(size, len(rows), size)):
                who = owner[part]
                first = np.flatnonzero(np.diff(who, prepend=-1))
                if b > MOST_BLOCKS:
                    message = data[start[part[0]]:start[part[0]] + length[part[0]]].tobytes()
                    values = np.array([[int.from_bytes(hashlib.md5(texts[i] + message).digest()[:4], "little")]
                                       for i in hashes], dtype=np.uint32)
                    _lower(out, hashes, who[first], values)
                    continue
                words = _padded(data, start[part], length[part], plen, int(b))
                step = max(1, VALUES // len(part))
                for h in range(0, len(hashes), step):
                    values = _tile(prefixes[h:h + step], words, plen)
                    _lower(out, hashes[h:h + step], who[first], np.minimum.reduceat(values, first, axis=1))
    out[:, np.bincount(owner, minlength=owners) == 0] = 0
    return out.T


def _lower(out: np.ndarray, hashes: np.ndarray, owners: np.ndarray, values: np.ndarray) -> None:
    spot = np.ix_(hashes, owners)
    out[spot] = np.minimum(out[spot], values)
