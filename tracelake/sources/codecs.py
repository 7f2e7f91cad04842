"""Compressed TIFF data: the codecs of a page's strips or tiles, and the predictor that undoes differences of neighbours."""

from __future__ import annotations

import zlib

import numpy as np

# Fixed values of the format: compression schemes.
PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
KNOWN = frozenset((PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS))
_CLEAR, _END = 256, 257


def unpack_bits(data: bytes) -> bytes:
    """Runs and literals, each after its count."""
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += n + 2
        elif n > 128:
            out += data[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
    return bytes(out)


def unpack_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the highest bit first; a width ends one code early, as in the format."""
    words: list[bytes] = []
    out: list[bytes] = []
    before, width, held, bits = None, 9, 0, 0
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == _END:
            break
        if code == _CLEAR:
            words, before, width = [bytes([i]) for i in range(256)] + [b"", b""], None, 9
            continue
        if before is None:
            word = words[code]
        else:
            if code > len(words):
                raise ValueError("a code that isn't there yet")
            word = words[code] if code < len(words) else before + before[:1]
            words.append(before + word[:1])
        out.append(word)
        before = word
        width = 9 if len(words) < 511 else 10 if len(words) < 1023 else 11 if len(words) < 2047 else 12
    return b"".join(out)


def decoded(data: bytes, compression: int) -> bytes:
    if compression == PLAIN:
        return data
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(data)
    if compression == LZW:
        return unpack_lzw(data)
    if compression == PACKBITS:
        return unpack_bits(data)
    raise ValueError(f"unknown compression {compression}")


def undone(a: np.ndarray, predictor: int) -> np.ndarray:
    """Values of (rows, columns, samples) from differences to the left neighbour (predictor 2), which wrap around."""
    if predictor == 1:
        return a
    if predictor != 2 or a.dtype.kind not in "ui":
        raise ValueError(f"unknown predictor {predictor}")
    return np.cumsum(a, axis=1, dtype=a.dtype)
