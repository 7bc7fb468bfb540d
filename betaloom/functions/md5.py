"""MD5 of many short texts at once: the same steps on whole arrays, some seven times as fast as one text at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_ADD = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2**32).astype(np.uint64).astype(np.uint32)
_TURN = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_WORD = [lambda i: i, lambda i: (5 * i + 1) % 16, lambda i: (3 * i + 5) % 16, lambda i: 7 * i % 16]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
LONGEST = 55  # bytes of a text that fits one block


def _first_words(words: list, n: int) -> np.ndarray:
    """The first word of n digests, each of one block; a word of the block is an array, a number that all share, or None for 0."""
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(61):  # the three steps after make the other words
        turn = i // 16
        if turn == 0:
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
        elif turn == 1:
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
        elif turn == 2:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f), np.add(f, _ADD[i], out=f)
        word = words[_WORD[turn](i)]
        if word is not None:
            np.add(f, word, out=f)
        left = _TURN[turn][i % 4]
        np.left_shift(f, np.uint32(left), out=t), np.right_shift(f, np.uint32(32 - left), out=f)
        np.bitwise_or(f, t, out=f), np.add(f, b, out=f)
        a, b, c, d, f = d, f, b, c, a
    return b + np.uint32(_START[0])


def md5_heads(numbers: np.ndarray) -> Callable[[str], np.ndarray]:
    """A function of an ASCII prefix: the first 32 bits of md5(prefix + number) for each number >= 0 in decimal, as unsigned integers."""
    digits = numbers.astype("S20")
    length, digits = np.char.str_len(digits), digits.view(np.uint8).reshape(len(numbers), 20)
    digits = digits[:, : max(length, default=0)]
    blocks: dict[int, list] = {}

    def block(ahead: int) -> list:
        """The words of every text whose prefix has so many bytes, with zeros in its place."""
        if ahead not in blocks:
            if ahead + digits.shape[1] > LONGEST:
                raise ValueError(f"texts of more than {LONGEST} bytes")
            text = np.zeros((len(digits), 56), np.uint8)
            text[:, ahead : ahead + digits.shape[1]] = digits
            text[np.arange(len(digits)), ahead + length] = 0x80
            words = np.ascontiguousarray(text.view("<u4").T).astype(np.uint32)
            bits = ((ahead + length) * 8).astype(np.uint32)
            blocks[ahead] = [*(w if w.any() else None for w in words), bits, None]
        return blocks[ahead]

    def heads(prefix: str) -> np.ndarray:
        start = prefix.encode("ascii")
        words = list(block(len(start)))
        for i, w in enumerate(np.frombuffer(start.ljust(-(-len(start) // 4) * 4, b"\0"), "<u4").astype(np.uint32)):
            words[i] = w if words[i] is None else words[i] + w
        return _first_words(words, len(digits)).byteswap()

    return heads
