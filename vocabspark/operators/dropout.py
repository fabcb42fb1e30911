"""BPE merges and their dropout inside tasks, on many pieces at a time.

A draw is the first 32 bits of ``md5(key:position:step)``, as :func:`vocabspark.operators.encode.draws` makes it one by one. Here
the hashes of many draws are computed side by side, and pieces of a similar length make their merges in step: every
piece that can still merge makes one draw a step, for its pair of the lowest rank, then the leftmost.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from hashlib import md5
from itertools import pairwise

import numpy as np

from vocabspark.operators.packs import gathered

# Pieces up to each of these widths are merged together; a longer one is merged alone.
WIDTHS = (0, 4, 6, 8, 12, 16, 24, 32, 48, 64)
# Draws whose hashes are computed together, and bytes of a key that leave a block room for two numbers.
_AT_ONCE, _KEY_BYTES = 16_384, 33
_BLOCK = 64
_SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_TENS = 10 ** np.arange(1, 11, dtype=np.int64)
_NEVER = np.iinfo(np.int64).max


def md5_heads(words: list[np.ndarray | None], n: int) -> np.ndarray:
    """The first 32 bits of the md5 of ``n`` single blocks, given as 16 columns of words; None is a column of zeros."""
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(61):  # the last three steps make the other registers
        if i < 16:
            np.bitwise_and(np.bitwise_xor(c, d, out=f), b, out=f)
            np.bitwise_xor(f, d, out=f)
            g = i
        elif i < 32:
            np.bitwise_and(np.bitwise_xor(b, c, out=f), d, out=f)
            np.bitwise_xor(f, c, out=f)
            g = (5 * i + 1) % 16
        elif i < 48:
            np.bitwise_xor(np.bitwise_xor(b, c, out=f), d, out=f)
            g = (3 * i + 5) % 16
        else:
            np.bitwise_or(np.invert(d, out=f), b, out=f)
            np.bitwise_xor(f, c, out=f)
            g = 7 * i % 16
        f += a
        f += np.uint32(_SINES[i])
        if words[g] is not None:
            f += words[g]
        shift = _SHIFTS[i // 16][i % 4]
        np.left_shift(f, np.uint32(shift), out=t)
        f >>= np.uint32(32 - shift)
        t |= f
        t += b
        a, b, c, d, t = d, t, b, c, a
    return (b + np.uint32(_START[0])).byteswap()


class Draws:
    """Draws of the pieces of some rows; ``keys`` are what the rows' draws start from."""

    def __init__(self, keys: list[str], dropout: float) -> None:
        raws = [key.encode() for key in keys]
        self.keys, self.limit = keys, dropout * 2**32
        self.sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        self.long = self.sizes > _KEY_BYTES
        self.bytes = np.zeros((len(raws), _BLOCK), np.uint8)
        inside = np.arange(_BLOCK) < np.where(self.long, 0, self.sizes)[:, None]
        self.bytes[inside] = np.frombuffer(b"".join(x for x, long in zip(raws, self.long.tolist()) if not long), np.uint8)

    def skip(self, row: np.ndarray, pos: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Whether draw ``step`` of the piece at ``pos`` of ``row`` says to skip a merge."""
        heads = np.empty(len(row), np.uint32)
        for at in range(0, len(row), _AT_ONCE):
            part = slice(at, at + _AT_ONCE)
            heads[part] = self._heads(row[part], pos[part], step[part])
        for i in np.flatnonzero(self.long[row]).tolist():
            key = f"{self.keys[row[i]]}:{pos[i]}:{step[i]}"
            heads[i] = int.from_bytes(md5(key.encode()).digest()[:4], "big")
        return heads < self.limit

    def _heads(self, row: np.ndarray, pos: np.ndarray, step: np.ndarray) -> np.ndarray:
        n = len(row)
        text = self.bytes[row]
        flat, begin = text.reshape(-1), np.arange(0, n * _BLOCK, _BLOCK)
        at = begin + np.where(self.long[row], 0, self.sizes[row])
        for number in (pos, step):
            flat[at] = ord(":")
            digits = np.searchsorted(_TENS, number, "right") + 1
            at += digits
            for back in range(int(digits.max(initial=0))):
                some = slice(None) if not back else np.flatnonzero(digits > back)
                flat[at[some] - back] = 48 + number[some] // 10**back % 10
            at += 1
        flat[at] = 0x80
        used = -(-int((at - begin).max(initial=0) + 1) // 4)
        words = text.view("<u4").astype(np.uint32, copy=False)
        columns = [np.ascontiguousarray(words[:, k]) if k < used else None for k in range(16)]
        columns[14] = (8 * (at - begin)).astype(np.uint32)
        return md5_heads(columns, n)


class Merges:
    """Merge rules as arrays: symbols have numbers, and a pair of numbers has a rank and the number of what it makes."""

    def __init__(self, ranks: dict[tuple[str, str], int]) -> None:
        self.numbers: dict[str, int] = {}
        found = []
        for (left, right), rank in ranks.items():
            a, b, made = (self.numbers.setdefault(s, len(self.numbers)) for s in (left, right, left + right))
            found.append((a << 32 | b, rank, made))
        found.sort()
        self.names = list(self.numbers)
        # The last entry stands for pairs without a rule.
        self.pairs, self.rank, self.made = np.array([*found, (_NEVER, _NEVER, 0)], np.int64).T.copy()

    def rule(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rule of each pair, or the last entry."""
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, at, len(self.pairs) - 1)

    def symbols(self, letters: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """Numbers of characters given by their code points, and the characters without rules: theirs come last."""
        points, place = np.unique(letters, return_inverse=True)
        letters = list(map(chr, points.tolist()))
        more = [c for c in letters if c not in self.numbers]
        extra = {c: len(self.names) + k for k, c in enumerate(more)}
        known = (self.numbers.get(c, extra.get(c)) for c in letters)
        return np.fromiter(known, np.int64, len(letters))[place], more

    def pieces(
        self, texts: list[str], which: np.ndarray, skip: Callable[[np.ndarray, int], np.ndarray] | None, alone: Callable[[int], list[str]]
    ) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """What the merges make of ``texts[which]``: how many symbols of each, all of them as places in a list, and that list.

        ``skip(items, step)`` draws for items of ``which``; ``alone(item)`` merges one that is too long to stand beside others.
        """
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        letters, others = self.symbols(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"))
        begin, width = np.cumsum(lengths) - lengths, lengths[which]
        made = []
        for least, most in pairwise(WIDTHS):
            some = np.flatnonzero((width > least) & (width <= most))
            if len(some):
                table = np.zeros((len(some), most), np.int64)
                table[np.arange(most) < width[some, None]] = letters[gathered(begin, lengths, which[some])[0]]
                sizes = self.merged(table, width[some], skip and (lambda rows, step, some=some: skip(some[rows], step)))
                made.append((some, sizes, table[np.arange(most) < sizes[:, None]]))
        extra = {name: len(self.names) + k for k, name in enumerate(others)}
        for item in np.flatnonzero(width > WIDTHS[-1]).tolist():
            symbols = alone(item)
            made.append((np.array([item]), np.array([len(symbols)]), np.array([self.numbers.get(s, extra.get(s)) for s in symbols])))
        counts = np.zeros(len(which), np.int64)
        for some, sizes, _ in made:
            counts[some] = sizes
        at = np.cumsum(counts) - counts
        symbols = np.empty(counts.sum(), np.int64)
        for some, _, found in made:
            symbols[gathered(at, counts, some)[0]] = found
        names, place = np.unique(symbols, return_inverse=True)
        known = len(self.names)
        return counts, place, [self.names[k] if k < known else others[k - known] for k in names.tolist()]

    def merged(self, symbols: np.ndarray, sizes: np.ndarray, skip: Callable[[np.ndarray, int], np.ndarray] | None) -> np.ndarray:
        """Merges the pieces in the rows of ``symbols``, in place, and gives their new sizes; ``skip(rows, step)`` draws.

        Equal to :func:`vocabspark.operators.encode.merge_piece` row by row: what was skipped is offered again after a merge.
        """
        n, width = symbols.shape
        sizes = sizes.copy()
        if width < 2:
            return sizes
        last = len(self.pairs) - 1
        column = np.arange(width)
        rules = self.rule(symbols[:, :-1], symbols[:, 1:])
        rules[column[1:] >= sizes[:, None]] = last
        rules = np.append(rules, np.full((n, 1), last), axis=1)
        offered = self.rank[rules]
        live, step = np.arange(n), 0
        while True:
            at = offered.argmin(axis=1)
            open_ = offered[np.arange(len(at)), at] != _NEVER
            if not open_.all():
                live, at, offered, rules = live[open_], at[open_], offered[open_], rules[open_]
            if not len(live):
                return sizes
            go = np.arange(len(live))
            if skip:
                skipped = skip(live, step)
                step += 1
                offered[np.flatnonzero(skipped), at[skipped]] = _NEVER
                go = np.flatnonzero(~skipped)
                if not len(go):
                    continue
            row, place = live[go], at[go]
            own, rule = symbols[row], rules[go]
            made = self.made[rule[np.arange(len(go)), place]]
            # What stands behind the merged pair moves up by one.
            after = column > place[:, None]
            own = np.where(after, np.append(own[:, 1:], own[:, -1:], axis=1), own)
            rule = np.where(after, np.append(rule[:, 1:], np.full((len(go), 1), last), axis=1), rule)
            every = np.arange(len(go))
            own[every, place] = made
            sizes[row] -= 1
            right = place + 1 < sizes[row]
            rule[every, place] = last
            rule[every[right], place[right]] = self.rule(made[right], own[every[right], place[right] + 1])
            left = place > 0
            rule[every[left], place[left] - 1] = self.rule(own[every[left], place[left] - 1], made[left])
            symbols[row], rules[go] = own, rule
            offered[go] = self.rank[rule]
