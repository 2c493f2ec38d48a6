"""Byte-pair encoding by speculation and verification.

A word's tokens are proposed by greedy longest match.  They are the exact encoding if and only if each adjacent pair
of them is *compatible*: merging the pair's bytes from scratch would give just these two tokens.  Compatibility is
decided for all pairs of a batch at once, by walking both tokens' merge trees in numpy: the boundary between two
tokens would be crossed by the merge of some right-edge node of the left token with some left-edge node of the right
token, if that merge ranked before the merge that buried one of the two nodes.  Only words with an incompatible pair
are merged exactly.
"""

from __future__ import annotations

import heapq
import json
import re
from itertools import chain

import numpy as np
import regex

#: Fixed: the split of text before merging, as the public vocabulary defines it.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for ASCII texts, which need no Unicode classes.
ASCII_WORDS = re.compile(r" ?[A-Za-z]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.A).findall
#: Texts are worked through in pieces of about this many characters, cut where a word must end.
PIECE = 1 << 20
#: Distinct words remembered by a worker, a bound on its memory only.
REMEMBERED = 400_000


_NEVER = (1 << 40, -1)


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that vocabulary files use for the 256 bytes."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Places(dict):
    """Numbers words in the order they are first asked for, and notes which are new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.new.append(word)
        return place


class Encoder:
    """Encodes texts with a byte-level vocabulary given as the JSON of a public tokenizer file."""

    def __init__(self, vocabulary: bytes):
        model = json.loads(vocabulary)["model"]
        letters = _byte_letters()
        asbytes = lambda s: bytes(map(letters.__getitem__, s))
        names = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        special = {n for n in names if not all(c in letters for c in n)} | {"<|endoftext|>"}
        self.ids = {asbytes(n): i for n, i in names.items() if n not in special}
        # By its first three bytes, how long a token can be: the greedy match tries no more.
        self.reach: dict[bytes, int] = {}
        for word in self.ids:
            if len(word) > 2:
                self.reach[word[:3]] = max(len(word), self.reach.get(word[:3], 0))
        size = max(names.values()) + 1
        # Of each token the rank of its merge (-1: a single byte) and its two halves.
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        keys = np.empty(len(merges), np.int64)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            x, y, z = names[a], names[b], names[a + b]
            keys[r] = (x << 32) | y
            self.pairs[x, y] = (r, z)
            if self.rank[z] < 0:
                self.rank[z], self.left[z], self.right[z] = r, x, y
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.split = regex.compile(WORDS).findall
        self.cut = regex.compile(r"(?<=\S) ")
        self._reset()

    def _reset(self) -> None:
        self.index, self.learned = Places(), 0
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, np.int32), 0
        self.failed = 0

    def exact(self, word: bytes) -> list[int]:
        """Merges the lowest-ranked adjacent pair, leftmost first, until none is left."""
        tokens = [self.single[b] for b in word]
        n = len(tokens)
        if n <= 24:  # looking at all pairs again is cheaper than keeping a heap
            pairs = self.pairs
            found = [pairs.get(p, _NEVER) for p in zip(tokens, tokens[1:])]
            while found and (low := min(found)) is not _NEVER:
                i = found.index(low)
                tokens[i : i + 2] = [low[1]]
                del found[i]
                if i:
                    found[i - 1] = pairs.get((tokens[i - 1], low[1]), _NEVER)
                if i < len(found):
                    found[i] = pairs.get((low[1], tokens[i + 1]), _NEVER)
            return tokens
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(found[0], i, found[1], tokens[i], tokens[i + 1]) for i in range(n - 1) if (found := self.pairs.get((tokens[i], tokens[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, made, x, y = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or tokens[i] != x or tokens[j] != y:
                continue
            tokens[i], alive[j] = made, False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := self.pairs.get((made, tokens[k])):
                    heapq.heappush(heap, (found[0], i, found[1], made, tokens[k]))
            if (h := before[i]) >= 0 and (found := self.pairs.get((tokens[h], made))):
                heapq.heappush(heap, (found[0], h, found[1], tokens[h], made))
        return [t for t, live in zip(tokens, alive) if live]

    def greedy(self, word: bytes) -> list[int]:
        """The longest match at each place."""
        ids, reach, out, at, n = self.ids, self.reach, [], 0, len(word)
        while at < n:
            end = min(n, at + reach.get(word[at : at + 3], 2))
            while (found := ids.get(word[at:end])) is None:
                end -= 1
            out.append(found)
            at = end
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair (a, b) of tokens stays as it is when its bytes are merged from scratch."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        good = np.ones(len(a), bool)
        # The merges that bury the two nodes at the boundary come no earlier than these ranks.
        far = np.int64(1 << 40)
        buried_a, buried_b = np.full(len(a), far), np.full(len(a), far)
        todo = np.arange(len(a))
        while len(todo):
            x, y = a[todo], b[todo]
            key = (x << 32) | y
            at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            rank = np.where(self._keys[at] == key, self._ranks[at], far)
            # Both nodes exist at once while neither is buried. Of equal ranks the leftmost merge comes first.
            crossed = (rank < buried_a[todo]) & (rank <= buried_b[todo])
            good[todo[crossed]] = False
            todo, x, y = todo[~crossed], x[~crossed], y[~crossed]
            rx, ry = self.rank[x], self.rank[y]
            # Undo the later of the two nodes' own merges.
            undo_x = (rx > ry) & (rx >= 0)
            undo_y = ~undo_x & (ry >= 0)
            tx, ty = todo[undo_x], todo[undo_y]
            buried_a[tx], a[tx] = rx[undo_x], self.right[x[undo_x]]
            buried_b[ty], b[ty] = ry[undo_y], self.left[y[undo_y]]
            todo = todo[undo_x | undo_y]
        return good

    def learn(self, words: list[str]) -> None:
        """Encodes words not yet known: proposals for all, one check of all pairs, exact merging of the failures."""
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        ids = self.ids
        proposals = [[i] if (i := ids.get(w)) is not None else self.greedy(w) for w in coded]
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        bad = np.unique(owner[inside[~self.compatible(flat[inside], flat[inside + 1])]])
        if len(bad):
            for w in bad:
                proposals[w] = self.exact(coded[w])
            self.failed += len(bad)
            sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
            flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(sizes.sum()))
        known, need = self.learned, self.used + len(flat)
        while known + len(words) > len(self.starts):
            self.starts, self.sizes = np.concatenate([self.starts, self.starts]), np.concatenate([self.sizes, self.sizes])
        while need > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        ends = np.cumsum(sizes)
        self.starts[known : known + len(words)] = self.used + ends - sizes
        self.sizes[known : known + len(words)] = sizes
        self.flat[self.used : need] = flat
        self.used = need
        self.learned += len(words)

    def pieces(self, text: str):
        """Parts of a text between which no word runs: cuts lie before a space that follows no white space."""
        at = 0
        while len(text) - at > PIECE:
            m = self.cut.search(text, at + PIECE)
            if m is None:
                break
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def _places(self, words: list[str]) -> np.ndarray:
        if len(self.index) > REMEMBERED:
            self._reset()
        places = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.new:
            new, self.index.new = self.index.new, []
            self.learn(new)
        return places

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another, number of ids of each text); null and empty texts have none."""
        return self._run(texts, True)

    def count(self, texts: list[str | None]) -> np.ndarray:
        """The number of ids of each text."""
        return self._run(texts, False)[1]

    def _run(self, texts, want: bool) -> tuple[np.ndarray, np.ndarray]:
        counts = np.zeros(len(texts), np.int64)
        out: list[np.ndarray] = []
        words: list[str] = []
        marks: list[tuple[int, int]] = []

        def flush():
            if not words:
                return
            places = self._places(words)
            sizes = self.sizes[places]
            ends = np.cumsum(sizes)
            at = 0
            for text, n in marks:
                counts[text] += int(ends[at + n - 1] - (ends[at - 1] if at else 0)) if n else 0
                at += n
            if want:
                shift = self.starts[places] - (ends - sizes)
                out.append(self.flat[np.repeat(shift, sizes) + np.arange(int(ends[-1]))])
            words.clear()
            marks.clear()

        held = 0
        for i, text in enumerate(texts):
            if not text:
                continue
            for piece in self.pieces(text):
                found = ASCII_WORDS(piece) if piece.isascii() else self.split(piece)
                words.extend(found)
                marks.append((i, len(found)))
                held += len(piece)
                if held >= PIECE:
                    flush()
                    held = 0
        flush()
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), counts
