"""Edit distances, a BK-tree and correction against a bounded lexicon."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


def damerau(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance (a metric): insertions, deletions, substitutions and transpositions of neighbours."""
    if a == b:
        return 0
    last: dict[str, int] = {}
    far = len(a) + len(b)
    rows = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        rows[i + 1][1] = i
    for j in range(len(b) + 1):
        rows[1][j + 1] = j
    for i, x in enumerate(a, 1):
        match = 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), match
            cost = int(x != y)
            if not cost:
                match = j
            rows[i + 1][j + 1] = min(rows[i][j] + cost, rows[i + 1][j] + 1, rows[i][j + 1] + 1, rows[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[x] = i
    return rows[-1][-1]


def one_edit(a: str, b: str) -> bool:
    """Whether two strings are equal or one edit apart, transpositions of neighbours included."""
    x, y = len(a), len(b)
    if abs(x - y) > 1:
        return False
    i = 0
    while i < x and i < y and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    return a[1:] == b[1:] or a[1:] == b or a == b[1:] or (a[:2] == b[1::-1] and len(a) > 1 < len(b) and a[2:] == b[2:])


class BKTree:
    """All stored strings within a distance of a query; subtrees are left out by the triangle inequality."""

    def __init__(self, strings: Iterable[str]) -> None:
        self.root: tuple[str, dict] | None = None
        for s in strings:
            self.add(s)

    def add(self, s: str) -> None:
        if self.root is None:
            self.root = (s, {})
            return
        node = self.root
        while d := damerau(s, node[0]):
            if d not in node[1]:
                node[1][d] = (s, {})
                return
            node = node[1][d]

    def within(self, query: str, most: int) -> Iterator[tuple[int, str]]:
        """(distance, string) of every stored string within ``most``, in no order."""
        stack = [self.root] if self.root else []
        while stack:
            s, below = stack.pop()
            d = damerau(query, s)
            if d <= most:
                yield d, s
            stack += [child for edge, child in below.items() if d - most <= edge <= d + most]


class Corrector:
    """Maps a misspelled word, that is one out of the lexicon, to a lexicon word: the most frequent one an edit away, else, from five letters on, two edits away.

    Lexicon words, words with digits and ideographs stay. Words in ``weak`` are taken only if
    no other word is as near.
    """

    def __init__(self, lexicon: dict[str, int], weak: frozenset[str] = frozenset(), memo_max: int = 200_000) -> None:
        self.lexicon, self.weak, self.memo, self.memo_max = lexicon, weak, {}, memo_max
        self.letters = sorted({c for w in lexicon for c in w if c.isalpha() and c < "⺀"})
        self.tree = BKTree(w for w in lexicon if len(w) > 3 and w.isalpha() and w[0] < "⺀")

    def _near(self, w: str) -> Iterator[str]:
        for i in range(len(w) + 1):
            a, b = w[:i], w[i:]
            if b:
                yield a + b[1:]
                if len(b) > 1:
                    yield a + b[1] + b[0] + b[2:]
            for c in self.letters:
                yield a + c + b
                if b:
                    yield a + c + b[1:]

    def _best(self, found: Iterable[str], default: str) -> str:
        return max(found, key=lambda x: (x not in self.weak, self.lexicon[x], x), default=default)

    def _correct(self, word: str) -> str:
        near = {x for x in self._near(word) if x in self.lexicon and x.isalpha() and x != word}
        if near or len(word) < 5:
            return self._best(near, word)
        return self._best((x for _, x in self.tree.within(word, 2)), word)

    def __call__(self, word: str) -> str:
        if word in self.lexicon or len(word) < 2 or not word.isalpha() or word[0] >= "⺀":
            return word
        if word not in self.memo:
            if len(self.memo) >= self.memo_max:
                self.memo.clear()
            self.memo[word] = self._correct(word)
        return self.memo[word]
