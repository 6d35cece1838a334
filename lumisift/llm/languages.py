"""Which of five languages a sentence is written in: word frequencies fitted on a bounded sample, seeded with function words."""

from __future__ import annotations

import math
import re
from collections import Counter

#: Function words by language.
SEEDS = {
    "en": "the is are a an of and in to what where which does how many there this that by at on with was it its has can".split(),
    "de": "der die das und ist ein eine einen dem den auf im bei vor mit nicht kein was macht zwischen wird sich".split(),
    "fr": "le la les un une des du est et dans sur que fait cette il ne pas au aux par avec près se".split(),
    "es": "el la los las un una y en es que hace esta del al con se por no hay lo muy junto".split(),
}
_WORD = re.compile(r"[^\W\d_]+")
_HAN = re.compile(r"[㐀-鿿]")
SURE = 1.5


class Languages:
    """Log-likelihoods of words by language."""

    def __init__(self) -> None:
        self.counts = {lang: Counter({w: 3 for w in words}) for lang, words in SEEDS.items()}
        self._close()

    def _close(self) -> None:
        size = len(set().union(*self.counts.values()))
        self.logs = {lang: {w: math.log(n + 0.1) for w, n in c.items()} for lang, c in self.counts.items()}
        self.best: dict[str, str] = {}
        total = {lang: sum(c.values()) for lang, c in self.counts.items()}
        for lang, c in self.counts.items():
            for w, n in c.items():
                if w not in self.best or n / total[lang] > self.counts[self.best[w]][w] / total[self.best[w]]:
                    self.best[w] = lang
        self.base = {lang: math.log(sum(c.values()) + 0.1 * size) for lang, c in self.counts.items()}

    def fit(self, pairs: list[tuple[str, str]]) -> Languages:
        """Learns the words of texts from (a text that tells the language, a text of that language) pairs."""
        found = {lang: Counter() for lang in SEEDS}
        for told, text in pairs:
            lang = self.of(told)
            if lang in found:
                found[lang].update(_WORD.findall(text.lower()))
        for lang, c in found.items():
            self.counts[lang].update({w: n for w, n in c.items() if n > 1})
        total = Counter()
        for c in self.counts.values():
            total.update(c)
        # what a few texts of the wrong language bring in isn't learned
        share = {lang: sum(c.values()) for lang, c in self.counts.items()}
        for lang, c in self.counts.items():
            best = {w: max(x[w] / share[k] for k, x in self.counts.items()) for w in c}
            self.counts[lang] = Counter({w: n for w, n in c.items() if n / share[lang] >= 0.05 * best[w]})
        self._close()
        return self

    def of(self, text: str | None) -> str | None:
        """The language of a text; None if it can't be told."""
        if not text:
            return None
        words = _WORD.findall(text.lower())
        han = len(_HAN.findall(text)) if not text.isascii() else 0
        if han and han * 2 >= sum(map(len, words)) - han:
            return "zh"
        words = [w for w in words if w in self.best]  # a word of no language tells nothing
        if not words:
            return None
        scores = sorted(((sum(self.logs[lang].get(w, -2.3) for w in words) - len(words) * self.base[lang], lang) for lang in SEEDS), reverse=True)
        return scores[0][1] if scores[0][0] - scores[1][0] >= SURE else None

    def surely_other(self, text: str, asked: str) -> bool:
        """Whether a text is surely in another language than ``asked``; most words at home in ``asked`` settle it at once."""
        if asked != "zh" and (text.isascii() or not _HAN.search(text)):
            votes = list(map(self.best.get, _WORD.findall(text.lower())))
            if 2 * votes.count(asked) > len(votes):
                return False
        found = self.of(text)
        return found is not None and found != asked
