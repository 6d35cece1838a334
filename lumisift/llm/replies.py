"""The layouts in which a teacher's reasoning and answer are written, taken apart."""

from __future__ import annotations

import json
import re

#: The labels that open a reasoning and an answer.
REASONING_LABELS = (r"\[Reasoning\]", r"\*\*Reasoning:?\*\*:?", r"Reasoning:", r"Observation:", r"Analysis:")
ANSWER_LABELS = (r"\[Answer\]", r"\*\*Answer:?\*\*:?", r"Final Answer:", r"Conclusion:", r"Answer:")
ROLE = re.compile(r"^\s*(?:assistant|user|system)\b[ \t]*:?(?:\n|$|(?=\s*\[))", re.I)
ANSWER = re.compile("|".join(ANSWER_LABELS), re.I)
LABEL = re.compile("|".join((*ANSWER_LABELS, *REASONING_LABELS)), re.I)
BULLET = re.compile(r"(?m)^\s*(?:[-*•]|\d{1,2}[.)])\s+|^\s*#{1,6}\s*")
_BULLETS = frozenset("-*•#0123456789")
#: The labels' plain texts, for a text that stops inside one.
_SPELLED = ("[reasoning]", "[answer]", "**reasoning**", "**answer:**", "final answer:", "observation:", "analysis:", "conclusion:", "answer:")
TERMINAL = ".!?。！？"
CLOSERS = "\"'”’»)]*"


class Reply:
    """``reasoning`` and ``answer`` (None without an answer label) of a text; ``broken`` for JSON that stops early."""

    __slots__ = ("answer", "broken", "layout", "reasoning")

    def __init__(self, text: str) -> None:
        self.answer: str | None = None
        self.broken = False
        body = text.strip()
        self.layout = "plain"
        if body.startswith("{"):
            self.layout = "json"
            try:
                held = json.loads(body)
                if isinstance(held, dict):
                    self.reasoning = str(held.get("reasoning") or "")
                    self.answer = str(held.get("answer") or "")
                    return
            except ValueError:
                self.broken = True
            body = re.sub(r'^\{\s*"?\w*"?\s*:?\s*"?', "", body)
        if body[:1] in "aAuUsS":
            body = ROLE.sub("", body, count=1)
        if not marked(body):
            self.reasoning = body
            return
        found = None
        for found in ANSWER.finditer(body):  # noqa: B007 - the last one counts
            pass
        if found is None or self.broken:
            self.reasoning = LABEL.sub(" ", body)
            if found is None and LABEL.search(body):
                self.layout = "labelled"
        else:
            self.layout = "labelled"
            self.reasoning = LABEL.sub(" ", body[: found.start()])
            self.answer = body[found.end() :].strip()

    def core(self) -> str:
        """All that isn't a tag, a heading, a bullet or a role."""
        both = self.reasoning if not self.answer else f"{self.reasoning}\n{self.answer}"
        return without_bullets(LABEL.sub(" ", both) if marked(both) else both).strip()


def marked(text: str) -> bool:
    """Whether a text has one of the signs that are in every label."""
    return "[" in text or ":" in text or "*" in text


def without_bullets(text: str) -> str:
    """A text without list marks and heading signs at the beginnings of its lines."""
    return BULLET.sub("", text) if "\n" in text or text[:1] in _BULLETS or text[:1].isspace() else text


def partial_label(text: str) -> bool:
    """Whether a text stops inside a label: its last line's end is a proper beginning of one, after a finished sentence or on a line of its own."""
    tail = text.rstrip().lower()[-16:]
    for label in _SPELLED:
        for n in range(len(label) - 1, 2 if label[0].isalpha() else 0, -1):
            if tail.endswith(label[:n]):
                before = tail[:-n].rstrip(" ")
                if not before or before[-1] in TERMINAL + "\n" + CLOSERS:
                    return True
                break
    return False


_SENTENCE = re.compile(r"[^.!?。！？\n]+(?:[.!?](?=\d)[^.!?。！？\n]*)*[.!?。！？]*[\"'”’»)]*")


def sentences(text: str) -> list[str]:
    """The sentences of a text, without bullets."""
    return [m.strip() for m in _SENTENCE.findall(without_bullets(text)) if any(map(str.isalnum, m))]
