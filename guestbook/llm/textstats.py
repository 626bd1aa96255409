"""Statistics of a text, as the quality operators use them."""

from __future__ import annotations

import re
from collections import Counter

from guestbook.llm.common import WORD

WORDS = re.compile(WORD)
SYMBOLS = "#*$%&|<>"
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[^\W\d_]")


def base_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, and words in repeated three-word windows."""
    text = text or ""
    words = WORDS.findall(text)
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup_lines = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                dup_lines += 1
            elif WORDS.search(line):
                seen.add(line)
    return len(words), sum(map(len, words)), symbols, dup_lines, repeated_words(words)


def repeated_words(words: list[str]) -> int:
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, upto = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def shape(text: str | None) -> dict[str, float]:
    """Shares and means that describe how a text is written, independent of what it says."""
    text = text or ""
    words = WORDS.findall(text)
    n, chars = max(1, len(words)), max(1, len(text))
    letters = max(1, len(_LETTER.findall(text)))
    upper = len(_UPPER.findall(text))
    lines = [x for x in text.split("\n") if x.strip()]
    runs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    count = text.count
    return {
        "words": len(words),
        "word_chars": sum(map(len, words)) / n,
        "symbols": sum(map(count, "#*$%&<>")) / chars,
        "pipes": count("|") / chars,
        "bangs": count("!") / chars,
        "stops": (count(".") + count(",")) / chars,
        "digits": sum(map(count, "0123456789")) / chars,
        "upper": upper / letters,
        "letters": letters / chars,
        "lines": len(lines) / n,
        "dup_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "runs": runs / n,
        "distinct": len(set(words)) / n**0.5,
        "repeated": repeated_words(words) / n,
        "short": sum(len(w) == 1 for w in words) / n,
        "long": sum(len(w) > 20 for w in words) / n,
    }
