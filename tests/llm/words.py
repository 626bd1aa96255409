"""Made-up texts."""

from __future__ import annotations

import random

VOCABULARY = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "s", "")]


def prose(rng: random.Random, n: int) -> str:
    out, line = [], []
    for i in range(n):
        line.append(rng.choice(VOCABULARY) + ("." if i % 9 == 8 else ""))
        if i % 23 == 22:
            out.append(" ".join(line))
            line = []
    return "\n".join([*out, " ".join(line)]) if line else "\n".join(out)


def edited(rng: random.Random, text: str, changes: int) -> str:
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
    return " ".join(words)
