"""Probabilistic automata inferred from strings, by merging statistically compatible states of their prefix tree.

A string is read as its form: every run of letters and digits is written in the letter of the narrowest class that holds it, as often as it has
characters, and what stands between is written as it is. The prefix tree of forms is walked from its root; each state met is merged
with the first one accepted so far whose ends and symbols are as frequent, by Hoeffding's bound, there and below (else it is
accepted itself). Long equal runs thus keep their length where the strings show it, and become loops where they don't.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

#: Confidence of the test that two states differ.
ALPHA = 0.05
#: What is added to each count of a symbol in a state.
SMOOTHING = 0.02
#: Classes a run of letters and digits may fit in, the first that does is taken.
CLASSES = {
    "n": "[0-9]+",
    "l": "[a-z]+",
    "U": "[A-Z]+",
    "h": "[0-9a-f]+",
    "H": "[0-9A-F]+",
    "d": "[0-9a-z]+",
    "D": "[0-9A-Z]+",
    "c": "[a-zA-Z]+",
}
MIXED = "m"
_RUN = re.compile("[A-Za-z0-9]+")
_NAME = re.compile("[A-Z][a-z]+")
_FITS = [(c, re.compile(p)) for c, p in CLASSES.items()]
#: Symbols that a form may hold, and its end.
ALPHABET = len(CLASSES) + 1 + len("+/_.=-") + 1


def _written(run: re.Match) -> str:
    text = run[0]
    if _NAME.fullmatch(text):
        return "U" + "l" * (len(text) - 1)
    return next((c for c, fits in _FITS if fits.fullmatch(text)), MIXED) * len(text)


def form(text: str) -> str:
    return _RUN.sub(_written, text)


@dataclass
class Automaton:
    """States by number, the first is where strings begin. A step is (symbol -> state, times); ``ends`` and ``met`` are counts."""

    steps: list[dict[str, list[int]]] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    met: list[int] = field(default_factory=list)

    def bits(self, symbols: str) -> float:
        """Logarithm (base 2) of the likelihood of a form, its end included. Where no step leads on, all symbols are alike from there."""
        state: int | None = 0
        total = 0.0
        for s in symbols:
            if state is None:
                total -= math.log2(ALPHABET)
                continue
            step = self.steps[state].get(s)
            total += math.log2(((step[1] if step else 0) + SMOOTHING) / (self.met[state] + SMOOTHING * ALPHABET))
            state = step[0] if step else None
        if state is None:
            return total - math.log2(ALPHABET)
        return total + math.log2((self.ends[state] + SMOOTHING) / (self.met[state] + SMOOTHING * ALPHABET))


def prefix_tree(counts: Iterable[tuple[str, int, int]]) -> Automaton:
    """From ``(prefix, times met, times it is the whole string)`` of all prefixes, the empty one included."""
    tree, number = Automaton(), {}
    for prefix, met, ends in sorted(counts):  # a prefix comes before what it begins
        number[prefix] = len(tree.met)
        tree.steps.append({})
        tree.ends.append(ends)
        tree.met.append(met)
        if prefix:
            tree.steps[number[prefix[:-1]]][prefix[-1]] = [number[prefix], met]
    return tree


def _differ(f: int, n: int, g: int, m: int, alpha: float) -> bool:
    return abs(f / n - g / m) > math.sqrt(math.log(2 / alpha) / 2) * (n**-0.5 + m**-0.5)


def compatible(a: Automaton, p: int, q: int, alpha: float = ALPHA) -> bool:
    todo = [(p, q)]
    while todo:
        p, q = todo.pop()
        if p == q:
            continue
        n, m = a.met[p], a.met[q]
        if _differ(a.ends[p], n, a.ends[q], m, alpha):
            return False
        for s in a.steps[p].keys() | a.steps[q].keys():
            x, y = a.steps[p].get(s), a.steps[q].get(s)
            if _differ(x[1] if x else 0, n, y[1] if y else 0, m, alpha):
                return False
            if x and y:
                todo.append((x[0], y[0]))
    return True


def _fold(a: Automaton, p: int, q: int) -> None:
    """Count what begins at ``q``, the root of a tree, as beginning at ``p``."""
    todo = [(p, q)]
    while todo:
        p, q = todo.pop()
        a.ends[p] += a.ends[q]
        a.met[p] += a.met[q]
        for s, (y, times) in a.steps[q].items():
            if s in a.steps[p]:
                a.steps[p][s][1] += times
                todo.append((a.steps[p][s][0], y))
            else:
                a.steps[p][s] = [y, times]


def merged(tree: Automaton, alpha: float = ALPHA) -> Automaton:
    """The automaton of a prefix tree, which is used up; states are looked at in the order of their strings' length, then symbols."""
    accepted = [0]
    known = {0}
    while True:
        edge = next(
            ((p, s, y) for p in accepted for s, (y, _) in sorted(tree.steps[p].items()) if y not in known), None
        )
        if edge is None:
            break
        p, s, q = edge
        twin = next((r for r in accepted if compatible(tree, r, q, alpha)), None)
        if twin is None:
            accepted.append(q)
            known.add(q)
        else:
            tree.steps[p][s][0] = twin
            _fold(tree, twin, q)
    number = {p: i for i, p in enumerate(accepted)}
    return Automaton(
        [{s: [number[y], times] for s, (y, times) in tree.steps[p].items()} for p in accepted],
        [tree.ends[p] for p in accepted],
        [tree.met[p] for p in accepted],
    )
