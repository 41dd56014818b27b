"""Finite-state transducers over token classes, and the grammar that toxicity composes from them.

A transducer reads one symbol per step and writes one symbol. ``compose`` feeds the output of one into the next and gives a
single transducer, so that a clause is read once from the left; what follows a word (a target after an insult) is read by a
second transducer from the right over the first one's output.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from dataclasses import dataclass

# Token classes.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
CLASSES = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)
# Marks that the transducers add to an insult or a threat.
NEGATED, REPORTED, TARGETED = 8, 16, 32
REACH = 4  # words between a negation or target and what it belongs to


@dataclass(frozen=True)
class Transducer:
    start: Hashable
    step: dict  # (state, symbol) -> (state, output)

    def run(self, symbols: Iterable[Hashable]) -> list[Hashable]:
        state, out = self.start, []
        for symbol in symbols:
            state, written = self.step[state, symbol]
            out.append(written)
        return out


def tabulate(start: Hashable, rule: Callable, alphabet: Iterable[Hashable]) -> Transducer:
    """The transducer of ``rule(state, symbol) -> (state, output)`` over the states it reaches."""
    alphabet, todo, step = list(alphabet), [start], {}
    while todo:
        state = todo.pop()
        for symbol in alphabet:
            if (state, symbol) not in step:
                step[state, symbol] = rule(state, symbol)
                todo.append(step[state, symbol][0])
    return Transducer(start, step)


def outputs(t: Transducer) -> set:
    return {out for _, out in t.step.values()}


def compose(first: Transducer, second: Transducer) -> Transducer:
    """``second`` reads what ``first`` writes."""

    def rule(state, symbol):
        a, middle = first.step[state[0], symbol]
        b, out = second.step[state[1], middle]
        return (a, b), out

    return tabulate((first.start, second.start), rule, {symbol for _, symbol in first.step})


def kind(symbol: int) -> int:
    return symbol & 7


def is_match(symbol: int) -> bool:
    return kind(symbol) in (INSULT, THREAT)


def nearby(opening: int, mark: int, alphabet: Iterable[int], kinds: tuple[int, ...] = (INSULT, THREAT)) -> Transducer:
    """Marks words of ``kinds`` up to ``REACH`` words after a word of class ``opening``."""

    def rule(left, symbol):
        if kind(symbol) == opening:
            return REACH, symbol
        return max(0, left - 1), symbol | mark if left and kind(symbol) in kinds else symbol

    return tabulate(0, rule, alphabet)


def reporting(alphabet: Iterable[int]) -> Transducer:
    """Marks insults and threats anywhere after a word of reported speech."""

    def rule(reported, symbol):
        reported = reported or kind(symbol) == REPORT
        return reported, symbol | REPORTED if reported and is_match(symbol) else symbol

    return tabulate(False, rule, alphabet)


def left_to_right() -> Transducer:
    grammar = nearby(NEGATION, NEGATED, CLASSES)
    grammar = compose(grammar, reporting(outputs(grammar)))
    # "You idiot" is aimed at you, but who kills is not whom a threat is aimed at: that comes after it.
    return compose(grammar, nearby(TARGET, TARGETED, outputs(grammar), (INSULT,)))


LEFT = left_to_right()
RIGHT = nearby(TARGET, TARGETED, outputs(LEFT))


def matches(classes: list[int]) -> list[int]:
    """Each word's class with its marks, for one clause."""
    return RIGHT.run(reversed(LEFT.run(classes)))[::-1]


# Every pattern that can come out: an insult in any context, and a threat that has a target.
PATTERNS = tuple(sorted(s for s in outputs(RIGHT) if kind(s) == INSULT or kind(s) == THREAT and s & TARGETED))
