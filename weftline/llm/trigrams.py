"""Boolean trigram queries derived from regular expressions.

A query is a formula over three-letter strings that holds for every text the expression can match
(case folded to lower case): True, a trigram, or ("and" | "or", parts). The derivation keeps, for
each part of the expression, the exact strings it can match while they are few, else the possible
first and last letters and what must stand inside.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as c
from re import _parser

#: More exact strings than this are no longer listed one by one.
EXACT = 64
Query = object


def both(op: str, parts: list) -> Query:
    """The parts under "and" or "or", simplified."""
    flat: list = []
    for p in parts:
        flat.extend(p[1] if isinstance(p, tuple) and p[0] == op else [p])
    if op == "or" and (True in flat or not flat):
        return True
    flat = sorted({p for p in flat if p is not True}, key=repr)
    if op == "or":
        # A part that demands all that another does, and more, adds nothing.
        needs = [frozenset(p[1]) if isinstance(p, tuple) and p[0] == "and" else frozenset([p]) for p in flat]
        flat = [p for p, n in zip(flat, needs, strict=True) if not any(m < n for m in needs)]
    if not flat:
        return True
    return flat[0] if len(flat) == 1 else (op, tuple(flat))


def grams(text: str) -> Query:
    return both("and", [text[i : i + 3] for i in range(len(text) - 2)])


@dataclass
class Info:
    """What a part can match: ``exact`` strings or None; else its ends (None: anything); and what it demands."""

    exact: frozenset[str] | None
    first: frozenset[str] | None
    last: frozenset[str] | None
    match: Query

    def demands(self) -> Query:
        return both("and", [self.match, both("or", [grams(s) for s in self.exact])]) if self.exact is not None else self.match


_EMPTY = Info(frozenset([""]), frozenset([""]), frozenset([""]), True)
_ANY = Info(None, frozenset([""]), frozenset([""]), True)


def _few(x: frozenset[str]) -> frozenset[str]:
    return x if len(x) <= EXACT else frozenset([""])


def _then(a: Info, b: Info) -> Info:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= EXACT:
        exact = frozenset(x + y for x in a.exact for y in b.exact)
        return Info(exact, exact, exact, both("and", [a.match, b.match]))
    # What stands across the seam: ends of the first with beginnings of the second.
    ends, heads = (a.exact if a.exact is not None else a.last), (b.exact if b.exact is not None else b.first)
    across = both("or", [grams(x[-2:] + y[:2]) for x in ends for y in heads]) if len(ends) * len(heads) <= EXACT * 4 else True
    first = _few(frozenset(x + y for x in a.exact for y in heads)) if a.exact is not None and len(a.exact) * len(heads) <= EXACT else heads_of(a)
    last = _few(frozenset(x + y for x in ends for y in b.exact)) if b.exact is not None and len(ends) * len(b.exact) <= EXACT else tails_of(b)
    return Info(None, first, last, both("and", [a.demands(), b.demands(), across]))


def heads_of(a: Info) -> frozenset[str]:
    return a.exact if a.exact is not None else a.first


def tails_of(a: Info) -> frozenset[str]:
    return a.exact if a.exact is not None else a.last


def _or(parts: list[Info]) -> Info:
    exact = frozenset().union(*(p.exact for p in parts)) if all(p.exact is not None for p in parts) else None
    if exact is not None and len(exact) <= EXACT:
        return Info(exact, exact, exact, both("or", [p.match for p in parts]) if any(p.match is not True for p in parts) else True)
    return Info(None, _few(frozenset().union(*map(heads_of, parts))), _few(frozenset().union(*map(tails_of, parts))), both("or", [p.demands() for p in parts]))


def _letters(items) -> frozenset[str] | None:
    out: set[str] = set()
    for op, av in items:
        if op is c.LITERAL:
            out.add(chr(av).lower())
        elif op is c.RANGE and av[1] - av[0] < EXACT:
            out.update(chr(x).lower() for x in range(av[0], av[1] + 1))
        else:
            return None
    return frozenset(out) if len(out) <= 8 else None


def _info(tree) -> Info:
    now = _EMPTY
    for op, av in tree:
        if op is c.LITERAL:
            one = frozenset([chr(av).lower()])
            part = Info(one, one, one, True)
        elif op is c.IN:
            letters = _letters(av)
            part = Info(letters, letters, letters, True) if letters else _ANY
        elif op is c.SUBPATTERN:
            part = _info(av[-1])
        elif op is c.BRANCH:
            part = _or([_info(x) for x in av[1]])
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
            low, high, inner = av
            one = _info(inner)
            if (low, high) == (0, 1):
                part = _or([_EMPTY, one])
            elif low == 0:
                part = _ANY
            else:
                part = one
                for _ in range(min(low, 3) - 1):
                    part = _then(part, one)
                if high != low or low > 3:
                    part = Info(None, heads_of(part), tails_of(part), part.demands())
        elif op in (c.AT, c.ASSERT, c.ASSERT_NOT):
            part = _EMPTY
        else:
            part = _ANY
        now = _then(now, part)
    return now


def query(pattern: str) -> Query:
    """The trigram query of ``pattern``; True if no trigram is mandatory."""
    return _info(_parser.parse(pattern)).demands()


#: Letters from the commonest to the rarest in running text; other characters are rarer still.
_COMMON = "etaoinsrhldcumfpgwybvkxjqz"


def lighten(q: Query, most: int = 3) -> Query:
    """A weaker query that demands at most ``most`` trigrams at once, the rarest; whatever satisfies q satisfies it."""
    if q is True or isinstance(q, str):
        return q
    op, parts = q
    if op == "and":
        plain = sorted((p for p in parts if isinstance(p, str)), key=lambda g: (-sum(_COMMON.find(x) if x in _COMMON else 30 for x in g), g))
        return both("and", plain[:most] + [lighten(p, most) for p in parts if not isinstance(p, str)])
    return both("or", [lighten(p, most) for p in parts])


def names(q: Query) -> set[str]:
    """The trigrams in a query."""
    if q is True:
        return set()
    return {q} if isinstance(q, str) else set().union(*map(names, q[1]))
