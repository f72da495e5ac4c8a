"""What every match of a regular expression must hold, from the expression itself.

``trigram_query``: a Boolean query over lower-cased trigrams, an OR of ANDs, that the
text of every match satisfies.  The parsed expression is walked from the inside out.  A
part is known exactly (the set of all strings it matches, while that is small) or by a query
and by what it begins and ends with; concatenation joins sets, or adds the trigrams
across the seam; alternatives are an OR, groups that may be absent ask for nothing,
repeats for their least number.  What is not known asks for nothing, so a query may admit
too much but never too little.

``whole_tokens``: the runs of ASCII letters and digits that every match holds with
no letter or digit before or behind them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from re import _constants as C
from re import _parser

#: Strings of an exact set, characters of a class in it, alternatives of a query, copies of a repeat.
MOST, CLASS, ALTERNATIVES, COPIES = 64, 8, 64, 4
Query = frozenset   # of frozensets of trigrams; {{}} asks for nothing
ANY: Query = frozenset([frozenset()])


def _grams(s: str) -> frozenset:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _least(q) -> Query:
    """Without alternatives that ask for more than another one."""
    return frozenset(a for a in q if not any(b < a for b in q))


def _or(a: Query, b: Query) -> Query:
    q = _least(a | b)
    return q if len(q) <= ALTERNATIVES else ANY


def _and(a: Query, b: Query) -> Query:
    q = _least(frozenset(x | y for x in a for y in b)) if len(a) * len(b) <= ALTERNATIVES**2 else None
    return q if q is not None and len(q) <= ALTERNATIVES else min(a, b, key=lambda x: (x == ANY, len(x)))


def _of(strings) -> Query:
    out: Query = frozenset()
    for s in strings:
        out = _or(out, frozenset([_grams(s)]))
    return out


@dataclass(frozen=True)
class Part:
    exact: frozenset | None          # all strings that the part matches
    query: Query = ANY
    starts: frozenset = frozenset([""])
    ends: frozenset = frozenset([""])

    def opened(self) -> Part:
        """The same without its exact set."""
        if self.exact is None:
            return self
        return Part(None, _of(self.exact), frozenset(s[:2] for s in self.exact), frozenset(s[-2:] for s in self.exact))


EMPTY, UNKNOWN = Part(frozenset([""])), Part(None)


def _small(strings: frozenset) -> frozenset:
    return strings if len(strings) <= MOST else frozenset([""])


def _concat(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST:
        return Part(frozenset(x + y for x in a.exact for y in b.exact))
    starts = frozenset((x + y)[:2] for x in a.exact for y in b.opened().starts) if a.exact is not None else a.starts
    ends = frozenset((x + y)[-2:] for x in a.opened().ends for y in b.exact) if b.exact is not None else b.ends
    a, b = a.opened(), b.opened()
    seam = _of(x + y for x in a.ends for y in b.starts) if len(a.ends) * len(b.starts) <= MOST else ANY
    return Part(None, _and(_and(a.query, b.query), seam), _small(starts), _small(ends))


def _alternative(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MOST:
        return Part(a.exact | b.exact)
    a, b = a.opened(), b.opened()
    return Part(None, _or(a.query, b.query), _small(a.starts | b.starts), _small(a.ends | b.ends))


def _letter(code: int) -> Part:
    return Part(frozenset([chr(code).lower()])) if code < 128 else UNKNOWN


def _class(items) -> frozenset | None:
    """The characters of a small class of ASCII characters, lower-cased."""
    out = set()
    for op, arg in items:
        if op is C.LITERAL and arg < 128:
            out.add(chr(arg).lower())
        elif op is C.RANGE and arg[1] < 128:
            out.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return frozenset(out) if len(out) <= CLASS else None


def _sequence(nodes) -> Part:
    out = EMPTY
    for node in nodes:
        out = _concat(out, _part(*node))
    return out


def _part(op, arg) -> Part:
    if op is C.LITERAL:
        return _letter(arg)
    if op is C.IN:
        chars = _class(arg)
        return UNKNOWN if chars is None else Part(chars)
    if op is C.SUBPATTERN:
        return _sequence(arg[3])
    if op is C.ATOMIC_GROUP:
        return _sequence(arg)
    if op is C.BRANCH:
        out = None
        for nodes in arg[1]:
            part = _sequence(nodes)
            out = part if out is None else _alternative(out, part)
        return out
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, nodes = arg
        if (least, most) == (0, 1):
            return _alternative(EMPTY, _sequence(nodes))
        out, once = EMPTY, _sequence(nodes) if least else UNKNOWN
        for _ in range(min(least, COPIES)):
            out = _concat(out, once)
        return out if least == most <= COPIES else _concat(out, UNKNOWN)
    if op is C.AT or op in (C.ASSERT, C.ASSERT_NOT):
        return EMPTY
    return UNKNOWN


@lru_cache(maxsize=4096)
def trigram_query(pattern: str) -> tuple[tuple[str, ...], ...]:
    """The query as sorted tuples; empty when some match may hold no trigram that is known."""
    query = _sequence(_parser.parse(pattern)).opened().query
    return () if frozenset() in query else tuple(sorted(tuple(sorted(q)) for q in query))


# -- whole tokens -----------------------------------------------------------------

def _word(code: int) -> bool:
    return code < 128 and chr(code).isalnum()


def _kinds(nodes, forward: bool) -> set[str]:
    """What may stand next to a place, going through ``nodes`` away from it: ``word`` (an
    ASCII letter or digit), ``other``, ``edge`` (the text's end); ``empty`` when all nodes may be absent."""
    out: set[str] = set()
    for op, arg in nodes if forward else reversed(nodes):
        if op is C.AT:
            if arg in (C.AT_BEGINNING, C.AT_BEGINNING_STRING, C.AT_END, C.AT_END_STRING):
                return out | {"edge"}
            if arg is C.AT_BOUNDARY:   # beside a letter or digit
                return out | {"other"}
            continue
        if op in (C.ASSERT, C.ASSERT_NOT):
            continue
        if op is C.LITERAL:
            return out | {"word" if _word(arg) else "other"}
        if op is C.IN and arg[0][0] is not C.NEGATE and all(o in (C.LITERAL, C.RANGE) for o, _ in arg):
            codes = [c for o, a in arg for c in (range(a[0], a[1] + 1) if o is C.RANGE else [a])]
            return out | {"word" if _word(c) else "other" for c in codes}
        if op is C.SUBPATTERN or op is C.ATOMIC_GROUP:
            found = _kinds(list(arg[3] if op is C.SUBPATTERN else arg), forward)
        elif op is C.BRANCH:
            found = set().union(*[_kinds(list(b), forward) or {"empty"} for b in arg[1]])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            found = _kinds(list(arg[2]), forward) | ({"empty"} if arg[0] == 0 else set())
        else:
            return out | {"word", "other"}
        out |= found - {"empty"}
        if "empty" not in found:
            return out
    return out | {"empty"}


def whole_tokens(pattern: str) -> tuple[str, ...]:
    """Tokens at the top level of the expression, in its order.  In a part that ignores
    case, or where something else may stand beside a run, there are none."""
    parsed = _parser.parse(pattern)
    nodes = list(parsed)
    if parsed.state.flags & C.SRE_FLAG_IGNORECASE:
        return ()
    out, i = [], 0
    while i < len(nodes):
        j = i
        while j < len(nodes) and nodes[j][0] is C.LITERAL and _word(nodes[j][1]):
            j += 1
        if j > i:
            # beyond the expression anything may stand
            beside = [_kinds(nodes[:i], False), _kinds(nodes[j:], True)]
            if not any(k & {"word", "empty"} for k in beside):
                out.append("".join(chr(c) for _, c in nodes[i:j]))
        i = max(j, i + 1)
    return tuple(out)
