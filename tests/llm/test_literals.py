import random
import re

import pytest

from tidewatch.llm.literals import trigram_query, whole_tokens


def satisfied(pattern, text):
    query, low = trigram_query(pattern), text.lower()
    return not query or any(all(g in low for g in q) for q in query)


@pytest.mark.parametrize("pattern, words", [
    ("abcd", ["abcd"]), ("abcd|efg", ["abcd", "efg"]), ("(?:abcd|ef)g", ["abcdg", "efg"]), ("ab|cdef", None), ("abcd?", ["abc"]), ("(abcd)?", None),
    ("(?:abcd)*", None), ("(?:abcd)+", ["abcd"]), ("a[bc]d", ["abd", "acd"]), ("a[b-z]cdef", ["cdef"]), ("(?i)ABCD", ["abcd"]), ("(?i:Ab)Cd", ["abcd"]),
    ("abc.def", ["abc&def"]), ("ab.cd", None), (r"abc\d+xyz", ["abc&xyz"]), ("(?:ab){2}", ["abab"]), ("(?:ab){2,}c", ["abab"]), ("a{3}", ["aaa"]), ("x{20}", ["xxxx"]),
    (r"\babc\b", ["abc"]), ("^abc$", ["abc"]), ("(?=abc)xyz", ["xyz"]), ("(a|b)(c|d)(e|f)", ["ace", "acf", "ade", "adf", "bce", "bcf", "bde", "bdf"]),
    (r"(abc)\1", ["abc"]), ("[^a]bcd", ["bcd"]), ("é{3}abc", ["abc"]), ("", None), ("a(?:b|)cd", ["abcd", "acd"]), ("abc(?:def)??ghi", ["abcdefghi", "abcghi"]),
])
def test_queries(pattern, words):
    want = set() if words is None else {frozenset(
        w[i:i + 3] for part in word.split("&") for w in [part] for i in range(len(w) - 2)) for word in words}
    got = {frozenset(q) for q in trigram_query(pattern)}
    assert got == {w for w in want if not any(v < w for v in want)}


def random_pattern(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 3)
    if kind <= 2:
        return "".join(rng.choice("abAB_") for _ in range(rng.randrange(1, 5)))
    inner = [random_pattern(rng, depth + 1) for _ in range(rng.randrange(1, 4))]
    if kind == 3:
        return "(?:" + "|".join(inner) + ")"
    if kind == 4:
        return "(?:" + "".join(inner) + ")" + rng.choice(["?", "*", "+", "{2}", "{1,3}", "{3,}"])
    if kind == 5:
        return rng.choice(["[ab]", "[^a]", ".", r"\w", "[aB_]{2}"]) + "".join(inner)
    if kind == 6:
        return "(?i:" + "".join(inner) + ")"
    return "".join(inner)


def test_no_match_without_its_query():
    """Whatever an expression matches satisfies its query."""
    rng = random.Random(5)
    found = asked = 0
    for _ in range(1500):
        pattern = random_pattern(rng)
        asked += bool(trigram_query(pattern))
        for _ in range(12):
            text = "".join(rng.choice("abAB_") for _ in range(rng.randrange(14)))
            if re.search(pattern, text):
                found += 1
                assert satisfied(pattern, text), (pattern, text)
    assert found > 3000 and asked > 300


@pytest.mark.parametrize("pattern, tokens", [
    ("^abc/", ["abc"]), ("abc/", []), ("/abc/", ["abc"]), ("/abc", []), ("/abc$", ["abc"]), (r"/a1\.b2/", ["a1", "b2"]), ("/abc[0-9]", []), ("/abc[./]", ["abc"]),
    ("/abc(?:/|$)", ["abc"]), ("/abc(?:x|$)", []), ("/abc(?:-x)?/", ["abc"]), ("/abc(?:x)?/", []), (r"\babc\b", ["abc"]), ("(?i)/abc/", []), ("/(?:abc)/", ["abc"]), ("/(abc)/", []),
    ("^(?:[^/]*[.-])?abc-def/", ["abc", "def"]), ("/abc.*/def/", ["def"]), ("/abc|/def/", []), ("é/abc/", ["abc"]), ("", []),
])
def test_whole_tokens(pattern, tokens):
    assert list(whole_tokens(pattern)) == tokens


def test_whole_tokens_are_in_every_match():
    rng = random.Random(6)
    found = 0
    for _ in range(4000):
        parts = [rng.choice(["ab", "b1", "/", "-", "^", "$", "[a-]", "(?:-x)?", "(?:a|/)", ".", r"\b", "(?:/b)*"]) for _ in range(rng.randrange(1, 6))]
        pattern = "".join(parts)
        tokens = whole_tokens(pattern)
        for _ in range(60 if tokens else 0):
            text = "".join(rng.choice(["ab", "b1", "/", "-", "/", "x"]) for _ in range(rng.randrange(7)))
            if re.search(pattern, text):
                found += 1
                assert set(tokens) <= set(re.findall("[A-Za-z0-9]+", text)), (pattern, text, tokens)
    assert found > 100
