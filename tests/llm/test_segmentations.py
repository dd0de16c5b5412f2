"""op3: the field against all segmentations, and regions of any length."""

from __future__ import annotations

import math
import random

import pytest

from stratalake.llm import semicrf
from stratalake.llm.semicrf import KINDS, LONGEST


def segmentations(n, segments):
    """All sets of segments that do not overlap, as lists of their numbers."""
    if n <= 0:
        yield []
        return
    yield from segmentations(n - 1, segments)
    for i, s in enumerate(segments):
        if s[1] == n:
            for rest in segmentations(s[0], segments):
                yield [*rest, i]


@pytest.mark.parametrize("seed", range(12))
def test_decoding_and_posteriors_by_enumeration(seed):
    r = random.Random(seed)
    text = " ".join(r.choice(["4111 1111", "call", "x at y dot com", "+49 30", "12.7.0.1", "a", ",", "1234"]) for _ in range(r.randint(2, 4)))
    tokens, gaps, _ = semicrf.tokenised(text)
    tokens, gaps = tokens[:9], gaps[:9]
    field = semicrf.Field()
    scored = field.scored(tokens, gaps)
    for *_, names in scored:
        for name in names:
            field.weights.setdefault(name, r.uniform(-0.8, 1.0))
    scored = field.scored(tokens, gaps)
    all_of_them = list(segmentations(len(tokens), scored))
    weight = [math.exp(sum(scored[i][3] for i in some)) for some in all_of_them]
    best = all_of_them[max(range(len(weight)), key=lambda j: weight[j])]
    got = field.decode(tokens, gaps)
    assert [g[:3] for g in got] == [scored[i][:3] for i in best]
    exact = {i: sum(w for w, some in zip(weight, all_of_them) if i in some) / sum(weight) for i in range(len(scored))}
    assert [g[3] for g in got] == pytest.approx([exact[i] for i in best])
    p, whole = field.posteriors(len(tokens), scored)
    assert p == pytest.approx([exact[i] for i in range(len(scored))]) and whole == pytest.approx(math.log(sum(weight)))


def test_groups_are_apart():
    segments = [(0, 4), (0, 6), (2, 5), (6, 9), (12, 14), (13, 20), (19, 21), (21, 22)]
    assert list(semicrf.apart(segments)) == [segments[:3], segments[3:4], segments[4:7], segments[7:]]


def test_a_long_region_is_decoded_like_its_parts():
    """Thousands of spelled-out addresses in one region: each is found as it is alone."""
    finder = semicrf.Finder(semicrf.trained())
    one = "write to anna (at) example (dot) com today , "
    alone = finder.added(one, [])
    assert alone
    long = one * 3000
    assert len(semicrf.open_regions(long, [])) == 1
    got = finder.added(long, [])
    want = [(a + i * len(one), b + i * len(one), k) for i in range(3000) for a, b, k in alone]
    assert len(set(got) & set(want)) >= 2998 * len(alone)  # the first and last lack neighbours


def test_words_before_a_sign_are_found_however_long():
    word = "x" * 5000
    text = f"{word} {word} mail {word} at example dot com"
    at = text.index(" at ") + 1
    first, _ = semicrf._reach(text, at, at + 2)
    assert first == 0 and LONGEST > 4 and len(KINDS) == 4
