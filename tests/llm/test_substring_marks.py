"""A chunk's mark depends on its step too: windows with one core and two steps give two marks."""

from __future__ import annotations

import random

from variantloom.llm import substrings


def test_steps_give_their_own_marks():
    rng = random.Random(3)
    grams = substrings.LENGTH - substrings.GRAM
    for _ in range(20_000):  # a text whose second window takes a new anchor at the right, CHUNK * k further than the first's
        raw = bytes(rng.choices(b"abcdefgh ", k=substrings.LENGTH + 1))
        block = substrings.Block([raw])
        hashes = substrings.mixed((block.sums[substrings.GRAM :] - block.sums[: -substrings.GRAM]) * block.back[: len(raw) - substrings.GRAM + 1])
        old, new = int(hashes[: grams + 1].argmin()), int(hashes[1:].argmin()) + 1
        if old != new and old >= 1 and (new - old) % substrings.CHUNK == 0:
            break
    else:
        raise AssertionError("no such text")
    whole = set(substrings.Block([raw]).chunks()[0].tolist())
    later = set(substrings.Block([raw[1:]]).chunks()[0].tolist())
    assert later <= whole and len(whole) == 2
