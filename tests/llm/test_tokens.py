"""Words of long texts are hashed in parts as they are in one piece; steps hold whole texts only."""

from random import Random

import numpy as np
import pytest

from linewarden.llm import tokens
from linewarden.llm.common import steps


@pytest.mark.parametrize("latin", [False, True])
def test_parts_change_no_hash(monkeypatch, latin):
    random = Random(3)
    word = lambda: random.choice(["Über", "x", "Straße", "a" * 90, "É", "数据"]) + str(random.randrange(50))
    texts = [(random.choice(" \n\t") * random.randrange(1, 4)).join(word() for _ in range(n)).encode() for n in (0, 1, 7, 900, 40)]
    texts += [b"w" * 5_000, b" " * 700, b"w" * 300 + b" end"]
    whole = tokens.WordHasher(latin=latin)(texts)
    monkeypatch.setattr(tokens, "PART", 64)
    parted = tokens.WordHasher(latin=latin)(texts)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parted, strict=True))
    assert np.diff(parted[1]).tolist() == [len(t.split()) for t in texts]


def test_steps_cover_every_text_once():
    texts = [b"x" * n for n in (3, 0, 50, 4, 4, 4, 0)]
    cut = list(steps(texts, 10))
    assert [i for a, b in cut for i in range(a, b)] == list(range(len(texts)))
    assert all(b - a == 1 or sum(map(len, texts[a:b])) <= 10 for a, b in cut)
