"""Suffix arrays against sorting."""

import random

import numpy as np

from tabwright.llm.suffix_groups import suffix_arrays


def check(texts):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = suffix_arrays(np.array([x for t in texts for x in t], np.int64), bounds)
    for k, t in enumerate(texts):
        want = sorted(range(len(t)), key=lambda i: t[i:])
        assert (found[bounds[k] : bounds[k + 1]] - bounds[k]).tolist() == want, t


def test_random_texts():
    rng = random.Random(4)
    for _ in range(200):
        texts = []
        for _ in range(rng.randint(1, 20)):
            t = [rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 60))]
            texts.append((t[:5] * 8 if rng.random() < 0.3 else t) + [0])
        check(texts)


def test_plain_cases():
    check([[0]])
    check([[1, 0], [0], [2, 1, 0]])
    check([[1] * 200 + [0]])  # one letter
    check([list(range(1, 100)) + [0], list(range(100, 1, -1)) + [0]])
    check([[1, 2] * 60 + [0], [2, 1] * 60 + [0], [1, 1, 2] * 40 + [0]])
    a, b = [1], [1, 2]
    for _ in range(9):  # Fibonacci words, rich in repeats
        a, b = b, b + a
    check([b + [0]])


def test_nothing():
    assert len(suffix_arrays(np.zeros(0, np.int64), np.zeros(1, np.int64))) == 0
