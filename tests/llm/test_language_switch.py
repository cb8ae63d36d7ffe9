"""Texts whose pass is skipped have the labels the pass would give."""

from types import SimpleNamespace

import numpy as np

from routeline.llm.language import label, viterbi


def value(s, path, penalty):
    return s[np.arange(len(s)), path].sum() - penalty * np.count_nonzero(np.diff(path))


def labelled(s, penalty):
    return label(SimpleNamespace(text_words=np.array([0, len(s)])), s, 0, penalty)


def test_two_languages_under_a_third():
    s = np.array([[0.0, -20, -9], [-20, 0, -9]])
    assert labelled(s, 15.0).tolist() == viterbi(s, 15.0).tolist() == [0, 1]


def test_three_languages_against_the_pass():
    rng, switched = np.random.default_rng(3), 0
    for _ in range(3000):
        n = int(rng.integers(1, 12))
        s = -rng.integers(0, 21, (n, int(rng.integers(1, 4)))).astype(float)
        path, best = labelled(s, 15.0), viterbi(s, 15.0)
        assert value(s, path, 15.0) == value(s, best, 15.0)
        switched += len(set(best.tolist())) > 1
    assert switched > 100
