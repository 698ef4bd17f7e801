"""Verdicts of the quality rules against a minimum-covariance-determinant search of its own in NumPy, from many random starts."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from cardloom.llm import quality_rules as Q
from tests.llm.helpers import frame

FLOORS = np.diag(np.square([0.06, 0.4, 0.4, 0.5]))


def vector(text):
    w = text.split()
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return [math.log(sum(map(len, w)) / len(w)), math.log(1 + 100 * symbols / len(w)), math.log(1 + 10 * len(covered) / len(w)), math.log(1 + 100 * (len(lines) - len(set(lines))) / len(w))]


def chi2(x, k):
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))


def quantile(p, k):
    low, high = 0.0, 500.0
    for _ in range(100):
        low, high = ((low + high) / 2, high) if chi2((low + high) / 2, k) < p else (low, (low + high) / 2)
    return high


def mcd_distances(x, starts=60):
    """Squared distances by the estimate of the least determinant over three quarters of the rows."""
    rng = np.random.default_rng(0)
    h = math.ceil(0.75 * len(x))
    factor = 0.75 / chi2(quantile(0.75, 4), 6)
    best = None
    for n in range(starts):
        some = x[rng.choice(len(x), 6, replace=False)] if n else x
        at, spread = np.median(some, axis=0), np.cov(some.T, bias=True) * (factor if n else 1) + FLOORS
        for _ in range(100):
            d = np.einsum("ij,jk,ik->i", x - at, np.linalg.inv(spread), x - at)
            near = x[np.argsort(d, kind="stable")[:h]]
            new_at, new = near.mean(axis=0), np.cov(near.T, bias=True) * factor + FLOORS
            if np.allclose(new, spread) and np.allclose(new_at, at):
                break
            at, spread = new_at, new
        if best is None or np.linalg.det(spread) < best[0]:
            best = np.linalg.det(spread), at, spread
    _, at, spread = best
    return np.einsum("ij,jk,ik->i", x - at, np.linalg.inv(spread), x - at)


@pytest.mark.parametrize(("good", "bad"), [(300, 30), (150, 35), (40, 6), (14, 2)])
def test_verdicts_and_distances_equal_numpy(spark, good, bad):
    rng = random.Random(good)
    word = lambda: rng.choice(["ab", "cde", "fghi", "jk", "l"]) + str(rng.randrange(900))
    texts = []
    for i in range(good):
        words = [word() + ("#" if rng.random() < 0.03 else "") for _ in range(rng.randrange(60, 220))]
        if i % 5 == 0:
            words += words[3:12]
        texts.append("\n".join(" ".join(words[k : k + 12]) for k in range(0, len(words), 12)) + ("\n" + " ".join(words[:12])) * (i % 4 == 0))
    for i in range(bad):
        texts.append(" ".join(word() + "$" * rng.randrange(2, 6) for _ in range(90)) if i % 2 else "\n".join(" ".join([word(), "wwwwwwwwwwwwwwwwwww"]) + "\nsame line" for _ in range(40)))
    got = {r.doc_id: r for r in Q.quality_verdicts(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}
    sound = [i for i in range(len(texts)) if not got[i].base_failed]
    distance = dict(zip(sound, mcd_distances(np.array([vector(texts[i]) for i in sound])).tolist()))
    cutoff = quantile(1 - 1e-5, 4)
    assert [got[i].kept for i in sound] == [distance[i] <= cutoff for i in sound]
    inner = [i for i in sound if distance[i] <= cutoff]
    assert np.corrcoef([distance[i] for i in inner], [got[i].distance for i in inner])[0, 1] > 0.97
    assert not any(got[i].kept for i in range(good, good + bad) if i in distance)
