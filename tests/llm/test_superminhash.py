"""SuperMinHash near duplicates against brute force, and what its signatures promise."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

pytest.importorskip("meterlake.llm")
from meterlake.llm import superminhash  # noqa: E402
from meterlake.llm.superminhash import near_duplicates, signatures  # noqa: E402


def brute(rows, k=2, percent=80):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return Counter((row[0], len(sets[i]), least.get(root(i))) for i, row in enumerate(rows))


def result(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())


def test_signatures():
    """Agreement estimates similarity, more closely than independent draws would; each set is signed alike in any company."""
    rnd = np.random.default_rng(1)
    errors = []
    for share in (0.5, 0.8) * 60:
        both = rnd.integers(0, 2**63, int(20 * share), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rnd.integers(0, 2**63, 20 - len(both), dtype=np.uint64)])) for _ in range(2))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = signatures([a, b])
        errors.append(((x == y).mean() - true) ** 2 / (true * (1 - true) / 128))
    assert np.mean(errors) < 0.85  # 1 for independent components
    sets = [np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 7, 50, 128, 700, 5000)]
    assert all((signatures([s])[0] == t).all() for s, t in zip(sets, signatures(sets)))


@pytest.mark.parametrize("seed", [1, 2])
def test_families(spark, seed, monkeypatch):
    """Chains of links, passages that many share, pairs about the threshold, exact copies in number."""
    rnd = random.Random(seed)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for family in range(14):
        words = [f"f{family}x{rnd.randrange(400)}" for _ in range(rnd.choice([1, 2, 3, 12, 60, 150]))]
        for _ in range(rnd.choice([1, 2, 12, 30])):
            words = list(words)
            for _ in range(rnd.randrange(4)):
                words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(words + passage * (rnd.random() < 0.5))))
    base = [f"b{i}" for i in range(100)]
    for _ in range(40):
        rows.append((len(rows), " ".join(w if rnd.random() < 0.95 else f"q{rnd.randrange(10**6)}" for w in base)))
    rows += [(len(rows) + i, rows[0][1]) for i in range(50)]
    monkeypatch.setattr(superminhash, "HOT_ROWS", 10)
    assert result(spark, rows) == brute(rows)


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (6, "one two"), (7, "İ é"), (None, "no id"), (None, "no  ID"), (8, text)]
    rows += [(None, text.upper()), (9, text + " x"), (9, "other text"), (10, " ".join(f"w{i % 977}" for i in range(60_000))), (11, "a\x0bb\x0cc")]
    assert result(spark, rows) == brute(rows)
    assert near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    other = spark.createDataFrame([(1, text, 5, "k"), (2, text, 6, "k")], "a bigint, t string, ref bigint, component_id string")
    assert [(r.doc_id, r.component_id) for r in near_duplicates(other, "a", "t").orderBy("doc_id").collect()] == [(1, 1), (2, 1)]
