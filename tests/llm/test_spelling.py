"""Spelling variants against a brute-force version."""

import os
import random
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("meterlake.llm")
from meterlake.llm import queries as registered  # noqa: E402
from meterlake.llm.spelling import neighbours, variants, word_counts  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute_counts(rows, shortest=5, fewest=3, spoil=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and spoil and h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= fewest}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_near(words):
    """Pairs that agree in what is left when one code point is taken out, or in all words by trial where they are few."""
    by_rest = {}
    for w in words:
        for key in {(0, w)} | {(1, w[:i] + w[i + 1 :]) for i in range(len(w))} | {(2, i, w[:i] + w[i + 1 :]) for i in range(len(w))}:
            by_rest.setdefault(key if key[0] == 2 else key[1], set()).add(w)
    return {(a, b) for met in by_rest.values() for a in met for b in met if near(a, b)}


def brute_variants(counts):
    met = {}
    for a, b in brute_near(counts):
        met.setdefault(a, []).append(b)
    form = {}
    for w, n in counts.items():
        best = min(met.get(w, []), key=lambda b: (-counts[b], b), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(met.get(w, [])), counts.get(form[w])))
    return sorted(out, key=repr)


def test_brute_near():
    rnd = random.Random(5)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 6))) for _ in range(60)}
    assert brute_near(words) == {(a, b) for a in words for b in words if near(a, b)}


@pytest.mark.parametrize("seed", [1, 2])
def test_neighbours(spark, seed):
    """Dense and sparse vocabularies, runs of one letter, letters of two bytes, words within words, very long ones."""
    rnd = random.Random(seed)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 9))) for _ in range(500)}
    words |= {"a" * n for n in range(1, 30)} | {"x" * 400, "x" * 399, "x" * 200 + "y" + "x" * 199, "q" * 1000}
    for _ in range(300):
        w = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzÿ÷") for _ in range(rnd.randrange(5, 12)))
        i = rnd.randrange(len(w) + 1)
        words |= {w, w[:i] + rnd.choice("abz") + w[i:], w[:i] + w[i + 1 :], w[:i] + "ü" + w[i + 1 :]}
    words.discard("")
    frame = spark.createDataFrame([(w,) for w in sorted(words)] + [(None,), ("",), ("aa",)], "w string")
    got = [tuple(r) for r in neighbours(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_near(words)


def test_variants(spark):
    """Ties of n go by code point; roots follow long chains; clashing columns, null ids, null and empty texts, repeated rows."""
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbbc", "bbbbcc"]
    text = " ".join(" ".join([w] * 3 * 2**i) for i, w in enumerate(chain))
    rows = [(1, text), (2, "Zebra zebra ZEBRA zebrá Zebrà zebrá zebrà zebrà zebrá " * 2), (None, "planted " * 5), (3, None), (4, ""), (4, "planted " * 2)]
    rows += [(5, "same row here same words " * 2)] * 3 + [(i, "misspelling correctly") for i in range(6, 900)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, n int, word string")
    for spoil in (97, 0):
        counts = brute_counts(rows, spoil=spoil)
        got = variants(word_counts(docs, spoil=spoil))
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_variants(counts)
    assert variants(word_counts(docs.limit(0))).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")
def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = registered.queries()["op13_spelling_variants"](spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_variants(brute_counts(docs))
