"""Periodic runs against a brute-force version."""

import hashlib
import os
import random
import re
import zlib
from fractions import Fraction

import pytest

pytest.importorskip("meterlake.llm")
from pyspark.sql import functions as F  # noqa: E402

from meterlake.llm import queries as registered  # noqa: E402
from meterlake.llm.runs import periodic_runs  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute_words(text, seed=None):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if seed is not None and seed % 10 == 0 and n:
        g = seed // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute_runs(words):
    """Every period's longest stretches, those of which no divisor is a period too."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        m = 0
        while m + q < n:
            if words[m] != words[m + q]:
                m += 1
                continue
            start = m
            while m + q < n and words[m] == words[m + q]:
                m += 1
            stretch = words[start : m + q]
            if len(stretch) >= max(24, 3 * q) and not any(q % d == 0 and stretch[d:] == stretch[:-d] for d in range(1, q)):
                found.append((start, q, len(stretch)))
    return sorted(found)


def brute_collapsed(words, runs):
    gone = {i for s, q, k in runs for i in range(s + q, s + k)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def brute_digest(doc_id, text):
    words = brute_words(text, None if doc_id is None else zlib.crc32(str(doc_id).encode()))
    runs = brute_runs(words)
    top = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    listed = "".join(f"{s},{k},{q}\n" for s, q, k in runs)
    kept = brute_collapsed(words, runs)
    best = (None,) * 4 if top is None else (top[0], top[2], top[1], 1000 * top[2] // top[1])
    return doc_id, len(runs), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept))


def periodic(rnd, n):
    """Words with repetitions of many periods, nested ones and near misses among them."""
    out = []
    while len(out) < n:
        unit = [rnd.choice("abcdefgh") + str(rnd.randrange(40)) for _ in range(rnd.choice([1, 2, 3, 5, 8, 15, 16, 17, 31, 33, 60, 130]))]
        if rnd.random() < 0.3:
            unit = unit * 4 + [rnd.choice("xyz")]
        out += unit * rnd.choice([1, 2, 3, 4, 9]) + unit[: rnd.randrange(len(unit) + 1)]
        if rnd.random() < 0.3:
            out[rnd.randrange(len(out))] = "odd"
    return " ".join(out[:n])


ODD = [None, "", " \t\n ", "a", "a " * 23, "a " * 24, "A a " * 12, "x y " * 11 + "x", "ü\x0b漢 " * 8, "é " * 400, "a b c " * 300 + "d " * 50]


@pytest.mark.parametrize("long_bytes,tile", [(1 << 14, 2048), (0, 64), (200, 128)])
def test_runs(spark, long_bytes, tile):
    """Alike in one tile and in many, however small."""
    rnd = random.Random(tile)
    texts = ODD + [periodic(rnd, n) for n in (30, 70, 200, 500, 900, 1500, 2500)] + [" ".join(rnd.choice("ab") for _ in range(400))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[-1]), (3, texts[-2]), (3, texts[-2])]
    docs = spark.createDataFrame(rows, "runs bigint, collapsed string").withColumn("key", F.lit("kept"))
    got = periodic_runs(docs, "collapsed", ("runs", "key"), long_bytes=long_bytes, tile=tile).collect()
    want = []
    for i, t in rows:
        words = brute_words(t)
        runs = brute_runs(words)
        want.append(((i, "kept"), len(words), runs, brute_collapsed(words, runs)))
    assert sorted(((tuple(r.row), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=repr) == sorted(want, key=repr)


def test_long_text(spark):
    """A run over very many tiles is one run, and a long period is found across them."""
    line = [f"w{i}" for i in range(7001)]
    text = " ".join(line * 3 + ["end"] + ["x", "y"] * 30_000)
    got = periodic_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()[0]
    assert [tuple(r) for r in got.runs] == [(0, 7001, 21003), (21004, 2, 60_000)]
    assert got.collapsed == " ".join(line + ["end", "x", "y"])


def test_empty(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")
def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    out = registered.queries()["op12_periodic_runs"](spark, SF_DIR)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, out.collect())) == sorted(brute_digest(*r) for r in docs)
