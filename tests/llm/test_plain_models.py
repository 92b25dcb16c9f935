"""The trained operators against plain Python: count tables, compression calls and rounds of co-training, document by document."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

pytest.importorskip("meterlake.llm")
from pyspark.sql import functions as F  # noqa: E402

from meterlake.llm import langid, quality, toxicity  # noqa: E402
from meterlake.llm import queries as registered  # noqa: E402
from meterlake.llm.labelled import logistic  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def learned_from(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 != 1


@pytest.fixture(scope="module")
def tables(spark):
    return {name: spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels")}


def plain_buckets(text):
    weights = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D]
    points, out = [ord(c) for c in lower(text)], Counter()
    for k in langid.ORDERS:
        for i in range(len(points) - k + 1):
            h = k
            for j in range(k):
                h = h + points[i + j] * weights[j] & 0xFFFFFFFF
                h ^= h >> 15
                h = h * 0x2C1B3C6D & 0xFFFFFFFF
            out[h >> 17] += 1
    return out


def test_language_is_naive_bayes(spark, tables):
    docs = tables["documents"].select("doc_id", "text", "lang").collect()
    grams = {r.doc_id: plain_buckets(r.text) for r in docs}
    counts, n = {}, Counter()
    for r in docs:
        if learned_from(r.doc_id) and r.lang is not None and r.text is not None:
            counts.setdefault(r.lang, Counter()).update(grams[r.doc_id])
            n[r.lang] += 1
    total = {lang: sum(c.values()) + 0.5 * langid.BUCKETS for lang, c in counts.items()}
    got = {r.doc_id: r for r in registered.queries()["op4_language_id"](spark, SF_DIR).collect()}
    for r in docs:
        if not any(c.isalpha() for c in r.text or ""):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        odds = {
            lang: math.log(n[lang] / sum(n.values())) + sum(k * math.log((c[b] + 0.5) / total[lang]) for b, k in grams[r.doc_id].items())
            for lang, c in counts.items()
        }
        best = max(odds.values())
        share = 1 / sum(math.exp(max(o - best, -700)) for o in odds.values())
        assert odds[got[r.doc_id].lang_pred] == pytest.approx(best, rel=1e-6)
        assert got[r.doc_id].score == pytest.approx(share, abs=1e-2)  # the matrix is in single precision


def plain_words(text):
    """Words of letters and digits as bytes; none of the sample's is long enough to be cut."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    assert all(len(w) <= toxicity.LONGEST_WORD for w in words)
    return words


def test_toxicity_is_compression_distance(spark):
    larger = "/root/testdata/sf0.01"
    if not os.path.isdir(larger):
        pytest.skip("larger sample not present")
    docs, labels = (spark.read.parquet(f"{larger}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    filler = b" " + model.filler

    def compressor(content):
        kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = {"strategy": zstandard.STRATEGY_BTLAZY2, "min_match": 4, "hash_log": 17, "chain_log": 17, "source_size": 256}
        plain = {"write_content_size": False, "write_dict_id": False, "write_checksum": False, "dict_size": len(content)}
        return zstandard.ZstdCompressor(dict_data=kept, compression_params=zstandard.ZstdCompressionParameters.from_level(3, **settings, **plain))

    toxic, ordinary = compressor(model.toxic), compressor(model.ordinary)
    alone = len(toxic.compress(model.filler))

    def gain(words):
        window = b" " + b" ".join(words) + filler
        size = len(toxic.compress(window))
        return len(ordinary.compress(window)) - size, size - alone

    got = {r.doc_id: r.score for r in registered.queries()["op9_toxicity"](spark, larger).collect()}
    turned = 0
    for r in docs.join(labels, "doc_id").orderBy("toxic", "doc_id").select("doc_id", "text").tail(40):
        def score(words):
            one = [gain([w]) for w in words]
            wide = [gain(words[max(0, i - 2) : i + 3])[0] for i, (g, _) in enumerate(one) if g >= 2]
            counts = [sum(g >= k for g, _ in one) for k in range(1, 6)]
            counts += [sum(g >= k and d <= m for g, d in one) for k in (2, 3) for m in (3, 4, 5, 6)]
            counts += [sum(g >= k for g in wide) for k in (2, 3, 4, 5, 6, 8)]
            x = [*(math.log1p(c) for c in counts), *(c / math.sqrt(len(words) + 20) for c in counts), math.log(len(words) + 20)]
            odds = sum(a * b for a, b in zip(x, model.weights)) + model.weights[-1]
            return 1 / (1 + math.exp(-max(-30, min(30, odds))))

        words = plain_words(r.text)
        assert got[r.doc_id] == pytest.approx(score(words), abs=1e-9)
        turned += abs(score(words) - score(words[::-1])) > 1e-9
    assert turned  # the order of words counts


def plain_text_bins(text):
    data = (text or "").encode()
    words = data.split()
    n, size, some = len(words), max(1, len(data)), max(1, len(words))
    white = b" \t\n\x0b\x0c\r"
    kinds = Counter()
    for b in data:
        if b in white:
            kinds["white"] += 1
        elif 65 <= b <= 90:
            kinds["upper"] += 1
        elif 48 <= b <= 57:
            kinds["digit"] += 1
        elif b in b".,":
            kinds["stop"] += 1
        elif b < 128 and not 97 <= b <= 122:
            kinds["sign"] += 1
    ratios = [math.sqrt(kinds[k] / size) * 16 for k in ("upper", "digit", "stop", "white", "sign")]
    distinct = sum(len({w.lower() for w in words[i : i + 256]}) for i in range(0, n, 256)) / some
    lines = math.sqrt(data.count(b"\n") / some) * 16
    rest = [distinct * 16, (len(data) - kinds["white"]) / some, math.sqrt(kinds["sign"] / some) * 4, lines, math.log2(n + 1)]
    return [int(min(15, max(0, x))) + 16 * i for i, x in enumerate([*ratios, *rest])]


def plain_view(rows, size):
    """Log-odds per code, and of the classes last, from (label, codes)."""
    counts = np.full((2, size + 1), 0.5)
    for label, codes in rows:
        for c in [*codes, size]:
            counts[label, c] += 1
    table = np.log((counts[1] / counts[1, -1]) / (counts[0] / counts[0, -1]))
    table[-1] = math.log(counts[1, -1] / counts[0, -1])
    return table


def test_quality_is_co_training(spark, tables):
    docs = tables["documents"].select("doc_id", "text", quality._meta_codes("text", "source", "lang").alias("m")).collect()
    y = {r.doc_id: r.quality for r in tables["labels"].collect() if learned_from(r.doc_id)}
    views = {r.doc_id: (plain_text_bins(r.text), list(r.m)) for r in docs}
    sizes = quality.TEXT_FEATURES * quality.BINS, quality.META_CODES

    def odds(codes, table):
        return table[-1] + sum(table[c] for c in codes)

    labels = [dict(y), dict(y)]  # what each view learns from
    edge = math.log(quality.CONFIDENT / (1 - quality.CONFIDENT))
    for _ in range(quality.ROUNDS):
        fitted = [plain_view([(labels[v][d], views[d][v]) for d in views if d in labels[v]], sizes[v]) for v in (0, 1)]
        told = [{d: int(o > 0) for d in views if abs(o := odds(views[d][v], fitted[v])) >= edge} for v in (0, 1)]
        labels = [told[1] | y, told[0] | y]
    known = sorted((y[d], odds(views[d][0], fitted[0]), odds(views[d][1], fitted[1])) for d in views if d in y)
    w = logistic(np.array([k[1:] for k in known]), np.array([k[0] for k in known], float))
    got = {r.doc_id: r.score for r in registered.queries()["op10_quality"](spark, SF_DIR).collect()}
    for d, (text, meta) in views.items():
        o = odds(text, fitted[0]) * w[0] + odds(meta, fitted[1]) * w[1] + w[2]
        assert got[d] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, o)))), abs=1e-9)


def test_both_views_do_better_than_either(spark):
    """Held-out documents of the larger sample: the views together mark at least as many rightly as the better one alone."""
    larger = "/root/testdata/sf0.01"
    if not os.path.isdir(larger):
        pytest.skip("larger sample not present")
    docs, labels = (spark.read.parquet(f"{larger}/{name}.parquet") for name in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect() if not learned_from(r.doc_id)}

    def right(frame):
        scored = quality.score_quality(frame, labels).select("doc_id", "quality_score").collect()
        return sum((r.quality_score >= 0.5) == bool(truth[r.doc_id]) for r in scored if r.doc_id in truth)

    both = right(docs)
    text_only = right(docs.withColumn("source", F.lit("s")).withColumn("lang", F.lit("l")))
    meta_only = right(docs.withColumn("text", F.lit("same text")))
    assert both >= max(text_only, meta_only) - 0.01 * len(truth)
