"""The mix against a plain schedule, slot after slot."""

import os
import re

import pytest
from llm_brute import brute_targets

pytest.importorskip("meterlake.llm")
from pyspark.sql import functions as F  # noqa: E402

from meterlake.llm import mixing  # noqa: E402
from meterlake.llm import queries as registered  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


def plain_schedule(blocks, golden):
    """slot -> (source, block): sources side by side on the unit interval, as long as their blocks; points of the sequence."""
    names = sorted((s for s in blocks if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in blocks)
    total, upto, edges, met = sum(blocks.values()), 0, [], dict.fromkeys(blocks, 0)
    for s in names:
        edges.append((s, int(upto / total * mixing.MODULUS), int((upto + blocks[s]) / total * mixing.MODULUS)))
        upto += blocks[s]
    edges[-1] = (*edges[-1][:2], mixing.MODULUS)
    out, slot = {}, 0
    while len(out) < total:
        point = slot * golden % mixing.MODULUS
        source = next(s for s, lo, hi in edges if lo <= point < hi)
        if met[source] < blocks[source]:
            out[slot] = source, met[source]
            met[source] += 1
        slot += 1
    return out


@pytest.mark.parametrize("golden", [mixing.GOLDEN, mixing.MODULUS - mixing.GOLDEN])
def test_mix_is_the_schedule(spark, monkeypatch, golden):
    monkeypatch.setattr(mixing, "GOLDEN", golden)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.select("doc_id", "source", "text").collect()
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    order = spark.createDataFrame(list(words.items()), "doc_id bigint, size bigint")
    order = {r.doc_id: r.h for r in order.select("doc_id", F.xxhash64(F.lit("mix"), "doc_id", "size").alias("h")).collect()}
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + words[r.doc_id]
    goals = {s: min(int(float(t) + 0.5), 2 * sizes[s]) for s, t in brute_targets(sizes).items()}
    k = mixing.BLOCK_WORDS
    slots = plain_schedule({s: -(-g // k) for s, g in goals.items() if g}, golden)
    taken, first = dict.fromkeys(words, 0), {}
    for source in sizes:
        axis = sorted((r.doc_id for r in rows if r.source == source), key=lambda d: (order[d], d))
        owner = [d for d in axis for _ in range(words[d])] * 2
        for slot, (s, block) in sorted(slots.items()):
            if s == source:
                for d in owner[block * k : min((block + 1) * k, goals[source])]:
                    taken[d] += 1
                    first.setdefault(d, slot)
    got = {r.doc_id: r for r in registered.queries()["op6_source_mix"](spark, SF_DIR).collect()}
    assert {d: (r.taken, r.first_slot) for d, r in got.items()} == {d: (n, first.get(d)) for d, n in taken.items()}


def test_a_sequence_that_misses_a_source_is_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GOLDEN", 1)
    with pytest.raises(RuntimeError, match="have a slot"):
        mixing.mix_sources(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_a_tiny_source_has_its_slot(spark):
    """A source of one word beside one of very many, a source without words, and a null source."""
    rows = [(1, "w " * 50_000, "big"), (2, "one", "a"), (3, "", "empty"), (4, "two words", None)]
    mix = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), block_words=10)
    blocks = mix.blocks.collect()
    assert {b.source for b in blocks} == {"big", "a", None} and len({b.slot for b in blocks}) == len(blocks)
    assert {r.doc_id: r.first_slot is None for r in mix.docs.collect()} == {1: False, 2: False, 3: True, 4: False}
