"""Registered queries on the smallest sample: their SQL, or held-out accuracy."""

import os
import re
import zlib

import pytest
from llm_brute import brute_targets

pytest.importorskip("meterlake.llm")
duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from meterlake.llm import queries as registered  # noqa: E402
from meterlake.llm.secrets import RULES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return connection


def test_all_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in registered.queries()}
    assert numbers == set(range(1, 14)) and "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, con, name):
    df = registered.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name.startswith(("op1_", "op6_")):
        assert "Python" not in plan and "Arrow" not in plan
    rows = df.collect()
    if sql := registered.oracle_sql().get(name):
        result = con.execute(sql)
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(tuple(r[c] for c in columns) for r in rows) == sorted(result.fetchall())
    elif name != "op7_exact_top_k":
        assert len(rows) == con.execute("SELECT count(*) FROM documents").fetchone()[0]


def test_pipeline(spark, con):
    rows = contract.queries()["pipeline"](spark, SF_DIR).collect()
    total = con.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert 0.5 * total < len(rows) < total
    assert all(r.taken <= 2 * r.size for r in rows)


LARGER = "/root/testdata/sf0.01"


def learned_from(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 != 1


def test_held_out_accuracy(spark):
    """Classifiers against the labels of the documents they must not learn from."""
    labels = {r.doc_id: r for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}

    def held(name):
        out = registered.queries()[name](spark, LARGER).collect()
        assert len(out) == len(docs) and all(r.held_out != learned_from(r.doc_id) for r in out)
        return [r for r in out if r.held_out]

    told = [r for r in held("op4_language_id") if docs[r.doc_id].lang is not None and r.lang_pred != "und"]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in told) >= 0.98 * len(told)
    toxic = [(labels[r.doc_id].toxic, r.predicted) for r in held("op9_toxicity") if r.doc_id in labels]
    assert sum(p for t, p in toxic if not t) <= 0.02 * len(toxic)
    assert sum(p for t, p in toxic if t) >= 0.4 * sum(t for t, _ in toxic)
    good = [(labels[r.doc_id].quality, r.predicted) for r in held("op10_quality") if r.doc_id in labels]
    assert sum(q == p for q, p in good) >= 0.85 * len(good)


def test_token_counts_are_the_tokenizers(spark, con):
    tokenizers = pytest.importorskip("tokenizers")
    path = str(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    encode = tokenizers.Tokenizer.from_file(path).encode
    want = set()
    for doc_id, text in con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall():
        n = len(encode(text, add_special_tokens=False).ids)
        want.add((doc_id, len(text.encode()), n, n > 1024))
    assert {tuple(r) for r in registered.queries()["op5_token_counts"](spark, SF_DIR).collect()} == want


def test_secret_places(spark, con):
    got = {r.doc_id: r for r in registered.queries()["op8_secret_scan"](spark, SF_DIR).collect()}
    for doc_id, text in con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall():
        spans = []
        for n, rule in enumerate(RULES):
            for m in re.finditer(rule.pattern, text):
                if len(m[rule.group]) >= rule.least:
                    spans.append((m.start(), n, f"{rule.kind}:{m.start()}:{m.end()}"))
        assert got[doc_id].spans == ",".join(s for *_, s in sorted(spans))


def test_mix_targets(spark, con):
    sizes, words = {}, {}
    for doc_id, text, source in con.execute("SELECT doc_id, coalesce(text, ''), source FROM documents").fetchall():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        sizes[source] = sizes.get(source, 0) + n
        words[doc_id] = n, source
    want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for r in registered.queries()["op6_source_mix"](spark, SF_DIR).collect():
        n, source = words[r.doc_id]
        assert (r["size"], r.source_size) == (n, sizes[source]) and 0 <= r.taken <= 2 * n
        assert abs(r.target - float(want[source])) < 1e-6 * max(1.0, r.target)
        taken[source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_items_without_id_are_hit(spark, tmp_path):
    """Query and SQL agree on a benchmark item without id: its words are hit, no list has it."""
    docs = [(1, "one two three"), (2, "nothing"), (3, None), (4, "six seven one two")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(None, "one two"), (7, "six seven"), (8, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    result = con.execute(registered.oracle_sql()["op3_decontaminate"])
    columns = [d[0] for d in result.description]
    got = sorted(tuple(r[c] for c in columns) for r in registered.queries()["op3_decontaminate"](spark, str(tmp_path)).collect())
    assert got == sorted(result.fetchall())
    assert [(r[columns.index("n_hit")], r[columns.index("n_items")]) for r in got] == [(2, 0), (0, 0), (0, 0), (4, 1)]
