"""Registered queries of the operators, each over its whole table, with the SQL that must give its result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import langid, superminhash, toxicity
from meterlake.llm.decontaminate import find_benchmark, n_hit
from meterlake.llm.labelled import held_out
from meterlake.llm.licenses import TEMPLATES, scan_licenses
from meterlake.llm.mixing import mix_sources
from meterlake.llm.ngram_join import near_duplicates
from meterlake.llm.quality import score_quality
from meterlake.llm.runs import periodic_runs
from meterlake.llm.secrets import RULES, secret_spans
from meterlake.llm.sharing import bound_batches
from meterlake.llm.spelling import variants, word_counts
from meterlake.llm.token_counts import token_counts
from meterlake.llm.topk import top_k

TOKEN_LIMIT = 1024
TOXIC_FROM = 0.7
KEEP_FROM = 0.5
PLANTED_ERRORS = 97


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_licenses(docs, "text", ["doc_id"]).select("doc_id", "license.*")
    return found.withColumn("score", F.round("score", 6))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(docs, _table(spark, sf_dir, "benchmark"), without_id=True)
    return found.select("doc_id", F.col("leak.n_words").alias("n_words"), n_hit().alias("n_hit"), F.array_sort("leak.items").alias("items")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out()))
    found = docs.select("doc_id", langid.predict(docs, "text", model).alias("p"))
    return found.select("doc_id", held_out().alias("held_out"), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", token_counts("text", str(public_tokenizers.path("byte_bpe_50k.json"))).alias("c"))
    return counted.select("doc_id", "c.n_bytes", "c.n_tokens", (F.col("c.n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).docs.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", secret_spans("text").alias("spans"))
    base = [r.kind for r in RULES if r.base]

    def joined(spans: str) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = found.withColumn("base", F.filter("spans", lambda s: s["kind"].isin(base)))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.toxicity(docs, "text", model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    scored = score_quality(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= KEEP_FROM, 1).otherwise(0)
    )


def op11_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superminhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs, seed=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    # Ratios are compared as products; runs come by start, then period, so that the first of equal ones stays.
    ahead = F.expr("reduce(runs, runs[0], (a, b) -> IF(b.length * a.period > a.length * b.period, b, a))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.withColumn("top", F.when(F.size("runs") > 0, ahead))
    return found.select(
        "row.doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(word_counts(docs, shortest=5, fewest=3, spoil=PLANTED_ERRORS), times=2)


_QUERIES = [
    op1_license_scan,
    op2_ngram_join,
    op3_decontaminate,
    op4_language_id,
    op5_token_counts,
    op6_source_mix,
    op7_exact_top_k,
    op8_secret_scan,
    op9_toxicity,
    op10_quality,
    op11_superminhash,
    op12_periodic_runs,
    op13_spelling_variants,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


# --- SQL ---------------------------------------------------------------------------------------------------------------
# chr(11) and chr(12) are white space too; lower() is kept to A-Z by translate().

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NO_SPACE = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _near_sql(k: int, percent: int, more: str = "") -> str:
    """Links by comparing all documents that share a shingle of k words, and what is reachable by them."""
    return f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_NO_SPACE}') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS s
    FROM words, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
repeated AS (SELECT s FROM shingles GROUP BY s HAVING count(*) > 1),
kept AS (SELECT doc_id, s FROM shingles SEMI JOIN repeated USING (s)),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM kept a JOIN kept b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= {percent} * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r.y) AS component_id{more}
FROM words w LEFT JOIN sizes USING (doc_id) JOIN reach r ON r.x = w.doc_id GROUP BY w.doc_id
"""


_OP2_SQL = _near_sql(5, 75)
_OP11_SQL = _near_sql(2, 80, ", w.doc_id = min(r.y) AS kept")

_OP3_SQL = f"""
WITH words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS w FROM documents),
items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS v
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
places AS (
    SELECT doc_id, i, list_slice(w, i, i + k - 1) AS v, k
    FROM words, (SELECT DISTINCT len(v) AS k FROM windows) AS lengths, unnest(range(1, len(w) - k + 2)) AS t(i)),
hits AS (SELECT doc_id, i, k, item_id FROM places JOIN windows USING (v)),
hit_words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + k)) AS t(j) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(id) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_OP7_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5
"""


_PHRASES = ", ".join(f"({n}, '{t.label}', {str(t.words)}, {t.base})" for n, t in enumerate(TEMPLATES))

_OP1_SQL = f"""
WITH words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS w FROM documents),
templates(n, label, p, base) AS (VALUES {_PHRASES}),
template_words AS (SELECT n, i, p[i] AS word FROM templates, unnest(range(1, len(p) + 1)) AS t(i)),
spoken AS (
    SELECT doc_id, i, w[i] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(i)
    WHERE w[i] IN (SELECT word FROM template_words)),
idf AS (
    SELECT word, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(DISTINCT doc_id))) + 1 AS idf
    FROM (SELECT DISTINCT word FROM template_words) LEFT JOIN spoken USING (word) GROUP BY word),
weighed AS (
    SELECT *, idf / sum(idf) OVER (PARTITION BY n) AS part, row_number() OVER (PARTITION BY n ORDER BY idf DESC, i) AS rarity
    FROM template_words JOIN idf USING (word)),
places AS (SELECT doc_id, n, s.i - r.i AS place FROM spoken s JOIN weighed r USING (word) WHERE rarity = 1),
shares AS (
    SELECT doc_id, n, place, sum(part) AS share, count(*) AS agreeing
    FROM places JOIN weighed w USING (n) JOIN spoken s USING (doc_id) WHERE s.i = place + w.i AND s.word = w.word GROUP BY doc_id, n, place),
scores AS (SELECT doc_id, least(1.0, max(share)) AS score FROM shares GROUP BY doc_id),
found AS (SELECT doc_id, place, label, base FROM shares JOIN templates USING (n) WHERE agreeing = len(p)),
per_doc AS (
    SELECT doc_id, count(*) FILTER (base) AS n_base, min(place) FILTER (base) AS first_word, max(place) FILTER (base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM found GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, round(coalesce(score, 0.0), 6) AS score
FROM words LEFT JOIN per_doc USING (doc_id) LEFT JOIN scores USING (doc_id)
"""


def _found(order: int, kind: str, pattern: str, group: int = 0, least: int = 0) -> str:
    """Spans of one kind: what stands between its matches gives their places."""
    return f"""
    SELECT doc_id, {order} AS o, '{kind}' AS kind, e - len(m[i]) AS s, e FROM (
        SELECT doc_id, m, g, i, CAST(list_sum(list_transform(list_slice(b, 1, i), lambda x: len(x)))
               + list_sum(list_transform(list_slice(m, 1, i), lambda x: len(x))) AS BIGINT) AS e
        FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS b, regexp_extract_all(text, '{pattern}') AS m,
                     regexp_extract_all(text, '{pattern}', {group}) AS g FROM documents WHERE regexp_matches(text, '{pattern}')),
             unnest(range(1, len(m) + 1)) AS t(i)) WHERE len(g[i]) >= {least}"""


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_SPANS = " UNION ALL ".join(
    [
        _found(0, "assign", rf"""({_KEYS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        _found(1, "access", "AKIA[A-Z0-9]+", 0, 20),
        _found(2, "hex", "[0-9a-f]{24,}"),
        *(_found(n, r.kind, r.pattern) for n, r in enumerate(RULES) if not r.base),
    ]
)

_OP8_SQL = f"""
WITH spans AS ({_SPANS}),
per_doc AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < 3) AS base,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans
    FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per_doc USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": _OP1_SQL,
        "op2_ngram_join": _OP2_SQL,
        "op3_decontaminate": _OP3_SQL,
        "op7_exact_top_k": _OP7_SQL,
        "op8_secret_scan": _OP8_SQL,
        "op11_superminhash": _OP11_SQL,
    }
