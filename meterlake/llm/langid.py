"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams per language come from a bounded sample of labelled rows, one partial table per task, summed in
Spark.  The matrix of log-probabilities (languages x buckets) is broadcast; batches of texts are scored in numpy by looking up
one value per n-gram and language and summing over each text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.text import Slice, slices

BUCKETS = 1 << 15
ORDERS = (2, 3)
SAMPLE_ROWS = 40_000  # labelled rows the model is fitted on, at most (in expectation)
PARTS = 8
SALTS = 64
_WEIGHTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def code_points(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a slice, ASCII letters in lower case, and where each row begins."""
    begins = (part.data & 0xC0) != 0x80
    total = np.concatenate([[0], np.cumsum(begins)])
    points = np.frombuffer(part.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32).copy()
    points[(points >= 0x41) & (points <= 0x5A)] += 0x20
    return points, total[part.offsets]


def ngram_buckets(points: np.ndarray, k: int) -> np.ndarray:
    """Bucket of the k-gram that begins at each code point (the last k - 1 have none)."""
    n = max(0, len(points) - k + 1)
    h = np.full(n, k, np.uint32)
    for j in range(k):
        h += points[j : j + n] * _WEIGHTS[j]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(32 - BUCKETS.bit_length() + 1)


def _inside(values: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Sets what begins in the last k - 1 places of a row to 0."""
    for j in range(1, k):
        edge = first[1:] - j
        edge = edge[(edge >= 0) & (edge < len(values))]
        values[edge] = 0
    return values


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for part in slices(batch.column(1)):
            points, first = code_points(part)
            for i in range(len(part)):
                lang = langs[part.first + i]
                own = points[first[i] : first[i + 1]]
                table = tables.setdefault(lang, np.zeros(BUCKETS, np.int64))
                docs[lang] = docs.get(lang, 0) + 1
                for k in ORDERS:
                    table += np.bincount(ngram_buckets(own, k), minlength=BUCKETS)
    for lang, table in tables.items():
        for p, chunk in enumerate(np.split(table, PARTS)):
            yield pa.RecordBatch.from_pydict({"lang": [lang], "part": pa.array([p], pa.int32()), "docs": [docs[lang] if p == 0 else 0], "counts": [chunk.tobytes()]})


def _add(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()], axis=0)
    docs = sum(table.column("docs").to_pylist())
    return pa.table({"lang": table.column("lang")[:1], "part": table.column("part")[:1], "docs": [docs], "counts": [total.tobytes()]})


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the matrix of log-probabilities with the log-priors as its last column.

    Rows with a null language or text are not used.  Above sample_rows rows, those are used whose hashed key falls under the
    fraction sample_rows / rows, alike on every run.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(key, lang, text)
    total = rows.count()
    if total > sample_rows:
        rows = rows.where(F.pmod(F.xxhash64(F.lit("language sample"), key), F.lit(1_000_000)) < int(1e6 * sample_rows / total))
    schema = "lang string, part int, docs bigint, counts binary"
    counted = rows.select(lang, text).mapInArrow(_count, schema).withColumn("salt", F.spark_partition_id() % SALTS)
    # Two levels: a frequent language has a table from every task that holds a sampled row.
    summed = counted.groupBy("lang", "part", "salt").applyInArrow(_add, schema).groupBy("lang", "part").applyInArrow(_add, schema).collect()
    langs = sorted({r.lang for r in summed})
    counts, docs = np.zeros((len(langs), BUCKETS)), np.zeros(len(langs))
    width = BUCKETS // PARTS
    for r in summed:
        i = langs.index(r.lang)
        counts[i, r.part * width : (r.part + 1) * width] = np.frombuffer(r.counts, np.int64)
        docs[i] += r.docs
    smooth = counts + 0.5
    logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if langs else counts
    return langs, np.concatenate([logs, np.log(docs / max(1, docs.sum()))[:, None]], axis=1).astype(np.float32)


def _has_letter(own: np.ndarray) -> bool:
    if ((own >= 0x61) & (own <= 0x7A)).any():
        return True
    return any(chr(c).isalpha() for c in np.unique(own[own >= 0x80]))


def predict(docs: DataFrame, text: Column | str, model: tuple[list[str], np.ndarray]) -> Column:
    """struct<lang, score>: the likeliest language of a whole text and its probability under the model.

    ``und`` with score 0 for a null text, a text without a letter, or a model without languages.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        langs, matrix = shared.value
        for texts in batches:
            names, scores = [], []
            for part in slices(texts):
                points, first = code_points(part)
                sums = np.repeat(matrix[:, -1:].astype(np.float64), len(part), axis=1)
                for k in ORDERS:
                    bucket = ngram_buckets(points, k)
                    for c in range(len(langs)):
                        values = _inside(matrix[c][bucket].astype(np.float64), first, k)
                        total = np.concatenate([[0.0], np.cumsum(values)])
                        total = np.append(total, np.full(k - 1, total[-1])) if len(total) < len(points) + 1 else total
                        sums[c] += np.diff(total[np.minimum(first, len(total) - 1)])
                for i in range(len(part)):
                    if not langs or not _has_letter(points[first[i] : first[i + 1]]):
                        names.append("und")
                        scores.append(0.0)
                        continue
                    best = int(sums[:, i].argmax())
                    names.append(langs[best])
                    scores.append(float(1 / np.exp(np.maximum(sums[:, i] - sums[best, i], -700)).sum()))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return score(text)
