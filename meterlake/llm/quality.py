"""Quality classifier by co-training of two views of a document: its text and its metadata.

The text view sees ratios of characters, words and lines; the metadata view the source, the language tag and the length.
Each view is a naive Bayes over small codes (feature and bin), so that one grouped count over all documents is all it takes to
fit it.  In each round each view labels the documents it is confident about, and the other view learns from them, next to the
true labels.  At the end the two log-odds are calibrated together on labelled rows and score every document.

Text is read once; the codes are written and every round works on them with plain column expressions.  What comes to the driver
is one count per code and, for the calibration, two numbers for each row of a bounded labelled sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.labelled import held_out, logistic, training_labels
from meterlake.llm.sharing import bound_batches
from meterlake.llm.text import NOT_SPACE, Slice, mix, slices, word_hashes, words
from meterlake.sources.staging import stage

SAMPLE_ROWS = 50_000  # labelled documents learned from, at most (in expectation)
ROUNDS = 3
CONFIDENT = 0.97
BINS = 16
SPAN = 256  # words among which repetition is measured
TEXT_FEATURES = 10
META_CODES = 3 * 64


def _counts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets]).astype(np.float64)


def _text_bins(part: Slice) -> np.ndarray:
    """Bins of the text features of every row of a slice."""
    data, at = part.data, part.offsets
    size = np.maximum(1, np.diff(at))
    kinds = np.zeros(256, np.uint8)  # 1 upper case, 2 digit, 3 stop or comma, 4 white space, 5 other sign
    kinds[0x00:0x80] = 5
    kinds[0x61:0x7B] = 0
    kinds[0x41:0x5B] = 1
    kinds[0x30:0x3A] = 2
    kinds[[0x2E, 0x2C]] = 3
    kinds[~NOT_SPACE] = 4
    kind = kinds[data]
    found = words(part, NOT_SPACE)
    n = np.diff(found.first)
    some = np.maximum(1, n)
    ratios = [_counts(kind == k, at) / size for k in range(1, 6)]
    # Distinct words within spans of SPAN words: independent of the length of the text.
    row = np.repeat(np.arange(len(part)), n)
    span = (np.arange(len(row)) - found.first[row]) // SPAN
    key = word_hashes(data, found.starts, found.ends) ^ mix(row.astype(np.uint64) << np.uint64(32) | span.astype(np.uint64))
    distinct = np.bincount(row[np.unique(key, return_index=True)[1]], minlength=len(part)) / some
    mean_length = _counts(kind != 4, at) / some
    signs = _counts(kind == 5, at) / some
    lines = _counts(data == 0x0A, at) / some
    bins = [np.sqrt(r) * BINS for r in ratios] + [distinct * BINS, mean_length, np.sqrt(signs) * 4, np.sqrt(lines) * BINS, np.log2(n + 1)]
    return np.clip(np.column_stack(bins), 0, BINS - 1).astype(np.int32)


def text_codes(text: Column | str) -> Column:
    """One code per text feature: which feature, and the bin of its value."""

    @F.arrow_udf("array<int>")
    def codes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            bins = [_text_bins(p) for p in slices(texts)]
            table = np.concatenate(bins) if bins else np.zeros((0, TEXT_FEATURES), np.int32)
            flat = pa.array((table + np.arange(TEXT_FEATURES, dtype=np.int32) * BINS).ravel())
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1, dtype=np.int32) * TEXT_FEATURES), flat)

    return codes(text)


def _meta_codes(text: str, source: str, lang: str) -> Column:
    def hashed(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(64))

    size = F.least(F.lit(63), F.floor(F.log2(F.length(F.coalesce(text, F.lit(""))) + 1) * 3))
    return F.array(hashed(source).cast("int"), (64 + hashed(lang)).cast("int"), (128 + size).cast("int"))


def _log_odds(codes: str, table: np.ndarray) -> Column:
    weights = F.array(*(F.lit(float(x)) for x in table[:-1]))
    return F.aggregate(codes, F.lit(float(table[-1])), lambda s, c: s + F.get(weights, c))


def _fit_view(rows: DataFrame, codes: str, label: Column, size: int) -> np.ndarray:
    """Log-odds per code, and of the classes last, from the rows whose label is not null."""
    rows = rows.select(label.alias("label"), F.explode(F.concat(codes, F.array(F.lit(size)))).alias("code")).where("label IS NOT NULL")
    counts = np.full((2, size + 1), 0.5)
    for r in rows.groupBy("label", "code").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.label, r.code] += r.n
    total = counts[:, -1:]
    table = np.log((counts[1] / total[1]) / (counts[0] / total[0]))
    table[-1] = np.log(total[1, 0] / total[0, 0])
    return table


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """All columns of docs and ``quality_score``, the probability of label 1, one row per document.

    Labels of the held-out fold are not used.  Null texts count as empty, null sources and languages as a value of their own;
    repeated rows and null ids are scored like any other.  Without labels of both classes the score is the smoothed share of
    label 1 (0.5 if there is no label).  A column of docs named quality_score is replaced.
    """
    bound_batches(docs.sparkSession)
    known = training_labels(labels, label, sample_rows, doc_id)
    codes = docs.select(
        F.col(doc_id).alias("id"), text_codes(text).alias("t"), _meta_codes(text, source, lang).alias("m")
    )
    codes = stage(codes.join(F.broadcast(known), "id", "left"), "codes")
    text_size, meta_size = TEXT_FEATURES * BINS, META_CODES
    by_text, by_meta = F.col("y"), F.col("y")  # what each view learns from
    low, high = np.log((1 - CONFIDENT) / CONFIDENT), np.log(CONFIDENT / (1 - CONFIDENT))

    def confident(odds: Column) -> Column:
        return F.when(odds >= high, 1).when(odds <= low, 0)

    for step in range(rounds):
        text_table = _fit_view(codes, "t", by_text, text_size)
        meta_table = _fit_view(codes, "m", by_meta, meta_size)
        if step + 1 < rounds:
            by_text = F.coalesce("y", confident(_log_odds("m", meta_table)))
            by_meta = F.coalesce("y", confident(_log_odds("t", text_table)))
    text_odds, meta_odds = _log_odds("t", text_table), _log_odds("m", meta_table)
    # One row per labelled id, however often the id repeats.
    labelled = codes.where("y IS NOT NULL").groupBy("id", "y").agg(F.min(F.struct("t", "m")).alias("c")).select("y", "c.*")
    table = labelled.select("y", text_odds.alias("a"), meta_odds.alias("b")).orderBy("y", "a", "b").toArrow()
    x = np.column_stack([table.column(c).to_numpy().astype(np.float64) for c in ("a", "b")])
    w = logistic(x, table.column("y").to_numpy().astype(np.float64))
    odds = _log_odds("_quality_t", text_table) * float(w[0]) + _log_odds("_quality_m", meta_table) * float(w[1]) + float(w[2])
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), odds))))
    keep = [c for c in docs.columns if c != "quality_score"]
    scored = docs.select(*keep, text_codes(text).alias("_quality_t"), _meta_codes(text, source, lang).alias("_quality_m"))
    return scored.select(*keep, score.alias("quality_score"))
