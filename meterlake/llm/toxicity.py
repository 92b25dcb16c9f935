"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

The dictionaries share a background of frequent ordinary words and differ in a part of equal length: terms that toxic documents
hold far more often than ordinary ones, against ordinary words.  A term is a word, or a beginning that many words of toxic
documents have in common.  Counts of a term are of documents with different surroundings of it, so that copies of one document
count once.  A run of letters longer than a word can be, as in scripts without spaces, is cut into overlapping pieces that count as
words: every byte is in one, here and in scoring.

Every word is a window, compressed before a filler that both dictionaries hold; its gain is the length it compresses to with the
ordinary dictionary less the length with the toxic one, its distance the bytes it adds to the filler under the toxic one.  About
each word that gains, the words on either side make a wider window, and windows of neighbours overlap; their gains tell terms
among terms from a lone likeness.  Gains and distances of a whole text, counted at several thresholds, are calibrated to a
probability on labelled rows.

Dictionaries and calibration are fitted on a bounded sample of labelled rows; scoring covers every document.  A word is
compressed once per task and remembered within a bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.labelled import held_out, logistic, training_labels
from meterlake.llm.sharing import load, share
from meterlake.llm.text import LETTER_DIGIT, Slice, Words, mix, slices, word_hashes, words
from meterlake.sources.staging import stage

SAMPLE_ROWS = 12_000  # labelled documents the dictionaries and the calibration are fitted on, at most (in expectation)
BACKGROUND_BYTES = 8_000
CLASS_TERMS = 1_000
# A term of the toxic dictionary is in more than LEAST toxic documents, LIFT times as often as in ordinary ones, and Z deviations more often than by chance.
LEAST, LIFT, Z = 4, 4, 4
STEM = (4, 7)  # characters of a beginning
STEM_GAIN = 1.5  # times the documents of any longer term it begins, or the longer ones say as much
FILLER_BYTES = 40
SIDE_WORDS = 2  # words on either side of one that gains
SUSPECT = 2  # gain of such a word
HASH_LOG = 17  # the match finder keeps every place of a dictionary
REMEMBERED = 500_000  # words whose window a task keeps: 16 bytes each
LONGEST_WORD = 200  # bytes of a word; a longer run of letters is cut into pieces
PIECE_BYTES = 48  # bytes of a piece; pieces overlap by half


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None = None

    @property
    def filler(self) -> bytes:
        return self.toxic[-BACKGROUND_BYTES:][:FILLER_BYTES]


def _pieces(part: Slice) -> Words:
    """The words of a slice; a run longer than LONGEST_WORD bytes gives pieces that overlap by half, cut between characters."""
    found = words(part, LETTER_DIGIT)
    size, step = found.ends - found.starts, PIECE_BYTES // 2
    if not (size > LONGEST_WORD).any():
        return found
    each = np.where(size > LONGEST_WORD, -(-size // step) - 1, 1)
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    starts, ends = np.repeat(found.starts, each) + nth * step, np.repeat(found.ends, each)
    ends = np.where(np.repeat(each, each) > 1, np.minimum(ends, starts + PIECE_BYTES), ends)
    for _ in range(3):  # a character has at most three bytes after its first
        starts -= (part.data[starts] & 0xC0) == 0x80
        ends -= (part.data[np.minimum(ends, len(part.data) - 1)] & 0xC0 == 0x80) & (ends < len(part.data))
    return Words(starts, ends, np.concatenate([[0], np.cumsum(each)])[found.first])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """y, text -> one row per document and term: a word with a blank behind it, or a beginning, and a value of its surroundings
    (the least there)."""
    for batch in batches:
        labels = batch.column(0).to_numpy()
        for part in slices(batch.column(1)):
            found = _pieces(part)
            values = word_hashes(part.data, found.starts, found.ends)
            for i in range(len(part)):
                lo, hi = found.first[i], found.first[i + 1]
                if lo == hi:
                    continue
                own = values[lo:hi]
                before, after = np.append(np.uint64(1), own[:-1]), np.append(own[1:], np.uint64(2))
                around = mix(before * np.uint64(3) + after)
                order = np.lexsort((around, own))
                first = order[np.append(True, own[order][1:] != own[order][:-1])]
                text = part.data.tobytes() if len(part) == 1 else part.data[part.offsets[i] : part.offsets[i + 1]].tobytes()
                base = part.offsets[i]
                names = [text[found.starts[lo + k] - base : found.ends[lo + k] - base].lower() for k in first]
                terms: dict[bytes, int] = {}
                for name, k in zip(names, first):
                    terms[name + b" "] = k
                    letters = name.decode("utf-8", "ignore")
                    for size in range(STEM[0], min(STEM[1] + 1, len(letters))):
                        terms.setdefault(letters[:size].encode(), k)
                y = np.full(len(terms), labels[part.first + i], np.int32)
                seen = around[list(terms.values())].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(list(terms), pa.binary()), pa.array(y), pa.array(seen)], ["word", "y", "around"])


def _joined(names: list[bytes], size: int) -> bytes:
    out = b" "
    for name in names:
        name = name.strip()
        if len(out) + len(name) + 1 <= size:
            out += name + b" "
    return out + b" " * (size - len(out))


def _dictionaries(sample: DataFrame) -> Model | None:
    """The two dictionaries from (y, text); None if one of the classes has no document."""
    docs = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not docs.get(0) or not docs.get(1):
        return None
    seen = sample.select("y", "text").mapInArrow(_contexts, "word binary, y int, around bigint").distinct()
    counts = seen.groupBy("word").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("ordinary"))
    n1, n0 = float(docs[1]), float(docs[0])
    share = (F.col("toxic") + F.col("ordinary")) / (n0 + n1)
    counts = counts.withColumn(
        "z", (F.col("toxic") - n1 * share) / F.sqrt(F.greatest(n1 * share * (1 - share) * (n0 / (n0 + n1)), F.lit(1e-9)))
    ).withColumn("lift", (F.col("toxic") + 0.5) / (n1 + 1) / ((F.col("ordinary") + 0.5) / (n0 + 1)))
    counts = stage(counts, "word-counts")
    marked = counts.where(f"z > {Z} AND lift > {LIFT} AND toxic > {LEAST}").orderBy(F.desc("z"), "word").limit(8 * CLASS_TERMS)
    found = {bytes(r.word): r.toxic for r in marked.select("word", "toxic").collect()}
    terms = _telling(found)[:CLASS_TERMS]
    plain = counts.where("ordinary > 0 AND endswith(word, X'20')").orderBy(F.desc("ordinary"), "word").limit(BACKGROUND_BYTES)
    frequent = [bytes(r.word) for r in plain.select("word").collect()]
    frequent = [w for w in frequent if not any(w.startswith(t) for t in terms)]
    background = _joined(frequent, BACKGROUND_BYTES)
    size = max(16, sum(len(t.strip()) + 1 for t in terms) + 1)
    return Model(_joined(terms[::-1], size) + background, _joined(frequent, size) + background)


def _telling(found: dict[bytes, int]) -> list[bytes]:
    """The terms without beginnings that say little more than a longer term; the most telling first, as given."""
    longest: dict[bytes, int] = {}
    for term, n in found.items():
        letters = term.decode("utf-8", "ignore")
        for size in range(STEM[0], len(letters)):
            begin = letters[:size].encode()
            longest[begin] = max(longest.get(begin, 0), n)
    return [t for t, n in found.items() if t.endswith(b" ") or n >= STEM_GAIN * longest.get(t, 0)]


class _Windows:
    """Gain and distance of words, remembered by a 64-bit value of the word."""

    def __init__(self, model: Model) -> None:
        self.compress = [self.compressor(d).compress for d in (model.toxic, model.ordinary)]
        self.filler = b" " + model.filler
        self.alone = len(self.compress[0](model.filler))
        self.values, self.known = np.zeros(0, np.uint64), np.zeros((0, 2), np.int16)

    @staticmethod
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            3,
            strategy=zstandard.STRATEGY_BTLAZY2,
            min_match=4,
            hash_log=HASH_LOG,
            chain_log=HASH_LOG,
            source_size=256,
            dict_size=len(content),
            write_content_size=False,
            write_dict_id=False,
            write_checksum=False,
        )
        return zstandard.ZstdCompressor(dict_data=kept, compression_params=settings)

    def length(self, window: bytes) -> tuple[int, int]:
        """Gain and distance of a window."""
        window = b" " + window.lower() + self.filler
        size = len(self.compress[0](window))
        return len(self.compress[1](window)) - size, size - self.alone

    def wider(self, data: np.ndarray, found: Words, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, gain) of the wider window about each word that gains, within its text."""
        at = np.flatnonzero(gain >= SUSPECT)
        row = np.searchsorted(found.first, at, "right") - 1
        lo, hi = np.maximum(at - SIDE_WORDS, found.first[row]), np.minimum(at + SIDE_WORDS + 1, found.first[row + 1])
        out = np.zeros(len(at), np.int64)
        for k, (a, b) in enumerate(zip(lo, hi)):
            out[k] = self.length(b" ".join(data[found.starts[i] : found.ends[i]].tobytes() for i in range(a, b)))[0]
        return at, out

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        values, first, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        row = np.minimum(np.searchsorted(self.values, values), max(0, len(self.values) - 1))
        seen = self.values[row] == values if len(self.values) else np.zeros(len(values), bool)
        out = np.zeros((len(values), 2), np.int16)
        out[seen] = self.known[row[seen]]
        new = np.flatnonzero(~seen)
        for k in new:
            i = first[k]
            out[k] = self.length(data[starts[i] : ends[i]].tobytes())
        if len(self.values) + len(new) > REMEMBERED:
            self.values, self.known = self.values[::2], self.known[::2]
        self.values = np.concatenate([self.values, values[new]])
        order = np.argsort(self.values)[:REMEMBERED]
        self.known = np.concatenate([self.known, out[new]])[order]
        self.values = self.values[order]
        return out[which]


FEATURES = 39


def _features(words: np.ndarray, wider: tuple[np.ndarray, np.ndarray], first: np.ndarray) -> np.ndarray:
    """Per row of a slice: words at several thresholds of gain, also by distance, and wider windows by gain, as amounts and as
    shares."""
    n = np.diff(first)
    gain, distance = words[:, 0], words[:, 1]

    def count(at: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(at, first)).astype(np.float64)

    counts = [count(np.flatnonzero(gain >= k)) for k in range(1, 6)]
    counts += [count(np.flatnonzero((gain >= k) & (distance <= m))) for k in (2, 3) for m in (3, 4, 5, 6)]
    counts += [count(wider[0][wider[1] >= k]) for k in (2, 3, 4, 5, 6, 8)]
    return np.column_stack([*map(np.log1p, counts), *(c / np.sqrt(n + 20) for c in counts), np.log(n + 20)])


def _feature_rows(texts: pa.Array, windows: _Windows) -> np.ndarray:
    rows = []
    for part in slices(texts):
        found = _pieces(part)
        words = windows(part.data, found.starts, found.ends)
        rows.append(_features(words, windows.wider(part.data, found, words[:, 0]), found.first))
    return np.concatenate(rows) if rows else np.zeros((0, FEATURES))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Dictionaries and calibration from labelled documents outside the held-out fold; None if a class is missing.

    A labelled id counts once, however often it repeats, with the least of its texts and the largest of its labels; null ids and
    labels are left out, a null text is empty.  Texts of any length count whole.  Other columns play no part.
    """
    known = training_labels(labels, label, sample_rows, doc_id)
    sample = docs.where(~held_out(doc_id)).select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    # One row per labelled id, however often the id repeats.
    sample = sample.join(F.broadcast(known), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    sample = stage(sample.select("y", "text"), "labelled")
    model = _dictionaries(sample)
    if model is None:
        return None
    shared = share(docs.sparkSession.sparkContext, model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(load(shared))
        for batch in batches:
            x = _feature_rows(batch.column(1), windows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

    table = sample.mapInArrow(features, "y int, x array<double>").toArrow()  # the bounded sample: FEATURES numbers a row
    x = np.array(table.column("x").to_pylist(), np.float64).reshape(table.num_rows, -1)
    model.weights = logistic(x, table.column("y").to_numpy().astype(np.float64))
    return model


def toxicity(docs: DataFrame, text: Column | str, model: Model | None) -> Column:
    """Probability that a text is toxic, 0 to 1; a null text counts as empty.  Without a model every score is 0.

    A score follows from the text alone: repeated rows score alike, and no other column counts, whatever its name.
    """
    if model is None:
        return F.lit(0.0)
    shared = share(docs.sparkSession.sparkContext, model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load(shared)
        windows, weights = _Windows(model), model.weights
        for texts in batches:
            x = _feature_rows(texts, windows)
            yield pa.array(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))), pa.float64())

    return score(text)
