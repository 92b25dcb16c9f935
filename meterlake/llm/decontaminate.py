"""Benchmark decontamination as a prefix-filtered set join.

Every item gives windows of ``window`` consecutive words.  A window has to be contained whole, so its necessary prefix is one
token: of its shingles of three words, ordered by rarity over all documents, the rarest.  Documents are scanned for these
tokens only; the place of a token in its window bounds where the window may begin and end in the document, and what is left
is verified word by word.

The benchmark is taken in blocks of a bounded number of windows, one broadcast at a time.  With one block, documents are not
shuffled; with several, what each finds is written and joined to the documents by a 64-bit value of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.hot import hot_keys, spread_join
from meterlake.llm.sharing import bound_batches, load, share
from meterlake.llm.text import LETTER_DIGIT, rolling, slices, word_hashes, words
from meterlake.sources.staging import stage

SHINGLE = 3
BLOCK_WINDOWS = 200_000  # windows broadcast at once: at most 100 bytes each
STEP_CANDIDATES = 200_000  # places a window may begin at that are verified together
_SIEVE_BITS = 20


def _windows(window: int):
    """item_id, text -> item_id, window (64-bit values of its words); a shorter item is one window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for part in slices(batch.column(1)):
                found = words(part, LETTER_DIGIT)
                hashes = word_hashes(part.data, found.starts, found.ends).view(np.int64)
                owner, out = [], []
                for i in range(len(part)):
                    own = hashes[found.first[i] : found.first[i + 1]]
                    for k in range(max(1, len(own) - window + 1) if len(own) else 0):
                        owner.append(part.first + i)
                        out.append(own[k : k + window])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(owner, pa.int64())), pa.array(out, pa.list_(pa.int64()))], ["item", "window"])

    return cut


@dataclass
class _Block:
    """Windows as rows of a matrix (padded with 0), their length and their item."""

    rows: np.ndarray
    length: np.ndarray
    item: np.ndarray
    items: list[str | None]

    def tokens(self) -> dict[int, np.ndarray]:
        """Shingle length -> matrix of the shingle values of the windows that use it (0 rows elsewhere)."""
        out = {}
        for k in range(1, SHINGLE + 1):
            mine = self.length >= k if k == SHINGLE else self.length == k
            if mine.any():
                runs = [rolling(row[:n], k) for row, n in zip(self.rows[mine], self.length[mine])]
                out[k] = mine, np.stack([np.concatenate([x, np.zeros(self.rows.shape[1] - len(x), np.uint64)]) for x in runs])
        return out


def _blocks(windows: DataFrame, width: int) -> Iterator[_Block]:
    total = windows.count()
    parts = max(1, -(-total * 5 // (4 * BLOCK_WINDOWS)))
    for b in range(parts):
        table = windows.where(F.pmod(F.xxhash64("item", "window"), F.lit(parts)) == b).toArrow()
        if not table.num_rows:
            continue
        lists = table.column("window").to_pylist()
        rows = np.zeros((len(lists), width), np.uint64)
        for i, values in enumerate(lists):
            rows[i, : len(values)] = np.array(values, np.int64).view(np.uint64)
        items = sorted(set(table.column("item").drop_null().to_pylist())) + [None] * (table.column("item").null_count > 0)
        where = {x: i for i, x in enumerate(items)}
        yield _Block(rows, np.array([len(x) for x in lists]), np.array([where[x] for x in table.column("item").to_pylist()]), items)


class _Lookup:
    """Membership and row of 64-bit values in a sorted table, behind a sieve of one byte per slot."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.unique(values)
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self.values >> np.uint64(64 - _SIEVE_BITS)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the values that are in the table, and their rows."""
        place = np.flatnonzero(self.sieve[values >> np.uint64(64 - _SIEVE_BITS)])
        if not len(self.values) or not len(place):
            return place[:0], place[:0]
        row = np.searchsorted(self.values, values[place])
        row[row == len(self.values)] = 0
        same = self.values[row] == values[place]
        return place[same], row[same]


def _inside(found, places: np.ndarray, k: int) -> np.ndarray:
    """Whether runs of k words beginning at these words stay in their row."""
    row = np.searchsorted(found.first, places, "right") - 1
    return places + k <= found.first[row + 1]


def _count_tokens(lookups: dict[int, _Lookup]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros(len(v.values), np.int64) for k, v in lookups.items()}
        for batch in batches:
            for part in slices(batch.column(0)):
                found = words(part, LETTER_DIGIT)
                hashes = word_hashes(part.data, found.starts, found.ends)
                for k, lookup in lookups.items():
                    place, row = lookup.find(rolling(hashes, k))
                    row = row[_inside(found, place, k)]
                    totals[k] += np.bincount(row, minlength=len(lookup.values))
        for k, n in totals.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), k, np.int32)), pa.array(lookups[k].values[some].view(np.int64)), pa.array(n[some])],
                ["k", "token", "n"],
            )

    return count


def _by_rarity(block: _Block, docs: DataFrame, text: str) -> dict[int, tuple]:
    """Shingle length -> (lookup, order, bounds, place): windows by the rarest of their shingles that the documents have.

    A window none of whose shingles, or not all of them, occurs anywhere is in no document and gets no entry.
    """
    tokens = block.tokens()
    lookups = {k: _Lookup(values[values != 0]) for k, (_, values) in tokens.items()}
    counted = docs.select(text).mapInArrow(_count_tokens(lookups), "k int, token bigint, n bigint")
    counted = counted.groupBy("k", "token").agg(F.sum("n").alias("n")).toArrow()  # at most one row per shingle of the block
    found = {k: np.zeros(len(v.values), np.int64) for k, v in lookups.items()}
    for k, token, n in zip(*(counted.column(c).to_pylist() for c in ("k", "token", "n"))):
        found[k][np.searchsorted(lookups[k].values, np.array([token], np.int64).view(np.uint64)[0])] = n
    out = {}
    for k, (mine, values) in tokens.items():
        n = found[k][np.searchsorted(lookups[k].values, np.where(values == 0, lookups[k].values[0], values))]
        n = np.where(values == 0, np.iinfo(np.int64).max, n)
        place = n.argmin(axis=1)
        at = np.arange(len(place))
        there = np.flatnonzero(n[at, place] > 0)
        if len(there):
            key = values[at, place][there]
            order = np.argsort(key, kind="stable")
            lookup = _Lookup(key)
            bounds = np.searchsorted(key[order], np.concatenate([lookup.values, lookup.values[-1:]]))
            bounds[-1] = len(order)
            out[k] = lookup, np.flatnonzero(mine)[there][order], bounds, place[there][order]
    return out


def _steps(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts [lo, hi) of a list of sizes whose sums stay within STEP_CANDIDATES, or that hold one element."""
    upto = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        before = int(upto[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, before + STEP_CANDIDATES, "right")))
        yield lo, hi
        lo = hi


def _scan(shared):
    """Per text: number of words, hit words as flat [start, end) pairs, items found."""

    @F.arrow_udf("struct<n_words:bigint,hits:array<bigint>,items:array<string>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block, index = load(shared)
        for texts in batches:
            n_words, hits, items = [], [], []
            for part in slices(texts):
                found = words(part, LETTER_DIGIT)
                hashes = word_hashes(part.data, found.starts, found.ends)
                marks = np.zeros(len(hashes) + 1, np.int32)
                pairs = []
                for k, (lookup, order, bounds, place) in index.items():
                    at, row = lookup.find(rolling(hashes, k))
                    # One candidate for each window under the token, by steps of a bounded number of candidates.
                    for lo, hi in _steps(bounds[row + 1] - bounds[row]):
                        first = bounds[row[lo:hi]]
                        each = bounds[row[lo:hi] + 1] - first
                        at_each = np.repeat(at[lo:hi], each)
                        nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                        entry = np.repeat(first, each) + nth
                        window, begin = order[entry], at_each - place[entry]
                        fits = begin >= 0
                        owner = np.searchsorted(found.first, at_each, "right") - 1
                        fits &= begin >= found.first[owner]
                        fits &= begin + block.length[window] <= found.first[owner + 1]
                        window, begin, owner = window[fits], begin[fits], owner[fits]
                        for j in range(block.rows.shape[1]):
                            last = block.length[window] <= j
                            same = last | (hashes[np.minimum(begin + j, len(hashes) - 1)] == block.rows[window, j])
                            window, begin, owner = window[same], begin[same], owner[same]
                        np.add.at(marks, begin, 1)
                        np.add.at(marks, begin + block.length[window], -1)
                        pairs.append(np.unique(owner.astype(np.int64) * len(block.items) + block.item[window]))
                hit = np.cumsum(marks[:-1]) > 0
                n_words += np.diff(found.first).tolist()
                pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
                cut = np.searchsorted(pairs, np.arange(len(part) + 1) * len(block.items))
                for i in range(len(part)):
                    own = hit[found.first[i] : found.first[i + 1]]
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]]))) if cut[i + 1] > cut[i] else []
                    hits.append(list(map(int, edges)))
                    known = (block.items[x % len(block.items)] for x in pairs[cut[i] : cut[i + 1]])
                    items.append([x for x in known if x is not None])
            yield pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                ["n_words", "hits", "items"],
            )

    return scan


def _merged(spans: Column | str) -> Column:
    """Union of spans given as flat [start, end) pairs."""

    @F.arrow_udf("array<bigint>")
    def union(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for each in batches:
            out = []
            for flat in each.to_pylist():
                joined: list[int] = []
                for start, end in sorted(zip(flat[::2], flat[1::2])):
                    if joined and start <= joined[-1]:
                        joined[-1] = max(joined[-1], end)
                    else:
                        joined += [start, end]
                out.append(joined)
            yield pa.array(out, pa.list_(pa.int64()))

    return union(spans)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    without_id: bool = False,
) -> DataFrame:
    """All columns of docs and a struct ``leak``: n_words, hits (flat [start, end) word spans), items (ids found, as strings).

    A window is ``window`` consecutive words of an item (the whole item, if it has fewer but some); a word inside an occurrence
    of a window is hit.  Items without text take no part, nor do those without id, unless ``without_id``: then their windows are
    hit like any other, and only ``items`` leaves them out.  Repeated items count once.  Null texts have no words.  Repeated
    documents are kept; a column of docs named leak is replaced.
    """
    bound_batches(docs.sparkSession)
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    items = items.dropna(subset=["text"] if without_id else ["item", "text"])
    items = items.mapInArrow(_windows(window), "item string, window array<bigint>").distinct()
    context, windows = docs.sparkSession.sparkContext, stage(items, "windows")
    keep = [c for c in docs.columns if c != "leak"]
    if windows.count() * 5 <= 4 * BLOCK_WINDOWS:
        nothing = _Block(np.zeros((0, window), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), [""])
        block = next(_blocks(windows, window), nothing)
        index = _by_rarity(block, docs, text) if len(block.rows) else {}
        return docs.select(*keep, _scan(share(context, (block, index)))(text).alias("leak"))
    # What is found depends on the text alone.  Of each block the texts with hits are written, then its broadcast goes.
    found = None
    for block in _blocks(windows, window):
        shared = share(context, (block, _by_rarity(block, docs, text)))
        hit = docs.select(F.xxhash64(text).alias("key"), _scan(shared)(text).alias("leak")).where("size(leak.hits) > 0")
        hit = stage(hit.select("key", "leak.hits", "leak.items").distinct(), "hits")
        shared.unpersist()
        found = hit if found is None else found.unionByName(hit)
    found = found.groupBy("key").agg(F.flatten(F.collect_list("hits")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    found = stage(found.select("key", _merged("spans").alias("hits"), "items"), "merged-hits")
    keyed = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    out = spread_join(keyed, found, "key", stage(hot_keys(keyed.select("key")), "hot"))
    none = _Block(np.zeros((0, window), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), [""])
    out = out.withColumn("n_words", _scan(share(context, (none, {})))("text")["n_words"])
    hits, items = F.coalesce("hits", F.lit([]).cast("array<bigint>")), F.coalesce("items", F.lit([]).cast("array<string>"))
    return out.select("row.*", F.struct("n_words", hits.alias("hits"), items.alias("items")).alias("leak"))


def n_hit(leak: str = "leak") -> Column:
    """Number of hit words of a ``leak`` struct."""
    return F.expr(f"CAST(aggregate({leak}.hits, 0L, (s, x) -> x - s) AS BIGINT)")
