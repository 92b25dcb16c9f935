"""Periodic runs of words, found by tiles scaled to the period.

A run is a longest stretch of words with a smallest period q (words q apart are equal) that repeats often enough.  Where it has
period q, word m equals word m + q: an interval of matching places.  Periods are taken by octaves: [1, 16), [16, 32), [32, 64) ...
An octave that begins with B (8 for the first) is sought over aligned blocks of B words.  A stretch of three periods always holds
a whole block that recurs q words later, so the blocks' values, held against the values one block further, name every place and
period worth a look.  From the outer boundaries of a chain of recurring blocks, the Z-function (how far the words from the
boundary on, or before it, agree with those q further) gives the exact ends.

Long texts are exploded to overlapping tiles of words per octave; a tile has 8 blocks at least, one block more to the left and
three to the right, so that every boundary is decided inside some tile.  Tiles are dealt over the cluster and solved
independently.  Their interval fragments are shuffled by (document, period) and stitched where they touch.  A text of at most
``LONG_BYTES`` is one tile of every octave: the task that reads it solves it and has nothing to stitch.

Words of one text are numbered exactly.  Sequences of numbers are compared by 64-bit values; with n of them compared in one tile
the chance of any collision is about n * n / 2 ** 65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.hot import hot_keys, spread_join
from meterlake.llm.sharing import bound_batches
from meterlake.llm.text import mix, powers
from meterlake.sources.staging import stage

LONG_BYTES = 1 << 14  # longer texts are cut into tiles that other tasks solve
TILE_WORDS = 2048  # tiles of all octaves below a quarter of this; larger octaves have tiles of 8 blocks
REMEMBERED = 100_000  # long texts of which a task knows that it has dealt their tiles
_FIRST_BLOCK, _FIRST_END = 8, 16
RUN = "struct<start:bigint,period:bigint,length:bigint>"


def _octaves(lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """(first period, block) of the octaves of the periods lo to hi - 1."""
    if lo < _FIRST_END:
        yield 1, _FIRST_BLOCK
        lo = _FIRST_END
    while lo < hi:
        yield lo, lo
        lo *= 2


def _scales(n: int, tile: int) -> Iterator[tuple[int, int, int, int]]:
    """(first period, end of periods, block, step of tiles) for a text of n words."""
    lo, hi = 1, max(_FIRST_END, tile // 4)
    while 3 * lo <= n:
        block = max(_FIRST_BLOCK, hi // 2)
        yield lo, hi, block, max(tile, 8 * block)
        lo, hi = hi, 2 * hi


def _values(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which the value of any stretch follows, and the factor of each place."""
    up, down = powers(len(ids) + 1)
    sums = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * up[: len(ids)], out=sums[1:])
    return sums, down


def _z(sums: np.ndarray, down: np.ndarray, at: np.ndarray, shift: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """Z-function of boundaries: how many words from ``at`` on (or back from it) agree with those ``shift`` further, up to most."""
    low, high = np.zeros(len(at), np.int64), np.maximum(most, 0)
    while (low < high).any():
        size = (low + high + 1) >> 1
        a = at - size if back else at
        b = a + shift
        same = (sums[a + size] - sums[a]) * down[a] == (sums[b + size] - sums[b]) * down[b]
        low, high = np.where(same, size, low), np.where(same, high, size - 1)
    return low


def _solve(ids: np.ndarray, lo: int, hi: int, own: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, begin, end) of the intervals of places that agree with those a period further, from blocks that begin in ``own``.

    An interval goes at most one block beyond its recurring blocks; it is never cut short by that unless more of it follows
    from a neighbouring block.
    """
    n = len(ids)
    sums, down = _values(ids)
    out = [(np.zeros(0, np.int64),) * 3]
    for first, block in _octaves(lo, hi):
        m = n - block + 1
        if m <= first:
            break
        rows = -(-m // block) + 1
        grid = np.zeros(rows * block, np.uint64)
        grid[:m] = (sums[block:] - sums[:m]) * down[:m]
        grid = grid.reshape(rows, block)
        if first == 1:
            shifted = np.concatenate([grid[:-1, 1:], grid[1:]], axis=1)
        else:
            shifted = grid[1:]
        k, q = np.nonzero(shifted == grid[:-1, :1])
        q += first
        real = (k * block + q < m) & (k * block >= own[0]) & (k * block < own[1])
        k, q = k[real], q[real]
        if not len(k):
            continue
        order = np.lexsort((k, q))
        k, q = k[order], q[order]
        fresh = np.append(True, (q[1:] != q[:-1]) | (k[1:] != k[:-1] + 1))
        begin, end = k[fresh] * block, (k[np.append(fresh[1:], True)] + 1) * block
        q = q[fresh]
        begin = begin - _z(sums, down, begin, q, np.minimum(block, begin), True)
        end = end + _z(sums, down, end, q, np.minimum(block, n - end - q), False)
        out.append((q, begin, end))
    return tuple(np.concatenate(c) for c in zip(*out))


def _planted(n: int, seed: int | None) -> np.ndarray | None:
    """The word each place gets from, where the seed plants a repetition."""
    if seed is None or seed % 10 or not n:
        return None
    g = seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    src = np.arange(n)
    src[a:] = a + (src[a:] - a) % p
    return src


def _read(text: bytes | None, seed: int | None) -> tuple[list[bytes], np.ndarray, np.ndarray | None]:
    """Words, their numbers after planting, and where each word came from if something was planted."""
    found = (text or b"").split()  # cuts at the bytes 0x20 and 0x09 to 0x0D
    numbers = {w: i for i, w in enumerate(dict.fromkeys(found))}
    ids = np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))
    src = _planted(len(found), seed)
    return found, ids if src is None else ids[src], src


def _runs(ids: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, period, length) of the runs of a whole text, by start, then period."""
    n = len(ids)
    if n < max(least, times):
        return []
    q, begin, end = _solve(ids, 1, n // times + 1, (0, n))
    end = end + q
    keep = end - begin >= np.maximum(least, times * q)
    q, begin, end = q[keep], begin[keep], end[keep]
    # One stretch found under several periods: the smallest is its period.
    order = np.lexsort((q, end, begin))
    q, begin, end = q[order], begin[order], end[order]
    first = np.append(True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1]))[: len(q)]
    found = zip(begin[first].tolist(), q[first].tolist(), (end - begin)[first].tolist())
    return sorted(found)


def _collapsed(found: list[bytes], src: np.ndarray | None, runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds beyond its first period, joined by one space."""
    if src is None and not runs:
        return b" ".join(found).decode("utf-8")
    places = np.arange(len(found)) if src is None else src
    edge = np.zeros(len(found) + 1, np.int64)
    for start, period, length in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = places[np.cumsum(edge[:-1]) == 0]
    return b" ".join([found[i] for i in kept.tolist()]).decode("utf-8")


_RESULT = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "period", "length")]))), ("collapsed", pa.string())])
_RESULT_DDL = f"struct<n_words:bigint,runs:array<{RUN}>,collapsed:string>"


def _result(rows: list[tuple[int, list[tuple[int, int, int]], str]]) -> pa.Array:
    named = [{"n_words": n, "runs": [{"start": s, "period": q, "length": k} for s, q, k in runs], "collapsed": c} for n, runs, c in rows]
    return pa.array(named, _RESULT)


def _whole(least: int, times: int):
    @F.arrow_udf(_RESULT_DDL)
    def solve(texts: pa.Array, seeds: pa.Array) -> pa.Array:
        rows = []
        for text, seed in zip(texts, seeds):
            found, ids, src = _read(text.as_py(), seed.as_py())
            runs = _runs(ids, least, times)
            rows.append((len(found), runs, _collapsed(found, src, runs)))
        return _result(rows)

    return solve


def _finished():
    @F.arrow_udf(_RESULT_DDL)
    def finish(texts: pa.Array, seeds: pa.Array, stitched: pa.Array) -> pa.Array:
        rows = []
        for text, seed, runs in zip(texts, seeds, stitched):
            found, _, src = _read(text.as_py(), seed.as_py())
            runs = [(r["start"], r["period"], r["length"]) for r in runs.as_py() or []]
            rows.append((len(found), runs, _collapsed(found, src, runs)))
        return _result(rows)

    return finish


_TILES = "key bigint, lo bigint, hi bigint, at bigint, own bigint, step bigint, words binary"


def _deal(tile: int):
    """text, seed, key -> the tiles of every text, and a row without tile for each text (to count copies)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for text, seed, key in zip(*batch.columns):
                key = key.as_py()
                yield packed([(key, None, None, None, None, None, None)])
                if key in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                _, ids, _ = _read(text.as_py(), seed.as_py())
                ids = ids.astype(np.int32)
                for lo, hi, block, step in _scales(len(ids), tile):
                    for own in range(0, len(ids), step):
                        at = max(0, own - block)
                        yield packed([(key, lo, hi, at, own, step, ids[at : own + step + 3 * block].tobytes())])

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 6 + [pa.binary()]
        names = ["key", "lo", "hi", "at", "own", "step", "words"]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

    return deal


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles -> (key, period, begin, end) in places of the whole text."""
    for batch in batches:
        for key, lo, hi, at, own, step, held in zip(*batch.columns):
            at, begins = at.as_py(), own.as_py() - at.as_py()
            ids = np.frombuffer(held.as_py(), np.int32)
            q, begin, end = _solve(ids, lo.as_py(), hi.as_py(), (begins, begins + step.as_py()))
            if len(q):
                keys = np.full(len(q), key.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (keys, q, begin + at, end + at)], ["key", "q", "begin", "end"])


def stitched_runs(tiles: DataFrame, least: int, times: int) -> DataFrame:
    """key, runs of the texts whose tiles are given: fragments of one period that touch are one interval."""
    tiles = tiles.where("words IS NOT NULL")
    tiles = tiles.repartition("key", "lo", "own")
    fragments = tiles.mapInArrow(_solve_tiles, "key bigint, q bigint, begin bigint, end bigint").distinct()
    by_place = Window.partitionBy("key", "q").orderBy("begin", "end")
    reached = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    fragments = fragments.withColumn("fresh", F.when(F.col("begin") <= reached, 0).otherwise(1))
    fragments = fragments.withColumn("interval", F.sum("fresh").over(by_place))
    whole = fragments.groupBy("key", "q", "interval").agg(F.min("begin").alias("start"), (F.max("end") + F.col("q")).alias("stop"))
    long_enough = whole.where(F.expr(f"stop - start >= greatest({least}, {times} * q)"))
    # One stretch found under several periods: the smallest is its period.
    runs = long_enough.groupBy("key", "start", "stop").agg(F.min("q").alias("period"))
    run = F.struct("start", "period", (F.col("stop") - F.col("start")).alias("length"))
    return runs.groupBy("key").agg(F.sort_array(F.collect_list(run)).alias("runs"))


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    least: int = 24,
    times: int = 3,
    seed: Column | None = None,
    long_bytes: int = LONG_BYTES,
    tile: int = TILE_WORDS,
) -> DataFrame:
    """row (a struct of the columns ``keep``), n_words, runs, collapsed: one row per document.

    Words are cut at the characters U+0020 and U+0009 to U+000D; case counts.  A run (start, period, length in words) has a
    smallest period q, length >= max(least, times * q), and cannot be extended by a word on either side; runs come by start,
    then period.  collapsed joins by one space the words that no run holds beyond its first q.  times: 3 or more; least: 24 or more.

    seed plants repetitions for trials: where it is not null and divisible by 10, words from place (seed / 10) % n on repeat
    with a period derived from it.  A null, empty or blank text has no words, no runs and an empty collapsed text.  Repeated
    rows are kept, one row each.  Runs of equal stretch cannot tie: the smallest period is the run's.  Ids play no part, so they
    may be null or repeat; as ``keep`` goes into a struct, no column name can clash.  Long texts are solved in tiles of ``tile``
    words (a power of two, 64 or more), alike whatever the tile.
    """
    if least < 24 or times < 3:
        raise ValueError("least must be 24 or more, times 3 or more")
    bound_batches(docs.sparkSession)
    seed = F.lit(None) if seed is None else seed
    rows = docs.select(
        F.struct(*(F.col(c) for c in keep)).alias("row"), F.col(text).cast("binary").alias("text"), seed.cast("bigint").alias("seed")
    )
    is_long = F.coalesce(F.octet_length("text") > long_bytes, F.lit(False))
    short = rows.where(~is_long).select("row", _whole(least, times)("text", "seed").alias("r"))
    long = rows.where(is_long).withColumn("key", F.xxhash64("seed", "text"))
    tiles = stage(long.select("text", "seed", "key").mapInArrow(_deal(tile), _TILES), "tiles")
    runs = stage(stitched_runs(tiles, least, times), "runs")
    hot = stage(hot_keys(tiles.where("words IS NULL").select("key")), "hot-keys")
    long = spread_join(long, runs, "key", hot)
    long = long.select("row", _finished()("text", "seed", "runs").alias("r"))
    return short.unionByName(long).select("row", "r.n_words", "r.runs", "r.collapsed")
