"""Near duplicates by SuperMinHash signatures, banding, verification on whole sets, and union-find grouping.

1. *Signatures.*  Every shingle walks through all components of the signature in a random order of its own; what it offers to the
   j-th component it meets is j plus a random fraction.  A component keeps its least offer.  As the places of one shingle are a
   permutation and not independent draws, the share of agreeing components varies less about the Jaccard similarity than that of
   a MinHash of the same length.  All shingles of a text take their j-th step together, and the text is done as soon as every
   component holds an offer below j + 1: about (components / shingles) * log(components) steps.
2. *Banding.*  Documents of one set are one class.  Classes that agree on all components of a band meet in its bucket.  With 32
   bands of 4, a pair at a similarity of 0.8 meets nowhere once in (1 - 0.8 ** 4) ** -32, 2e7, pairs; more similar ones far less.
3. *Verification.*  Pairs whose signatures agree in half of their components or more are compared on their whole sets.  (Of a pair
   at 0.8 fewer agree once in 1e14.)  A bucket first holds all its members against its most central one, its center; what is then still in
   different components is compared exhaustively: under each center, all but the largest component against everything there,
   in blocks that are matrix products of whole sets.  The work grows with the square only of families of near misses.
4. *Grouping.*  Tasks reduce the links they hold to spanning trees by union-find; trees of all tasks are put together by star
   contraction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.components import components
from meterlake.llm.hot import HOT_KEYS, HOT_ROWS, hot_keys, spread_join
from meterlake.llm.sharing import bound_batches
from meterlake.llm.text import mix, shingle_sets
from meterlake.sources.staging import stage

BANDS, ROWS = 32, 4
COMPONENTS = BANDS * ROWS
AGREEING = COMPONENTS // 2
HELD_SHINGLES = 1 << 16  # shingles whose signatures are made together; also shingles sent on together
REMEMBERED = 200_000  # classes a task knows it has sent a text of
TREE_LINKS = 200_000  # links a task puts together at once
BLOCK_SHINGLES = 400_000  # shingles on each side of a block of the exhaustive comparison, about
BLOCK_ROWS, BLOCK_COLUMNS = 512, 1024  # a block's matrices
SPARSE = 200  # a shingle of less than one in so many pairs of a block's rows is counted pair by pair
PAIRS_AT_ONCE = 2_000_000
_STEP = 0x9E3779B97F4A7C15


def _value(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(sets: list[np.ndarray], m: int = COMPONENTS) -> np.ndarray:
    """One row of m 16-bit components for each set of 64-bit values; sets are not empty."""
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    offers = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(items), 1))
    for j in range(m):
        drawn = mix(items + np.uint64((j + 1) * _STEP % (1 << 64)))
        k = j + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(items))
        place = order[rows, k]
        order[rows, k] = order[:, j]  # the places from j + 1 on stay a permutation of those not met yet
        offer = (np.uint64(j) << np.uint64(32)) | (drawn >> np.uint64(32))
        np.minimum.at(offers.reshape(-1), owner * m + place, offer)
        open_ = offers.max(axis=1) >= np.uint64(j + 1) << np.uint64(32)
        going = open_[owner]
        if not going.any():
            break
        if 2 * going.sum() < len(items):
            items, owner, order = items[going], owner[going], order[going]
    return (mix(offers) & np.uint64(0xFFFF)).astype(np.uint16)


_SUMMARY = pa.struct([("n", pa.int64()), ("ref", pa.int64()), ("signature", pa.binary())])


def summary(text: Column | str, words: int) -> Column:
    """struct<n: number of distinct shingles, ref: value of the set, signature>; the last two null for an empty set."""

    @F.arrow_udf("struct<n:bigint,ref:bigint,signature:binary>")
    def summarise(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows: list[dict] = []
            held: list[tuple[dict, np.ndarray]] = []
            size = 0
            for _, shingles in shingle_sets(texts, words):
                row = {"n": len(shingles), "ref": None, "signature": None}
                rows.append(row)
                if len(shingles):
                    row["ref"] = _value(shingles)
                    held.append((row, shingles))
                    size += len(shingles)
                if size >= HELD_SHINGLES:
                    signed(held)
                    held, size = [], 0
            signed(held)
            yield pa.array(rows, _SUMMARY)

    def signed(held: list[tuple[dict, np.ndarray]]) -> None:
        if held:
            for (row, _), s in zip(held, signatures([s for _, s in held])):
                row["signature"] = s.tobytes()

    return summarise(text)


def _one_text(words: int):
    """text -> ref, text: one text of each class a task meets (a task that forgets may send one more)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows, refs = [], []
            for row, shingles in shingle_sets(batch.column(0), words):
                if len(shingles) and (ref := _value(shingles)) not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(ref)
                    rows.append(row)
                    refs.append(ref)
            if rows:
                texts = batch.column(0).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(refs, pa.int64()), texts], ["ref", "text"])

    return send


def _whole_sets(words: int):
    """ref, text -> ref, n, shingles"""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, size = 0, [], 0
            for row, shingles in shingle_sets(batch.column(1), words):
                held.append(shingles)
                size += len(shingles)
                if row + 1 == batch.num_rows or size >= HELD_SHINGLES:
                    sizes = [len(s) for s in held]
                    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(np.concatenate(held).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(held)), pa.array(sizes, pa.int64()), lists], ["ref", "n", "shingles"])
                    first, held, size = row + 1, [], 0

    return whole


def agreeing(a: Column | str, b: Column | str) -> Column:
    """Number of components in which two signatures agree."""

    @F.arrow_udf("int")
    def count(left: pa.Array, right: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(s.to_pylist()), np.uint16).reshape(len(s), -1) for s in (left, right))
        return pa.array((x == y).sum(axis=1), pa.int32())

    return count(a, b)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) -> links (node, root) that connect the same nodes, one for each node that is no root."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    def planted() -> pa.RecordBatch:
        found = [(x, root(x)) for x in list(parent)]
        found = [(x, r) for x, r in found if x != r]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 2, ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= TREE_LINKS:
            yield planted()
    yield planted()


def grouped(links: DataFrame) -> DataFrame:
    """node, component of every node of the links (a, b): trees by union-find in the tasks, contracted over all tasks."""
    return components(links.select("a", "b").mapInArrow(_trees, "a bigint, b bigint"))


def _linked(common: str, a: str, b: str, percent: int) -> Column:
    return F.expr(f"(100 + {percent}) * ({common}) >= {percent} * ({a} + {b})")


class _Join:
    """The classes of one corpus, and what is compared among them."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> None:
        self.docs, self.classes, self.words, self.percent = docs, classes, words, percent

    def stars(self) -> DataFrame:
        """center, ref, n: the most central class of every bucket that several classes meet in, with all classes of its buckets.

        Central is who has most company over all its buckets.  Two classes that meet in a bucket stand under its center both.
        """
        slices = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * 2 * ROWS + 1, F.lit(2 * ROWS))))
        entries = self.classes.select("ref", "n", F.explode(slices).alias("key"))
        sizes = stage(entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
        most = max(HOT_ROWS, (sizes.agg(F.sum("size")).first()[0] or 0) // HOT_KEYS)
        hot = sizes.where(F.col("size") > most).select("key", F.ceil(F.col("size") / most).cast("int").alias("salts"))
        entries = stage(spread_join(entries, sizes, "key", hot, "inner"), "entries")
        company = entries.groupBy("ref").agg(F.sum("size").alias("company"))
        told = entries.select("key", "ref").join(company, "ref")
        central = told.groupBy("key").agg(F.max_by("ref", F.struct("company", "ref")).alias("center"))
        return stage(spread_join(entries, central, "key", hot, "inner").select("center", "ref", "n").distinct(), "stars")

    def alike(self, pairs: DataFrame) -> DataFrame:
        """a, b, agree of the pairs (a, b) whose sizes and signatures allow a link."""
        a = self.classes.select(F.col("ref").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
        b = self.classes.select(F.col("ref").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
        both = spread_join(pairs.join(a, "a"), b, "b", stage(hot_keys(pairs.select("b")), "hot"), "inner")
        both = both.where(_linked("least(na, nb)", "na", "nb", self.percent))
        return stage(both.select("a", "b", agreeing("sa", "sb").alias("agree")).where(F.col("agree") >= AGREEING), "alike")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """ref, n, shingles: the whole sets of the wanted classes (ref); one text of each class and task is shuffled."""
        texts = self.docs.select("text").mapInArrow(_one_text(self.words), "ref bigint, text string")
        texts = texts.join(wanted.hint("shuffle_hash"), "ref", "left_semi")
        return stage(texts.mapInArrow(_whole_sets(self.words), "ref bigint, n bigint, shingles array<bigint>").dropDuplicates(["ref"]), "sets")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole sets overlap enough."""
        a = sets.select(F.col("ref").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
        b = sets.select(F.col("ref").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
        hot = stage(hot_keys(pairs.select("b")), "hot")
        both = spread_join(pairs.select("a", "b").join(a, "a"), b, "b", hot, "inner")
        return stage(both.where(_linked("size(array_intersect(sa, sb))", "na", "nb", self.percent)).select("a", "b"), "links")

    def rest(self, stars: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
        """Links between different components under one center: all but its largest component against everything there.

        Blocks of the one meet blocks of the other, each a matrix product of whole sets, so no pair is ever a row.
        """
        label = grouped(found).select(F.col("node").alias("ref"), "component")
        placed = stage(stars.join(label, "ref", "left").withColumn("comp", F.coalesce("component", "ref")).drop("component"), "placed")
        per = placed.groupBy("center", "comp").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
        mixed = per.groupBy("center").agg(
            F.count(F.lit(1)).alias("comps"), F.max_by(F.struct("comp", "n"), F.struct("k", "comp")).alias("major"), F.sum("n").alias("n")
        )
        blocks = F.ceil((F.col("n") - F.col("major.n")) / BLOCK_SHINGLES).cast("int"), F.ceil(F.col("n") / BLOCK_SHINGLES).cast("int")
        mixed = mixed.where("comps > 1").select("center", F.col("major.comp").alias("major"), blocks[0].alias("rows"), blocks[1].alias("columns"))
        hot = stage(hot_keys(placed.select("center")), "hot")
        units = stage(spread_join(placed.drop("n"), stage(mixed, "mixed"), "center", hot, "inner"), "units")
        units = spread_join(units, sets, "ref", stage(hot_keys(units.select("ref")), "hot"), "inner")
        row, column = F.expr("pmod(xxhash64(ref), rows)").cast("int"), F.expr("pmod(xxhash64(ref), columns)").cast("int")
        sought = units.where("comp <> major").withColumn("i", row).withColumn("j", F.explode(F.expr("sequence(0, columns - 1)")))
        against = units.withColumn("j", column).withColumn("i", F.explode(F.expr("sequence(0, rows - 1)")))
        columns = ["center", "i", "j", "ref", "comp", "n", "shingles"]
        dealt = sought.select(*columns, F.lit(True).alias("sought")).unionByName(against.select(*columns, F.lit(False).alias("sought")))
        links = dealt.groupBy("center", "i", "j").applyInArrow(_block_links(self.percent), "a bigint, b bigint")
        return stage(links.distinct(), "links")


def _block_links(percent: int):
    """The links between the sought rows of a block and its other rows, of different components."""

    def links(table: pa.Table) -> pa.Table:
        sought = table.column("sought").to_numpy()
        refs, comps, sizes = (table.column(c).to_numpy() for c in ("ref", "comp", "n"))
        sets = table.column("shingles").combine_chunks()
        flat = sets.flatten().to_numpy()
        owner = np.repeat(np.arange(len(refs)), np.diff(sets.offsets.to_numpy()))
        # Only shingles on both sides can be common; who has too few of them has no link.  Dropping rows drops shingles in turn.
        while True:
            left = np.isin(flat, np.intersect1d(flat[sought[owner]], flat[~sought[owner]]))
            flat, owner = flat[left], owner[left]
            held = np.bincount(owner, minlength=len(refs))
            left = (100 * held >= percent * sizes)[owner]
            if left.all():
                break
            flat, owner = flat[left], owner[left]
        if not len(flat):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        a, b = np.unique(owner[sought[owner]]), np.unique(owner[~sought[owner]])
        at = np.zeros(len(refs), np.int64)
        at[a], at[b] = np.arange(len(a)), np.arange(len(b))
        both, place = np.unique(flat, return_inverse=True)
        mine = sought[owner]
        pairs = np.bincount(place[mine], minlength=len(both)) * np.bincount(place[~mine], minlength=len(both))
        out: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        for lo in range(0, len(a), BLOCK_ROWS):
            some = a[lo : lo + BLOCK_ROWS]
            common = np.zeros((len(some), len(b)), np.float32)
            here = ~mine | ((at[owner] >= lo) & (at[owner] < lo + BLOCK_ROWS))
            dense = pairs >= len(a) * len(b) / SPARSE
            _multiply(common, at[owner[here]] - np.where(mine[here], lo, 0), place[here], mine[here], dense)
            enough = (100 + percent) * common.astype(np.int64) >= percent * (sizes[some][:, None] + sizes[b][None, :])
            i, j = np.nonzero(enough & (comps[some][:, None] != comps[b][None, :]))
            out.append(np.column_stack([refs[some[i]], refs[b[j]]]))
        found = np.concatenate(out)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return links


def _multiply(common: np.ndarray, row: np.ndarray, place: np.ndarray, mine: np.ndarray, dense: np.ndarray) -> None:
    """Add to common[i, j] the number of places that row i of one side and row j of the other hold: places that many rows hold
    as matrix products, the others pair by pair."""
    order = np.argsort(place, kind="stable")
    row, place, mine = row[order], place[order], mine[order]
    columns = np.flatnonzero(dense)
    for first in range(0, len(columns), BLOCK_COLUMNS):
        some = columns[first : first + BLOCK_COLUMNS]
        index = np.full(len(dense), -1)
        index[some] = np.arange(len(some))
        here = index[place] >= 0
        x, y = (np.zeros((n, len(some)), np.float32) for n in common.shape)
        x[row[here & mine], index[place[here & mine]]] = 1
        y[row[here & ~mine], index[place[here & ~mine]]] = 1
        common += x @ y.T
    thin = ~dense[place]
    row, place, mine = row[thin], place[thin], mine[thin]
    i, at_i, j, at_j = row[mine], place[mine], row[~mine], place[~mine]
    begin, end = np.searchsorted(at_j, at_i), np.searchsorted(at_j, at_i, "right")
    upto = np.cumsum(end - begin)
    lo = 0
    while lo < len(i):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS_AT_ONCE, "right")))
        n = (end - begin)[lo:hi]
        which = np.repeat(begin[lo:hi] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        flat = np.repeat(i[lo:hi], n) * common.shape[1] + j[which]
        np.add.at(common.reshape(-1), flat, np.float32(1))
        lo = hi


def _links(join: _Join) -> DataFrame:
    """Links (a, b) between classes that connect what all links connect."""
    stars = join.stars()
    # First every class against the center it agrees with most, then against the centers that are still apart from it.
    starred = join.alike(stars.where("ref <> center").select(F.col("ref").alias("a"), F.col("center").alias("b")))
    sets = join.sets(stars.select("ref").distinct())
    best = starred.groupBy("a").agg(F.max_by("b", F.struct("agree", "b")).alias("b"))
    found = join.verified(best, sets)
    label = stage(grouped(found), "labels")
    apart = starred.join(best, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        apart = apart.join(label.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
    apart = apart.where("coalesce(ca, a) <> coalesce(cb, b)")
    found = stage(found.unionByName(join.verified(stage(apart.select("a", "b"), "apart"), sets)), "links")
    # Then whatever stands under one center in different components.
    return found.unionByName(join.rest(stars, sets, found))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, ref, component, component_id: one row per document.

    Words are cut at the characters U+0020 and U+0009 to U+000D, A-Z count as a-z; a document's set are its distinct shingles
    of ``words`` words, the whole sequence where it has fewer.  Two documents link when 100 * (common shingles) >= percent *
    (shingles of either), confirmed on the whole sets; percent: 75 to 100, for which the bands are made.  component_id is the
    smallest doc_id reachable by links, the document itself included.

    A null, empty or blank text has an empty set, is linked with nothing and is its own component (ref and component null).
    Repeated rows and equal sets are one class: all of them get one component, one row each.  A null doc_id counts as no id and
    gets the smallest id of its component, null if it has none.  Where ids repeat on different texts, component (the smallest
    ref reachable) tells components apart.  Other columns play no part, whatever their names.
    """
    if not 75 <= percent <= 100:
        raise ValueError("percent must be from 75 to 100")
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    base = stage(docs.select("doc_id", summary("text", words).alias("s")).select("doc_id", "s.*"), "signatures")
    known = base.where("ref IS NOT NULL")
    classes = known.groupBy("ref").agg(F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    classes = stage(classes, "classes")
    label = stage(grouped(_links(_Join(docs, classes, words, percent))).select(F.col("node").alias("ref"), "component"), "labels")
    linked = label.join(classes.select("ref", "least_id"), "ref")
    least = linked.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = spread_join(linked, least, "component", stage(hot_keys(label.select("component")), "hot"), "inner").select("ref", "component", "component_id")
    final = classes.select("ref", "least_id").join(linked, "ref", "left")
    final = final.select("ref", F.coalesce("component", "ref").alias("component"), F.coalesce("component_id", "least_id").alias("component_id"))
    base = base.select("doc_id", "n", "ref")
    out = spread_join(base, final, "ref", stage(hot_keys(base.select("ref")), "hot"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "ref", "component", F.when(F.col("ref").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
