"""N-gram Jaccard join as a grouped prefix join, and the components its links make.

Documents are sets of word shingles.  The join goes from cheap to exact, and every filter is lossless:

1. *Sets.*  One scan gives every document the number of its shingles and a 64-bit value of its set.  Documents with equal
   sets are one class; from here on only classes count.
2. *Prefix screen.*  In hash order, two linked classes share at least k shingles inside their prefixes of n - t + k
   shingles (t the least overlap, k an eighth of n).  Prefix shingles are dealt to buckets as packed blobs, each map task
   sending a shingle once; a class that holds too few repeated ones has no partner and drops out.
3. *Rarity prefixes.*  The shingles of what is left are counted and ordered by rarity.  Shingles of one class only can match
   nothing, so what counts of a prefix are its repeated shingles.
4. *Grouping.*  Classes with identical prefix and size become one group; group pairs sharing a prefix shingle pass length and
   positional bounds, then are expanded to members and verified on the whole sets.

Only connectivity is asked for, so pairs within one component need no second link: first every group is held against the most
central group it meets, then only pairs from different components are enumerated, smaller components against the rest.  A
shingle whose classes are one component drops out altogether, however many they are.

64-bit values stand for shingles and sets; with n of them the chance of any collision is about n * n / 2 ** 65.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.components import components
from meterlake.llm.hot import hot_keys, spread_join
from meterlake.llm.sharing import bound_batches
from meterlake.llm.text import shingle_sets
from meterlake.sources.staging import stage

BUCKET_SHINGLES = 1_000_000  # shingles counted together in one task
CHUNK_SHINGLES = 500_000  # shingles one map task holds before it sends them on
SCREENED_CLASSES = 50_000  # classes whose counts are put together in one task
SENT_SHINGLES = 50_000  # shingles of whole sets that are sent on together
COPY_SALTS = 16  # tasks that the copies of one row are dealt to


def _least(n, percent: int):
    """The smallest overlap a set of n shingles has with a partner: a partner's size is at least percent of n."""
    return -(-n * percent // 100)


def _set_value(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def sets_of(text: Column | str, words: int = 5) -> Column:
    """struct<n: number of distinct shingles, ref: value of the set, null when it is empty>."""

    @F.arrow_udf("struct<n:bigint,ref:bigint>")
    def summary(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [(len(s), _set_value(s) if len(s) else None) for _, s in shingle_sets(texts, words)]
            yield pa.StructArray.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["n", "ref"]
            )

    return summary(text)


def _whole_sets(words: int):
    """text, ref -> ref, n, shingles of the texts whose set has this value; sent on slice by slice."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).to_pylist()
            held: list[np.ndarray] = []
            for row, shingles in shingle_sets(batch.column(0), words):
                if len(shingles) and _set_value(shingles) == wanted[row]:
                    held.append(shingles)
                if row + 1 == batch.num_rows or sum(map(len, held)) > SENT_SHINGLES:
                    sizes = [len(s) for s in held]
                    flat = np.concatenate([*held, np.zeros(0, np.uint64)]).view(np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat))
                    refs = pa.array([_set_value(s) for s in held], pa.int64())
                    yield pa.RecordBatch.from_arrays([refs, pa.array(sizes, pa.int64()), lists], ["ref", "n", "shingles"])
                    held = []

    return whole


def _prefix(n: int, percent: int) -> tuple[int, int]:
    """Length of the screening prefix of a set, and how many repeated shingles in it a set with a partner has."""
    extra = max(1, n // 8)
    return n - _least(n, percent) + extra, max(1, _least(n, percent) // 8)


_SENT = pa.schema(
    [("bucket", pa.int32()), ("refs", pa.binary()), ("counts", pa.binary()), ("alone", pa.binary()), ("shared", pa.binary())]
)


def _send_prefixes(words: int, percent: int, buckets: int, places: int):
    """Map side of the screen: prefix shingles by bucket; a shingle of several classes of the task goes without them.

    Rows of bucket -1 - p hold the classes of place p, their needs, and how many of their shingles were found repeated right here.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        size = 0
        for batch in batches:
            for _, shingles in shingle_sets(batch.column(0), words):
                if len(shingles) and (ref := _set_value(shingles)) not in held:
                    length, need = _prefix(len(shingles), percent)
                    held[ref] = need, shingles[:length].copy()
                    size += length
                if size >= CHUNK_SHINGLES:
                    yield from packed(held)
                    held, size = {}, 0
        yield from packed(held)

    def packed(held: dict[int, tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        refs = np.fromiter(held, np.int64, len(held))
        needs = np.array([need for need, _ in held.values()], np.int64)
        shingles = np.concatenate([s for _, s in held.values()])
        owner = np.repeat(np.arange(len(refs), dtype=np.int32), [len(s) for _, s in held.values()])
        order = np.argsort(shingles)
        ordered = shingles[order]
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        run = np.diff(np.concatenate([np.flatnonzero(fresh), [len(ordered)]]))
        alone = np.zeros(len(ordered), bool)
        alone[order] = np.repeat(run == 1, run)
        here = np.bincount(owner[~alone], minlength=len(refs)).astype(np.int64)
        several = ordered[fresh][run > 1]
        rows = []
        for p, mine in _by_place(refs, places):
            rows.append((-1 - p, refs[mine].tobytes(), here[mine].tobytes(), needs[mine].tobytes(), b""))
        shingles, owner = shingles[alone], owner[alone]
        bucket = (shingles % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        shingles, owner, bucket = shingles[order], owner[order], bucket[order]
        several_in = (several % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(several_in, kind="stable")
        several, several_in = several[order], several_in[order]
        # Only buckets that this chunk has something for: their number is bounded by the chunk, not by the corpus.
        present = np.union1d(bucket, several_in)
        begin, end = np.searchsorted(bucket, present), np.searchsorted(bucket, present, "right")
        begin_both, end_both = np.searchsorted(several_in, present), np.searchsorted(several_in, present, "right")
        for b, lo, hi, lo_both, hi_both in zip(present.tolist(), begin, end, begin_both, end_both):
            mine, counts = np.unique(owner[lo:hi], return_counts=True)
            both = several[lo_both:hi_both]
            rows.append((b, refs[mine].tobytes(), counts.astype(np.int32).tobytes(), shingles[lo:hi].tobytes(), both.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT, strict=True)], schema=_SENT)

    return send


def _by_place(refs: np.ndarray, places: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where classes are put together again: (place, rows of refs)."""
    place = (refs.view(np.uint64) % np.uint64(places)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    cuts = np.flatnonzero(np.diff(place[order])) + 1
    for mine in np.split(order, cuts):
        if len(mine):
            yield int(place[mine[0]]), mine


_COUNTED = "place int, refs binary, elsewhere binary, here binary, need binary"


def _count_bucket(places: int):
    """Reduce side of the screen: for each class, the number of its shingles in this bucket that others hold too."""

    def count(table: pa.Table) -> pa.Table:
        columns = {name: table.column(name).to_pylist() for name in ("refs", "counts", "alone", "shared")}
        owners = zip(columns["refs"], columns["counts"])
        refs = np.concatenate([np.repeat(np.frombuffer(r, np.int64), np.frombuffer(c, np.int32)) for r, c in owners])
        shingles = np.frombuffer(b"".join(columns["alone"]), np.uint64)
        shared = np.unique(np.frombuffer(b"".join(columns["shared"]), np.uint64))
        order = np.argsort(shingles, kind="stable")
        shingles, refs = shingles[order], refs[order]
        fresh = np.append(True, shingles[1:] != shingles[:-1]) if len(shingles) else np.zeros(0, bool)
        starts = np.flatnonzero(fresh)
        rows = []
        if len(starts):
            # Copies of one class may come from several tasks: a shingle is repeated if its least and largest class differ.
            repeated = np.minimum.reduceat(refs, starts) != np.maximum.reduceat(refs, starts)
            repeated |= np.isin(shingles[starts], shared, assume_unique=True)
            kept, counts = np.unique(refs[repeated[np.cumsum(fresh) - 1]], return_counts=True)
            for p, mine in _by_place(kept, places):
                rows.append((p, kept[mine].tobytes(), counts[mine].astype(np.int64).tobytes(), b"", b""))
        names = ["place", "refs", "elsewhere", "here", "need"]
        kinds = [pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    return count


def _enough(table: pa.Table) -> pa.Table:
    """The classes of one place that hold as many repeated shingles as a class with a partner does."""
    refs, elsewhere, here, need = ([np.frombuffer(x, np.int64) for x in table.column(c).to_pylist()] for c in ("refs", "elsewhere", "here", "need"))
    names, which = np.unique(np.concatenate(refs), return_inverse=True)
    total, local, least = (np.zeros(len(names), np.int64) for _ in range(3))
    at = 0
    for r, e, h, n in zip(refs, elsewhere, here, need):
        rows = which[at : at + len(r)]
        if len(e):
            np.add.at(total, rows, e)
        else:
            np.maximum.at(local, rows, h)
            np.maximum.at(least, rows, n)
        at += len(r)
    return pa.table({"ref": names[total + local >= least]})


def _screened(docs: DataFrame, text: str, words: int, percent: int, shingles: int, classes: int) -> DataFrame:
    """ref of every class that may have a partner."""
    buckets = max(12, -(-shingles * (100 - percent + 13) // 100 // BUCKET_SHINGLES))
    places = max(12, -(-classes // SCREENED_CLASSES))
    sent = docs.select(text).mapInArrow(_send_prefixes(words, percent, buckets, places), _ddl(_SENT))
    # One scan feeds both sides: the packed rows are written once.
    sent = stage(sent, "prefixes")
    counted = sent.where("bucket >= 0").groupBy("bucket").applyInArrow(_count_bucket(places), _COUNTED)
    nothing = F.lit(b"")
    own = sent.where("bucket < 0").select(
        (-1 - F.col("bucket")).alias("place"), "refs", nothing.alias("elsewhere"), F.col("counts").alias("here"), F.col("alone").alias("need")
    )
    return counted.unionByName(own).groupBy("place").applyInArrow(_enough, "ref bigint")


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _linked(common: str, a: str, b: str, percent: int) -> Column:
    """percent test on sizes a and b and an overlap: common >= percent of the union."""
    return F.expr(f"(100 + {percent}) * ({common}) >= {percent} * ({a} + {b})")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets overlap enough; one side's set travels to the other."""
    left = sets.select(F.col("ref").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("ref").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    # A family meets at its one central class b: its rows are spread.
    both = spread_join(pairs.join(left, "a"), right, "b", stage(hot_keys(pairs.select("b")), "hot"), "inner")
    both = both.where(_linked("least(na, nb)", "na", "nb", percent))
    return both.where(_linked("size(array_intersect(sa, sb))", "na", "nb", percent)).select("a", "b")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Edges between classes that connect exactly the classes that links connect."""
    tokens = sets.select("ref", F.explode("shingles").alias("t"))
    df = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    repeated = tokens.join(df, "t").groupBy("ref").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("by_rarity"))
    ordered = (
        repeated.join(sets.select("ref", "n"), "ref")
        .withColumn("r", F.size("by_rarity").cast("bigint"))
        # Length of the prefix, less the n - r shingles no other class has, which come first.
        .withColumn("keep", F.expr(f"r + 1 - CAST(ceil(n * {percent} / 100.0) AS BIGINT)"))
        .where("keep > 0")
        .select("ref", "n", "r", F.expr("slice(by_rarity.t, 1, CAST(keep AS INT))").alias("prefix"))
        .withColumn("g", F.xxhash64("n", "r", "prefix"))
    )
    ordered = stage(ordered, "rarity-prefixes")
    members = ordered.select("ref", "g")
    groups = ordered.groupBy("g").agg(*(F.first(c).alias(c) for c in ("n", "r", "prefix")), F.min("ref").alias("leader"))
    groups = stage(groups, "groups")
    entries = groups.select("g", "leader", "n", "r", F.posexplode("prefix").alias("i", "t"))
    # First round: every group against the most central group (fewest shingles of its own) it shares a prefix shingle with.
    central = F.struct((F.col("n") - F.col("r")).alias("own"), F.col("g"), F.col("leader"), F.col("n"), F.col("r"), F.col("i"))
    best = entries.groupBy("t").agg(F.min(central).alias("c"))
    bound = _linked("least(r - i, c.r - c.i)", "n", "c.n", percent)
    met = entries.join(best, "t").where("g <> c.g").where(bound).groupBy("g").agg(F.min(F.struct("c.own", "c.leader")).alias("c"))
    round_one = (
        met.join(groups.select("g", "leader"), "g")
        .select(F.col("leader").alias("a"), F.col("c.leader").alias("b"))
        .unionByName(
            members.join(groups.select("g", "leader"), "g").where("ref <> leader").select(F.col("ref").alias("a"), F.col("leader").alias("b"))
        )
    )
    found = stage(_verified(stage(round_one, "round-one"), sets, percent), "links")
    # Second round: what may link different components, the largest component of a shingle against the others.
    label = components(found)
    placed = members.join(label.withColumnRenamed("node", "ref"), "ref", "left").withColumn("comp", F.coalesce("component", "ref"))
    placed = stage(placed.select("ref", "g", "comp"), "placed")
    units = placed.select("g", "comp").distinct().join(groups.select("g", "n", "r", "prefix"), "g")
    units = units.select("g", "comp", "n", "r", F.posexplode("prefix").alias("i", "t"))
    per = units.groupBy("t", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = per.groupBy("t").agg(F.count(F.lit(1)).alias("comps"), F.max_by("comp", F.struct("k", "comp")).alias("major"))
    units = stage(units.join(mixed.where("comps > 1").select("t", "major"), "t"), "units")
    a = units.where("comp <> major").select("t", *(F.col(c).alias(f"{c}_a") for c in ("g", "comp", "n", "r", "i")))
    b = units.select("t", "major", *(F.col(c).alias(f"{c}_b") for c in ("g", "comp", "n", "r", "i")))
    pairs = (
        a.join(b, "t")
        .where("comp_b = major OR comp_a < comp_b")
        .where(_linked("least(r_a - i_a, r_b - i_b)", "n_a", "n_b", percent))
        .select("g_a", "comp_a", "g_b", "comp_b")
        .distinct()
    )
    in_a = placed.select(F.col("ref").alias("a"), F.col("g").alias("g_a"), F.col("comp").alias("comp_a"))
    in_b = placed.select(F.col("ref").alias("b"), F.col("g").alias("g_b"), F.col("comp").alias("comp_b"))
    rest = stage(pairs.join(in_a, ["g_a", "comp_a"]).join(in_b, ["g_b", "comp_b"]).select("a", "b"), "rest")
    return found.unionByName(stage(_verified(rest, sets, percent), "links"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, ref, component, component_id: one row per document.

    Two documents link when 100 * (common shingles) >= percent * (shingles of either).  component_id is the smallest doc_id
    among the documents reachable by links, the document itself included.  A null or wordless text has an empty set: it is
    linked with nothing, its ref is null and its component is itself.  Repeated rows are kept, one row each; a null doc_id
    counts as no id and gets the smallest id of its component.  Different components may have one component_id: where ids
    repeat on different texts, or where no document has one (null).  component tells them apart: it is the smallest ref among
    the documents reachable, null like ref.  Other columns play no part.  percent: 1 to 100.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    base = stage(docs.select("doc_id", sets_of("text", words).alias("s")).select("doc_id", "s.n", "s.ref"), "sets")
    classes = base.where("ref IS NOT NULL").groupBy("ref").agg(F.min("doc_id").alias("least_id"), F.first("n").alias("n"))
    shingles, rows = base.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("ref")).first()
    screened = _screened(docs, "text", words, percent, shingles, rows)
    kept = stage(classes.join(screened, "ref", "left_semi"), "screened")
    # Whole sets of the classes left: only they are shuffled, one document of each class.
    salts = F.explode(F.sequence(F.lit(0), F.lit(COPY_SALTS - 1))).alias("wanted_salt")
    wanted = kept.select(F.col("least_id").alias("wanted_id"), F.col("ref").alias("wanted_ref"), salts).hint("shuffle_hash")
    # By id and set: one id, or none, may stand on many texts.  <=> on both, else a filter would run the function twice.  Many
    # copies of one row are spread by the partition they come from.
    marked = docs.withColumn("_ref", sets_of("text", words)["ref"]).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(COPY_SALTS)))
    same = F.expr("doc_id <=> wanted_id AND _ref <=> wanted_ref AND _salt = wanted_salt")
    sets = marked.join(wanted, same).select("text", "wanted_ref")
    sets = sets.mapInArrow(_whole_sets(words), "ref bigint, n bigint, shingles array<bigint>").dropDuplicates(["ref"])
    sets = stage(sets, "shingles")
    label = components(_links(sets, percent))
    label = label.select(F.col("node").alias("ref"), "component")
    linked = label.join(kept.select("ref", "least_id"), "ref")
    least = linked.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = label.join(least, "component").select("ref", "component", "component_id")
    final = classes.select("ref", "least_id").join(linked, "ref", "left")
    final = final.select(
        "ref", F.coalesce("component", "ref").alias("component"), F.coalesce("component_id", "least_id").alias("component_id")
    )
    return spread_join(base, final, "ref", stage(hot_keys(base.select("ref")), "hot")).select(
        "doc_id", F.col("n").alias("n_shingles"), "ref", "component", F.coalesce("component_id", "doc_id").alias("component_id")
    )
