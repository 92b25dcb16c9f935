"""Spelling variants: words one edit apart, found by walking a relational trie level by level.

The trie is a table of edges (node, label, child).  A node is a prefix at which words end or part; a label is the stretch of
characters to the next such node, so that a walk takes as many levels as words part, whatever their length.  A state (word,
position, node, edits) says that the word has been read up to the position and stands at the node.  Without edits a word stands
at the nodes of its own path, which its row of the trie lists: these states, of all levels, are the first frontier.  Where an edge
begins with another letter than the word goes on with, the one edit is spent: the letter is replaced, left out, or put in.  Each
further level joins the frontier with the edges of its nodes, and word and label must agree.  A state with one edit that has
read its whole word at a node where words end has found a neighbour.

Words are entered twice, as they are and reversed, and an edit is sought in the second half of what was entered.  So every edit is
found from one side at least, and no state ever meets the crowded nodes about the root with its edit unspent.

Once the edit is spent, the rest of the word must be one of the ends below the child.  An edge keeps a digest of them: one of 256
bits for each, by hash.  States whose rest is not in the digest are given up at once; the walk decides about the others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.sharing import bound_batches
from meterlake.sources.staging import stage

HELD_WORDS = 300_000  # words a task counts before it sends them on


def _counts(spoil: int, shortest: int):
    """doc id as text, text -> (word, n): partial counts of the words of a task."""
    # The texts are in lower case (A-Z only) when they are searched; a planted error only shortens a run.
    letters = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                found = Counter(letters.findall((text.as_py() or b"").lower().decode("utf-8")))
                if doc_id.is_valid and spoil:
                    seed = zlib.crc32(doc_id.as_py().encode() + b":")
                    for word, n in found.items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % spoil == 0:
                            i = h % len(word)
                            word = word[:i] + word[i + 1 :]
                        held[word] += n
                else:
                    held.update(found)
                if len(held) >= HELD_WORDS:
                    yield packed(held)
        if held:
            yield packed(held)

    def packed(held: Counter[str]) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    return count


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 5, fewest: int = 3, spoil: int = 0) -> DataFrame:
    """word, n: runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z as a-z, that have ``shortest`` code points and occur
    ``fewest`` times over all documents, at least.

    spoil plants misspellings for trials: of a run whose crc32 of ``<doc_id>:<run>`` it divides, one code point is left out, in
    every occurrence in that document.  A null text has no words; in a document without id nothing is planted.  Repeated rows
    count as often as they stand there.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    counted = rows.mapInArrow(_counts(spoil, shortest), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.char_length("word") >= shortest) & (F.col("n") >= fewest))


def _place(rest: str) -> str:
    """The bit of an end in a digest."""
    return f"crc32(CAST({rest} AS BINARY)) % 256"


def _may_end(rest: str) -> str:
    """Whether the digest of the edge has the rest of a word."""
    return f"getbit(array(below0, below1, below2, below3)[CAST({_place(rest)} div 64 AS INT)], CAST({_place(rest)} % 64 AS INT)) = 1"


def _trie(words: DataFrame, first: int) -> tuple[DataFrame, DataFrame]:
    """(edges: node, label, child, ends, below0 to below3; paths: side, word, stops) of words (side, word).

    stops are the nodes on the path of a word from the depth ``first`` on (depth, node, ends); ends says that a word ends there.
    """
    node = F.xxhash64("side", F.substring("word", F.lit(1), F.col("depth")))
    prefixes = words.withColumn("depth", F.explode(F.sequence(F.lit(first), F.char_length("word"))))
    prefixes = prefixes.select("side", "word", "depth", node.alias("node"), F.expr("substring(word, depth + 1, 1)").alias("next"))
    # The empty next letter is the end of a word, so a node at which words end is one where the next letters differ, or a leaf.
    forks = prefixes.groupBy("node").agg(F.min("next").alias("least"), F.max("next").alias("most"))
    forks = forks.where("least <> most OR least = ''").select("node", (F.col("least") == "").alias("ends"))
    paths = prefixes.join(forks, "node").groupBy("side", "word").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "ends"))).alias("stops"))
    paths = stage(paths, "paths")
    edge = F.expr(
        "transform(sequence(1, size(stops) - 1), i -> struct(stops[i - 1].node AS node, substring(word, stops[i - 1].depth + 1, "
        "stops[i].depth - stops[i - 1].depth) AS label, stops[i].node AS child, stops[i].ends AS ends, "
        f"{_place('substring(word, stops[i].depth + 1)')} AS place))"
    )
    below = [F.expr(f"bit_or(IF(place div 64 = {k}, shiftleft(1L, CAST(place % 64 AS INT)), 0L)) AS below{k}") for k in range(4)]
    edges = paths.where("size(stops) > 1").select(F.explode(edge).alias("e")).select("e.*").groupBy("node", "label", "child", "ends").agg(*below)
    return edges.withColumn("first", F.expr("substring(label, 1, 1)")), paths


# Where in the word the walk goes on behind a label that begins with another letter.
_SPENT = (
    "filter(array("
    # replaced
    "IF(pos + char_length(label) <= char_length(word) AND substring(label, 2) = substring(word, pos + 2, char_length(label) - 1),"
    " pos + char_length(label), NULL), "
    # missing in the word
    "IF(substring(label, 2) = substring(word, pos + 1, char_length(label) - 1), pos + char_length(label) - 1, NULL), "
    # too much in the word
    "IF(label = substring(word, pos + 2, char_length(label)), pos + char_length(label) + 1, NULL)), e -> e IS NOT NULL)"
)


def neighbours(words: DataFrame) -> DataFrame:
    """word, near: all ordered pairs of the distinct words of the frame's only column that are one edit apart."""
    (name,) = words.columns
    words = words.select(F.col(name).alias("word")).where("word IS NOT NULL AND word <> ''").distinct()
    words = stage(words, "distinct")
    shortest = words.agg(F.min(F.char_length("word"))).first()[0] or 0
    words = words.select(F.lit(0).alias("side"), "word").unionByName(words.select(F.lit(1).alias("side"), F.reverse("word").alias("word")))
    edges, paths = _trie(words, shortest // 2)
    edges = stage(edges, "edges")
    length = F.char_length("word")
    low = F.when(F.col("side") == 0, F.floor(length / 2)).otherwise(length - F.floor(length / 2))
    unspent = paths.withColumn("stop", F.explode(F.filter("stops", lambda s: s["depth"] >= low)))
    unspent = unspent.select("side", "word", F.col("stop.depth").alias("pos"), F.col("stop.node").alias("node"), F.col("stop.ends").alias("ends"))
    # One letter is left over where another word ends.
    found = [unspent.where("ends AND pos = char_length(word) - 1").select("side", "word", F.expr("substring(word, 1, pos)").alias("text"))]
    # Read with the edit spent: what of the trie (text) and up to where in the word (pos).
    text = F.expr("concat(substring(word, 1, pos), label)").alias("text")
    states = unspent.drop("ends").join(edges.hint("shuffle_hash"), "node").where("first <> substring(word, pos + 1, 1)")
    states = states.withColumn("end", F.explode(F.expr(_SPENT))).where(_may_end("substring(word, end + 1)"))
    states = stage(states.select("side", "word", text, F.col("end").alias("pos"), F.col("child").alias("node"), "ends"), "states")
    while not states.isEmpty():
        found.append(states.where("ends AND pos = char_length(word)").select("side", "word", "text"))
        going = states.where("pos < char_length(word)").drop("ends").withColumn("first", F.expr("substring(word, pos + 1, 1)"))
        met = going.join(edges.hint("shuffle_hash"), ["node", "first"]).where("label = substring(word, pos + 1, char_length(label))")
        met = met.withColumn("pos", F.col("pos") + F.char_length("label")).where(_may_end("substring(word, pos + 1)"))
        states = stage(met.select("side", "word", F.concat("text", "label").alias("text"), "pos", F.col("child").alias("node"), "ends"), "states")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    turned = F.col("side") == 1
    pairs = pairs.select(F.when(turned, F.reverse("word")).otherwise(F.col("word")).alias("word"), F.when(turned, F.reverse("text")).otherwise(F.col("text")).alias("near"))
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): from word, follow forms to the last; a word without form is its own root.

    Each round doubles the steps already taken, so a chain of k forms takes about log2(k) rounds.
    """
    links = stage(forms.where("form IS NOT NULL").select("word", "form"), "forms")
    ahead = links
    while True:
        far = ahead.select(F.col("word").alias("form"), F.col("form").alias("further"))
        longer = stage(ahead.join(far, "form", "left").select("word", F.coalesce("further", "form").alias("form"), F.col("further").isNotNull().alias("moved")), "forms")
        ahead = longer.select("word", "form")
        if longer.where("moved").isEmpty():
            break
    return forms.select("word").join(ahead, "word", "left").select("word", F.coalesce("form", "word").alias("root"))


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of (word, n).

    Two words are near if they differ by one inserted, deleted or replaced code point.  A word's form is its near word of largest
    n, the smallest in code-point order of equal ones, if that n is at least ``times`` the word's (times: 2 or more, so that
    forms make no circle); else null.  root follows the forms to the last.  n_near is 0 and form_n null where there is none.
    Words are expected once each, without null or empty ones; no words give no rows.
    """
    words = stage(words.select("word", "n"), "words")
    pairs = stage(neighbours(words.select("word")), "pairs")
    told = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near")))
    per = told.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    out = words.join(per, "word", "left")
    enough = -F.col("best.order") >= times * F.col("n")
    out = out.select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, -F.col("best.order")).alias("form_n"),
    )
    out = stage(out, "variants")
    return out.join(roots(out), "word").select("word", "form", "root", "n", "n_near", "form_n")
