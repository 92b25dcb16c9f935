"""License scans with a positional index of rare words.

One scan counts in how many documents each word of the license templates occurs.  Each template is then indexed by its two
words of highest IDF.  The second scan looks these words up in each file, shifts their positions by their place in the
template, intersects the two posting lists to get the places where the template may stand, and verifies the whole key phrase
there.  Files without an index word cost no more than their tokenisation.  Everything is DataFrame functions; nothing is
shuffled but one count per template word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """A key phrase, in lower case and words, that must stand word by word for its label to be given."""

    label: str
    phrase: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.phrase.split()


# The phrases and labels of the contract come first, marked base; the others are the library's own.
TEMPLATES = [
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("bsd", "redistribution and use in source and binary forms"),
    Template("gpl", "gnu general public license"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("cc-by", "creative commons attribution"),
    Template("unlicense", "free and unencumbered software released into the public domain"),
    Template("all-rights-reserved", "all rights reserved"),
]

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; may begin and end with an empty string.  A null text gives one empty string."""
    # lower() would make k of the Kelvin sign, the only letter beyond ASCII with an ASCII lower case of one character.
    ascii_safe = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ"))
    return F.split(F.lower(ascii_safe), SEPARATORS)


def _literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def word_counts(docs: DataFrame, text: str, vocabulary: list[str]) -> tuple[dict[str, int], int]:
    """In how many of all documents each word of a (small) vocabulary occurs, and the number of documents."""
    found = docs.select(F.explode(F.concat(F.array_intersect(_literal(vocabulary), word_array(F.col(text))), F.array(F.lit(None)))).alias("w"))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return counts, counts.pop(None, 0)


def scan_licenses(docs: DataFrame, text: str = "text", keep: list[str] | None = None, templates: list[Template] = TEMPLATES) -> DataFrame:
    """The columns ``keep`` (default: all but the text) and a struct ``license``, one row per document.

    license: n_words; n_base, first_word, last_word over all places of the base phrases (words from 0, null if there is none);
    base_labels, labels (distinct, sorted, comma-joined; empty if none); score, the largest share of a template's IDF that
    stands at its relative places around one of its rarest word, 1 where a phrase stands.  Null and empty texts have no words
    and score 0.  Repeated rows are kept.  A column of the input named license is replaced.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    counts, total = word_counts(docs, text, vocabulary)
    idf = {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}

    def rarest(t: Template) -> list[int]:
        return sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], i))[:2]

    index = sorted({t.words[i] for t in templates for i in rarest(t)})
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    keep = [c for c in keep if c != "license"]
    w = F.col("_license.words")
    lead = F.col("_license.lead")
    docs = docs.select(*keep, F.struct(word_array(F.col(text)).alias("words")).alias("_license"))
    docs = docs.withColumn("_license", F.struct(w.alias("words"), F.when(w[0] == "", 1).otherwise(0).alias("lead")))
    places = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))), lambda h: h["w"].isin(index))
    size = F.size(w) - lead - F.when((F.size(w) > 1) & (F.element_at(w, -1) == ""), 1).otherwise(0)
    docs = docs.select(
        *keep,
        F.struct(
            w.alias("words"),
            lead.alias("lead"),
            size.cast("bigint").alias("n_words"),
            F.when(F.arrays_overlap(w, _literal(index)), places).alias("hits"),
        ).alias("_license"),
    )
    hits = F.col("_license.hits")

    def postings(t: Template, place: int) -> Column:
        """Where the template would begin, by the places of one of its words."""
        return F.transform(F.filter(hits, lambda h: h["w"] == t.words[place]), lambda h: h["i"] - F.lit(place))

    def starts(t: Template) -> Column:
        first, *second = rarest(t)
        found = postings(t, first)
        for place in second:
            found = F.array_intersect(found, postings(t, place))
        return F.filter(F.array_distinct(found), lambda s: (s >= 0) & (F.slice(w, F.greatest(s + 1, F.lit(1)), len(t.words)) == _literal(t.words)))

    def share(t: Template) -> Column:
        weight = sum(idf[x] for x in t.words)

        def at(s: Column) -> Column:
            terms = [F.when(F.get(w, s + i) == x, F.lit(idf[x] / weight)).otherwise(0.0) for i, x in enumerate(t.words)]
            return sum(terms[1:], terms[0])

        return F.coalesce(F.array_max(F.transform(postings(t, rarest(t)[0]), at)), F.lit(0.0))

    docs = docs.withColumn(
        "_license",
        F.struct(
            F.col("_license.n_words").alias("n_words"),
            lead.alias("lead"),
            *(F.when(hits.isNotNull(), starts(t)).alias(f"at{k}") for k, t in enumerate(templates)),
            F.when(hits.isNotNull(), F.least(F.lit(1.0), F.greatest(*map(share, templates)))).otherwise(0.0).alias("score"),
        ),
    )

    def at(k: int) -> Column:
        return F.coalesce(F.col(f"_license.at{k}"), F.array().cast("array<int>"))

    def labels(only_base: bool) -> Column:
        given = [F.when(F.size(at(k)) > 0, F.lit(t.label)) for k, t in enumerate(templates) if t.base or not only_base]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*given)))), ",")

    base = F.concat(*(at(k) for k, t in enumerate(templates) if t.base))
    return docs.select(
        *keep,
        F.struct(
            F.col("_license.n_words").alias("n_words"),
            F.size(base).cast("bigint").alias("n_base"),
            (F.array_min(base) - lead).cast("bigint").alias("first_word"),
            (F.array_max(base) - lead).cast("bigint").alias("last_word"),
            labels(True).alias("base_labels"),
            labels(False).alias("labels"),
            F.col("_license.score").alias("score"),
        ).alias("license"),
    )
