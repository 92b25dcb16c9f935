"""Secret scans behind a trigram index.

Each rule's regex is turned into a Boolean query over the trigrams any match must hold.  For every slice of texts the trigrams
of all queries are looked up at once, giving their posting lists; a query intersects and joins the lists, and only the texts it
leaves are handed to the regex, on the whole text.  A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as regex_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.llm.text import Slice, slices

ALTERNATIVES = 64  # literal alternatives followed at once; beyond them a query is cut there, which only weakens it


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a match counts if its ``group`` has at least ``least`` characters. Its span is the whole match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The rules of the contract come first, marked base; the others are the library's own.
RULES = [
    Rule(
        "assign",
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]+", least=24, base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]

# --- Boolean trigram queries -----------------------------------------------------------------------------------------
# A query is None (any text), a trigram (bytes), or ("and" | "or", queries).


def _both(queries: list) -> object:
    kept = list(dict.fromkeys(q for q in queries if q is not None))
    return None if not kept else kept[0] if len(kept) == 1 else ("and", tuple(kept))


def _either(queries: list) -> object:
    kept = list(dict.fromkeys(queries))
    return None if None in kept or not kept else kept[0] if len(kept) == 1 else ("or", tuple(kept))


def _of_strings(strings: set[str]) -> object:
    """What a text holds that has one of these strings, in lower case, as UTF-8."""

    def grams(s: str) -> object:
        b = s.encode()
        return _both([b[i : i + 3] for i in range(len(b) - 2)])

    return _either([grams(s) for s in sorted(map(str.lower, strings))])


def _alternatives(node: tuple) -> set[str] | None:
    """The strings a small node matches, if they can be listed."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value)} if value < 128 else None
    if kind is op.IN and all(k is op.LITERAL and v < 128 for k, v in value) and len(value) <= 8:
        return {chr(v) for _, v in value}
    if kind is op.SUBPATTERN:
        return _sequence_strings(value[-1])
    if kind is op.BRANCH:
        each = [_sequence_strings(b) for b in value[1]]
        return None if None in each else set().union(*each)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[:2] == (0, 1):
        inner = _sequence_strings(value[2])
        return None if inner is None else inner | {""}
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        found = _alternatives(node)
        if found is None or len(out) * len(found) > ALTERNATIVES:
            return None
        out = {a + b for a, b in product(out, found)}
    return out


def _sequence(nodes) -> object:
    queries, run = [], {""}
    for node in nodes:
        found = _alternatives(node)
        if found is not None and len(run) * len(found) <= ALTERNATIVES:
            run = {a + b for a, b in product(run, found)}
            continue
        queries.append(_of_strings(run))
        run = found if found is not None and len(found) <= ALTERNATIVES else {""}
        kind, value = node
        if found is None and kind is op.SUBPATTERN:
            queries.append(_sequence(value[-1]))
        elif found is None and kind is op.BRANCH:
            queries.append(_either([_sequence(b) for b in value[1]]))
        elif found is None and kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            queries.append(_sequence(value[2]))
    return _both([*queries, _of_strings(run)])


def trigram_query(pattern: str) -> object:
    """The Boolean query over lower-case trigrams that every match of the pattern satisfies; None if nothing is mandatory."""
    return _sequence(regex_parser.parse(pattern))


def _trigrams(query: object) -> set[bytes]:
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


class _Index:
    """Posting lists of the trigrams of some queries, over one slice at a time."""

    def __init__(self, rules: list[Rule]) -> None:
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.number = {g: i + 1 for i, g in enumerate(sorted(set().union(*map(_trigrams, self.queries))))}
        kind = np.uint8 if len(self.number) < 256 else np.uint16
        self.of_code = np.zeros(1 << 24, kind)
        for gram, i in self.number.items():
            self.of_code[gram[0] << 16 | gram[1] << 8 | gram[2]] = i
        self.lower = np.arange(256, dtype=np.uint32)
        self.lower[0x41:0x5B] += 0x20

    def candidates(self, part: Slice) -> list[np.ndarray]:
        """For each rule, whether each row may match."""
        has = np.zeros((len(self.number) + 1, len(part)), bool)
        b = self.lower[part.data]
        if len(b) > 2:
            number = self.of_code[(b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]]
            at = np.flatnonzero(number)
            row = np.searchsorted(part.offsets, at, "right") - 1
            inside = at + 3 <= part.offsets[row + 1]
            has[number[at[inside]], row[inside]] = True
        return [self.holds(q, has) for q in self.queries]

    def holds(self, query: object, has: np.ndarray) -> np.ndarray:
        if query is None:
            return np.ones(has.shape[1], bool)
        if isinstance(query, bytes):
            return has[self.number[query]]
        parts = [self.holds(q, has) for q in query[1]]
        return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)


def _spans(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), rule.kind) for m in compiled.finditer(text) if len(m[rule.group]) >= rule.least]


def _scannable(rule: Rule) -> Rule:
    """A bare run of one class needs no look at its short matches: the bound goes into the regex, the matches stay."""
    run = re.fullmatch(r"(\[[^\]\\]+\])\+", rule.pattern)
    return Rule(rule.kind, f"{run[1]}{{{rule.least},}}", 0, 0, rule.base) if run and rule.least > 1 and rule.group == 0 else rule


def secret_spans(text: Column | str, rules: list[Rule] = RULES) -> Column:
    """array<struct<kind, start, end>> of one text, by start, then by the order of the rules.

    Offsets are code points, the end exclusive.  Matches of one rule are leftmost and do not overlap; different rules may.  Null
    and empty texts have none.
    """

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = _Index(rules)
        scanned = [_scannable(r) for r in rules]
        compiled = [re.compile(r.pattern) for r in scanned]
        order = {r.kind: i for i, r in enumerate(rules)}
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for texts in batches:
            out = []
            for part in slices(texts):
                may = np.array(index.candidates(part))
                for i in range(len(part)):
                    found = []
                    text = part.text(i)
                    for r in np.flatnonzero(may[:, i]):
                        found += _spans(scanned[r], compiled[r], text)
                    found.sort(key=lambda s: (s[0], order[s[2]], s[1]))
                    out.append([{"kind": k, "start": s, "end": e} for s, e, k in found])
            yield pa.array(out, kind)

    return scan(text)


def redacted(text: Column | str, spans: Column | str, mark: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark; a text without spans stays as it is."""

    @F.arrow_udf("string")
    def redact(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            out = []
            for text, own in zip(texts.to_pylist(), found.to_pylist()):
                done, parts = 0, []
                for s in own or ():
                    if s["start"] >= done:
                        parts += [text[done : s["start"]], mark]
                    done = max(done, s["end"])
                out.append(text if not own else "".join([*parts, text[done:]]))
            yield pa.array(out, pa.string())

    return redact(text, spans)
