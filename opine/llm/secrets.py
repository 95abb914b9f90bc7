"""Secret scans with a trigram index.

From each pattern a Boolean query over trigrams is derived: every text that the pattern can match satisfies it.
Each batch of texts is a segment of the index: its postings list, for the trigrams that any query names, the
texts that hold them. Queries are answered by intersecting and uniting postings, and the pattern itself runs on
the candidates only. A pattern that no trigram must be part of runs on every text. Segments are as large as
Arrow batches, so memory stays bounded and no text is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from re import _constants as sre  # type: ignore[attr-defined]
from re import _parser as parser  # type: ignore[attr-defined]

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from opine.llm.common import text_or_empty
from opine.llm.secret_rules import BASE, MORE, Rule

# A query is in disjunctive form: any of these sets of trigrams, held whole. None: every text is a candidate.
Query = frozenset[frozenset[str]] | None

# Bounds of the derivation. Beyond them a part of the pattern counts as "any text", which only adds candidates.
MOST_STRINGS, MOST_CLASS = 64, 8
# Texts are joined for one pass of numpy up to so many bytes (one text may be longer).
SEGMENT_BYTES = 4 << 20


# --- from a pattern to a query -----------------------------------------------------------


def _strings(item: tuple) -> list[str] | None:
    """All lower-cased strings an element can match, if they are few."""
    kind, value = item
    if kind is sre.LITERAL:
        return [chr(value).lower()]
    if kind is sre.IN and all(k is sre.LITERAL for k, _ in value) and len(value) <= MOST_CLASS:
        return sorted({chr(v).lower() for _, v in value})
    if kind is sre.SUBPATTERN:
        return _sequence_strings(list(value[3]))
    if kind is sre.BRANCH:
        listed = [_sequence_strings(list(b)) for b in value[1]]
        return None if None in listed else sorted({s for part in listed for s in part})
    if kind is sre.MAX_REPEAT and value[1] != sre.MAXREPEAT:
        low, high, part = value
        once = _sequence_strings(list(part))
        if once is None or high > 3:
            return None
        found: set[str] = set()
        for times in range(low, high + 1):
            joined = {""}
            for _ in range(times):
                joined = {a + b for a in joined for b in once}
            found |= joined
        return sorted(found) if len(found) <= MOST_STRINGS else None
    return None


def _sequence_strings(items: list[tuple]) -> list[str] | None:
    found = {""}
    for item in items:
        more = _strings(item)
        if more is None or len(found) * len(more) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in more}
    return sorted(found)


def _of_strings(listed: Sequence[str]) -> Query:
    options = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in listed]
    return None if any(not o for o in options) else frozenset(options)


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a if b is None else b
    joined = frozenset(x | y for x in a for y in b)
    return joined if len(joined) <= MOST_STRINGS else a


def _of_sequence(items: list[tuple]) -> Query:
    """Runs of elements with few strings give trigrams; the others are asked by themselves."""
    query: Query = None
    run: list[tuple] = []

    def close(query: Query) -> Query:
        while run:
            for end in range(len(run), 0, -1):
                listed = _sequence_strings(run[:end])
                if listed is not None:
                    query = _both(query, _of_strings(listed))
                    del run[:end]
                    break
        return query

    for item in items:
        if _strings(item) is not None:
            run.append(item)
            continue
        kind, value = item
        if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] >= 1 and len(once := list(value[2])) == 1:
            literal = _strings(once[0])
            if literal is not None and value[0] <= 8:
                run.extend(once * value[0])  # what must come at least
        query = close(query)
        if kind is sre.SUBPATTERN:
            query = _both(query, _of_sequence(list(value[3])))
        elif kind is sre.BRANCH:
            parts = [_of_sequence(list(b)) for b in value[1]]
            if None not in parts:
                query = _both(query, frozenset(option for part in parts for option in part))
    return close(query)


def trigram_query(pattern: str) -> Query:
    """The query, over lower-cased text, that each text with a match satisfies; None if there is none."""
    query = _of_sequence(list(parser.parse(pattern)))
    # An option that holds all of another one adds nothing.
    return query and frozenset(option for option in query if not any(other < option for other in query))


# --- postings ----------------------------------------------------------------------------


def _packed(trigram: str) -> int | None:
    raw = trigram.encode("utf-8")
    return raw[0] << 16 | raw[1] << 8 | raw[2] if len(raw) == 3 else None


# Bytes A-Z to a-z, as the queries are over lower-cased text.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Index:
    """Postings of one segment, for the trigrams that some query names."""

    def __init__(self, texts: Sequence[bytes], slots: np.ndarray):
        joined = _LOWER[np.frombuffer(b"\n\n".join(texts), dtype=np.uint8)]
        lengths = np.fromiter((len(t) + 2 for t in texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths)
        self.postings: dict[int, np.ndarray] = {}
        if len(joined) < 3:
            return
        wide = joined.astype(np.uint32)
        slot = slots[wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]]
        at = np.flatnonzero(slot)
        owner = np.searchsorted(ends, at, side="right")
        pairs = np.unique(slot[at].astype(np.int64) * len(texts) + owner)
        found, documents = np.divmod(pairs, len(texts))
        for number in np.unique(found):
            self.postings[int(number)] = documents[found == number]

    def answer(self, query: Sequence[Sequence[int]]) -> np.ndarray:
        nothing = np.empty(0, dtype=np.int64)
        found = nothing
        for option in query:
            lists = [self.postings.get(n, nothing) for n in option]
            held = lists[0]
            for more in lists[1:]:
                held = np.intersect1d(held, more, assume_unique=True)
            found = np.union1d(found, held)
        return found


def _prepared(rules: Sequence[Rule]) -> tuple[list, np.ndarray]:
    """Each rule with its compiled pattern and its query over slot numbers, and the trigram -> slot table."""
    slots, numbers, out = np.zeros(1 << 24, dtype=np.uint16), {}, []
    for rule in rules:
        query = trigram_query(rule.pattern)
        options = None
        if query is not None:
            options = []
            for option in query:
                packed = [p for p in map(_packed, sorted(option)) if p is not None]
                if not packed:  # only trigrams of other characters: not indexed
                    options = None
                    break
                for p in packed:
                    slots[p] = numbers.setdefault(p, len(numbers) + 1)
                options.append([numbers[p] for p in packed])
        out.append((rule, re.compile(rule.pattern), options))
    return out, slots


def find_spans(texts: Sequence[str], rules: Sequence[Rule], prepared: tuple[list, np.ndarray] | None = None) -> list:
    """For each text its (start, rule number, end), sorted; leftmost non-overlapping matches of each rule."""
    compiled, slots = prepared or _prepared(rules)
    index = Index([t.encode("utf-8", "surrogatepass") for t in texts], slots)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, (rule, pattern, query) in enumerate(compiled):
        for at in range(len(texts)) if query is None else index.answer(query):
            for match in pattern.finditer(texts[at]):
                if match.end(rule.group) - match.start(rule.group) >= rule.least:
                    spans[at].append((match.start(), number, match.end()))
    return [sorted(found) for found in spans]


# --- over documents ----------------------------------------------------------------------


def _segments(texts: pd.Series) -> Iterator[tuple[int, int]]:
    first = size = 0
    for at, text in enumerate(texts):
        if size and size + len(text) > SEGMENT_BYTES:
            yield first, at
            first, size = at, 0
        size += len(text)
    if len(texts) > first:
        yield first, len(texts)


def scan(documents: DataFrame, rules: Sequence[Rule] = BASE + MORE) -> DataFrame:
    """doc_id, n_<kind> of each base rule, base_sha256, spans; one row for each row of `documents`.

    Spans are kind:start:end in code points, end exclusive, by start, then by the order of the rules. A null or
    empty text has none. Rows may repeat and ids may be null; other columns are not read.
    """
    rules = tuple(rules)
    counts = {f"n_{rule.kind}": n for n, rule in enumerate(rules) if rule.base}

    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        prepared = _prepared(rules)
        for texts in batches:
            found: list = []
            for first, end in _segments(texts):
                found += find_spans(texts.iloc[first:end].tolist(), rules, prepared)
            out = {name: [sum(n == number for _, n, _ in spans) for spans in found] for name, number in counts.items()}
            named = [[(n, f"{rules[n].kind}:{start}:{end}") for start, n, end in spans] for spans in found]
            out["base_sha256"] = [
                hashlib.sha256(",".join(s for n, s in spans if rules[n].base).encode()).hexdigest() for spans in named
            ]
            out["spans"] = [",".join(s for _, s in spans) for spans in named]
            yield pd.DataFrame(out)

    fields = [StructField(name, LongType()) for name in counts]
    fields += [StructField("base_sha256", StringType()), StructField("spans", StringType())]
    scan_texts = F.pandas_udf(scanned, StructType(fields))
    return documents.select("doc_id", scan_texts(text_or_empty()).alias("found")).select("doc_id", "found.*")
