"""Licence scan: ordered signature rules behind a keyword prefilter.

Each text is normalised to lower-case words. One pass of an Aho-Corasick
automaton over the normalised text finds which keywords occur; only their
rules run. Every match is a detection (first word, word count, rule).
Detections are taken by priority, then length, then place, then rule order;
one whose words lie wholly inside a kept detection is suppressed. The base phrases are counted everywhere and their labels stay.

A map over rows: nothing is shuffled and no state outlives a text.
Defined cases: a null or empty text has no words, no labels, score 0 and null
places; repeated rows give repeated results; other columns are ignored; a very
long text takes time in proportion to its length and number of detections.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WORDS, map_arrow, text_of
from .license_rules import BASE_PHRASES, RULES


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


def _words(text: str) -> bytes:
    return b" ".join(text.encode().translate(WORDS).split())


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    out = []
    for line in RULES.splitlines():
        label, priority, keywords, pattern = line.split(" ; ", 3)
        compiled = re.compile(b"(?<= )(?:" + pattern.encode() + b")(?= )", re.DOTALL)
        out.append(Rule(label, int(priority), tuple(map(_words, keywords.split(" | "))), compiled))
    return tuple(out)


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    auto = ahocorasick.Automaton()
    by_keyword: dict[str, list[int]] = {}
    for i, rule in enumerate(rules()):
        for keyword in rule.keywords:
            by_keyword.setdefault(keyword.decode("latin-1"), []).append(i)
    for keyword, ids in by_keyword.items():
        auto.add_word(keyword, ids)
    auto.make_automaton()
    return auto


@dataclass(frozen=True)
class Detection:
    label: str
    priority: int
    start: int
    length: int


def _clusters(found: list[tuple]) -> Iterator[list[tuple]]:
    """Runs of detections that overlap, by place."""
    run: list[tuple] = []
    end = -1
    for d in sorted(found, key=lambda d: d[2]):
        if run and d[2] >= end:
            yield run
            run = []
        run.append(d)
        end = max(end, d[4])
    if run:
        yield run


def detections(padded: bytes) -> list[Detection]:
    """All rule matches in a normalised text with a blank at either end, after
    overlaps are resolved, in order of place."""
    candidates: set[int] = set()
    for _, ids in _automaton().iter(padded.decode("latin-1")):
        candidates.update(ids)
    found = []
    for i in sorted(candidates):
        rule = rules()[i]
        for m in rule.pattern.finditer(padded):
            found.append((-rule.priority, m.start() - m.end(), m.start(), i, m.end()))
    kept: list[tuple[int, int, int]] = []
    for cluster in _clusters(found):  # only detections that overlap can suppress each other
        winners: list[tuple[int, int, int]] = []
        for _, _, start, i, stop in sorted(cluster):
            if not any(a <= start and stop <= b for a, b, _ in winners):
                winners.append((start, stop, i))
        kept += winners
    kept.sort()
    blanks = blank_places(padded)
    before = np.searchsorted(blanks, [start for start, _, _ in kept])  # blanks before a detection and up to its end
    until = np.searchsorted(blanks, [stop for _, stop, _ in kept])
    return [
        Detection(rules()[i].label, rules()[i].priority, int(a) - 1, int(b - a) + 1)
        for (_, _, i), a, b in zip(kept, before, until, strict=True)
    ]


def blank_places(padded: bytes) -> np.ndarray:
    """Where a normalised text has its blanks: places become word numbers by
    binary search, so a text full of detections is not counted through anew."""
    return np.flatnonzero(np.frombuffer(padded, np.uint8) == 32)


_BASE = {label: re.compile(b"(?= " + phrase.encode() + b" )") for label, phrase in BASE_PHRASES.items()}
_BASE_WORDS = [phrase.encode() for phrase in BASE_PHRASES.values()]


def scan(text: bytes) -> tuple:
    """One text -> (n_words, n_base, first_word, last_word, base_labels,
    labels, score, detections)."""
    words = text.translate(WORDS).split()
    padded = b" " + b" ".join(words) + b" "
    places: list[int] = []
    base = set()
    for (label, pattern), phrase in zip(_BASE.items(), _BASE_WORDS, strict=True):
        if phrase in padded:
            at = [m.start() for m in pattern.finditer(padded)]
            if at:
                base.add(label)
                places += at
    found = detections(padded)
    word_of = lambda at: padded.count(b" ", 0, at + 1) - 1
    covered = sum(d.length for d in found)
    strongest = max((d.priority for d in found), default=0)
    # Strength of the best signature, raised by how much of the text is licence text.
    score = 0.0 if not found and not base else min(1.0, 0.2 * max(strongest, 2 if base else 0) + 0.2 * min(1.0, covered / max(1, len(words))))
    return (
        len(words),
        len(places),
        word_of(min(places)) if places else None,
        word_of(max(places)) if places else None,
        ",".join(sorted(base)),
        ",".join(sorted(base | {d.label for d in found})),
        score,
        found,
    )


_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("priority", pa.int32())])
_FIELDS = [
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
    ("detections", pa.list_(_SPAN)),
]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts, labels, score and the detections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(t) for t in batch.column(1).to_pylist()]
            cols = [batch.column(0)]
            for k, (name, kind) in enumerate(_FIELDS):
                values = [r[k] for r in rows]
                if name == "detections":
                    values = [[{"label": d.label, "start": d.start, "words": d.length, "priority": d.priority} for d in v] for v in values]
                cols.append(pa.array(values, kind))
            yield pa.RecordBatch.from_arrays(cols, [id_col, *(n for n, _ in _FIELDS)])

    picked = docs.select(id_col, text_of(text_col).alias("__text"))
    id_type = picked.schema[id_col].dataType.simpleString()
    return map_arrow(
        picked,
        run,
        f"`{id_col}` {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, detections array<struct<label:string,start:bigint,words:bigint,priority:int>>",
    )
