"""License scan: ordered signature rules over normalised words.

A keyword prefilter over all texts of a batch finds the few that may mention a
license; only there the rules run, each only if its words occur.  Of the
detections, one that lies inside another of higher priority, or inside a longer
one of the same priority, is dropped.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import small_batches, tidy
from starloom.llm.license_rules import BASE_PHRASES, GRANT_PREPOSITIONS, GRANT_VERBS, Rule, rules
from starloom.llm.text import _LOWER, ALNUM, CHUNK, slices, text_bytes, words

_BLANK, _END = 0x20, 0x0A
_NORMAL = np.where(ALNUM, _LOWER, np.uint8(_BLANK)).astype(np.uint8)
# A text that has none of these byte strings has no rule's words either.
PREFILTER = (
    b"licen", b"spdx", b"copyright", b"creative commons", b"cc by", b"cc0", b"public domain", b"gpl", b"all rights reserved",
    b"without any warranty", b"without warranty", b"hereby granted", b"permission to use", b"redistribution and use",
    b"proprietary and", b" cc ", b"openrail", b"apache 2 0",
    *(f"{verb} {preposition}".encode() for verb in GRANT_VERBS for preposition in GRANT_PREPOSITIONS),
)
BASE_CONFIDENCE = 0.95


def normalised(data: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All texts as lower-case words with one blank between them, each ended by a newline, and where they begin."""
    text = np.insert(_NORMAL[data], bounds[1:], _END)
    kept = text != _BLANK
    kept[1:] |= (text[:-1] != _BLANK) & (text[:-1] != _END)
    text = text[kept]
    return text.tobytes(), np.concatenate([[0], np.flatnonzero(text == _END) + 1])


def _occurrences(text: bytes, what: bytes) -> list[int]:
    found, at = [], text.find(what)
    while at >= 0:
        found.append(at)
        at = text.find(what, at + 1)
    return found


def _uncontained(start: np.ndarray, end: np.ndarray, priority: np.ndarray) -> np.ndarray:
    """Which intervals lie in no interval of higher priority and in no other, longer one of the same."""
    kept = np.zeros(len(start), bool)
    for level in np.unique(priority):
        own = np.flatnonzero(priority == level)
        above = np.flatnonzero(kept)
        above = above[np.argsort(start[above], kind="stable")]
        reach = np.maximum.accumulate(end[above]) if len(above) else above
        before = np.searchsorted(start[above], start[own], side="right") - 1
        free = (before < 0) | (reach[before] < end[own]) if len(above) else np.ones(len(own), bool)
        own = own[free]
        own = own[np.lexsort((-end[own], start[own]))]
        if len(own):
            reach = np.concatenate([[-1], np.maximum.accumulate(end[own])[:-1]])
            equal = np.concatenate([[False], (start[own][1:] == start[own][:-1]) & (end[own][1:] == end[own][:-1])])
            covered = reach >= end[own]
            for i in np.flatnonzero(equal):  # the same words may carry several labels of one priority
                covered[i] = covered[i - 1]
            kept[own[~covered]] = True
    return kept


def detections(text: bytes, by_word: dict[bytes, list[Rule]]) -> list[tuple[int, int, str, float]]:
    """(first word, word after the last, label, confidence) in one normalised text, suppressed ones left out."""
    have = set(text.split())
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == _BLANK)
    found = []
    for rule in {id(rule): rule for word in have for rule in by_word.get(word, ())}.values():
        if rule.gate and rule.gate not in have:
            continue
        found += [
            (*match.span(), rule.priority, rule.label, rule.confidence)
            for match in rule.regex.finditer(text) if rule.must in match.group()
        ]
    if not found:
        return []
    start = np.searchsorted(breaks, [f[0] for f in found], side="right")
    end = np.searchsorted(breaks, [f[1] for f in found], side="left") + 1
    kept = _uncontained(start, end, np.array([f[2] for f in found]))
    return sorted({(int(start[i]), int(end[i]), found[i][3], found[i][4]) for i in np.flatnonzero(kept)})


def scan(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """License findings of every text, whole texts, one row per row.

    ``doc_id, n_words, n_base, first_word, last_word`` and ``base_labels``
    describe the base phrases; ``labels`` adds the rules' labels, ``findings``
    has the detections left after suppression, ``score`` is the highest
    confidence among all, 0 without any.  A null text is empty; texts without a
    finding have empty label strings and null words.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word = defaultdict(list)
        for rule in rules():
            for word in rule.keywords:
                by_word[word].append(rule)
        for batch in slices(batches, "text", CHUNK):
            data, bounds = text_bytes(batch.column("text"))
            _, _, counts = words(data, bounds, ALNUM)
            text, begin = normalised(data, bounds)
            places = defaultdict(list)
            for phrase, label in BASE_PHRASES.items():
                for at in _occurrences(text, phrase.encode()):
                    after = text[at + len(phrase)]
                    if (at == 0 or text[at - 1] in (_BLANK, _END)) and after in (_BLANK, _END):
                        doc = int(np.searchsorted(begin, at, side="right")) - 1
                        places[doc].append((text.count(b" ", begin[doc], at), label))
            hits = np.array(sorted({at for word in PREFILTER for at in _occurrences(text, word)}), np.int64)
            docs = set(np.unique(np.searchsorted(begin, hits, side="right") - 1).tolist()) | set(places)
            rows = {}
            for doc in docs:
                found = detections(text[begin[doc]:begin[doc + 1] - 1].rstrip(), by_word)
                at = sorted(word for word, _ in places[doc])
                base = {label for _, label in places[doc]}
                score = max([f[3] for f in found] + [BASE_CONFIDENCE] * bool(at), default=0.0)
                rows[doc] = (
                    len(at), at[0] if at else None, at[-1] if at else None, ",".join(sorted(base)),
                    ",".join(sorted(base | {f[2] for f in found})), score,
                    [dict(zip(("first_word", "end_word", "label", "confidence"), f)) for f in found],
                )
            nothing = (0, None, None, "", "", 0.0, [])
            parts = list(zip(*[rows.get(doc, nothing) for doc in range(batch.num_rows)]))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(np.diff(counts)),
                **{
                    name: pa.array(part, kind)
                    for (name, kind), part in zip(kinds.items(), parts)
                },
            })

    kinds = {
        "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(),
        "labels": pa.string(), "score": pa.float64(),
        "findings": pa.list_(pa.struct([
            ("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("confidence", pa.float64()),
        ])),
    }
    return small_batches(documents).select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(
        tidy(find),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, findings array<struct<first_word: long, end_word: long, label: string, confidence: double>>",
    )
