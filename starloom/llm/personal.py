"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over each text and finds anchors: at-signs,
plus signs before a digit, digits, schemes and identifier cues.  At each anchor
a small parser walks outwards as far as its kind of data reaches, cuts the
boundaries and validates what lies between.  No parser looks at a character
more than a fixed number of times, however long the text.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import small_batches, tidy
from starloom.llm.text import CHUNK, slices

# Kinds with a base definition, then those the cues add; the order breaks ties between spans of one start.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "ssn", "account")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DIGITS = "0123456789"
# What ends a dotted name, dotted digits, and digits with single gaps.
_DOMAIN_END = re.compile(r"\.\.|[^A-Za-z0-9.-]")
_DOTTED_END = re.compile(r"\.\.|[^0-9.]")
_CARD_END = re.compile(r"[ -][ -]|[^0-9 -]")
_PHONE_ZONE = re.compile(r"[ ().0-9-]+")
_AUTHORITY = re.compile(r"[^\s/?#\"'<>]+")
_REST = re.compile(r"[^\s\"'<>]*")
_DOT = re.compile(r" ?(?:\(dot\)|\[dot\]|\.| dot ) ?", re.IGNORECASE)
_LABEL = re.compile(r"[A-Za-z0-9-]{1,63}")
_AFTER_CUE = re.compile(r"(?:[ \t]{0,2}(?:numbers?|no\.?|nr\.?|id|code|is))?[ \t]{0,2}[:=#]?[ \t]{0,2}[\"']?", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"([0-9]{3})[- ]([0-9]{2})[- ]([0-9]{4})(?![0-9])")
_NUMBER = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9]|-(?=[A-Za-z0-9])){5,33}(?![A-Za-z0-9])")
_HANDLE = re.compile(r"@[A-Za-z_][A-Za-z0-9_]{2,29}(?![A-Za-z0-9_.@])")
_TEL = re.compile(r"[0-9](?:[-. ]?[0-9]){6,14}(?![0-9])")

# Words that announce an identifier, found in lower case, capitalised, or in upper case.
IBAN_CUES = ("iban",)
SSN_CUES = ("ssn", "social security")
ACCOUNT_CUES = ("account", "acct", "passport", "customer", "member", "user", "driver license", "tax")
HANDLE_CUES = ("twitter", "instagram", "telegram", "github", "mastodon", "handle", "username", "follow")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    found: dict[str, tuple[str, int]] = {"@": ("at", 1), "://": ("scheme", 3)}
    found |= {f"+{digit}": ("plus", 2) for digit in _DIGITS}
    found |= {digit: ("digit", 1) for digit in _DIGITS}
    cues = {"spelled": ("(at)", "[at]"), "tel": ("tel:",), "iban": IBAN_CUES, "ssn": SSN_CUES, "account": ACCOUNT_CUES, "handle": HANDLE_CUES}
    for what, words in cues.items():
        for word in words:
            found |= {form: (what, len(word)) for form in (word, word.capitalize(), word.upper())}
    automaton = ahocorasick.Automaton()
    for word, value in found.items():
        automaton.add_word(word, value)
    automaton.make_automaton()
    return automaton


def _until(end: re.Pattern, text: str, at: int) -> str:
    stop = end.search(text, at)
    return text[at:stop.start() if stop else len(text)]


def _domain(text: str, at: int) -> int:
    """End of the dotted name that begins at a place, -1 without one."""
    name = _until(_DOMAIN_END, text, at).rstrip(".")
    return at + len(name) if "." in name and name[0] != "." else -1


def _addresses(text: str, at: int) -> tuple[int, list[Span]]:
    """End of the dotted digits that begin at a place, and the addresses among them: each four parts make one."""
    run = _until(_DOTTED_END, text, at).rstrip(".")
    parts = run.split(".")
    found, start = [], at
    for i in range(0, len(parts) - 3, 4):
        end = start + sum(map(len, parts[i:i + 4])) + 3
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in parts[i:i + 4]):
            found.append(Span("ip", start, end, True))
        start = end + 1
    return at + len(run), found


def _card(text: str, at: int) -> tuple[int, list[Span]]:
    """End of the digits with single gaps that begin at a place, and the card number that they make."""
    run = _until(_CARD_END, text, at).rstrip(" -")
    digits = run.replace(" ", "").replace("-", "")
    good = 12 <= len(digits) <= 19 and luhn(digits)
    return at + len(run), [Span("card", at, at + len(run), True)] if good else []


def _phone(text: str, at: int) -> list[Span]:
    """The number that begins with the plus at a place."""
    zone = _PHONE_ZONE.match(text, at + 2)
    rest = zone.group().rstrip(" ().-") if zone else ""
    if len(rest) < 2 or not 9 <= 1 + sum(map(str.isdigit, rest)) <= 15:
        return []
    return [Span("phone", at, at + 2 + len(rest), True)]


def _url(text: str, first: int, at: int) -> list[Span]:
    """The URL around the ``://`` at a place, if it names a user; its scheme begins at ``first`` or later."""
    scheme = text[max(first, at - 32):at]
    start = at - len(scheme) + len(scheme.rstrip(_LOCAL.replace("%", "").replace("_", "")))
    authority = _AUTHORITY.match(text, at + 3)
    if start == at or not text[start].isalpha() or authority is None:
        return []
    user, sign, host = authority.group().rpartition("@")
    if not sign or not user or not host.rstrip(".,;:!?)]"):
        return []
    whole = _REST.match(text, authority.end())
    end = whole.end() - len(whole.group()) + len(whole.group().rstrip(".,;:!?)]"))
    if end == authority.end():
        end -= len(host) - len(host.rstrip(".,;:!?)]"))
    return [Span("url", start, end, False)]


def _spelled(text: str, first: int, at: int, size: int) -> list[Span]:
    """An address whose at-sign is spelled out, with dots as they are or spelled out too."""
    stop = at - (at > first and text[at - 1] == " ")
    local = text[max(first, stop - 64):stop]
    start = stop - len(local) + len(local.rstrip(_LOCAL))
    place = at + size + (text[at + size:at + size + 1] == " ")
    label, labels = _LABEL.match(text, place), 0
    end = place
    while label and labels < 16:
        end, labels = label.end(), labels + 1
        dot = _DOT.match(text, end)
        label = _LABEL.match(text, dot.end()) if dot else None
    return [Span("email", start, end, False)] if start < stop and labels > 1 else []


def _iban(text: str, at: int) -> list[Span]:
    found = _IBAN.match(text, at)
    while found:
        code = found.group().replace(" ", "")
        if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return [Span("iban", at, found.end(), False)]
        shorter = found.end() - 1  # the last characters may belong to the next word
        found = _IBAN.match(text, at, shorter) if shorter > at + 14 else None
    return []


def _ssn(text: str, at: int) -> list[Span]:
    found = _SSN.match(text, at)
    good = found and found[1] not in ("000", "666") and found[1] < "900" and found[2] != "00" and found[3] != "0000"
    return [Span("ssn", at, found.end(), False)] if good else []


def _account(text: str, at: int) -> list[Span]:
    found = _NUMBER.match(text, at)
    return [Span("account", at, found.end(), False)] if found and sum(map(str.isdigit, found.group())) >= 5 else []


def _handle(text: str, at: int) -> list[Span]:
    found = _HANDLE.match(text, at)
    return [Span("account", at, found.end(), False)] if found else []


def _tel(text: str, at: int) -> list[Span]:
    found = _TEL.match(text, at)
    return [Span("phone", at, found.end(), False)] if found else []


_AFTER = {"iban": _iban, "ssn": _ssn, "account": _account, "handle": _handle}


def spans(text: str) -> list[Span]:
    """All personal data of a text, by start, kind and end; places are code points, ends exclusive.

    Base spans of one kind do not overlap.  A span that a cue adds is left out
    if it lies in a base span or overlaps an added one that begins before it.
    """
    base, added = [], []
    email_end = last_at = digits_end = card_end = scheme_end = 0
    for last, (what, size) in _automaton().iter(text):
        at = last + 1 - size
        if what == "digit":
            if at >= digits_end:
                digits_end, found = _addresses(text, at)
                base += found
            if at >= card_end:
                card_end, found = _card(text, at)
                base += found
        elif what == "at":
            before = text[max(last_at, email_end):at]
            start = at - len(before) + len(before.rstrip(_LOCAL))
            end = _domain(text, at + 1) if start < at else -1
            if end > 0:
                base.append(Span("email", start, end, True))
                email_end = end
            last_at = at + 1
        elif what == "plus":
            base += _phone(text, at)
        elif what == "scheme":
            if at >= scheme_end:
                found = _url(text, scheme_end, at)
                added += found
                scheme_end = found[0].end if found else at + 3
        elif what == "spelled":
            added += _spelled(text, email_end, at, size)
        elif what == "tel":
            added += _tel(text, at + size)
        elif not text[at - 1:at].isalnum():
            gap = _AFTER_CUE.match(text, at + size)
            added += _AFTER[what](text, gap.end())
    return _merged(base, added)


def _merged(base: list[Span], added: list[Span]) -> list[Span]:
    order = {kind: number for number, kind in enumerate(KINDS)}
    kept, reach = [], -1
    holders, place, furthest = sorted(base, key=lambda s: s.start), 0, -1
    for span in sorted(set(added), key=lambda s: (s.start, order[s.kind], s.end)):
        while place < len(holders) and holders[place].start <= span.start:
            furthest = max(furthest, holders[place].end)
            place += 1
        if span.start >= reach and furthest < span.end:
            kept.append(span)
            reach = span.end
    return sorted(base + kept, key=lambda s: (s.start, order[s.kind], s.end))


def redacted(text: str, found: list[Span]) -> str:
    """The text with a mark of its kind, such as ``[EMAIL]``, for each run of overlapping spans."""
    parts, reach = [], 0
    for span in found:
        if span.start >= reach:
            parts += [text[reach:span.start], f"[{span.kind.upper()}]"]
        reach = max(reach, span.end)
    return "".join([*parts, text[reach:]])


def find(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", redact: bool = False
) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, spans`` and, with ``redact``, ``text`` without them, for every row.

    The counts are those of the base definitions; ``spans`` holds kind, start,
    end and whether a span is a base one, by start, then kind in the order of
    ``KINDS``, then end.  A null text is empty and stays null when redacted; an
    empty one has no spans.  Rows with a null or repeated id are rows like
    others, an empty table gives none, and further columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK):
            texts = batch.column("text").to_pylist()
            found = [spans(text) if text else [] for text in texts]
            counts = {
                f"n_{kind}": pa.array([sum(s.base and s.kind == kind for s in row) for row in found], pa.int64())
                for kind in BASE_KINDS
            }
            columns = {"doc_id": batch.column("doc_id"), **counts, "spans": pa.array([
                [span._asdict() for span in row] for row in found
            ], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])))}
            if redact:
                columns["text"] = pa.array([t and redacted(t, row) for t, row in zip(texts, found)], pa.string())
            yield pa.record_batch(columns)

    schema = "doc_id long, " + "".join(f"n_{kind} long, " for kind in BASE_KINDS) + (
        "spans array<struct<kind: string, start: long, end: long, base: boolean>>"
    )
    chosen = small_batches(documents).select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    return chosen.mapInArrow(tidy(scan), schema + ", text string" * redact)
