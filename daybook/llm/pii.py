"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds anchors: at-signs, plus
signs, digits, dots before digits, URL schemes and cues such as "IBAN". At each a
local parser grows the span to its boundaries and validates it. Anchors are
visited from left to right and a parser never looks behind the end of the last
span of its kind, so spans of a kind do not overlap and the work is linear.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in the order in which spans with one start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "userinfo", "iban", "ssn")

DIGITS = "0123456789"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")

SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)
_SPANS_DDL = "spans array<struct<kind: string, start: bigint, end: bigint>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _email(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    n, end, labels = len(text), at + 1, 0
    if start == at:
        return None
    while True:
        label = end
        while end < n and text[end] in DOMAIN:
            end += 1
        if end == label:
            end = label - 1  # the dot before it does not belong to the address
            break
        labels += 1
        if end == n or text[end] != ".":
            break
        end += 1
    return (start, end, True) if labels >= 2 else None


_IP = re.compile(r"\.([0-9]+)\.([0-9]+)\.([0-9]+)")


def _ip(text: str, dot: int, floor: int) -> tuple[int, int, bool] | None:
    start = dot
    while start > floor and text[start - 1] in DIGITS:
        start -= 1
    rest = _IP.match(text, dot) if start < dot else None
    if rest is None:
        return None
    parts = [text[start:dot], *rest.groups()]
    small = all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in parts)
    return start, rest.end(), small


_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")


def _card(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    found = _CARD.match(text, at)
    if found is None:
        return None
    digits = found.group().replace(" ", "").replace("-", "")
    return at, found.end(), 12 <= len(digits) <= 19 and luhn(digits)


_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _phone(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    found = _PHONE.match(text, at)
    if found is None:
        return None
    return at, found.end(), 9 <= sum(c in DIGITS for c in found.group()) <= 15


_AUTHORITY = re.compile(r"://([^\s/?#@:<>\"']+)(?::[^\s/?#@<>\"']*)?@[^\s/?#@<>\"']+")


def _userinfo(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    """A URL that names a user before its host."""
    start = at
    while start > floor and (text[start - 1].isascii() and text[start - 1].isalpha()):
        start -= 1
    found = _AUTHORITY.match(text, at)
    return (start, found.end(), True) if found and start < at else None


_IBAN = re.compile(r"IBAN[\x20:]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)\b")


def _iban(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    found = _IBAN.match(text, at)
    if found is None:
        return None
    code = found.group(1).replace(" ", "")
    number = "".join(str(int(c, 36)) for c in code[4:] + code[:4])
    return found.start(1), found.end(1), 15 <= len(code) <= 34 and int(number) % 97 == 1


_SSN = re.compile(r"SSN[\x20:#]{0,3}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])")


def _ssn(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    found = _SSN.match(text, at)
    if found is None:
        return None
    return found.start(1), found.end(1), found.group(1)[:3] not in ("000", "666")


_Parser = Callable[[str, int, int], "tuple[int, int, bool] | None"]
ANCHORS: dict[str, list[tuple[str, _Parser]]] = {
    "@": [("email", _email)],
    "+": [("phone", _phone)],
    "://": [("userinfo", _userinfo)],
    "IBAN": [("iban", _iban)],
    "SSN": [("ssn", _ssn)],
    **{digit: [("card", _card)] for digit in DIGITS},
    **{f".{digit}": [("ip", _ip)] for digit in DIGITS},
}


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for anchor, parsers in ANCHORS.items():
        found.add_word(anchor, (len(anchor), parsers))
    found.make_automaton()
    return found


def find_spans(text: str, anchors) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then kind."""
    ends = dict.fromkeys(KINDS, 0)
    spans = []
    for last, (length, parsers) in anchors.iter(text):
        at = last - length + 1
        for kind, parse in parsers:
            if at < ends[kind]:
                continue
            found = parse(text, at, ends[kind])
            if found is not None:
                start, end, valid = found
                ends[kind] = end
                if valid:
                    spans.append((start, KINDS.index(kind), end))
    return [(KINDS[kind], start, end) for start, kind, end in sorted(spans)]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for batch in batches:
        rows = [
            [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(text or "", anchors)]
            for text in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, SPANS)], names=["doc_id", "spans"]
        )


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of personal data in the whole text of every row.

    Takes ``doc_id`` and ``text``; other columns are ignored. A null or empty text
    has no spans; rows that repeat are answered one by one; an empty table gives
    no rows. Beside the four base kinds, it finds URLs that name a user, and
    account numbers after the cues "IBAN" and "SSN".
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_run, f"doc_id long, {_SPANS_DDL}")


def listed(spans: Column, kinds: tuple[str, ...]) -> Column:
    """The spans of these kinds as kind:start:end, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(
        ",", F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
