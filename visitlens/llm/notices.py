"""Licence notices in texts, with up to a few typing errors each.

A notice of which at most k characters are wrong, missing or too many still has one of k + 1 pieces intact
(pigeonhole). One automaton finds the pieces of all notices in a text; around each, the ``regex`` library
decides whether the whole notice stands there within k errors, and where. Notices are allowed one error
per ``CHARS_PER_ERROR`` characters and ``MAX_ERRORS`` at most: the search is for short notices, and the
cost of the library's matching grows steeply with the errors.

Texts are compared as words: A-Z lower-cased, everything but digits, a-z and characters beyond ASCII
taken as a gap. Exact places of the base phrases are counted besides.

Defined results: null and empty texts have no words and no notices; repeated rows and null ids keep their
rows; other columns are ignored. Texts are handled one at a time, whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHARS_PER_ERROR = 9
MAX_ERRORS = 3
ROWS = 512
BASE_PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
# Opening words of public licences and usual short notices.
NOTICES = {
    "apache": "licensed under the apache license",
    "bsd": "redistribution and use in source and binary forms",
    "cc0": "creative commons zero",
    "cc-by": "creative commons attribution",
    "gpl": "gnu general public license",
    "lgpl": "gnu lesser general public license",
    "mit": "permission is hereby granted free of charge",
    "mpl": "mozilla public license",
    "public-domain": "released into the public domain",
    "reserved": "all rights reserved",
}
SPANS = "array<struct<label:string,first_word:int,n_words:int,errors:int,allowed:int,found:string>>"
# A-Z to a-z; digits, a-z and all bytes of characters beyond ASCII stay; the rest is a gap.
_GAPS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


@dataclass(frozen=True)
class Notice:
    label: str
    phrase: str

    @property
    def errors(self) -> int:
        return min(MAX_ERRORS, len(self.phrase) // CHARS_PER_ERROR)

    @property
    def pieces(self) -> list[tuple[int, str]]:
        """k + 1 consecutive pieces of about equal length with their places."""
        n = self.errors + 1
        cuts = [len(self.phrase) * i // n for i in range(n + 1)]
        return [(a, self.phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Finder:
    """The automaton of all pieces and a pattern per notice."""

    def __init__(self, notices: dict[str, str] | list[tuple[str, str]]):
        items = notices.items() if isinstance(notices, dict) else notices
        self.notices = [Notice(label, phrase) for label, phrase in items]

    @cached_property
    def patterns(self) -> list:
        return [regex.compile(rf"(?b)(?:{regex.escape(n.phrase)}){{e<={n.errors}}}") for n in self.notices]

    @cached_property
    def automaton(self):
        import ahocorasick

        places: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(self.notices):
            for at, piece in notice.pieces:
                places.setdefault(piece, []).append((number, at))
        automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            automaton.add_word(piece, (len(piece), where))
        automaton.make_automaton()
        return automaton

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per notice, the stretches in which it could lie. Pieces that point to about the same place share a stretch,
        which is never much longer than the notice, whatever stands beside it."""
        starts: dict[int, set[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for number, at in where:
                starts.setdefault(number, set()).add(end - length + 1 - at)
        found: dict[int, list[list[int]]] = {}
        for number, places in starts.items():
            notice, mine = self.notices[number], found.setdefault(number, [])
            for place in sorted(places):
                low, high = max(0, place - notice.errors), min(len(text), place + len(notice.phrase) + notice.errors)
                if mine and place - mine[-1][2] <= 2 * notice.errors:
                    mine[-1][1] = high
                else:
                    mine.append([low, high, place])
        return found

    def spans(self, text: str) -> list[tuple[int, int, int, Notice]]:
        """(start, end, errors, notice) of each notice in a text of words joined by single blanks. Of places of one
        notice that overlap, the one with fewest errors stays, then the first."""
        result = []
        for number, stretches in self.windows(text).items():
            notice, matches = self.notices[number], set()
            for low, high, _ in stretches:
                at = text.find(notice.phrase, low, high)
                if at >= 0:
                    matches.add((0, at, at + len(notice.phrase)))
                else:
                    matches.update((sum(m.fuzzy_counts), m.start(), m.end())
                                   for m in self.patterns[number].finditer(text, low, high))
            taken: list[tuple[int, int]] = []  # disjoint, in order
            for errors, start, end in sorted(matches):
                at = bisect_left(taken, (start, end))
                if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
                    taken.insert(at, (start, end))
                    result.append((start, end, errors, notice))
        return sorted(result, key=lambda s: (s[0], s[1], s[3].label))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_GAPS).split()


def exact_places(joined: bytes, phrase: str) -> list[int]:
    """Word numbers at which the phrase's words stand, in ``joined`` with a blank before each word and at the end."""
    target, places, at, word, counted = b" " + phrase.encode() + b" ", [], -1, 0, 0
    while (at := joined.find(target, at + 1)) >= 0:
        word += joined.count(b" ", counted, at)
        counted = at
        places.append(word)
    return places


def scan(text: str, finder: Finder, phrases: dict[str, str]) -> tuple:
    """n_words, n_base, first_word, last_word, base labels, spans."""
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" " if words else b""
    places = {label: exact_places(joined, phrase) for label, phrase in phrases.items()}
    starts = [p for some in places.values() for p in some]
    plain = joined[1:-1].decode("utf-8", "surrogatepass")
    spans, word, counted = [], 0, 0
    for start, end, errors, notice in finder.spans(plain):
        begin = start + (plain[start] == " ")
        word += plain.count(" ", counted, begin)  # the start before is never later, but for a leading blank
        counted = begin
        spans.append({"label": notice.label, "first_word": word, "n_words": len(plain[start:end].split()), "errors": errors,
                      "allowed": notice.errors, "found": plain[start:end]})
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            sorted(label for label, some in places.items() if some), spans)


def find_notices(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", notices=None,
                 phrases=None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels and spans of every document."""
    finder = Finder(NOTICES if notices is None else notices)
    phrases = BASE_PHRASES if phrases is None else phrases
    # Tasks build the automaton themselves; only labels and phrases travel.
    items = [(n.label, n.phrase) for n in finder.notices]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Finder(items)
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "spans"]
        span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32()),
                                   ("errors", pa.int32()), ("allowed", pa.int32()), ("found", pa.string())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), span]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = zip(*[scan(t or "", mine, phrases) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, type=t) for c, t in zip(found, types))], names)

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, "
                                f"n_base long, first_word long, last_word long, base_labels array<string>, spans {SPANS}")


def notice_report(found: DataFrame) -> DataFrame:
    """Labels joined by comma, and the best score: 1 for an exact notice, less by its share of errors."""
    score = F.array_max(F.transform("spans", lambda s: 1 - s["errors"] / (s["allowed"] + 1)))
    labels = F.array_sort(F.array_distinct(F.concat(
        "base_labels", F.transform("spans", lambda s: s["label"]))))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", labels).alias("labels"),
        F.when(F.size("base_labels") > 0, 1.0).otherwise(F.coalesce(score, F.lit(0.0))).alias("score"), "spans")
