"""Base places against plain search; fuzzy notices against every window's edit distance."""

import random
import re

import pytest

from tests.llm.helpers import documents, prose
from visitlens.llm import notices as n

PHRASES = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = {k: [i for i in range(len(words)) if words[i:i + len(p)] == p] for k, p in PHRASES.items()}
    starts = [i for p in places.values() for i in p]
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(k for k, p in places.items() if p)))


TEXTS = [None, "", "CC BY-NC", "cc by cc by", "All rights\nRESERVED. all rights reserved", "éall rights reserved",
         "cc-by", "ccby", "GNU General Public License, v3", "Straße 中文 cc  by", "x" * 9_000, "cc by " * 2_000]


def test_base(spark):
    random.seed(1)
    parts = ["cc", "by", "all", "rights", "reserved", "general", "public", "license", " ", "-", "é", "\n", "x"]
    texts = TEXTS + ["".join(random.choice(parts) + random.choice(["", " "]) for _ in range(40)) for _ in range(100)]
    df = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    for r in n.notice_report(n.find_notices(df)).collect():
        want = brute(texts[r["doc_id"]])
        assert tuple(r)[1:6] == want
        assert set(want[4].split(",")) <= set(r["labels"].split(",")) or not want[4]
        assert 0 <= r["score"] <= 1


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def spoiled(phrase, errors, draw):
    text = list(phrase)
    for _ in range(errors):
        at = draw.randrange(len(text))
        kind = draw.choice("ids")
        text[at:at + (kind != "i")] = [] if kind == "d" else [draw.choice("abcxyz")]
    return "".join(text)


def test_every_notice_within_its_errors_is_found():
    draw, finder = random.Random(4), n.Finder(n.NOTICES)
    for notice in finder.notices:
        for errors in range(notice.errors + 1):
            for _ in range(15):
                text = f"{prose(draw.random(), 30)} {spoiled(notice.phrase, errors, draw)} {prose(draw.random(), 30)}"
                found = [s for s in finder.spans(text) if s[3] is notice]
                assert found, (notice, errors, text)
                for start, end, count, _ in found:
                    assert distance(text[start:end], notice.phrase) <= count <= notice.errors


def test_clean_prose_has_no_notice():
    finder = n.Finder(n.NOTICES)
    assert not [s for i in range(200) for s in finder.spans(prose(i, 300))]


def test_labels_scores_and_odd_tables(spark):
    df = documents(spark, [(1, "All rigths reserved.", "en", "s"), (1, "All rights reserved", "en", "s"), (None, "x", None, None)])
    rows = sorted(n.notice_report(n.find_notices(df)).collect(), key=lambda r: r["score"])
    assert [(r["doc_id"], r["labels"], r["base_labels"]) for r in rows] == [
        (None, "", ""), (1, "reserved", ""), (1, "reserved", "reserved")]
    assert rows[1]["score"] == pytest.approx(1 - 2 / 3) and rows[1]["spans"][0]["first_word"] == 0
    assert n.notice_report(n.find_notices(documents(spark, []))).count() == 0


def ends_within(text, phrase, errors):
    """(end, distance) of every place where the phrase ends within the errors, by dynamic programming over the whole text."""
    column, found = list(range(len(phrase) + 1)), []
    for end, c in enumerate(text, 1):
        last, column = column, [0]
        for j, p in enumerate(phrase, 1):
            column.append(min(column[-1] + 1, last[j] + 1, last[j - 1] + (c != p)))
        if column[-1] <= errors:
            found.append((end, column[-1]))
    return found


def test_notices_side_by_side_against_all_windows():
    """Every place within the errors is found, or overlaps a place that is; a better neighbour hides none."""
    draw, finder = random.Random(7), n.Finder({"reserved": "all rights reserved", "cc0": "creative commons zero"})
    assert [s[:3] for s in finder.spans("all rihts reserved by all rights reserved")] == [(0, 18, 1), (22, 41, 0)]
    for _ in range(40):
        parts = [spoiled(draw.choice(finder.notices).phrase, draw.randrange(4), draw) if draw.random() < 0.7
                 else draw.choice(["all", "reserved", "rights", "zero", "by"]) for _ in range(12)]
        text = " ".join(" ".join(parts).split())
        spans = finder.spans(text)
        for notice in finder.notices:
            mine = [s for s in spans if s[3] is notice]
            assert all(a[1] <= b[0] for a, b in zip(mine, mine[1:]))
            for end, errors in ends_within(text, notice.phrase, notice.errors):
                assert any(s[0] < end and s[1] > end - len(notice.phrase) - errors for s in mine), (text, notice.label, end)


def test_many_near_notices_take_linear_time():
    import time

    finder = n.Finder(n.NOTICES)
    text = "all rihts reserved " * 20_000
    start = time.time()
    found = n.scan(text, finder, n.BASE_PHRASES)
    assert len(found[5]) == 20_000 and time.time() - start < 30
    assert [s["first_word"] for s in found[5][:3]] == [0, 3, 6]
