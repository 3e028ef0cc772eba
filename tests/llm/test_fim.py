"""Fill-in-middle forms against a plain version; frames of a few units, so that cuts, markers and parts cross them."""

import hashlib

import zstandard

from tests.llm.helpers import documents, prose
from visitlens.llm import fim


def plain_version(doc_id, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        form, out = "plain", text
    elif h4 % 100 < 20:
        form, out = "spm", f"<S>{text[high:]}<P>{text[:low]}<M>{text[low:high]}"
    else:
        form, out = "psm", f"<P>{text[:low]}<S>{text[high:]}<M>{text[low:high]}"
    cut = form != "plain"
    return (doc_id, n, form, low if cut else None, high - low if cut else None, out)


def odd_texts():
    texts = [None, "", "a", "<", "<<", "x<P>y", "<S", "P>", "M><S", "ends with <", "é" * 40, "日本語🎉\n" * 30, prose(1, 400),
             prose(2, 400), "<P" * 50, "S>" * 50, "\x00\r\n" * 9]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts * 6)]
    return rows + [(None, "no id " * 20, None, None), (None, "no id " * 20, None, None), (-5, "minus " * 9, "en", "a")]


def test_forms_against_plain_version(spark):
    rows = odd_texts()
    docs = documents(spark, rows)
    expected = sorted((plain_version(r[0], r[1]) for r in rows), key=str)
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    for units in (1, 7, fim.FRAME_UNITS):
        arranged = fim.arrange(fim.draw(fim.store(docs, units=units)))
        got = [tuple(r) for r in fim.output_texts(arranged).select(
            "doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()]
        assert sorted(got, key=str) == expected
        sums = sorted((str(r.doc_id), r.output_sha256, r.restored_sha256) for r in fim.digests(arranged).collect())
        assert sums == sorted((str(e[0]), hashlib.sha256(e[5].encode()).hexdigest(),
                               hashlib.sha256((r[1] or "").encode()).hexdigest())
                              for r in rows for e in [plain_version(r[0], r[1])])


def test_only_cut_frames_are_opened(spark):
    """Whole frames of the store are found again in the output, byte for byte, and the output is one stream."""
    docs = documents(spark, [(i, prose(i, 3000), "en", "a") for i in range(8)])
    stored = {r.doc_id: r for r in fim.store(docs, units=500).collect()}
    for row in fim.arrange(fim.draw(fim.store(docs, units=500))).collect():
        before = stored[row.doc_id]
        assert before.ends[-1] == before.n and len(before.frames) == len(before.ends)
        kept = sum(bytes(f) in [bytes(o) for o in row.frames] for f in before.frames)
        assert kept >= len(before.frames) - 2
        stream = b"".join(map(bytes, row.frames))
        text = zstandard.ZstdDecompressor().stream_reader(stream, read_across_frames=True).read().decode()
        assert text == plain_version(row.doc_id, prose(row.doc_id, 3000))[5]


def test_written_store_and_empty_table(spark):
    docs = documents(spark, odd_texts())
    assert fim.digests(fim.fill_in_middle(docs)).count() == len(odd_texts())
    assert fim.digests(fim.fill_in_middle(docs.limit(0))).collect() == []


def test_very_long_text(spark):
    text = "word " * 400_000
    row = fim.digests(fim.arrange(fim.draw(fim.store(documents(spark, [(3, text, "en", "a")]))))).first()
    expected = plain_version(3, text)
    assert (row.n, row.form) == expected[1:3]
    assert row.output_sha256 == hashlib.sha256(expected[5].encode()).hexdigest()
    assert row.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
