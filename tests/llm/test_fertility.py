"""Quality rules against plain counting."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.helpers import documents, prose
from visitlens.llm import fertility as f

BLANKS = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(BLANKS, text)
    lines = [x for x in text.split("\n") if re.search(BLANKS, x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


TEXTS = [None, "", " \t\n\x0b\x0c\r", "a", "one\xa0word\x85\x1c  two", "x\n\nx\n x\n y \ny ", "a b " * 20,
         prose(1, 30) + "\n" + prose(1, 30), prose(2, 9) + " | # <b> *** $% && " + prose(2, 9), "𝒳é 中文 " * 30,
         "w" * 5_000, prose(3, 3_000)]


def test_measures(spark):
    random.seed(1)
    texts = TEXTS + ["".join(random.choice(["a", "b ", "\n", "#", " c", "\xa0", "é"]) for _ in range(random.randint(0, 80)))
                     for _ in range(80)]
    df = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    for row in f.judge(df).collect():
        want = brute(texts[row["doc_id"]])
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want
        assert row["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (row["kept"] and row["base_failed"])


def test_tokens_of_words():
    tokens = f.WordTokens(f.VOCABULARY, limit=3)
    words = ["Haus", "Straße", "中文字", "x", "ꙮ"]
    for text in (" ".join(words), " ".join(words[::-1])):
        n = sum(len(tokens.model.encode(w)) for w in words)
        single = sum(tokens.model.is_byte(i) for w in words for i in tokens.model.encode(w))
        measured = f.measure(text, tokens)
        assert measured[5] == pytest.approx(len("".join(words)) / n)
        assert measured[6] == pytest.approx(single / n) and single > 0
    assert len(tokens) <= 3


def test_bands_reject_junk_and_keep_the_clean(spark):
    clean = [(i, prose(i, 60 + i % 300), "en", "s") for i in range(300)]
    junk = [(1_000 + i, " ".join(w.upper() + "!!&&$$" for w in prose(i, 200).split()), "en", "s") for i in range(10)]
    other = [(2_000, prose(7, 50), None, "s"), (None, prose(8, 50), "xx", "s"), (2_000, prose(7, 50), None, "s")]
    df = documents(spark, clean + junk + other)
    rows = f.judge(df).collect()
    kept = [r["doc_id"] for r in rows if r["kept"]]
    assert len(rows) == 313 and not [d for d in kept if d is not None and 1_000 <= d < 2_000]
    assert {d[0] for d in clean} <= set(kept) and kept.count(2_000) == 2 and None in kept
    survivors = f.clean_documents(df)
    assert survivors.columns == df.columns
    assert sorted(map(str, (r["doc_id"] for r in survivors.collect()))) == sorted(map(str, kept))


def middle(values):
    return sorted(values)[math.ceil(len(values) / 2) - 1]


def brute_kept(rows):
    """The stated bands, group by group, from the measures of judged rows."""
    def band(group):
        found = {"_typical": middle([r["n_words"] for r in group])}
        for m, (_, least) in f.BANDS.items():
            centre = middle([r[m] for r in group])
            found[f"_c_{m}"] = centre
            found[f"_v_{m}"] = max(1.4826 * middle([abs(r[m] - centre) for r in group]), least) ** 2
        return found

    def leaning(group, prior):
        if not group:
            return prior
        own, w = band(group), len(group) / (len(group) + f.PRIOR)
        found = {k: w * own[k] + (1 - w) * prior[k] for k in own}
        for m in f.BANDS:
            found[f"_v_{m}"] += w * (1 - w) * (own[f"_c_{m}"] - prior[f"_c_{m}"]) ** 2
        return found

    passing = [r for r in rows if not r["base_failed"]]
    general, langs, scripts = band(passing), defaultdict(list), defaultdict(list)
    for r in passing:
        langs[r["lang"]].append(r)
        scripts[r["script"]].append(r)
    verdicts = []
    for r in rows:
        b = leaning(langs[r["lang"]], leaning(scripts[r["script"]], general))
        wider = math.sqrt(max(1.0, b["_typical"] / max(r["n_words"], 1)))
        verdicts.append(not r["base_failed"] and all(
            side * (r[m] - b[f"_c_{m}"]) <= f.SPREADS * wider * math.sqrt(b[f"_v_{m}"])
            for m, (sides, _) in f.BANDS.items() for side in sides))
    return verdicts


def foreign(seed, n):
    """Words of letters that the vocabulary has as bytes only."""
    draw = random.Random(seed)
    return " ".join("".join(chr(draw.randint(0x12000, 0x12300)) for _ in range(3)) for _ in range(n))


@pytest.mark.parametrize("n", [5, 99, 101])
def test_bands_against_brute_force(spark, n):
    main = [(i, prose(i, 40 + i % 200), "en", "s") for i in range(200)]
    few = [(1_000 + i, " ".join(prose(i, 90).title().split()), "xx", "s") for i in range(n)]
    cyrillic = [(2_000 + i, "".join(chr(0x430 + ord(c) % 32) if c != " " else c for c in prose(i, 60)), "yy", "s")
                for i in range(n // 2)]
    odd = [(3_000 + i, t, lang, "s") for i, (t, lang) in enumerate(
        [(prose(1, 300).upper(), "en"), (foreign(1, 80), "en"), (foreign(2, 80), "zz"), (prose(1, 2), "en"),
         (prose(3, 25), None), (None, "en"), ("\ud7ff" * 40, None)])]
    rows = f.judge(documents(spark, main + few + cyrillic + odd)).collect()
    assert [r["kept"] for r in rows] == brute_kept(rows)
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert {d[0] for d in main + few + cyrillic} <= kept  # clean ones stay, whatever their number
    assert {r["script"] for r in rows if r["lang"] == "yy"} == {"cyrillic"}


def test_each_measure_rejects_its_junk(spark):
    clean = [(i, prose(i, 100 + i % 200), "en", "s") for i in range(300)]
    words = prose(77, 8).split()
    draw = random.Random(5)
    junk = {"chars_per_token": " ".join(w.upper() + "!!&&$$" for w in prose(1, 200).split()),
            "byte_share": foreign(3, 150),
            "token_entropy": " ".join(draw.choice(words[:3]) for _ in range(200))}
    found = {r["doc_id"]: r for r in f.judge(documents(
        spark, clean + [(1_000 + i, t, "en", "s") for i, t in enumerate(junk.values())])).collect()}
    measured = spark.createDataFrame(list(found.values()))
    languages, scripts = f.learned_bands(measured)
    assert all(found[d[0]]["kept"] for d in clean)
    for i, m in enumerate(junk):
        alone = {k: v for k, v in f.BANDS.items() if k == m}
        row = languages.filter("_lang = 'en'").first()
        sides = alone[m][0]
        assert any(s * (found[1_000 + i][m] - row[f"_c_{m}"]) > f.SPREADS * math.sqrt(row[f"_v_{m}"]) for s in sides), m
        assert found[1_000 + i]["base_failed"] or not found[1_000 + i]["kept"]


def test_weight_grows_smoothly():
    own = {"_typical": 50.0} | {f"_{k}_{m}": 2.0 for m in f.BANDS for k in "cv"}
    prior = {"_typical": 90.0} | {f"_{k}_{m}": 1.0 for m in f.BANDS for k in "cv"}
    centres = [f.blend(own, prior, n / (n + f.PRIOR))["_c_byte_share"] for n in range(400)]
    steps = [b - a for a, b in zip(centres, centres[1:])]
    assert centres[0] == 1.0 and all(0 < s <= steps[0] for s in steps) and steps[98] < 0.002


def test_names_with_dots_and_no_passing_text(spark):
    df = spark.createDataFrame([(i, prose(i, 60), "en", "x", i) for i in range(30)],
                               "doc_id long, text string, lang string, `a.b` string, script int")
    clean = f.clean_documents(df)
    assert clean.columns == df.columns and clean.count() == 30
    assert {r["script"] for r in clean.collect()} == set(range(30))
    short = f.judge(documents(spark, [(1, "a b", "en", "s"), (2, None, None, None)])).collect()
    assert [r["kept"] for r in short] == [False, False]


def test_empty_table(spark):
    assert f.judge(documents(spark, [])).count() == 0
    assert f.clean_documents(documents(spark, [])).count() == 0


def test_words_keep_packed_ids():
    """Ids wait in the cache as four bytes each, not as lists of numbers."""
    tokens = f.WordTokens(f.VOCABULARY)
    for word in ("training", "данные", "\U0001f600x"):
        assert np.frombuffer(tokens[word.encode()], dtype=np.int32).tolist() == tokens.model.encode(word)
