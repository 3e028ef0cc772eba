"""The pipeline against brute force, stage by stage, on invented documents with planted cases."""

import random

import numpy as np

import corpus_pipeline
from tests.llm.helpers import prose
from tests.llm.test_fertility import brute as counts
from tests.llm.test_mixing import targets
from tests.llm.test_neardup import brute as groups
from tests.llm.test_neardup import edited
from visitlens.llm import mixing, packing
from visitlens.llm.notices import words_of


def written(spark, tmp_path, rows):
    draw = random.Random(11)
    items = {i: prose(20_000 + i, 25) for i in range(8)}
    documents = [(i, prose(i, draw.randint(25, 200)), "en", f"s{i % 4}", 0) for i in range(rows)]
    documents += [(1_000 + i, prose(i, 5), "en", "s0", 0) for i in range(10)]  # too short
    documents += [(2_000 + i, "again and again " * 30, "en", "s1", 0) for i in range(5)]  # repeats itself
    documents += [(3_000 + i, edited(documents[i][1], 1, draw), "en", "s2", 0) for i in range(20, min(60, rows))]
    documents += [(4_000 + i, f"{prose(50_000 + i, 60)} {items[i % 8]} {prose(60_000 + i, 30)}", "fr", "s3", 0)
                  for i in range(16)]
    documents += [(5_000, None, None, None, None), (5_001, "", "en", "s0", 0)]
    folder = str(tmp_path)
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def test_stages(spark, tmp_path):
    folder, items = written(spark, tmp_path, 300)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder)
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        after = docs.collect()
        if name != "pack":
            assert docs.columns == columns
        ids = sorted(r["doc_id"] for r in after) if name != "pack" else []
        if name == "quality":
            kept = [r["doc_id"] for r in before if (c := counts(r["text"]))[0] >= 20 and 100 * c[4] <= 30 * c[0]]
            assert ids == sorted(kept)
        elif name == "near_dedup":
            rows = [(r["doc_id"], r["text"]) for r in before]
            assert ids == sorted(int(d) for d, _, c in groups(rows, corpus_pipeline.NEAR_PERCENT) if d == c)
        elif name == "decontaminate":
            item_words = [b" " + b" ".join(words_of(t)) + b" " for t in items.values()]
            clean = [r["doc_id"] for r in before if not any(
                w in b" " + b" ".join(words_of(r["text"])) + b" " for w in item_words)]
            assert ids == sorted(clean) and len(clean) < len(before)
        elif name == "mix":
            sizes, taken = {}, {}
            for r in before:
                sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
            for r in after:
                taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
            for source, target in targets(sizes).items():
                assert abs(taken.get(source, 0) - target) <= 0.02 * target + 60
            assert max(ids.count(i) for i in ids) <= mixing.MAX_COPIES
        else:
            encoder = packing.Encoder()
            want = sorted((r["doc_id"], encoder.encoding.encode_ordinary(r["text"]) + [packing.END]) for r in before)
            pieces = {}
            for r in after:
                found = np.frombuffer(r["ids"], dtype="<u2").tolist()
                for doc, piece, a, b in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:]):
                    pieces.setdefault(doc, []).append((piece, found[a:b]))
            assert all(p == 0 for some in pieces.values() for p, _ in some)  # no text here is longer than a row
            assert sorted((d, ids) for d, some in pieces.items() for _, ids in some) == want
        before = after
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(r["n_tokens"] for r in before)


def test_empty_tables(spark, tmp_path):
    folder, _ = written(spark, tmp_path, 0)
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
