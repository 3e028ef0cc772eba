"""Cascades are exact over their universe; rules against brute force."""

import random

import numpy as np

from visitlens.llm import url_cascade as uc


def members(spark, cascade, keys):
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    n = len(cascade.shards)
    rows = frame.select("key", uc.key_hash(frame.key).alias("h"), uc.key_shard(frame.key, n).alias("s")).collect()
    return {r["key"] for r in rows if cascade.contains(r["s"], np.array([r["h"]], dtype=np.int64))[0]}


def test_exact_over_the_universe(spark):
    keys = [f"host{i}" for i in range(6_000)]
    universe = spark.createDataFrame([(k,) for k in keys + keys[:50]] + [(None,)], "key string")
    for listed, bound in ((keys[:700], 1 << 20), (keys[:700], 200), (keys[:1], 1 << 20), ([], 1 << 20)):
        frame = spark.createDataFrame([(k,) for k in listed], "key string")
        cascade = uc.build_cascade(frame, universe, max_bytes=bound)
        assert (len(cascade.shards) > 1) == (bound == 200)
        assert members(spark, cascade, keys) == set(listed)


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block")]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3:]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(r, v) for r, v in RULES for h, p in [(r[:r.index("/")], r[r.index("/"):])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, rule, verdict


def test_pages_against_brute_force(spark):
    random.seed(3)
    hosts = ["example.com", "www.EXAMPLE.com", "a.www.example.com", "notexample.com", "b.net", "net", "C.net", "d.org",
             "com", "example.com.", "xcom", "", "é.net", "a:80"]
    ends = ["", "/", "/en/", "/en/1?x#y", "/es/2", "/fr/", "/EN/", "?q=/en/", "#/en/", "/en", "//en/", "/es/://x"]
    urls = [f"{s}{h}{p}" for s in ("http://", "", "://", "a://b://") for h in hosts for p in ends]
    urls += [None, "", "://", "x:/y"] + random.sample(urls, 50)
    df = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls)] + [(None, "http://b.net/es/", "c")],
                               "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    got = {r["page_id"]: r for r in uc.judge_pages(df, rules).collect()}
    want = {i: brute(u) for i, u in enumerate(urls)} | {None: brute("http://b.net/es/")}
    count, blocked = {}, {}
    for host, _, _, verdict in want.values():
        count[host] = count.get(host, 0) + 1
        blocked[host] = blocked.get(host, 0) + (verdict == "block")
    assert got.keys() == want.keys()
    for key, (host, path, rule, verdict) in want.items():
        bad = host != "" and 2 * blocked[host] >= count[host]
        assert tuple(got[key])[1:] == (host, path, rule, verdict or ("block" if bad else "allow")), urls[key or 0]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    assert uc.judge_pages(df, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/es/")], "page_id long, url string")
    assert [r["verdict"] for r in uc.judge_pages(one, rules.filter("false")).collect()] == ["allow"]


def test_short_list_in_a_large_universe(spark):
    """The error rate of the first level follows the ratio of the lists, and no shard is over the bound."""
    keys = [f"host{i}" for i in range(60_000)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    frame = spark.createDataFrame([(k,) for k in keys[:70]], "key string")
    cascade = uc.build_cascade(frame, universe, max_bytes=200)
    assert all(cascade.shard(i).n_bytes <= 200 for i in range(len(cascade.shards)))
    n = len(cascade.shards)
    rows = universe.select("key", uc.key_hash(universe.key).alias("h"), uc.key_shard(universe.key, n).alias("s")).toPandas()
    found = {k for s, part in rows.groupby("s") for k in part["key"][cascade.contains(s, part["h"].to_numpy())]}
    assert found == set(keys[:70])


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(uc, "key_hash", lambda key: uc.F.length(key).cast("long"))
    keys = [f"{i:03d}" for i in range(40)] + [f"{i:05d}" for i in range(60)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    frame = spark.createDataFrame([(k,) for k in keys[5:15]], "key string")
    cascade = uc.build_cascade(frame, universe)
    hashes = np.array([len(k) for k in keys], dtype=np.int64)
    assert [k for k, f in zip(keys, cascade.contains(0, hashes, keys)) if f] == keys[5:15]
    listed, _ = uc._contains_column(spark, cascade, 0)
    found = universe.select(uc.F.get(listed(uc.F.array("key")), uc.F.lit(0)).alias("k")).filter("k IS NOT NULL")
    assert sorted(r.k for r in found.collect()) == keys[5:15]


def test_pages_in_shards(spark):
    """Several shards, asked and released one by one, give the same verdicts."""
    hosts = [f"h{i}.{t}" for i in range(300) for t in ("com", "net")]
    df = spark.createDataFrame([(i, f"http://{h}/{'es' if i % 3 else 'en'}/") for i, h in enumerate(hosts)], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    whole, small = (sorted(map(tuple, uc.judge_pages(df, rules, max_bytes=b).collect())) for b in (1 << 20, 100))
    assert whole == small and {r[4] for r in whole} == {"allow", "block"}
