"""The ten operators against brute-force versions, on small and awkward tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import binpack, golay, langid, matroska, mixing, packing, quality, queries, secretscan, sharding, simhash, topk, urlfilter

KIND = "doc_id long, text string, lang string, source string, n_chars long, DOC_ID string, `te.xt` string"
SF = "/root/testdata/sf0.001"


def docs(spark, rows, kind=KIND):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], kind)


def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, clashing extra columns."""
    en, long = "the quick brown fox jumps over the lazy dog and runs away from it", "word and other " * 20_000
    rows = [(1, en, "en", "a", 5), (1, en, "en", "a", 5), (2, "", "en", "a", 0), (3, None, None, None, None), (None, en, None, "b", 1), (4, long, "en", "b", 9), (5, "!!! ... ???", "en", "a", 9), (6, "Ελληνικά κείμενα here and there", None, "c", 9)]
    return docs(spark, rows)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables(spark, empty):
    d = odd(spark).limit(0) if empty else odd(spark)
    lab = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 1), (None, 1, 1), (9, None, 0)], "doc_id long, quality int, toxic int")
    ask = spark.createDataFrame([(1, "lazy dog"), (1, "lazy dog"), (2, None), (3, ""), (4, "zzz")], "item_id long, text string")
    pages = spark.createDataFrame([(1, "http://a.b/c"), (1, "http://a.b/c"), (2, None), (3, ""), (None, "a.b")], "page_id long, url string")
    n = {k: v.count() for k, v in {
        1: sharding.shard_documents(d), 2: matroska.packets(matroska.with_media(d)), 3: topk.search(ask, d), 4: mixing.mix_sources(d), 5: packing.pack_documents(d), 7: simhash.near_duplicates(d), 8: langid.identify(d), 9: quality.classify(d, lab), 10: secretscan.find_secrets(d),
    }.items()}
    if empty:
        assert set(n.values()) == {0}
        pages = pages.limit(0)
    else:
        assert (n[1], n[9], n[3]) == (8, 8, 6) and n[2] >= 8 and n[5] >= 5
    entries = spark.createDataFrame([("a.b/c",)], "entry string").union(urlfilter.standing_list(pages))
    x = urlfilter.filter_urls(pages, urlfilter.build(entries)).collect()
    assert [r["blocked"] for r in x] == ([] if empty else [True, True, False, False, False])
    for stage in (langid.keep_known, simhash.keep_one, secretscan.redact):
        assert stage(d).columns == d.columns and stage(d).count() <= 8


def test_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(300):
        cap = rng.randint(1, 60)
        items = [rng.randint(0, cap + 3) for _ in range(rng.randint(0, 60))]
        s, c = np.unique(items, return_counts=True) if items else (np.zeros(0, int), np.zeros(0, int))
        rows, bins = binpack.best_fit_decreasing(s, c, cap)
        assert bins == binpack.naive(items, cap)
        fill: dict[int, int] = {}
        for size, lo, hi, first, per in rows:
            for k in range(lo, hi):
                fill[first + (k - lo) // per] = fill.get(first + (k - lo) // per, 0) + size
        assert sum(fill.values()) == sum(items) and all(v <= cap or v in items for v in fill.values())
        assert binpack.lower_bound(s, c, cap) <= max(bins, 1)


def test_sharding_and_packing(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    size = {r[0]: r[1] for r in d.select("doc_id", F.octet_length("text")).collect()}
    s = sharding.shard_documents(d, 20_000).toPandas()
    assert sorted(s.doc_id) == sorted(size) and s.groupby("group_key").shard_id.nunique().max() == 1
    groups = s.drop_duplicates("group_key")
    own = groups.groupby("shard_id").group_bytes.sum()
    assert ((own <= 20_000) | groups.set_index("shard_id").oversized.groupby("shard_id").all()).all()
    assert groups.shard_id.nunique() == binpack.naive(groups.group_bytes.tolist(), 20_000)
    for rows in (50_000, 40):
        p = packing.pack_documents(d, 4096, rows).toPandas()
        assert p.groupby("doc_id")["size"].sum().to_dict() == {k: v for k, v in size.items() if v}
        for _, g in p.groupby("pack_id"):
            g = g.sort_values("pack_offset")
            assert (g.pack_offset == g["size"].cumsum() - g["size"]).all() and g["size"].sum() <= 4096
        assert (p.part_bound <= p.part_packs).all()


def test_media_round_trip(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: (r["text"] or "").encode() for r in d.collect()}
    got = matroska.packets(matroska.with_media(d)).toPandas()
    for i, g in got.groupby("doc_id"):
        file = matroska.text_file(i, text[i])
        if text[i]:
            parts = [file[a : a + n] for a, n in zip(g.start.astype(int), g["size"].astype(int), strict=True)]
            assert b"".join(parts) == text[i] and [zlib.crc32(x) for x in parts] == g.crc32.astype(int).tolist()
    assert set(got.doc_id) == set(text)


@pytest.mark.parametrize("lacing", [0, 1, 3])
def test_matroska(lacing):
    rng = random.Random(lacing)
    for n in range(60):
        parts = [rng.randbytes(rng.choice([0, 1, 254, 255, 256, 1000, 70_000])) for _ in range(rng.randint(1, 12))]
        f = matroska.mux(parts, lacing, rng.randint(1, 5) if lacing else 1, per_cluster=rng.randint(1, 4), grouped=n % 2 == 0, unknown=n % 3 == 0)
        state, got = matroska.parse(f)
        assert state == "ok" and [f[x[10] : x[10] + x[11]] for x in got] == parts and [x[6] for x in got] == [40_000_000 * i for i in range(len(parts))]
        assert [x[9] for x in got] == [x[8] and x[4] == 0 for x in got]  # each cluster's first block is a keyframe and has the cue
        cut = matroska.parse(f[: len(f) - 3])
        assert cut[0] == "damaged" and cut[1] and [x[:9] for x in cut[1]] == [x[:9] for x in got[: len(cut[1])]]
    assert matroska.parse(b"RIFF....") == ("not matroska", []) and matroska.parse(None) == ("empty", [])


def test_topk_bounds():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, k = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(1, 6))):
            d = rng.permutation(n)[: int(rng.integers(1, n + 1))]
            w = np.sort(rng.integers(1, 6, len(d)))[::-1]
            lists.append((d, w))
            total[d] += w
        found, score = topk.best(lists, n, np.arange(n), k, step=int(rng.integers(1, 20)))
        want = [i for i in np.lexsort((np.arange(n), -total)) if total[i]][:k]
        assert found.tolist() == want and score.tolist() == total[want].tolist()


def test_mixing_rates(spark):
    rows = [(i, "x" * (10 if i % 2 else 40), "en", "small" if i % 2 else "large", 1) for i in range(4000)]
    m = mixing.mix_sources(docs(spark, rows), {"small": 1.0, "large": 1.0}).groupBy("source").count().collect()
    n = {r[0]: r[1] for r in m}
    assert abs(n["small"] / 5000 - 1) < 0.06 and abs(n["large"] / 1250 - 1) < 0.08
    x = mixing.mix_sources(docs(spark, rows)).toPandas()
    again = mixing.mix_sources(docs(spark, rows[::-1]).repartition(3)).toPandas()
    key = ["doc_id", "copy_no"]
    assert x.sort_values(key)[key].values.tolist() == again.sort_values(key)[key].values.tolist()


def test_mixing_large_rates(spark):
    """A small source meets its target weight however often it must repeat."""
    import math

    rows = [(i, "x", "en", "tiny", 1) for i in range(4)] + [(9, "y" * 20_000, "en", "large", 1)]
    n = {r[0]: r[1] for r in mixing.mix_sources(docs(spark, rows), {"tiny": 1.0, "large": 1.0}).groupBy("source").count().collect()}
    assert abs(n["tiny"] / 10_002 - 1) < 0.06
    for m in (701.5, 5500.0, 250_000.0):
        first, cdf = mixing.large_cdf(m)
        p = np.diff(cdf, prepend=0.0)
        for k in (int(m), int(m + 2 * math.sqrt(m)), int(m - 3 * math.sqrt(m))):
            assert p[k - first] == pytest.approx(math.exp(-m + k * math.log(m) - math.lgamma(k + 1)), rel=1e-6)


def test_url_filter(spark):
    entries = spark.createDataFrame([("bad.com",), ("x.org/a",), ("y.org/p?q=1",), (None,), ("",), ("bad.com",)], "entry string")
    urls = ["http://WWW.bad.com/z", "https://x.org/a/b?c", "x.org/ab", "http://y.org/p?q=1#f", "http://y.org/p?q=2", "http://notbad.com", "ftp://u@bad.com:21/"]
    got = urlfilter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), urlfilter.build(entries, 2)).orderBy("page_id").collect()
    assert [r["entry"] for r in got] == ["bad.com", "x.org/a", None, "y.org/p?q=1", None, None, "bad.com"]
    s = object.__new__(urlfilter.Shard)  # two entries with one key: the stored text decides
    s.keys, s.offs, s.text = np.array([5, 5, 9]), np.array([0, 1, 2, 3]), np.frombuffer(b"abc", np.uint8)
    assert s.holds(np.array([5, 5, 5, 9]), lambda i: [b"a", b"b", b"z", b"a"][i]).tolist() == [True, True, False, False]


def test_golay():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 23, 400).astype(np.uint32)
    for a, b in [(i, j) for i in range(23) for j in range(i)][::7]:
        w = v ^ np.uint32(1 << a | 1 << b)
        for keys in ((golay.near(v), golay.near(w)),):
            (r1, k1), (r2, k2) = keys
            sets = [set() for _ in range(400)], [set() for _ in range(400)]
            for r, k, s in ((r1, k1, sets[0]), (r2, k2, sets[1])):
                for i, x in zip(r, k, strict=True):
                    s[i].add(int(x))
            assert all(x & y for x, y in zip(*sets, strict=True))


def test_simhash_recall(spark):
    import pyarrow as pa

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null").toPandas()
    fp = simhash.fingerprints(pa.array(d.text))
    i, j = simhash.close_pairs(fp, 52)
    lab = simhash.labels(len(d), i, j)
    want = {int(d.doc_id[k]) for k in np.flatnonzero(lab != np.arange(len(d)))}
    for together in (1, 2):
        got = {r[0] for r in simhash.near_duplicates(spark.createDataFrame(d), together=together).select("doc_id").collect()}
        assert got <= want and len(got) >= 0.9 * len(want)


def test_simhash_crowded_keys(spark):
    """One key scheme at every size: crowded keys are split and lose nothing."""
    import inspect

    assert inspect.signature(simhash.near_duplicates).parameters["together"].default == 1
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted(map(tuple, simhash.near_duplicates(d).collect()))
    assert want and sorted(map(tuple, simhash.near_duplicates(d, crowd=20).collect())) == want
    rng = np.random.default_rng(5)
    fp = rng.integers(0, 1 << 63, (40, 4)).astype(np.uint64)
    row, key = simhash.key_rows(fp, 1)
    row, place = simhash.places(row, key, np.arange(40), {int(k): 3 for k in np.unique(key)[::2]})
    met = {(int(a), int(b), int(p) & 0xFFFF) for p in np.unique(place) for a in row[place == p] for b in row[place == p]}
    r, k = simhash.key_rows(fp, 1)
    assert met == {(int(a), int(b), int(p)) for p in np.unique(k) for a in r[k == p] for b in r[k == p]}


def test_viterbi():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = rng.integers(0, 7, 5)
        score, first = rng.normal(size=(int(n.sum()), 3)).astype(np.float32) * 3, np.cumsum(n) - n
        got = langid.viterbi(score, first, n, 2.0)
        for f, m in zip(first, n, strict=True):
            value = lambda path, f=f: sum(float(score[f + t, s]) for t, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:], strict=False))
            best = max((value(p) for p in np.ndindex(*[3] * int(m))), default=0)
            assert value(tuple(got[f : f + m])) == pytest.approx(best, abs=1e-4)


def test_language_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    x = langid.spans_of(d, langid.train(d, 60)).toPandas()
    main = x.sort_values("words").groupby("doc_id").tail(1).merge(d.select("doc_id", F.col("lang").alias("true")).toPandas(), on="doc_id")
    assert (main[main.words >= 20].lang == main[main.words >= 20].true).mean() > 0.97
    text = "the of and that with this for " * 5 + "der die und nicht mit sich auf " * 5
    e = langid.spans_of(docs(spark, [(1, text, "", "", 0)]), langid.train(d, 60)).orderBy("span_no").collect()
    assert [r["lang"] for r in e] == ["en", "de"]


def test_language_stage_decides(spark):
    """Labelled documents stay in every script; letter junk and untrained Latin languages go."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    greek = "Ελληνικά κείμενα για τη δοκιμή"
    rows = [(50_001, "xqzv kjhw pqrt zxcv bnmk wqxz", None, "a", 1), (50_002, "to jest przykład tekstu po polsku który nie należy do zbioru danych", None, "a", 1), (50_003, greek, "el", "a", 1), (50_004, "Русский текст без пометки", None, "a", 1)]
    both = d.union(spark.createDataFrame(rows, d.schema))
    got = {r[0] for r in corpus_pipeline.language_id(spark, both, SF).select("doc_id").collect()}
    assert {x for x in got if x > 50_000} == {50_003}
    lettered = {r[0] for r in d.filter(F.col("text").rlike("[A-Za-z]")).select("doc_id").collect()}
    assert len(lettered - got) <= 0.002 * len(lettered)
    bare = docs(spark, [(1, greek, None, "a", 1), (2, "plain text", None, "a", 1), (3, "...", None, "a", 1)])
    assert {r[0] for r in corpus_pipeline.language_id(spark, bare, SF).collect()} == {1, 2}


def test_quality_held_out(spark):
    from tidemark.llm.common import table

    sf = "/root/testdata/sf0.1"
    lab = table(spark, sf, "labels")
    x = quality.classify(table(spark, sf, "documents"), lab.filter("doc_id % 2 = 0")).join(lab.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "is_toxic"), "doc_id").toPandas()
    assert (x.good == (x.quality == 1)).mean() > 0.94
    assert x[x.is_toxic == 0].toxic.mean() < 0.02 and x[x.is_toxic == 1].toxic.mean() > 0.4  # two in five labels are on texts without a sign


def test_secrets(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    import re

    planted = {(r["doc_id"], m.start(1), m.end(1)) for r in d.collect() for m in re.finditer(r'token = "([0-9a-f]{40})', r["text"] or "")}
    got = {(r["doc_id"], r["start"], r["end"]) for r in secretscan.find_secrets(d).collect()}
    assert planted and planted <= got and len(got) <= 1.2 * len(planted)
    clean = secretscan.redact(d)
    assert clean.columns == d.columns and clean.count() == d.count() and not clean.filter(F.col("text").rlike('token = "[0-9a-f]{40}')).count()


def test_one_secret_among_words(spark):
    """p-values have no floor: a class of ordinary tokens doesn't hide the one that is certain."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    import re

    base = [re.sub("[0-9A-Fa-f]{40}", "", r["text"]) for r in d.filter("text is not null").collect()]
    words = [w for t in base[:300] for w in t.split() if w.isalpha() and w.isascii()]
    rng = random.Random(4)
    slugs = [s[:47].strip("-") for s in ("-".join(rng.choices(words, k=14)) for _ in range(600))]
    draw = lambda n, of: "".join(rng.choices(of, k=n))
    rows = [(i, f"see {s} there", "en", "a", 1) for i, s in enumerate(slugs)] + [(9000, f"key {draw(40, '0123456789abcdef')} end", "en", "a", 1)]
    rows += [(2000 + i, "a long " + "".join(rng.choices(words, k=6))[:17] + " word", "en", "a", 1) for i in range(900)]
    rows += [(9001 + i, f"key {draw(16, secretscan.SYMBOLS[:62])} end", "en", "a", 1) for i in range(3)]
    rows += [(20_000 + i, t, "en", "a", 1) for i, t in enumerate(base)]
    got = {(r["doc_id"], r["start"], r["end"]) for r in secretscan.find_secrets(docs(spark, rows)).collect()}
    planted = {x for x in got if 9000 <= x[0] <= 9003}
    assert (9000, 4, 44) in planted and len(planted) >= 3 and len(got - planted) <= 2  # text can imitate a 16-character key


def test_p_values_are_the_simulated_ones():
    """Where plain draws can tell, importance sampling gives their p-values; further out it goes on falling."""
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 50, (67, 66)).astype(float) ** 2
    null, other = secretscan.null_of(counts, seed=1), secretscan.null_of(counts, draws=60_000, seed=2)
    for n in (16, 40):
        at = np.quantile(null[n][0], [0.5, 0.9])
        assert np.allclose(secretscan.p_values(null[n], at), secretscan.p_values(other[n], at), rtol=0.1)
        assert 0 < secretscan.p_values(null[n], np.array([-1.0]))[0] < 1e-4


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF).toPandas()
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:  # again, stage by stage
        d = stage(spark, d, SF)
        if name != "best-fit packing":
            assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            d = spark.createDataFrame(d.toPandas(), d.schema)
    key = ["doc_id", "copy", "piece", "size"]
    assert sorted(map(tuple, out[key].values.tolist())) == sorted(map(tuple, d.toPandas()[key].values.tolist()))


def test_every_operator_is_registered():
    assert [k.split("_")[0] for k in queries.queries()] == [f"op{i}" for i in range(1, 11)]
