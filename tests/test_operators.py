"""Golden cases of the reference operators."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import dedup, enrich, gates, monitor, search
from tidemark.plans import catalog
from tidemark.plans.ingest import account, judge
from tidemark.sources import feeds
from tidemark.streaming.ingest import ingest


def one(spark, values, f, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(f(F.col("v"))).collect()]


def test_urls(spark):
    got = one(spark, ["HTTP://Ex.com/a/?utm_source=x&b=1&_=9#f", "https://ex.com/", "https://ex.com:443/a?x=&y=2", " not a url ", None, "https://ex.com/a/?redirect=z"], text.canonical_url)
    assert got == ["http://ex.com/a/?b=1", "https://ex.com", "https://ex.com/a?y=2", "not a url", None, "https://ex.com/a"]
    assert one(spark, ["https://a.b/x/Y/?q", "https://a.b"], text.last_segment) == ["y", ""]
    assert one(spark, ["https://a.b/x?_=12&y=1", "https://a.b/x?_=12"], text.strip_cache_bust) == ["https://a.b/x?y=1", "https://a.b/x"]


def test_html(spark):
    assert one(spark, ["<p>a <b>b</b></p><script>x<y</script> c&amp;d &#233;&#x41; &#0; &lt;"], text.html_to_text) == ["a b c&d éA &#0; <"]


def test_sections(spark):
    body = "\n".join(f"{i}. Heading number {i}\n" + "word " * 300 for i in (1, 2, 3))
    got = one(spark, [body, body[:3999], body.replace("3. H", "5. H")], text.sections)
    assert [s["number"] for s in got[0]] == [1, 2, 3] and got[0][1]["heading"] == "Heading number 2" and got[1] is None and got[2] is None


def test_failures(spark):
    assert one(spark, ["Status code 404", "fetch failed", "HTTP 429"], text.status_of) == [404, None, 429]
    assert one(spark, [403, 410, 429, 503, 418, None], text.failure_kind, "int") == ["forbidden", "not_found", "rate_limited", "server_error", "client_error", "network"]


@pytest.mark.parametrize(
    ("s", "want"),
    [
        ("April 20th, 2026", ["2026-04-20"]), ("16th of February 2026", ["2026-02-16", "2026-02-01"]), ("20-Apr-2026 Apr-21-2026", ["2026-04-20", "2026-04-21"]), ("2026/4/5", ["2026-04-05"]), ("13.04.2026 05-03-2026", ["2026-04-13", "2026-03-05"]),
        ("04/13/2026 05/03/2026 13/04/2026", ["2026-04-13", "2026-05-03", "2026-04-13"]), ("30 Feb 2026", ["2026-02-01"]), ("1 Jan 1989, 1 Jan 2101", []), ("Marine 2026", ["2026-03-01"]), ("2026-01-02 then March 4, 2026", ["2026-03-04", "2026-01-02"]), ("", []),
    ],
)
def test_all_dates(spark, s, want):
    assert [str(x) for x in one(spark, [s], dates.find_all_dates)[0]] == want


def test_date_choice(spark):
    kind = "array<struct<iso: string, source: string, confidence: string, step: int>>"
    rows = [[("a", "original", "high", None), ("b", "original", "high", 3)], [("a", "inferred", "high", 1), ("b", "original", "high", 9)], [], [(None, "original", "high", 1), ("c", None, None, None)]]
    assert [x and x["iso"] for x in one(spark, rows, dates.best_date, kind)] == ["b", "b", None, "c"]
    now = F.lit("2026-07-15 10:00:00").cast("timestamp")
    got = one(spark, ["Report June 2026", "July 2026", "Dec 2026", "none"], lambda c: dates.fallback_date(c, now))
    assert [x and (str(x["at"]), x["basis"]) for x in got] == [("2026-06-30 12:00:00", "title_month"), ("2026-07-15 10:00:00", "capture"), ("2026-07-15 10:00:00", "capture"), None]
    assert [str(x) for x in one(spark, ["D:20260304050607+02'00'", "D:2026", "x"], dates.pdf_date)] == ["2026-03-04 03:06:07", "2026-01-01 00:00:00", "None"]


def test_gate(spark):
    rows = [("A long vessel title", "You are using an outdated browser, please upgrade"), ("t", ""), ("t", "x" * 24), ("Grounding near Rotterdam harbour", "Nothing in this text overlaps at all, sorry."), ("Grounding near Rotterdam", "The grounding happened on Monday near Rotterdam."), ("t", "a" * 151 + " cookie policy")]
    df = spark.createDataFrame(rows, "t string, x string").select(gates.gate_reason(F.col("t"), F.col("x")))
    assert [r[0] for r in df.collect()] == ["boilerplate", "too-short", "too-short", "no-title-overlap", None, None]
    terms = ["Vestas", "Port of Tyne", "RIMPAC", "P&I", "EnBW", "lower case", "One Two Three Four", "according"]
    assert one(spark, terms, gates.proper_term) == [True] * 5 + [False] * 3
    df = spark.createDataFrame([("Onego sails", ["Onego Otra", "onego otra", "Onego", "Monday", "By Someone", "Dmitry Peskov", "YouTube"])], "t string, x array<string>")
    assert df.select(gates.filter_terms(F.col("t"), F.col("x"))).first()[0] == ["Onego Otra", "Dmitry Peskov"]


def test_article_reason(spark):
    long = "A vessel ran aground near the port and was refloated."
    rows = [("Seven77", long, ""), ("Read more ", long, ""), ("Articles", long, ""), ("A good title", long, "https://x.y/login"), ("A good title", "short", ""), ("A good title", "", "https://www.youtube.com/watch?v=1"), ("A good title", "This content is locked for members of the club", ""), ("A good title", "sign up to our newsletter for more", ""), ("A good title", "download " * 100, ""), ("A good title", long, None)]
    df = spark.createDataFrame(rows, "t string, e string, u string").select(gates.article_reason(F.col("t"), F.col("e"), F.col("u")))
    assert [r[0] for r in df.collect()] == ["title-short", "title-cta", "title-hub", "url-junk", "excerpt-short", None, "locked", "junk-phrase", "cta-dense", None]


def test_enrich(spark):
    rows = [("Tanker collision off Spain", "A tanker and a bulk carrier met.", None), ("Nothing", "at all here", "ports"), ("Nothing", "at all here", None), ("Seafarer news", "x", None)]
    df = spark.createDataFrame(rows, "t string, e string, h string")
    got = [r[0] for r in df.select(enrich.category(F.col("t"), F.col("e"), F.col("h"))).collect()]
    assert [(g["slug"], round(g["confidence"], 2)) for g in got] == [("accidents", 0.9), ("ports", 0.6), ("general", 0.3), ("crew", 0.7)]
    assert df.select(enrich.segments(F.col("t"), F.col("e"), F.lit("offshore"), F.lit("Container News"))).first()[0] == ["container", "offshore", "tanker", "dry_bulk"]
    m = df.select(gates.moderate(F.lit("Best video game builds"), F.lit("skill guide"))).first()[0]
    assert (m["decision"], m["reason"]) == ("hide", "spam")
    k = df.select(enrich.keywords(F.lit("Port of Hamburg strike"), F.lit("Hamburg Hamburg Vestas strike"))).first()[0]
    assert k == ["Port of Hamburg", "strike", "Hamburg Hamburg Vestas"]


def test_tags(spark):
    """Names are sought by broadcast words or through a shuffle, with the same results."""
    a, t = catalog.CASE_ARTS.frame(spark), catalog.CASE_TAGS.frame(spark)
    rows = [sorted(map(str, enrich.tag_details(a, t, "doc_id", most_tags=n).collect())) for n in (50_000, 0)]
    assert rows[0] == rows[1] and len(rows[0]) == 20
    got = {(r["doc_id"], r["slug"]): (r["score"], r["blocked"]) for r in enrich.tag_details(a, t, "doc_id").collect()}
    assert got[1, "grain-cargo"] == (6, None) and (2, "grain-cargo") not in got and got[6, "grain-cargo"][0] == 4 and got[7, "grain-cargo"][0] == 6
    assert got[10, "russia-sanctions"][1] == "requires one of: sanctions, price cap" and got[13, "ports"][1] == "title has a false-context phrase"
    assert (10, "t3") not in {tuple(r) for r in enrich.tag_ids(enrich.tag_details(a, t, "doc_id"), "doc_id").collect()}


def test_streaks_and_medians(spark):
    t0 = dt.datetime(2026, 1, 1)
    rows = [("a", i, t0 + dt.timedelta(hours=i), "success", 5 if i < 5 else 0, 0, "9 rejected" if i < 3 else None) for i in range(15)] + [("b", i, t0 + dt.timedelta(hours=i), "error", 0, 0, None) for i in range(3)]
    logs = spark.createDataFrame(rows, "source_id string, run_id int, started_at timestamp, status string, found long, new long, error string")
    b = {r["source_id"]: r for r in monitor.baselines(logs).collect()}
    assert (b["a"]["zero_streak"], b["a"]["error_streak"], b["a"]["median_found"], b["b"]["error_streak"]) == (10, 0, 0.0, 3)
    none = spark.createDataFrame([], "source_id string, published_at timestamp")
    f = {r["source_id"]: r["flags"] for r in monitor.flags(logs, none, F.lit("2026-02-01").cast("timestamp")).collect()}
    assert f == {"a": "SILENT_DEATH,SILENT,CHRONIC_REJECTION", "b": "ERROR_STREAK"}
    assert spark.createDataFrame([(1,), (2,), (3,), (4,)], "x long").select(monitor.upper_median(F.col("x"))).first()[0] == 3.0


def test_rules(spark):
    """Every rule fires on its own cases and not on those beside them."""
    got = {}
    for r in catalog.rule_cases(spark, "").collect():
        got.setdefault(r["rule"], set()).add(r["idx"])
    want = {"R1": {1}, "R2": {3, 4}, "R3": {5, 6}, "R4": {8, 9}, "R5": {10, 11}, "R6": {12, 13}, "R7": {14}, "R8": {17}, "R9": {19, 20}, "R10": {22, 23, 24}, "R11": {27, 28}, "R12": {31, 33}, "R13": {37, 38}, "R14": {41, 44}}
    assert {k: got.pop(k) for k in want} == want and got == {"R15": {35, 36, 37, 38, 40, 45, 47}}


def test_feeds(spark):
    rss = '<rss xmlns:media="http://search.yahoo.com/mrss/"><channel><item><title>T &amp;amp; U</title><link>https://a/1</link><description>&lt;p&gt;A body with more than thirty characters.&lt;/p&gt;</description><pubDate>x</pubDate><media:thumbnail url="i.png"/></item><item><title>no link</title></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>B</title><link href="https://a/2"/><summary>s</summary><updated>2026</updated></entry></feed>'
    df = spark.createDataFrame([("u", rss), ("v", atom), ("w", "broken <"), ("x", None)], "feed_url string, payload string")
    got = sorted((r["link"], r["title"], r["excerpt"], r["published"], r["image"]) for r in feeds.feed_items(df).collect())
    assert got == [("https://a/1", "T & U", "A body with more than thirty characters.", "x", "i.png"), ("https://a/2", "B", "B", "2026", None)]
    p = spark.createDataFrame([("s", json.dumps([{"id": 1, "link": "l", "date_gmt": "2026-01-02T03:04:05", "title": {"rendered": "A &#8211; b"}, "excerpt": {"rendered": "<p>e</p>"}, "content": {"rendered": "c"}}]))], "site string, payload string")
    assert tuple(feeds.posts(p).first())[3:6] == ("A – b", "", "2026-01-02T03:04:05Z")
    m = spark.createDataFrame([("i", "<sitemap><loc>a</loc><lastmod>2026-01-01</lastmod></sitemap><sitemap><loc>b</loc><lastmod>2026-02-01</lastmod></sitemap>")], "sitemap_url string, payload string")
    assert feeds.freshest_child(m).first()["child"] == "b"


def test_page():
    html = '<html><head><title>T</title><meta property="og:image" content="i"><script type="application/ld+json">{"@graph":[{"datePublished":"2026-01-01"}]}</script></head><body><nav><p>' + "n" * 90 + '</p></nav><article><h1>Head</h1><p>' + "a" * 50 + "</p><p>" + "b" * 50 + '</p><a href="/x">x</a></article></body></html>'
    title, body, image, *_, ld, _, _, links = feeds.read_page(html)
    assert (title, body, image, ld, links) == ("Head", "a" * 50 + "\n" + "b" * 50, "i", "2026-01-01", ["/x"])
    assert feeds.read_page(None)[1] is None


def test_pages_are_parsed_in_bounded_pieces(spark, monkeypatch):
    """Of a large batch no more than a run of pages is held as Python objects, and none is lost."""
    import pyarrow as pa

    from tidemark.sources import pages

    df, kept, seen, own = spark.createDataFrame([], "page_id long, html string"), [], [], feeds.read_page
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: kept.append(run))
    monkeypatch.setattr(feeds, "read_page", lambda h: seen.append(h) or own(h))
    feeds.page_details(df)
    html = [None if i % 7 == 0 else f"<h1>{i}</h1>" + "x" * (3 << 20) * (i == 500) for i in range(1000)]
    out, ids, titles = kept[0](iter([pa.RecordBatch.from_pydict({"page_id": list(range(1000)), "html": html})])), [], []
    for b in out:
        assert b.num_rows <= 256 and len(seen) == len(ids) + b.num_rows
        ids, titles = ids + b.column("page_id").to_pylist(), titles + b.column("title").to_pylist()
    assert ids == list(range(1000)) and titles == [None if i % 7 == 0 else str(i) for i in range(1000)]
    x = pa.RecordBatch.from_pydict({"h": ["abcd", "abcdefghij", None, "a", "b", "c"]}).slice(1)
    assert [p.column("h").to_pylist() for p in pages.pieces(x, "h", 2, 5)] == [["abcdefghij"], [None, "a"], ["b", "c"]]
    assert list(pages.pieces(x.slice(0, 0), "h")) == []


def test_page_ids_stay_as_they_are(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, "<h1>a</h1>"), (None, "<h1>b</h1>")], "page_id long, html string").coalesce(1)
    assert {(r["page_id"], r["title"]) for r in feeds.page_details(df).collect()} == {(big, "a"), (None, "b")}


def test_dedup_and_search(spark):
    x = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, k string")
    assert sorted(r[0] for r in dedup.unknown(x, spark.createDataFrame([("a",), (None,)], "k string"), "k").select("id").collect()) == [3, 4]
    assert [r["id"] for r in dedup.repeats(x, ["k"], ["id"]).collect()] == [2]
    r = spark.createDataFrame([("q", 1, 5), ("q", 2, 9)], "query string, id int, published_at int")
    e = spark.createDataFrame([("q", 1), ("q", 7)], "query string, expected_id int")
    assert sorted(tuple(x) for x in search.recall(r, e).collect()) == [("q", 1, True, 2), ("q", 7, False, -1)]


def test_coverage_gap_counts_pages_as_its_sql(spark, tmp_path):
    import duckdb

    urls = ["https://a.b/1?x=1", "https://a.b/1?x=1", "https://a.b/1?x=1#f", "https://a.b/2?y=1", "https://a.b/3", "https://a.b/3?utm_source=x", None]
    for name, some, want in (("all", urls, (4, 2)), ("none stored", [u for u in urls if u != "https://a.b/3"], (6, 3))):
        d = str(tmp_path / name)
        spark.createDataFrame(list(enumerate(some)), "page_id long, url string").withColumn("html", F.lit("")).write.parquet(f"{d}/pages.parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{d}/pages.parquet/*.parquet')")
        assert [tuple(r) for r in catalog.coverage_gap(spark, d).collect()] == con.execute(catalog.SQL["coverage_gap"]).fetchall() == [want]


def test_coverage_gap_is_by_source(spark):
    live = spark.createDataFrame([("s", "h1", "u1"), ("s", "h1", "u1"), ("t", "h1", "u1"), ("t", "h2", "u2")], "source_id string, url_hash string, url string")
    stored = spark.createDataFrame([("t", "h2")], "source_id string, url_hash string")
    assert sorted((r["source_id"], r["url"]) for r in dedup.coverage_gap(live, stored).collect()) == [("s", "u1"), ("t", "u1")]


def test_pipeline_accounts_for_every_row(spark):
    rows = [("s", "n", "https://a/1", "A collision of two tankers", "Two tankers collided near the port of Hamburg today.", "2026-01-01", None, "aggregator"), ("s", "n", "https://a/2", "Short", "x", None, None, "trusted"), ("s", "n", "https://a/3", "A title that is fine", "An excerpt of more than thirty characters.", None, None, "trusted")]
    raw = spark.createDataFrame(rows, "source_id string, source_name string, url string, title string, excerpt string, published_at string, category_hint string, trust string")
    j = judge(raw)
    assert sorted(r[0] for r in j.select("outcome").collect()) == ["inserted", "rejected_no_date", "rejected_quality"]
    a = account(j).first()
    assert (a["found"], a["inserted"], a["unexplained"], a["status"]) == (3, 1, 0, "success")


def test_stream_equals_batch(spark, tmp_path):
    landed, store = str(tmp_path / "in"), str(tmp_path / "store")
    for i, urls in enumerate((["https://a/1", "https://a/2"], ["https://a/2?utm_source=x", "https://a/3"])):
        spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1).write.mode("append").parquet(landed)
        ingest(spark, landed, "url string", store, str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(store).count() == (2, 3)[i]
    assert sorted(r[0] for r in spark.read.parquet(store).select("url").collect()) == ["https://a/1", "https://a/2", "https://a/3"]


def test_source_state_over_batches(spark, tmp_path):
    """Streaks go on from batch to batch, and a late run doesn't end them."""
    from tidemark.streaming.ingest import track_sources

    kind, landed = "source_id string, started_at timestamp, status string, found long", str(tmp_path / "runs")
    hour = lambda h: dt.datetime(2026, 1, 1, h)
    for rows in ([("a", hour(1), "success", 4), ("a", hour(2), "error", 0)], [("a", hour(3), "error", 0), ("b", hour(3), "success", 0), ("a", hour(0), "success", 9)]):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(landed)
    q = track_sources(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(landed)).writeStream.format("memory").queryName("state").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["source_id"]: (r["runs"], r["zero_streak"], r["error_streak"], r["peak_found"]) for r in spark.table("state").orderBy("runs").collect()}
    assert got == {"a": (4, 2, 2, True), "b": (1, 1, 0, False)}


def test_apply_reads_back_what_it_wrote(spark, tmp_path):
    from tidemark.operators import outcomes

    x = spark.createDataFrame([(f"https://a/{i}", f"s{i % 2}", "T", dt.datetime(2026, 1, 1), "rss_pubdate", "high", "would_insert" if i < 4 else "rejected") for i in (0, 1, 2, 2, 3, 5)], "url string, source_id string, title string, published_at timestamp, published_at_source string, published_at_confidence string, decision string")
    x = x.withColumn("url_hash", text.url_hash(F.col("url")))
    store, audit = str(tmp_path / "store"), str(tmp_path / "audit")
    first = outcomes.apply_report(x.filter("url <> 'https://a/3'"), store, audit + "1", "b1")
    again = outcomes.apply_report(x, store, audit + "2", "b2")
    assert first == {"attempted": 4, "inserted": 3, "skipped": 1, "failed": 0} and again == {"attempted": 5, "inserted": 1, "skipped": 4, "failed": 0}
    assert outcomes.apply_report(x, store, audit + "2", "b2") == again  # repeated, it writes the same
    assert [r["url"] for r in spark.read.json(audit + "2").collect()] == ["https://a/3"]


def test_patterns_are_tried_wherever_they_can_match(spark):
    """The words that can begin a pattern lose no match: each pattern against texts made from itself."""
    import random
    import re as regex

    from tidemark.functions import lexicons as L

    rng = random.Random(5)
    every = [p for _, ps in L.CATEGORIES.values() for p in ps] + L.MARITIME + L.SPAM + L.CTA + L.LOCKED + L.JUNK_PHRASES
    simple = lambda p: regex.sub(r"[\\^$~=]", "", regex.sub(r"\(\?:([^|()]*)[^()]*\)", r"\1", p))
    texts = [f"x {simple(p).replace('s*', ' ').replace('s+', ' ').replace('?', '')} y" for p in every] + [" ".join(rng.choices("tanker port sinks sinking imo IMO 12,345 teu crude carrier P&I oil spill mepc 80 sign up alert".split(), k=6)) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    f = text.Finder(every)
    got = df.select("t", text.let(f.read(F.col("t")), lambda x: F.array(*[f.has(x, p) for p in every])).alias("g"), F.array(*[F.col("t").rlike(L.java_pattern(p)) for p in every]).alias("w")).collect()
    assert all(r["g"] == r["w"] for r in got) and sum(map(sum, (r["w"] for r in got))) > 300
