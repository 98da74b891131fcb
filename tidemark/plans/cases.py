"""Queries whose expected rows are written out: the edges of each function as literal inputs, with results worked out by hand from
the rules, so that query and SQL share nothing. And the store's operators over the generated tables, with SQL of their own."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import dates, pdf, text
from tidemark.functions import lexicons as L
from tidemark.operators import enrich, gates, lookups, monitor, outcomes, search
from tidemark.plans.catalog import ART, HASH, LOGS, QUERIES, SQL, any_re, articles, logs, now, query, table
from tidemark.plans.ingest import judge
from tidemark.plans.literal import Cases, Literal
from tidemark.sources import feeds, pages, registry


def cases(name: str, kind: str, f, rows: list[tuple]) -> None:
    c = Cases(kind, f, rows)
    QUERIES[name], SQL[name] = c.query, c.sql


def expect(name: str, kind: str, rows: list[tuple]):
    """A query whose whole result is the rows given."""

    def add(f):
        QUERIES[name], SQL[name] = f, "WITH " + Literal(kind, rows).sql("x") + " SELECT * FROM x"
        return f

    return add


def at(s: str) -> Column:
    return F.lit(s).cast("timestamp")


NOON = "2026-07-15 10:00:00"
shown = lambda a: F.array_join(F.transform(a, lambda d: d.cast("string")), ",")

cases("url_cases", "url string", text.canonical_url, [
    ("HTTP://Ex.com/a/?utm_source=x&utm_medium=y&utm_campaign=z&utm_term=t&utm_content=c&fbclid=1&gclid=2&b=1&_=9#f", "http://ex.com/a/?b=1"), ("https://ex.com/", "https://ex.com"), ("https://ex.com:443/a?x=&y=2", "https://ex.com/a?y=2"), (" not a url ", "not a url"), (None, None),
    ("https://ex.com/a/?redirect=z", "https://ex.com/a"), ("https://ex.com/a?q=b%20c&r=d~e", "https://ex.com/a?q=b+c&r=d%7Ee"), ("https://ex.com/a b/ü", "https://ex.com/a%20b/%C3%BC"), ("https://ex.com/a/../b/./c", "https://ex.com/b/c"), ("https://ex.com/a/b/..", "https://ex.com/a"), ("https://ex.com/a?x", "https://ex.com/a"),
    ("https://ex.com/a?b=1&b=2#x?y", "https://ex.com/a?b=1&b=2"), ("https://EX.com/A?Q=Z", "https://ex.com/A?Q=Z"), ("https://ex.com?x=1", "https://ex.com?x=1"),
])
cases("cache_bust_cases", "url string", text.strip_cache_bust, [("https://a.b/x?_=12&y=1", "https://a.b/x?y=1"), ("https://a.b/x?_=12", "https://a.b/x"), ("https://a.b/x?y=1&_=3", "https://a.b/x?y=1"), ("https://a.b/x?my_=3", "https://a.b/x?my_=3")])
cases("html_cases", "html string", text.strip_html, [("foo<script>1</script>bar", "foobar"), ("a<style>b</style>c <i>d</i>", "ac d"), ("<p>a</p><p>b</p>", "a b"), ("x <SCRIPT src='y'>\nz</SCRIPT>w", "x w"), ("", ""), (None, None), ("a < b and c > d", "a d")])
cases("entity_cases", "html string", text.html_to_text, [("<p>a &amp; b&nbsp;c</p>", "a & b c"), ("&#233;&#x41;&lt;x&gt;&quot;&#39;", "éA<x>\"'"), ("&amp;lt;", "&lt;"), ("&#0;x", "&#0;x")])
cases("description_cases", "desc string", text.trim_description, [("Ship news today.\n#ship #sea\nmore", "Ship news today."), ("A\n0:00 intro", "A"), ("A\nTwitter: @x", "A"), ("A\nSubscribe to us", "A"), ("A\n-----\nB", "A"), ("A\n--\nB", "A\n--\nB"), ("A #one #two", "A #one #two"), ("A\nJoin our list\nPatreon: y", "A"), ("A\nMarine Traffic\nlink", "A"), ("A\nChapters: 1", "A")])
cases("excerpt_cases", "body string, feed string", text.build_excerpt, [("x" * 201, "feed", "x" * 201), ("x" * 200, "feed", "feed"), ("short", "", "short"), ("", "feed", "feed")])
cases("slug_cases", "name string", text.slugify, [("Gard & Sons P&I", "gard-and-sons-pandi"), ("--A  b!--", "a-b"), ("Übersee 9", "bersee-9")])
cases("segment_path_cases", "url string", text.last_segment, [("https://a.b/x/Y/?q=/z", "y"), ("https://a.b", ""), ("https://a.b/a//b//#c", "b")])
cases("like_cases", "s string", text.escape_like, [("50%_a\\b", "50\\%\\_a\\\\b"), ("plain", "plain")])
cases("status_cases", "error string", lambda e: F.concat_ws("/", text.status_of(e).cast("string"), text.failure_kind(text.status_of(e))), [
    ("Status code 404", "404/not_found"), ("fetch failed", "network"), ("Status code 403", "403/forbidden"), ("HTTP 410", "410/not_found"), ("HTTP 429", "429/rate_limited"), ("status: 503", "503/server_error"), ("Status code 418", "418/client_error")])
cases("reach_cases", "status int, error string", lookups.reachability, [(200, None, "ok"), (403, None, "forbidden"), (503, None, "blocked"), (429, None, "blocked"), (418, None, "blocked"), (None, "ECONNRESET", "network"), (302, None, "other"), (None, None, "other")])
cases("status_of_run_cases", "found long, inserted long, ai long, peak boolean", lambda f, i, a, p: monitor.run_status(f, i, a, p), [(5, 2, 0, True, "success"), (5, 2, 1, True, "partial"), (5, 0, 1, True, "success"), (0, 0, 0, True, "empty"), (0, 0, 0, False, "unknown")])
cases("rotation_cases", "groups array<string>, last int", outcomes.rotated, [(["a", "b", "c"], 0, "a"), (["a", "b", "c"], 4, "b"), (["a", "b", "c"], -1, "c"), (["a"], 7, "a"), ([], 1, None), (["a", "b"], None, "a")])
cases("set_cases", "a array<string>, b array<string>", lambda a, b: F.concat_ws("/", F.array_join(lookups.reclassified(a, b), "+"), lookups.same_set(a, b).cast("string")), [(["t", "c", "o"], ["o", "t"], "t+o/false"), (["a", "b"], ["b", "a"], "a+b/true"), ([], ["x"], "/false"), (["a", "a"], ["a"], "a/true")])
cases("label_cases", "seg string, kind string", lambda s, k: F.concat_ws("/", text.label(s, L.SEGMENT_LABELS), text.label(k, L.TYPE_LABELS)), [("lng_lpg", "psc_report", "LNG / LPG/PSC Report"), ("dry_bulk", "press_release", "Dry Bulk/Press"), ("cruise", "pi_circular", "Cruise/P&I Circular"), ("x", "news", "News")])

# Gates
GOOD = "A vessel ran aground near the port and was refloated."
cases("quality_cases", "title string, excerpt string, url string", gates.article_reason, [
    ("Seven77", GOOD, "", "title-short"), ("Eight888", GOOD, "", None), ("  Seven77  ", GOOD, "", "title-short"), ("Articles", GOOD, "", "title-hub"), ("Page 3 of 10", GOOD, "", "title-hub"), ("Read more ", GOOD, "", "title-cta"), ("Click here", GOOD, "", "title-cta"), ("A good title", GOOD, "https://x.y/login", "url-junk"), ("A good title", GOOD, "https://x.y/services/", "url-junk"),
    ("A good title", "x" * 29, "", "excerpt-short"), ("A good title", "x" * 30, "", None), ("A good title", "", "https://www.youtube.com/watch?v=1", None), ("A good title", "Lost your password? Please enter it. Don't have an account yet", "", "locked"), ("A good title", "Now " + "this content is locked" + " for you all", "", "locked"),
    ("A good title", "subscribe to our newsletter" + "y" * 99, "", "junk-phrase"), ("A good title", "subscribe to our newsletter" + " " + "y" * 100, "", None), ("A good title", "download " * 8 + "z" * 729, "", "cta-dense"), ("A good title", "download " * 8 + "z" * 728, "", None), ("A good title", "download " * 7 + "z" * 800, "", None),
])
cases("gate_cases", "title string, body string", gates.gate_reason, [
    ("A long vessel title", "You are using an outdated browser, please upgrade now", "boilerplate"), ("t", "", "too-short"), ("t", "x" * 24, "too-short"), ("t", "x" * 25, None), ("Grounding near Rotterdam harbour", "Nothing in this text overlaps at all, sorry.", "no-title-overlap"), ("Grounding near Rotterdam harbour", "A ship at ROTTERDAM today, all well.", None),
    ("t", "y" * 151 + " cookie policy", None), ("t", "y" * 100 + " cookie policy", "boilerplate"), ("Two words", "Nothing in this text overlaps at all, sorry.", None),
])
cases("term_cases", "term string", gates.proper_term, [("Vestas", True), ("Port of Tyne", True), ("RIMPAC", True), ("P&I", True), ("EnBW", True), ("lower case", False), ("One Two Three Four", False), ("according", False), ("Ab", False), ("CO2", True), ("van der Berg", False)])
cases("term_filter_cases", "title string, terms array<string>", lambda t, x: F.array_join(gates.filter_terms(t, x), "|"), [("Onego sails", ["Onego Otra", "onego otra", "Onego", "Monday", "By Someone", "Dmitry Peskov", "YouTube", "March", "According", "If Muscat"], "Onego Otra|Dmitry Peskov"), (None, ["IMO", "Photo Credit", "Speaking Clock"], "IMO"), ("x", [], "")])
cases("hub_cases", "title string, excerpt string", gates.is_hub, [("Latest news", "x", True), ("A real headline", "download " * 8 + "z" * 800, True), ("A real headline", "download " * 8, False), ("A real headline", "z" * 900, False)])
cases("moderation_cases", "title string, excerpt string", lambda t, e: text.let(gates.moderate(t, e), lambda m: F.concat_ws("/", *[m[k].cast("string") for k in ("decision", "reason", "hits", "matched")])), [
    ("Best video game builds", "skill guide", "hide/spam/0/video game"), ("Tanker", "a video game", "hide/spam/1/video game"), ("Tanker cargo", "a video game", "pass/maritime/2"), ("Quiet day", "at home", "pass/unknown/0"), ("MARPOL and imo", "x", "pass/unknown/1"), ("Dating tips", "Finding love", "hide/spam/0/Finding love"), ("Brand marketing and customer engagement", "", "hide/spam/0/Brand marketing and customer engagement"), ("BMW in old Dubai", "", "hide/spam/0/BMW in old Dubai"),
])
cases("visibility_cases", "decision string, trust string", gates.visibility, [("hide", "aggregator", "hidden"), ("pass", "aggregator", "pending"), ("pass", "trusted", "visible"), ("pass", None, "visible")])
cases("paywall_cases", "body string", gates.paywalled, [("Please LOG IN to Read more", True), ("Subscribe now!", True), ("subscribe to our newsletter", False), ("unlock the rest of this article", True), ("Join to continue", True), ("premium content", False), (None, False), ("This article is for paid subscribers", True), ("register", False)])

# Classification
cat = lambda t, e, h: text.let(enrich.category(t, e, h), lambda c: F.concat_ws("/", c["slug"], F.round(c["confidence"], 2).cast("string")))
cases("category_cases", "title string, excerpt string, hint string", cat, [
    ("Tanker collision off Spain", "A tanker and a bulk carrier met.", None, "accidents/0.9"), ("Nothing", "at all here", "ports", "ports/0.6"), ("Nothing", "at all here", None, "general/0.3"), ("Seafarer news", "x", None, "crew/0.7"), ("x", "a seafarer", None, "crew/0.55"), ("x", "a seafarer", "ports", "ports/0.6"), ("Seafarer", "x", "ports", "crew/0.7"),
    ("x", "a tanker and a teu", None, "tankers/0.55"), ("x", "a fire aboard", None, "accidents/0.7"), ("x", "mepc 80 and imo", None, "regulations/0.55"), ("Mepc 80 at the IMO", "MARPOL", None, "regulations/0.9"),
])
cases("segment_cases", "title string, excerpt string, slug string, source string", lambda t, e, c, s: F.array_join(enrich.segments(t, e, c, s), ","), [
    ("Tanker collision", "", "offshore", "Container News", "container,offshore,tanker"), ("x", "y" * 391 + " tanker", None, None, "tanker"), ("x", "y" * 394 + " tanker", None, None, ""), ("HMM Drilling wins", "", None, None, ""), ("HMM wins", "", None, None, "container"), ("hmm wins", "", None, None, ""), ("x", "nickel ore cargoes", None, None, "dry_bulk"), ("x", "Group A cargoes", None, "LNG Prime", "lng_lpg,dry_bulk"),
    ("Saipem wins", "", None, None, "offshore"), ("Star Bulk and GasLog", "", None, None, "dry_bulk,lng_lpg"), ("x", "MSC Cruises", None, "Tanker Operator", "tanker,cruise"), ("2M Alliance ends", "", None, None, "container"), ("2m alliance ends", "", None, None, ""), ("A", "B", "dry-bulk", None, "dry_bulk"), ("VLCCs and vlccs", "", None, None, "tanker"), ("TORM rates", "", None, None, "tanker"),
])
cases("type_cases", "hint string, source string, slug string, title string, excerpt string", enrich.document_type, [
    ("port-state-control", "x", "accidents", "Baltic dry index", "", "psc_report"), ("pi-insurance", "x", "accidents", "t", "", "pi_circular"), ("classification", None, None, "t", "", "class_notice"), (None, None, "accidents", "freight rates", "", "casualty_report"), (None, None, "regulations", "freight rates", "", "regulation"), (None, "Press Release Wire", None, "Freight rates rise", "", "market_report"),
    (None, "Press  Release Wire", None, "t", "", "press_release"), ("other", "News", "ports", "t", "", "news"), (None, None, None, "t", "y" * 590 + " BDI rises", "market_report"), (None, None, None, "t", "y" * 600 + " BDI", "news"), (None, None, None, "bdi", "", "news"),
])
cases("keyword_cases", "title string, excerpt string", lambda t, e: F.array_join(enrich.keywords(t, e), "|"), [
    ("Port of Hamburg strike", "Hamburg Hamburg Vestas strike", "Port of Hamburg|strike|Hamburg Hamburg Vestas"), ("vessel news", "Vestas Vestas Enercon", "Vestas Vestas Enercon"), ("", "Zeta then Alpha. Zeta! Alpha? Gamma", "Zeta|Alpha|Gamma"), ("Crane crane CRANE", "", "Crane"), (None, None, ""), ("one", "lower words only", ""),
])
cases("summary_cases", "excerpt string", text.summary, [
    ("Short. Two.", "Short. Two."), ("A" * 40 + ". " + "B" * 40 + ". C.", "A" * 40 + ".  " + "B" * 40 + "."), ("word " * 100, ("word " * 56).strip() + "…"), ("x" * 4100 + " and then. " + "Second one. Third.", "x" * 320), ("", ""), (None, ""), ("a" * 280, "a" * 280), ("No stop at all", "No stop at all"), ("?! " + "A" * 60 + "! B? C.", "A" * 60 + "!  B?"),
])
cases("section_cases", "body string", lambda b: F.array_join(F.transform(text.sections(b), lambda s: F.concat_ws(":", s["number"].cast("string"), s["heading"])), "|"), [
    ("\n".join(f"{i}. Heading number {i}\n" + "word " * 300 for i in (1, 2, 3)), "1:Heading number 1|2:Heading number 2|3:Heading number 3"), ("\n".join(f"{i}. Heading number {i}\n" + "word " * 300 for i in (1, 2)), None), ("\n".join(f"{i}. Heading number {i}\n" + "word " * 300 for i in (1, 2, 4)), None), ("1. Some heading\n2. Other head\n3. Third head\n" + "x" * 3900, None)])

# Dates
cases("date_cases", "body string", lambda b: shown(dates.find_all_dates(b)), [
    ("April 20th, 2026", "2026-04-20"), ("16th of February 2026", "2026-02-16,2026-02-01"), ("20-Apr-2026 Apr-21-2026", "2026-04-20,2026-04-21"), ("2026/4/5 and 2026-04-06", "2026-04-05,2026-04-06"), ("13.04.2026 05-03-2026", "2026-04-13,2026-03-05"), ("04/13/2026 05/03/2026 13/04/2026", "2026-04-13,2026-05-03,2026-04-13"), ("04.13.2026", "2026-04-13"), ("30 Feb 2026", "2026-02-01"),
    ("1 Jan 1989, 1 Jan 2101", ""), ("Marine 2026", "2026-03-01"), ("2026-01-02 then March 4, 2026", "2026-03-04,2026-01-02"), ("29 February 2024", "2024-02-29,2024-02-01"), ("Sept 3 2025", "2025-09-03"), ("no date", ""), ("12345-06-07", ""),
])
cases("first_date_cases", "body string", lambda b: dates.first_date(b, at(NOON)), [("1 August 2026 and 3 July 2026", "2026-07-03"), ("16 July 2026", "2026-07-16"), ("17 July 2026", "2026-07-01"), ("nothing", None)])
KIND = "c array<string>"
best = lambda c: dates.best_date(F.transform(c, lambda x: F.struct(F.split(x, "/")[0].alias("iso"), F.split(x, "/")[1].alias("source"), F.split(x, "/")[2].alias("confidence"), F.nullif(F.split(x, "/")[3], F.lit("")).cast("int").alias("step"))))["iso"]
cases("best_date_cases", KIND, best, [(["a/original/high/", "b/original/high/3"], "b"), (["a/scraper_default/high/1", "b/original/high/9"], "b"), ([], None), (["a/original/medium/1", "b/scraper_default/high/9"], "b"), (["a/original/high/3", "b/original/high/3"], "a")])
cases("fallback_cases", "title string", lambda t: F.concat_ws("/", dates.fallback_date(t, at(NOON))["at"].cast("string"), dates.fallback_date(t, at(NOON))["basis"]), [("Report June 2026", "2026-06-30 12:00:00/title_month"), ("July 2026", f"{NOON}/capture"), ("Dec 2026", f"{NOON}/capture"), ("none", ""), ("December 2025 report", "2025-12-31 12:00:00/title_month")])
cases("parse_cases", "raw string", lambda r: dates.try_parse(r, at(NOON)), [
    ("18 May 2026", "2026-05-18 00:00:00"), ("30/05/2026", "2026-05-30 00:00:00"), ("2026-05-29T10:00:00+02:00", "2026-05-29 08:00:00"), ("2026-05-29T10:00:00Z", "2026-05-29 10:00:00"), ("Fri, 29 May 2026 10:00:00 +0300", "2026-05-29 07:00:00"), ("Fri, 29 May 2026 10:00:00 GMT", "2026-05-29 10:00:00"), ("1748509200", "2025-05-29 09:00:00"), ("1748509200000", "2025-05-29 09:00:00"),
    ("99999999999", None), ("2026-08-29T10:00:00Z", None), ("at 10:30 on 3 May 2026", "2026-05-03 00:00:00"), ("", None), ("  ", None), (None, None), ("rubbish", None),
])
cases("provenance_cases", "source string, conf string", lambda s, c: F.concat_ws("/", dates.db_provenance(s), dates.db_confidence(c)), [("rss_pubdate", "high", "original/high"), ("url_slug_yyyy_mm", "low", "body_repaired/low"), ("unknown", "none", "unknown"), ("body_header_label", "medium", "original/medium")])
cases("cascade_cases", "rss string, ld string, sitemap string, body string", lambda r, j, s, b: F.concat_ws("/", *[dates.cascade({"rss": r, "jsonld": j, "sitemap": s, "body": b})[k].cast("string") for k in ("day", "signal", "confidence")]), [
    ("1", "2", None, None, "1/rss/medium"), ("1", None, None, "1", "1/rss/high"), (None, None, "3", None, "3/sitemap/low"), (None, None, "3", "4", "3/sitemap/low"), (None, None, "3", "3", "3/sitemap/high"), (None, None, None, None, ""), (None, "2", "3", None, "2/jsonld/medium")])
cases("pdf_date_cases", "raw string", dates.pdf_date, [("D:20260304050607+02'00'", "2026-03-04 03:06:07"), ("D:2026", "2026-01-01 00:00:00"), ("x", None), ("20260304Z", "2026-03-04 00:00:00")])
PAGE = "link string, meta string, ld string, semantic string, loose string, body string, scope string, title string"


def page(link, meta, ld, sem, loose, body, scope, title):
    found = dates.resolve({"link": link, "meta": meta, "json_ld": ld, "time_semantic": sem, "time_loose": loose, "body": body, "scope": scope}, at(NOON), title)
    return text.let(found, lambda r: F.concat_ws("/", *[r[k].cast("string") for k in ("at", "source", "confidence", "step")]))


cases("page_date_cases", PAGE, page, [
    ("https://a.b/x", "2026-05-01T08:00:00Z", "2026-05-02", None, None, None, None, None, "2026-05-01 08:00:00/original/high/meta"), ("https://a.b/x", None, "2026-05-02", None, None, "Published: 3 May 2026 by x", None, None, "2026-05-03 00:00:00/original/high/body_labelled"), ("https://a.b/x", None, "2026-05-02", None, None, None, None, None, "2026-05-02 00:00:00/original/high/json_ld"),
    ("https://a.b/2026/05/04/x", None, None, None, "2026-01-01", None, None, None, "2026-05-04 00:00:00/original/medium/url_path_day"), ("https://a.b/2026/05/x", None, None, None, None, None, None, None, "2026-05-01 00:00:00/scraper_default/low/url_slug_month"), ("https://a.b/news-june-2026.html", None, None, None, None, None, None, "Report March 2026", "2026-06-01 00:00:00/scraper_default/low/url_slug_month"),
    ("https://a.b/2026/05/04/x", None, None, None, None, None, "Seen 5 May 2026 here", None, "2026-05-04 00:00:00/original/medium/url_path_day"), ("https://a.b/x", None, None, None, "2026-01-01", None, "05.05.2026", None, "2026-05-05 00:00:00/original/medium/body_bare"), ("https://a.b/x", None, None, "2026-05-06", None, "Updated 3 May 2026 x", None, None, "2026-05-06 00:00:00/original/high/time_element_semantic"),
    ("https://a.b/x", "2026-09-01", None, None, None, None, None, "3 March 2026", "2026-03-03 00:00:00/scraper_default/low/title_fallback"), ("https://a.b/x", None, None, None, None, None, None, None, ""),
])

# PDF titles
cases("pdf_usable_cases", "title string", pdf.usable_title, [(x, False) for x in ("June 9, 2011", "letter template", "layout 12", "a draft", "Nov 2019", "7 May 2008", "Hull survey notes.indd", "Microsoft Word - 77.doc", "Click here", "Read more", "1999", "untitled 4", "FAX", "Final Plan.docx", "SAFE SEAS | 7 SAFE SEAS some words of it", "8 | SAFE SEAS SAFE SEAS A NAME, MASTER", "1 | HARBOUR | 2 LIGHTS AND MORE", "12 345 678 9", "twowords only", None)] + [
    (x, True) for x in ("SAFE SEAS – MAY 2025 – KOREAN", "Notice No. 3/25 - A Club's Own Yearly Meeting", "Rules for the carriage of grain", "LIGHTS & SHAPES ON SMALL CRAFT", "Page 3 of the story and more of it")])
cases("pdf_pick_cases", "meta string, link string, body string", pdf.pick_title, [("draft", "SAFE SEAS – MAY 2025", None, "SAFE SEAS – MAY 2025"), ("The yearly meeting of owners", "Download pdf", None, "The yearly meeting of owners"), ("Layout 9", "View pdf", None, None), ("May 2011", "Open", "Every enclosed space must be aired before work begins. More.", "Every enclosed space must be aired before work begins"), ("May 2011", "Open", "No stop in this one and it just ends", "No stop in this one and it just ends")])
cases("pdf_url_cases", "url string", pdf.title_from_url, [("https://a.com/2025/How-to-moor-in-a-strong-current.pdf", "How to moor in a strong current"), ("https://a.com/Pilot-ladders.pdf", "Pilot ladders"), ("https://a.com/files/cir_07_25.pdf", None), ("https://a.com/files/8812.PDF", None), ("https://a.com/files/bulletins.pdf", None), ("no address", None)])
cases("pdf_recover_cases", "body string, source string", pdf.recover_title, [
    ("Prices of this kind are subject to change without a word and owners ought to plan with some care for the year ahead of them all.", "Gard", None), ("Some office. Advisory To Shipping No. B-3-2025 TO: All Shipping Agents SUBJECT: New booking rules for small craft The Office says that this begins soon.", "Panama Canal Authority", "Advisory B-3-2025: New booking rules for small craft"),
    ("CIRCULAR NO. 12/24 Dear Member: SAFE MOORING IN WINTER: WHAT OWNERS OUGHT TO KNOW The Club hopes that you are well.", "American P&I Club", "Circular 12/24: SAFE MOORING IN WINTER: WHAT OWNERS OUGHT TO KNOW"), ("A trading name of some mutual. Dear Sirs CLASS 9 HULL AND CARGO, EARLY RENEWAL OF TERMS. At a meeting the board looked at it.", "London P&I Club", "CLASS 9 HULL AND CARGO, EARLY RENEWAL OF TERMS"),
    ("RA12 - Lashing of deck cargo in heavy weather. Introduction to the matter at hand", "Steamship Mutual", "RA12 – Lashing of deck cargo in heavy weather"), ("CIRCULAR NO. 5/20 Dear Member: " + "LONG WORDED HEADING " * 8 + "of it", "American P&I Club", "Circular 5/20: " + ("LONG WORDED HEADING " * 4 + "LONG WORDED").strip()),
    ("12 | SAFE SEAS SAFE SEAS | 13 and a bit more of it all", "Some club", None), ("brief", "Gard", None), ("Some club letter of the year Re: New ballast rules in Brazil. Please note the following today", None, "New ballast rules in Brazil"),
])
cases("pdf_cascade_cases", "meta string, link string, body string, url string, source string", pdf.title_cascade, [("Layout 1", "PDF", "x" * 10, "https://a.b/Pilot-ladders.pdf", None, "Pilot ladders"), ("Layout 1", "PDF", "Opening words of a document that says a lot. And more.", "https://a.b/1.pdf", None, "Opening words of a document that says a lot"), (None, None, None, None, None, None)])
cases("pdf_text_cases", "body string", lambda b: F.concat_ws("/", *[pdf.text_fields(b)[k].cast("string") for k in ("title", "length", "date_label", "is_empty")]), [
    ("To: all\nADVISORY NO 5 ON ICE\nbody text of the advisory follows on 3 May 2026 here", "ADVISORY NO 5 ON ICE/81/3 May 2026/false"), ("too short", "9/true"), ("v1.2\n12.05.2026\nhttps://a.b/c\nThe first plausible line here\nand text that goes on for long enough", "The first plausible line here/97/false"), ("Subject: Ice in the Baltic Sea\n" + "x" * 40, "Ice in the Baltic Sea/71/false")])

# Search
cases("capital_run_cases", "title string", lambda t: F.array_join(search.capital_run(t), " "), [("Maersk and MSC Split Gemini Deal Today", "MSC Split Gemini Deal Today"), ("The Big Ship sails Far", "Big Ship"), ("no capitals", ""), ("Alpha beta Gamma", "Alpha"), ("Al-Bahri's Ship", "AlBahris Ship")])
cases("candidate_cases", "title string, body string", lambda t, b: F.array_join(search.candidate_terms(t, b), "|"), [("x", "The captain Dmitry Peskov met Onego Otra. Dmitry Peskov left.", "Dmitry Peskov|Onego Otra"), ("Onego Otra sails", "Aboard was Onego Otra.", ""), ("x", "Photo by Getty: John Miller stands", ""), ("x", "It was in March Hare time", ""), ("x", "A Bo Li", "")])

# Pages
HTML = {
    1: '<html><head><meta property="og:title" content="The title"></head><body><nav><p>' + "n" * 90 + '</p></nav><article><p class="x">' + "a" * 50 + "</p><p>short</p><p>" + "b" * 50 + '</p><div class="promo"><p>' + "c" * 60 + '</p></div><a href="/doc.pdf">pdf</a></article></body></html>',
    2: '<html><head><title>Headline - Site</title><meta name="description" content="' + "d" * 90 + '"></head><body><p>tiny</p></body></html>',
    3: '<body><script id="__NEXT_DATA__">' + json.dumps({"props": [{"x": "short"}, {"deep": {"articleBody": "Word one. " * 25}}]}) + "</script><h1>Head</h1></body>",
    4: "<body><div class='content'><p>" + "e" * 79 + "</p></div></body>", 5: None,
}
HTMLS = Literal("page_id long, url string, html string", [(k, f"https://a.b/{k}", v) for k, v in HTML.items()])


@expect("body_cases", "page_id long, title string, excerpt string, visible_length int, found_in string, embedded_pdf string", [
    (1, "The title", "a" * 50 + " " + "b" * 50, 101, "dom", "/doc.pdf"), (2, "Headline", "d" * 90, 0, "meta_description", None), (3, "Head", ("Word one. " * 25).strip(), 0, "next_data", None), (4, None, None, 0, "none", None), (5, None, None, 0, "none", None)])
def body_cases(spark, d):
    return pages.bodies(HTMLS.frame(spark)).select("page_id", "title", "excerpt", "visible_length", "found_in", "embedded_pdf")


DATED = Literal("page_id long, url string, html string", [
    (1, "https://a.b/x", '<head><meta property="article:published_time" content="2026-05-01T08:00:00Z"></head><body>Published: 3 May 2026</body>'), (2, "https://a.b/x", '<script type="application/ld+json">{"@graph":[{"a":{"datePublished":"2026-05-02"}},{"dateCreated":"2026-05-09"}]}</script><body>x</body>'), (3, "https://a.b/x", '<body><time class="entry-date" datetime="2026-05-04">x</time><time datetime="2026-01-01">y</time></body>'),
    (4, "https://a.b/x", "<body>side 1 May 2026 <article><h1>2 May 2026</h1>Text of 6 May 2026</article></body>"), (5, "https://a.b/x", "<body><main>6 May 2026 or 7 May 2026</main></body>"), (6, "https://a.b/x", "<body>nothing</body>"), (7, "https://a.b/2026/05/08/x", None)])


@expect("page_date_pages", "page_id long, day string, confidence string, step string", [(1, "2026-05-01", "high", "meta"), (2, "2026-05-09", "high", "json_ld"), (3, "2026-05-04", "high", "time_element_semantic"), (4, "2026-05-06", "low", "body_bare"), (5, "2026-05-06", "low", "body_bare"), (6, None, None, None), (7, "2026-05-08", "medium", "url_path_day")])
def page_date_pages(spark, d):
    return pages.page_dates(DATED.frame(spark), at(NOON)).select("page_id", F.to_date("at").cast("string").alias("day"), "confidence", "step")


LISTS = Literal("source_id string, page int, url string, html string, status int", [
    ("a", 1, "https://a.b/list", '<a href="/n1">One</a><a href="/n2">Two</a><a href="http://a.b/k1">K</a>', 200), ("a", 2, "https://a.b/list/page/2/", '<a href="/k2">K2</a><a href="/n1">again</a><a href="/k3">K3</a>', 200), ("a", 3, "https://a.b/list/page/3/", '<a href="/n9">Nine</a>', 200),
    ("b", 1, "https://b.c/l", '<a href="x">X</a>', 200), ("b", 2, "https://b.c/l/page/2/", "", 404), ("b", 3, "https://b.c/l/page/3/", '<a href="/late">L</a>', 200), ("c", 1, "https://c.d/l", "".join(f'<a href="/i{i}">t</a>' for i in range(20)), 200)])


@expect("listing_cases", "source_id string, page int, url string", [("a", 1, "https://a.b/n1"), ("a", 1, "https://a.b/n2"), ("b", 1, "https://b.c/x"), *[("c", 1, f"https://c.d/i{i}") for i in range(15)]])
def listing_cases(spark, d):
    """A run of three known addresses over two pages ends source a before its third page; a missing page ends source b."""
    known = spark.createDataFrame([(u,) for u in ("https://a.b/k1", "https://a.b/k2", "https://a.b/k3")], "u string").select(text.url_hash(F.col("u")).alias("url_hash"))
    return pages.listing(LISTS.frame(spark), known, 3).select("source_id", "page", "url")


CARDS = Literal("page_id long, url string, html string", [(1, "https://a.b/l/", "".join(f'<article class="c"><h2> Card  {i} </h2><time>{i + 1} May 2026</time><a href="/c{i}">go</a><img src="i{i}.png" alt="Alt {i}"></article>' for i in range(27)) + '<article><h2>No link</h2></article><article><a href="/c0">x</a><h3>Twice</h3></article>')])


@expect("card_cases", "n long, first_title string, first_excerpt string, first_url string, first_image string, dated long", [(25, "Card 0", "1 May 2026. Card 0 Alt 0", "https://a.b/c0", "https://a.b/l/i0.png", 25)])
def card_cases(spark, d):
    x = pages.cards(CARDS.frame(spark), at(NOON))
    one = lambda c: F.min_by(c, "position")
    return x.agg(F.count(F.lit(1)).alias("n"), one("title").alias("first_title"), one("excerpt").alias("first_excerpt"), one("url").alias("first_url"), one("image").alias("first_image"), F.count("published_at").alias("dated"))


HUBS = Literal("page_id long, url string, html string", [(1, "https://a.b/hub", "".join(f'<a href="/news/n{i}">N{i}</a>' for i in range(10)) + '<a href="/login/news/x">no</a><a href="https://other.c/news/x">no</a><a href="/rules-and-resources/x">no</a><a href="/x.pdf?y">P</a><a href="#top">no</a>'), (2, "https://a.b/two", '<a href="/doc.PDF">D</a><a href="/about">no</a>')])


@expect("hub_page_cases", "page_id long, children long, first_child string", [(1, 8, "https://a.b/news/n1"), (2, 1, "https://a.b/doc.PDF")])
def hub_page_cases(spark, d):
    x = pages.hub_children(HUBS.frame(spark), spark.createDataFrame([("https://a.b/news/n0",)], "url string"))
    return x.groupBy("page_id").agg(F.count(F.lit(1)).alias("children"), F.min_by("child", "position").alias("first_child"))


@expect("image_fill_cases", "url string, image string", [("u1", "own.png"), ("u2", "og.png"), ("u3", "tw.png"), ("u4", None)])
def image_fill_cases(spark, d):
    items = spark.createDataFrame([("u1", "own.png"), ("u2", None), ("u3", None), ("u4", None)], "url string, image string")
    heads = spark.createDataFrame([("u1", '<meta property="og:image" content="x.png">'), ("u2", '<meta content="og.png" property="og:image">'), ("u3", "<meta name='twitter:image' content='tw.png'>"), ("u4", "<p>")], "url string, html string")
    return pages.fill_images(items, heads)


FEED = '<rss xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:media="http://search.yahoo.com/mrss/"><channel><item><title>T &amp;amp; U</title><link>https://a/1</link><content:encoded>&lt;p&gt;A body with more than thirty characters.&lt;/p&gt;</content:encoded><description>no</description><pubDate>Fri, 29 May 2026 10:00:00 +0000</pubDate><media:content url="i.png" medium="image"/></item><item><title>Short one here</title><link>https://a/2</link><description>tiny &lt;img src="d.png"&gt;</description></item><item><title>No link</title></item></channel></rss>'


@expect("feed_cases", "feed_url string, link string, title string, excerpt string, image string, day string", [("u", "https://a/1", "T & U", "A body with more than thirty characters.", "i.png", "2026-05-29"), ("u", "https://a/2", "Short one here", "Short one here", "d.png", None)])
def feed_cases(spark, d):
    x = feeds.feed_items(spark.createDataFrame([("u", FEED), ("w", "broken <"), ("x", None)], "feed_url string, payload string"))
    return x.select("feed_url", "link", "title", "excerpt", "image", F.to_date(dates.try_parse(F.col("published"), at(NOON))).cast("string").alias("day"))


POSTS = json.dumps([{"id": 1, "link": "https://a/1?_=9", "date_gmt": "2026-01-02T03:04:05", "title": {"rendered": "Strike &#8211; Hamburg port closes"}, "excerpt": {"rendered": "<p>The Hamburg port closes for a day of talks.</p>"}, "content": {"rendered": "Onego Otra waits at Hamburg while Dmitry Peskov talks."}}, {"id": 2, "link": "https://a/2", "date_gmt": "2026-01-02T03:04:05Z", "title": {"rendered": "Strike ends in Hamburg port"}, "excerpt": {"rendered": "Accept our cookie policy to go on reading"}, "content": {"rendered": ""}}, {"id": 3, "link": None, "date_gmt": None, "title": {"rendered": "x"}, "excerpt": {"rendered": ""}, "content": {"rendered": ""}}])


@expect("post_cases", "link string, title string, excerpt string, published_at string, text_source string, terms string, gate_reason string", [("https://a/1", "Strike – Hamburg port closes", "The Hamburg port closes for a day of talks.", "2026-01-02T03:04:05Z", "content", "Onego Otra|Dmitry Peskov", None), ("https://a/2", "Strike ends in Hamburg port", "", "2026-01-02T03:04:05Z", "none", "", "too-short")])
def post_cases(spark, d):
    return feeds.posts(spark.createDataFrame([("s", POSTS)], "site string, payload string")).select("link", "title", "excerpt", "published_at", "text_source", F.array_join("content_terms", "|").alias("terms"), "gate_reason")


MAP = "<urlset>" + "".join(f"<url><loc>https://a/{u}</loc>{m}</url>" for u, m in (("old", "<lastmod>2026-01-01</lastmod>"), ("none", ""), ("new", "<lastmod>2026-03-01T10:00:00Z</lastmod>"), ("bad", "<lastmod>soon</lastmod>"), ("tie", "<lastmod>2026-01-01</lastmod>"))) + "</urlset>"


@expect("sitemap_cases", "loc string, nth int", [("https://a/new", 1), ("https://a/old", 2), ("https://a/tie", 3), ("https://a/none", 4), ("https://a/bad", 5)])
def sitemap_cases(spark, d):
    return feeds.sitemap_entries(spark.createDataFrame([("s", MAP)], "sitemap_url string, payload string")).select("loc", "nth")


@expect("sitemap_index_cases", "sitemap_url string, child string", [("i", "b"), ("j", "first")])
def sitemap_index_cases(spark, d):
    block = lambda *xs: "".join(f"<sitemap><loc>{u}</loc><lastmod>{m}</lastmod></sitemap>" for u, m in xs)
    return feeds.freshest_child(spark.createDataFrame([("i", block(("a", "2026-01-01"), ("b", "2026-02-01"))), ("j", block(("first", "2026-02-01"), ("second", "2026-02-01")))], "sitemap_url string, payload string"))


# The store's operators over the generated tables
ITEMS = """items AS (SELECT doc_id, source AS source_name, 'https://example.org/a/' || doc_id AS url, CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'A title' END AS title, CASE WHEN doc_id % 19 = 0 THEN '  ' ELSE text END AS excerpt, CASE WHEN lang <> 'de' THEN TIMESTAMP '2024-01-01' END AS published_at, CASE WHEN doc_id % 5 = 0 THEN 'none' ELSE 'high' END AS date_confidence,
 doc_id % 23 = 0 AS pdf_too_large, doc_id % 29 = 0 AS is_pdf, CASE WHEN doc_id % 2 = 0 THEN 'failed' END AS fetch_error, doc_id % 31 = 0 AS pdf_no_text, n_chars::INT AS visible_length, doc_id % 3 = 0 AS paywalled, doc_id IN (SELECT doc_id FROM labels) AS dup FROM documents),
decided AS (SELECT *, CASE WHEN pdf_too_large THEN 'pdf_too_large' WHEN is_pdf AND fetch_error IS NOT NULL THEN 'pdf_fetch_failed' WHEN pdf_no_text THEN 'pdf_no_text' WHEN visible_length < 1100 AND paywalled THEN 'paywalled_thin' WHEN dup THEN 'duplicate' WHEN title = '' THEN 'no_title' WHEN published_at IS NULL OR date_confidence = 'none' THEN 'no_date' WHEN trim(coalesce(excerpt, ''), ' ') = '' THEN 'empty_body' END AS r FROM items)"""


def _decided(spark, d):
    i = F.col("doc_id")
    x = table(spark, d, "documents").select(
        i, F.col("source").alias("source_name"), F.concat(F.lit("https://example.org/a/"), i).alias("url"), F.when(i % 17 == 0, "").otherwise("A title").alias("title"), F.when(i % 19 == 0, "  ").otherwise(F.col("text")).alias("excerpt"), F.when(F.col("lang") != "de", at("2024-01-01")).alias("published_at"), F.lit("rss_pubdate").alias("date_source"), F.when(i % 5 == 0, "none").otherwise("high").alias("date_confidence"),
        (i % 23 == 0).alias("pdf_too_large"), (i % 29 == 0).alias("is_pdf"), F.when(i % 2 == 0, "failed").alias("fetch_error"), (i % 31 == 0).alias("pdf_no_text"), F.col("n_chars").cast("int").alias("visible_length"), (i % 3 == 0).alias("paywalled"),
    )
    known = table(spark, d, "labels").select(text.url_hash(F.concat(F.lit("https://example.org/a/"), "doc_id")).alias("url_hash"))
    return outcomes.decide(x, known)


@query(f"WITH {ITEMS} SELECT doc_id, CASE WHEN r = 'duplicate' THEN 'duplicate' WHEN r IS NOT NULL THEN 'rejected' ELSE 'would_insert' END AS decision, nullif(r, 'duplicate') AS reason FROM decided")
def reject_ladder(spark, d):
    return _decided(spark, d).select("doc_id", "decision", "reason")


@query(f"WITH {ITEMS} SELECT source_name, count(*) AS discovered, count(*) FILTER (r IS NULL) AS would_insert, count(*) FILTER (r = 'duplicate') AS duplicate, count(*) FILTER (r <> 'duplicate') AS rejected, count(fetch_error) AS fetch_failed FROM decided GROUP BY 1")
def dry_run_report(spark, d):
    return outcomes.report(_decided(spark, d))


@query("SELECT c_custkey, n_name AS source_name, r_name AS category_slug FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON r_regionkey = c_nationkey")
def article_names(spark, d):
    a = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("source_id"), F.col("c_nationkey").alias("category_id"))
    s, c = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), table(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("slug"))
    return lookups.with_names(a, s, c).select("c_custkey", "source_name", "category_slug")


@query("SELECT c_custkey, coalesce((SELECT min(n_nationkey) FROM nation WHERE n_name = upper(c_mktsegment)), (SELECT n_nationkey FROM nation ORDER BY n_name LIMIT 1)) AS category_id FROM customer")
def category_lookup(spark, d):
    n = table(spark, d, "nation")
    least = n.agg(F.min("n_name").alias("m"))
    c = n.crossJoin(F.broadcast(least)).select(F.col("n_nationkey").alias("id"), F.when(F.col("n_name") == F.col("m"), "general").otherwise(F.col("n_name")).alias("slug"))
    return lookups.category_ids(table(spark, d, "customer").select("c_custkey", F.upper("c_mktsegment").alias("category")), c).select("c_custkey", "category_id")


@query(f"WITH {HASH} SELECT count(*) AS n, count(*) FILTER (page_id % 7 > 0) AS ok FROM h")
def hash_parity(spark, d):
    p = table(spark, d, "pages").select("url", F.when(F.col("page_id") % 7 > 0, text.url_hash(F.col("url"))).otherwise("x").alias("url_hash"))
    return lookups.hash_parity(p).agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("ok"))


@query("SELECT count(*) AS n, count(*) FILTER (o_orderdate::DATE = day) AS ok FROM orders JOIN (SELECT l_orderkey, min(l_shipdate)::DATE AS day FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE day IS NOT NULL")
def date_agreement(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("published_at"))
    p = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("at"))
    return lookups.date_agreement(o, p, "o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("ok"))


@query("SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 'delta' ELSE 'base' END AS v FROM supplier UNION ALL SELECT -s_suppkey, 'delta' FROM supplier WHERE s_suppkey % 3 = 0")
def index_merge(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"))
    third = s.filter("k % 3 = 0")
    return lookups.merged_index(s.withColumn("v", F.lit("base")), third.union(third.select(-F.col("k"))).withColumn("v", F.lit("delta")), "k")


@query("WITH x AS (SELECT CASE s_suppkey % 5 WHEN 0 THEN 'rss' WHEN 1 THEN 'rest' WHEN 2 THEN 'sitemap' WHEN 3 THEN 'html_list' ELSE 'none' END AS mode FROM supplier) SELECT mode, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent FROM x GROUP BY 1")
def mode_shares(spark, d):
    k = F.col("s_suppkey") % 5
    conf = F.create_map(F.when(k == 0, "rss_url").when(k == 1, "wp_rest").when(k == 2, "sitemap_url").when(k == 3, "list_url").otherwise("x"), F.lit("https://x"))
    return lookups.shares(table(spark, d, "supplier"), lookups.discovery_mode(conf), "mode")


@query("WITH x AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 5000) SELECT 'o_orderstatus' AS col, o_orderstatus AS value, count(*) AS n FROM x GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM x GROUP BY 2")
def enum_counts(spark, d):
    return lookups.enum_counts(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], order="o_orderkey")


@query("WITH x AS (SELECT unnest(['a', 'b', 'c' || doc_id % 3]) AS s, doc_id FROM documents) SELECT s AS segment, count(*) AS n FROM x WHERE s <> 'a' AND NOT (s = 'b' AND doc_id % 2 = 0) GROUP BY 1")
def dropped_segments(spark, d):
    i = F.col("doc_id")
    x = table(spark, d, "documents").select(F.array(F.lit("a"), F.lit("b"), F.concat(F.lit("c"), (i % 3).cast("string"))).alias("old"), F.array(F.lit("a"), F.when(i % 2 == 0, "b").otherwise("a")).alias("new"))
    return lookups.dropped_counts(x, "old", "new")


@query("SELECT count(*) AS rows, 2 * count(*) AS terms, 100.0::DOUBLE * (count(*) + count(*) FILTER (doc_id % 4 = 0)) / (2 * count(*)) AS proper_percent, count(*) FILTER (length(text) > 500) AS over_500, count(*) FILTER (length(coalesce(text, '')) = 0) AS empty FROM documents")
def load_quality(spark, d):
    t = F.array(F.lit("Vestas"), F.when(F.col("doc_id") % 4 == 0, "IMO").otherwise("lower"))
    return lookups.load_quality(table(spark, d, "documents").select(t.alias("terms"), F.col("text").alias("raw_excerpt")))


@query("WITH b(bucket, a, z) AS (VALUES ('q1', TIMESTAMP '1996-01-01', TIMESTAMP '1996-04-01'), ('q2', TIMESTAMP '1996-04-01', TIMESTAMP '1996-07-01'), ('half', TIMESTAMP '1996-01-01', TIMESTAMP '1996-07-01'), ('never', TIMESTAMP '2050-01-01', TIMESTAMP '2051-01-01')) SELECT bucket, (SELECT count(*) FROM orders WHERE o_orderdate >= a AND o_orderdate < z) AS ours, (SELECT count(*) FROM lineitem WHERE l_shipdate >= a AND l_shipdate < z) AS theirs FROM b")
def bucket_comparison(spark, d):
    b = [("q1", "1996-01-01", "1996-04-01"), ("q2", "1996-04-01", "1996-07-01"), ("half", "1996-01-01", "1996-07-01"), ("never", "2050-01-01", "2051-01-01")]
    return lookups.bucket_counts(table(spark, d, "orders").select(F.col("o_orderdate").alias("published_at")), table(spark, d, "lineitem").select(F.col("l_shipdate").alias("published_at")), b)


@query("SELECT count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-01' AND o_orderdate < TIMESTAMP '1995-04-01'")
def archive_window(spark, d):
    return lookups.windowed(table(spark, d, "orders"), "o_orderdate", at("1995-03-01"), at("1995-04-01")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type AS tag_id, count(DISTINCT user_id) AS articles FROM events GROUP BY 1")
def tag_counts(spark, d):
    return outcomes.tag_counts(table(spark, d, "events").select(F.col("user_id").alias("article_id"), F.col("event_type").alias("tag_id")))


@query(f"WITH {LOGS}, acc AS (SELECT source_id, max(found) AS found FROM logs WHERE source_id % 3 > 0 GROUP BY 1) SELECT s_suppkey AS source_id, (s_acctbal > 5000 OR coalesce(found, 0) > 0) AS peak_found, CASE WHEN found IS NULL THEN s_nationkey ELSE s_nationkey + 1 END AS last_group, CASE WHEN found IS NULL THEN 'old' ELSE 'success' END AS last_status FROM supplier LEFT JOIN acc ON source_id = s_suppkey")
def source_state(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), (F.col("s_acctbal") > 5000).alias("peak_found"), F.col("s_nationkey").alias("last_group"), F.lit("old").alias("last_status"), at("2024-01-01").alias("last_scraped_at"))
    a = logs(spark, d).filter("source_id % 3 > 0").groupBy("source_id").agg(F.max("found").alias("found")).withColumn("status", F.lit("success"))
    return outcomes.next_state(s, a, now()).select("source_id", "peak_found", "last_group", "last_status")


@query(f"WITH {LOGS}, acc AS (SELECT source_id, sum(found)::BIGINT AS found, sum(new)::BIGINT AS inserted FROM logs WHERE source_id % 4 > 0 GROUP BY 1) SELECT s_suppkey AS source_id, CASE WHEN acc.source_id IS NULL THEN 'error' ELSE 'success' END AS status, found, inserted FROM supplier LEFT JOIN acc ON acc.source_id = s_suppkey")
def run_log(spark, d):
    opened = outcomes.open_runs(table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id")), now())
    a = logs(spark, d).filter("source_id % 4 > 0").groupBy("source_id").agg(F.sum("found").alias("found"), F.sum("new").alias("inserted")).select("*", F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"))
    return outcomes.close_runs(opened, a, now()).select("source_id", "status", "found", "inserted")


@expect("noop_trace", "status string, n long", [("no-op", 1)])
def noop_trace(spark, d):
    nothing = table(spark, d, "supplier").filter("s_suppkey < 0")
    return outcomes.trace(nothing, now()).union(outcomes.trace(table(spark, d, "supplier"), now())).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey AS source_id, CASE WHEN s_suppkey % 2 = 0 THEN 'rss,list,extra' ELSE 'rss' END AS jobs FROM supplier")
def config_patch(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), F.array(F.lit("rss")).alias("jobs"))
    p = s.filter("source_id % 2 = 0").select("source_id", F.posexplode(F.array(F.lit("list"), F.lit("rss"), F.lit("extra"))).alias("pos", "job"))
    return lookups.patched(s, p).select("source_id", F.array_join("jobs", ",").alias("jobs"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 'new' ELSE n_name END AS n_name FROM nation")
def re_extraction(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return lookups.re_extracted(n, n.filter("n_nationkey % 5 = 0"), n.withColumn("n_name", F.lit("new")), "n_nationkey", ["n_name"])


@expect("column_check", "missing string", [("content_terms,gate_reason",)])
def column_check(spark, d):
    lost = lookups.missing_columns(table(spark, d, "documents"), ["doc_id", "content_terms", "source", "gate_reason"])
    return spark.createDataFrame([(",".join(lost),)], "missing string")


@expect("provenance_defaults", "published_at_source string, published_at_confidence string, n long", [("original", "high", 1), ("scraper_default", "low", 1)])
def provenance_defaults(spark, d):
    x = spark.createDataFrame([("original", "high"), (None, None)], "published_at_source string, published_at_confidence string")
    return lookups.with_defaults(x).groupBy("published_at_source", "published_at_confidence").agg(F.count(F.lit(1)).alias("n"))


@expect("recall_cases", "source string, in_set long, queries long, control_ok boolean", [("CONTROL", 4, 5, True), ("a", 1, 2, True)])
def recall_cases(spark, d):
    results = spark.createDataFrame([(f"q{i}", i, i) for i in range(5)] + [(f"q{i}", 100 + j, 50 + j) for i in range(7) for j in range(160)], "query string, id int, published_at int")
    want = spark.createDataFrame([(f"q{i}", i if i < 4 else -1, "CONTROL") for i in range(5)] + [("q5", 250, "a"), ("q6", 105, "a")], "query string, expected_id int, source string")
    few = results.filter("id < 10 or query in ('q5', 'q6')")
    return search.recall_totals(search.recall(few, want.select("query", "expected_id")).join(want.select("query", "source"), "query"))


@expect("failure_summary", "summary string", [("forbidden×2, network×1, not_found×1",)])
def failure_summary(spark, d):
    x = spark.createDataFrame([(403,), (403,), (404,), (None,)], "s int").groupBy(text.failure_kind(F.col("s")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return text.failure_summary(x)


@expect("union_cases", "path string, n long", [("rest", 2), ("rss", 2)])
def union_cases(spark, d):
    return feeds.union_sources({"rss": feeds.feed_items(spark.createDataFrame([("u", FEED)], "feed_url string, payload string")), "rest": feeds.posts(spark.createDataFrame([("s", POSTS)], "site string, payload string"))}).groupBy("path").agg(F.count(F.lit(1)).alias("n"))




SOURCES = Literal("source_id string, enabled boolean, runner string, mode string, url_pattern string, max_items int, jobs array<string>, last_group int, last_scraped_at timestamp, scrape_interval_minutes int", [
    ("r", True, None, "rss", None, 5, ["x"], 0, None, 60), ("p", True, "big", "rest", "/1$", None, ["x", "y"], 3, dt.datetime(2026, 7, 15, 9, 0), 75), ("m", True, None, "sitemap", None, 2, [], None, dt.datetime(2026, 7, 15, 9, 13), 60), ("l", True, "small", "html_list", None, 3, ["x", "y"], -1, None, 60), ("c", False, None, "cards", None, 2, [], 0, None, 60)])
PAYLOADS = Literal("source_id string, url string, payload string", [("r", "u", FEED), ("p", "u", POSTS), ("m", "u", MAP), ("l", "https://c.d/l", LISTS.rows[-1][3]), ("c", "https://a.b/l/", CARDS.rows[0][2])])


@expect("discovery_cases", "source_id string, path string, url string", [("r", "rss", "https://a/1"), ("r", "rss", "https://a/2"), ("p", "rest", "https://a/1"), ("m", "sitemap", "https://a/new"), ("m", "sitemap", "https://a/old"), *[("l", "html_list", f"https://c.d/i{i}") for i in range(3)], ("c", "cards", "https://a.b/c0"), ("c", "cards", "https://a.b/c1")])
def discovery_cases(spark, d):
    return registry.discover(SOURCES.frame(spark), PAYLOADS.frame(spark)).select("source_id", "path", "url")


@expect("chosen_sources", "source_id string, turn string", [("r", "x"), ("p", "y")])
def chosen_sources(spark, d):
    """Due at 0.8 of the interval; of one runner; the job group by rotation."""
    return registry.chosen(SOURCES.frame(spark), at(NOON), "big").select("source_id", F.col("jobs_now").alias("turn"))


cases("pdf_split_cases", "url string, titles array<string>", lambda u, t: F.array_join(F.transform(pdf.split_rows(u, t, F.transform(t, lambda x: F.nullif(x, F.lit("-")))), lambda r: F.concat_ws("|", r["part"].cast("string"), r["url"], r["title"])), ";"), [
    ("https://a/x.pdf", ["One", "-", "Three"], "1|https://a/x.pdf?part=1|One;3|https://a/x.pdf?part=3|Three"), ("https://a/x.pdf?v=1", ["One", "Two"], "1|https://a/x.pdf?v=1&part=1|One;2|https://a/x.pdf?v=1&part=2|Two"), ("https://a/x.pdf", ["One", "-", "-", "-"], None), ("https://a/x.pdf", ["One", "Two", "-", "-", "-"], None), ("https://a/x.pdf", ["One"], None)])
cases("media_cases", "url string, kind string", lambda u, k: F.concat_ws("/", pages.media_type(k), pages.is_pdf(u, k).cast("string")), [("https://a/x", "application/pdf; charset=x", "application/pdf/true"), ("https://a/x.PDF?y", "text/html", "text/html/true"), ("https://a/x.pdf.html", None, "/false")])
cases("page_url_cases", "url string", lambda u: F.array_join(F.concat(pages.page_urls(u, 3), pages.page_urls(u, 2, "https://t/{n}")), " "), [("https://a/l/", "https://a/l/ https://a/l/page/2/ https://a/l/page/3/ https://a/l/ https://t/2")])


cases("suffix_cases", "title string", lambda t: text.strip_title_suffix(t, ["gCaptain", "Splash 247"]), [("Ship sinks | Some Site", "Ship sinks"), ("Ship sinks - gCaptain", "Ship sinks"), ("Ship sinks - again", "Ship sinks - again"), ("A | b", "A | b")])
cases("named_section_cases", "body string", lambda b: F.array_join(F.transform(text.sections(b), lambda s: F.concat_ws(":", s["number"].cast("string"), s["heading"], s["snippet"])), "|"), [
    ("Section 1: Hull\nfirst\n\nPage 3\nPart 2 - Cargo\nItem 3. Crew here\n" + "x" * 4000, "1:Hull:first Page 3|2:Cargo:Cargo|3:Crew here:" + "x" * 400), ("1. Wrong start\n2. Second one\n1. Heading one\n2. Heading two\n3. Heading three\n" + "y" * 4000, "1:Heading one:Heading one|2:Heading two:Heading two|3:Heading three:" + "y" * 400)])


@expect("detail_cases", "page_id long, title string, excerpt string, image string, author string", [(1, "Head", "Body text here.", "https://a.b/i.png", "Ann"), (2, "Only tag", "x y", "https://a.b/p.jpg", None), (3, None, "", None, None)])
def detail_cases(spark, d):
    rows = [(1, "https://a.b/1", '<head><title>T | Site</title><meta name="author" content="Ann"><meta name="twitter:image" content="/i.png"></head><body><h1> Head </h1><div class="c">Body <span class="promo">buy</span>text here.</div></body>'), (2, "https://a.b/2", '<title>Only tag | Some Site</title><body><main><p class="c">x</p><p class="c">y</p><img src="p.jpg"></main></body>'), (3, "https://a.b/3", None)]
    return pages.details(spark.createDataFrame(rows, "page_id long, url string, html string"), [], content=".c", exclude=".promo")


@expect("prose_cases", "page_id long, mode string, size int", [(1, "paragraphs", 624), (2, "broad", 9), (3, "none", 0)])
def prose_cases(spark, d):
    rows = [(1, "<article><p>" + "word " * 61 + "end ok.</p><p>short.</p><p>" + "More " * 60 + "stop now.</p></article>"), (2, "<body><nav>menu</nav><p>Tiny.</p><div class='related'>x</div>more</body>"), (3, None)]
    return pages.article_texts(spark.createDataFrame(rows, "page_id long, html string")).select("page_id", "mode", F.length("text").alias("size"))


@query(f"""WITH {ART}, s AS (SELECT doc_id, {", ".join(f"{any_re('title || chr(10) || substr(excerpt, 1, 400)', p)} AS s{i}" for i, p in enumerate(L.SEGMENTS.values()))} FROM art)
SELECT doc_id, concat_ws(',', {", ".join(f"CASE WHEN s{i} THEN '{n}' END" for i, n in enumerate(L.SEGMENTS) if n in ("tanker", "container"))}) AS kept, {" + ".join(f"(NOT s{i})::INT" for i, n in enumerate(L.SEGMENTS) if n in ("tanker", "container"))} AS dropped FROM s""")
def segment_rederivation(spark, d):
    """Stored segments that a new reading still finds stay, in their order; the others are dropped."""
    none = F.lit(None).cast("string")
    old = F.array(F.lit("tanker"), F.lit("container"))
    x = articles(spark, d).select("doc_id", old.alias("old"), enrich.segments(F.col("title"), F.col("excerpt"), none, none).alias("new"))
    return x.select("doc_id", F.array_join(lookups.reclassified(F.col("old"), F.col("new")), ",").alias("kept"), F.size(F.array_except("old", "new")).alias("dropped"))


@query(f"WITH {LOGS} SELECT source_id, run_id, status, found FROM logs QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY started_at DESC, run_id DESC) = 1")
def latest_run(spark, d):
    return monitor.latest(logs(spark, d), 1).select("source_id", "run_id", "status", "found")


UNDATED = Literal("source_id string, url string, title string, excerpt string, published_at timestamp, require_date boolean, date_fallback boolean", [
    ("a", "https://a/1", "Report of June 2026", GOOD, None, True, True), ("a", "https://a/2", "No month in here", GOOD, None, True, True), ("b", "https://a/3", "No month in here", GOOD, None, False, None), ("c", "https://a/4", "No month in here", GOOD, None, None, None), ("c", "https://a/5", "A dated headline", GOOD, dt.datetime(2026, 1, 1), None, None), ("d", "https://a/6", "No month in here", GOOD, None, False, True)])


@expect("undated_cases", "url string, outcome string, day string, published_at_source string", [("https://a/1", "inserted", "2026-06-30", "scraper_default"), ("https://a/2", "rejected_no_date", None, None), ("https://a/3", "inserted", None, None), ("https://a/4", "rejected_no_date", None, None), ("https://a/5", "inserted", "2026-01-01", None), ("https://a/6", "rejected_no_date", None, None)])
def undated_cases(spark, d):
    raw = UNDATED.frame(spark).withColumn("source_name", F.col("source_id")).withColumn("category_hint", F.lit(None).cast("string")).withColumn("trust", F.lit("trusted"))
    return judge(raw, None, at(NOON)).select("url", "outcome", F.to_date("published_at").cast("string").alias("day"), "published_at_source")
