"""Dates in text and their choice. `now` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.lexicons import EDGE, MONTHS
from tidemark.functions.text import let

_M = "(" + "|".join(MONTHS) + ")[a-z]*"


def make_date(y: Column, m: Column, d: Column) -> Column:
    """A real calendar day from 1990 to 2100, or null."""
    ok = y.between(1990, 2100) & m.between(1, 12) & d.between(1, 31)
    return F.when(ok, F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd"))


def month_number(name: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(name, 1, 3))).cast("int")


#: In this order; all matches of one family come before the next. (pattern, groups as (kind, place))
FAMILIES: list[tuple[str, str]] = [
    (rf"{_M}\s+(\d{{1,2}}),?\s+(\d{{4}})", "Mdy"), (rf"(\d{{1,2}})(?:\s+of)?\s+{_M},?\s+(\d{{4}})", "dMy"), (rf"(\d{{1,2}})-{_M}-(\d{{4}})", "dMy"), (rf"{_M}-(\d{{1,2}})-(\d{{4}})", "Mdy"),
    (r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", "ymd"), (r"(\d{1,2})[.\-](\d{1,2})[.\-](\d{4})", "eu"), (r"(\d{1,2})/(\d{1,2})/(\d{4})", "us"), (rf"{_M}\s+(\d{{4}})", "My"),
]


def find_all_dates(text: Column) -> Column:
    """All dates in text, by family of notation and then by place. Dots and dashes read day first, slashes
    month first, unless a number above 12 says otherwise."""
    def family(s: Column, pattern: str, kind: str) -> Column:
        whole = "(?i)" + EDGE + pattern + EDGE

        def date(p: Column) -> Column:
            at = lambda i: F.try_element_at(p, F.lit(i))
            num = lambda x: F.when(F.length(x) < 5, x).cast("int")
            if kind == "Mdy":
                return make_date(num(at(3)), month_number(at(1)), num(at(2)))
            if kind == "dMy":  # from the end, as "of" may stand between
                return make_date(num(at(-1)), month_number(at(-2)), num(at(1)))
            if kind == "ymd":
                return make_date(num(at(1)), num(at(2)), num(at(3)))
            if kind == "My":
                return make_date(num(at(2)), month_number(at(1)), F.lit(1))
            a, b, y = num(at(1)), num(at(2)), num(at(3))
            swap = (a <= 12) & (b > 12) if kind == "eu" else ~((a > 12) & (b <= 12))
            return make_date(y, F.when(swap, a).otherwise(b), F.when(swap, b).otherwise(a))

        # a match is split once into its numbers and words
        parts = F.transform(F.regexp_extract_all(s, F.lit(whole), F.lit(0)), lambda x: F.split(x, "[^0-9A-Za-z]+"))
        return F.filter(F.transform(parts, date), lambda d: d.isNotNull())

    none = F.array().cast("array<date>")
    return let(F.regexp_replace(text, rf"(?i)(\d+)(?:st|nd|rd|th){EDGE}", "$1"), lambda x: F.when(x.rlike(r"\d{4}"), _families(x, family)).otherwise(F.when(x.isNotNull(), none)))


def _families(s: Column, family) -> Column:
    return F.concat(*[family(s, p, k) for p, k in FAMILIES])


def first_date(text: Column, now: Column) -> Column:
    """The first date that lies at most 24 hours after now."""
    return F.try_element_at(F.filter(find_all_dates(text), lambda d: d.cast("timestamp") <= now + F.expr("INTERVAL 24 HOURS")), F.lit(1))


CONFIDENCE = {"high": 3, "medium": 2, "low": 1}
ORIGIN = {"original": 3, "inferred": 2, "scraper_default": 1}


def _rank(x: Column, order: dict[str, int]) -> Column:
    out = F.lit(0)
    for k, v in order.items():
        out = F.when(x == k, v).otherwise(out)
    return out


def best_date(candidates: Column) -> Column:
    """Of array<struct<iso, source, confidence, step>> the one with the highest confidence, then origin, then the
    lowest step (null: 99), then the earliest place."""
    rated = F.transform(candidates, lambda c, i: F.struct((-_rank(c["confidence"], CONFIDENCE)).alias("a"), (-_rank(c["source"], ORIGIN)).alias("b"), F.coalesce(c["step"], F.lit(99)).alias("s"), i.alias("i"), c.alias("c")))
    return F.try_element_at(F.transform(F.filter(F.array_sort(rated), lambda r: r["c"]["iso"].isNotNull()), lambda r: r["c"]), F.lit(1))


def fallback_date(title: Column, now: Column) -> Column:
    """A date from month and year in a title: the month's last day at noon, where it is past; now for the
    current month and later ones. struct<at, day_known, basis>, or null without a month."""
    whole = rf"(?i){EDGE}{_M}\s+(\d{{4}}){EDGE}"
    m, y = month_number(F.regexp_extract(title, whole, 1)), F.try_to_number(F.regexp_extract(title, whole, 2), F.lit("9999")).cast("int")
    day = make_date(y, m, F.lit(1))
    past = day < F.trunc(now.cast("date"), "month")
    at = F.when(past, F.last_day(day).cast("timestamp") + F.expr("INTERVAL 12 HOURS")).otherwise(now)
    return F.when(day.isNotNull(), F.struct(at.alias("at"), F.lit(False).alias("day_known"), F.when(past, "title_month").otherwise("capture").alias("basis")))


SIGNALS = ["rss", "jsonld", "meta", "time", "sitemap", "body", "pdf"]


def cascade(signals: dict[str, Column]) -> Column:
    """The first signal (a date) in the order of SIGNALS; high confidence where two or more agree, else
    medium, and low for a sitemap that none agrees with. struct<day, signal, confidence, agreeing>."""
    own = [F.struct(F.lit(s).alias("signal"), signals[s].alias("day")) for s in SIGNALS if s in signals]
    given = F.filter(F.array(*own), lambda x: x["day"].isNotNull())
    first = F.try_element_at(given, F.lit(1))
    n = F.size(F.filter(given, lambda x: x["day"] == first["day"]))
    sole = (n == 1) & (first["signal"] == "sitemap")
    return F.when(first.isNotNull(), F.struct(first["day"].alias("day"), first["signal"].alias("signal"), F.when(n >= 2, "high").when(sole, "low").otherwise("medium").alias("confidence"), n.alias("agreeing")))


def pdf_date(text: Column) -> Column:
    """D:YYYYMMDDHHmmSS+HH'mm' as a timestamp; missing parts are the first of their kind, UTC."""
    p = r"^(?:D:)?(\d{4})(\d{2})?(\d{2})?(\d{2})?(\d{2})?(\d{2})?(?:([+-]\d{2})'?(\d{2})?'?|Z)?"
    g = lambda i, least: F.coalesce(F.nullif(F.regexp_extract(text, p, i), F.lit("")), F.lit(least))
    iso = F.concat(g(1, "0000"), F.lit("-"), g(2, "01"), F.lit("-"), g(3, "01"), F.lit("T"), g(4, "00"), F.lit(":"), g(5, "00"), F.lit(":"), g(6, "00"), g(7, "+00"), F.lit(":"), g(8, "00"))
    return F.when(text.rlike(p), F.try_to_timestamp(iso))


def native(text: Column) -> Column:
    """Times with a zone or clock: ISO (UTC where no zone is given) and '29 May 2026 10:00[:00] [GMT|+0000]'."""
    t = F.trim(text)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?\z"), F.try_to_timestamp(F.regexp_replace(t, r"([+-]\d{2})(\d{2})\z", "$1:$2")))
    p = rf"(?i)^(?:[a-z]{{3,9}},?\s+)?(\d{{1,2}})\s+{_M}\.?\s+(\d{{4}})\s+(\d{{2}}:\d{{2}})(:\d{{2}})?\s*(?:GMT|UTC|Z)?([+-]\d{{2}})?:?(\d{{2}})?\z"
    g = lambda i: F.regexp_extract(t, p, i)
    made = F.concat(g(3), F.lit("-"), F.lpad(month_number(g(2)).cast("string"), 2, "0"), F.lit("-"), F.lpad(g(1), 2, "0"), F.lit("T"), g(4), F.when(g(5) == "", ":00").otherwise(g(5)), F.when(g(6) == "", "+00:00").otherwise(F.concat(g(6), F.lit(":"), g(7))))
    return F.coalesce(iso, F.when(t.rlike(p), F.try_to_timestamp(made)))


def _read(text: Column, now: Column) -> Column:
    """struct<p, d, n>: text as one date string (try_parse), the first date in it (first_date), and how many different dates it holds. All dates are sought once."""
    t = F.trim(text)
    late = lambda x: F.when(x <= now + F.expr("INTERVAL 24 HOURS"), x)
    n = F.when(t.rlike(r"^\d{10,18}\z"), t).cast("long")
    epoch = late(F.timestamp_millis(F.when(n < 10**12, n * 1000).otherwise(n)))
    clock = t.rlike(r"\dT\d|\d:\d{2}") | t.rlike(r"(?:[+-]\d{2}:?\d{2}|Z)\z")

    def parsed(x: Column) -> Column:
        best = F.when(t == "", None).when(t.rlike(r"^\d{10,}\z"), epoch).when(clock, F.coalesce(x["full"], x["d"])).otherwise(F.coalesce(x["d"], x["full"]))
        return F.struct(best.alias("p"), x["d"].alias("d"), x["n"].alias("n"))

    def dated(every: Column) -> Column:
        first = F.try_element_at(F.filter(every, lambda d: d.cast("timestamp") <= now + F.expr("INTERVAL 24 HOURS")), F.lit(1)).cast("timestamp")
        return let(F.struct(first.alias("d"), late(native(t)).alias("full"), F.size(F.array_distinct(every)).alias("n")), parsed)

    return let(find_all_dates(text), dated)


def try_parse(text: Column, now: Column) -> Column:
    """One date string as a timestamp, not over 24 hours after now: an epoch in seconds or milliseconds; a date without a clock by its
    notation, at midnight UTC; else a full time; else any date in it."""
    return _read(text, now)["p"]


STEPS = ["date_selector", "meta", "time_element_semantic", "body_labelled", "body_bare", "url_path_day", "url_slug_month", "time_element_loose", "title_fallback"]
LABELLED = r"(?i)(?:date|last\s+updated|posted|published|updated)\s*[-:]?\s*([^\n.]{4,80})"
LONG = "january february march april may june july august september october november december".split()


def resolve(page: dict[str, Column], now: Column, title: Column | None = None, day_first: bool = False) -> Column:
    """struct<at, source, confidence, step>: the best date of a page, of selector_datetime, selector_text, meta, json_ld, time_semantic, time_loose, body,
    scope (the article's text without headings), link, and the title; see best_date for the order."""
    no = F.lit(None).cast("string")
    get = lambda k: page.get(k, no)
    shown = F.regexp_replace(get("selector_text"), r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b", "$3-$2-$1") if day_first else get("selector_text")
    path = r"/(20\d{2})/(\d{1,2})(?:/(\d{1,2}))?/"
    part = lambda i: F.regexp_extract(get("link"), path, i)
    has_day = part(3) != ""
    in_path = F.when(get("link").rlike(path), F.concat(part(1), F.lit("-"), F.lpad(part(2), 2, "0"), F.lit("-"), F.lpad(F.when(has_day, part(3)).otherwise("01"), 2, "0"), F.lit("T00:00:00Z")))
    slug = r"(?:^|[/\-])(" + "|".join(LONG) + r")-(20\d{2})(?:[/\-.]|\z)"
    low = F.lower(get("link"))
    month = make_date(F.regexp_extract(low, slug, 2).try_cast("int"), month_number(F.regexp_extract(low, slug, 1)), F.lit(1)).cast("timestamp")
    month = F.when(month <= now + F.expr("INTERVAL 24 HOURS"), month)
    # all texts go through one reading: the expression holds the date notations once
    own = F.array(get("selector_datetime"), shown, get("meta"), get("json_ld"), get("time_semantic"), get("time_loose"), in_path, get("scope"), title if title is not None else no)
    labelled = F.coalesce(F.regexp_extract_all(get("body"), F.lit(LABELLED), F.lit(1)), F.array().cast("array<string>"))
    texts = F.concat(own, labelled)

    def choose(read: Column) -> Column:
        p, d = (lambda i: read[i]["p"]), (lambda i: read[i]["d"])
        label = F.try_element_at(F.filter(F.transform(F.slice(read, 10, F.greatest(F.size(read) - 9, F.lit(0))), lambda r: r["d"]), lambda x: x.isNotNull()), F.lit(1))
        lone = F.when(read[7]["n"] <= 1, "medium").otherwise("low")
        as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
        one = lambda at, source, confidence, name: F.struct(at.alias("iso"), as_col(source).alias("source"), as_col(confidence).alias("confidence"), as_col(name).alias("name"))
        every = F.array(
            one(p(0), "original", "high", "date_selector"), one(p(1), "original", "high", "date_selector"), one(d(1), "original", "high", "date_selector"), one(p(2), "original", "high", "meta"), one(p(3), "original", "high", "json_ld"),
            one(p(4), "original", "high", "time_element_semantic"), one(p(5), "original", "low", "time_element_loose"), one(p(6), F.when(has_day, "original").otherwise("scraper_default"), F.when(has_day, "medium").otherwise("low"), F.when(has_day, "url_path_day").otherwise("url_slug_month")),
            one(label, "original", "high", "body_labelled"), one(d(7), "original", lone, "body_bare"), one(month, "scraper_default", "low", "url_slug_month"), one(d(8), "scraper_default", "low", "title_fallback"),
        )
        place = F.create_map(*[F.lit(x) for i, k in enumerate(STEPS) for x in (k, i + 1)])
        rated = F.transform(every, lambda c, i: F.struct((-_rank(c["confidence"], CONFIDENCE)).alias("a"), (-_rank(c["source"], ORIGIN)).alias("b"), F.coalesce(place[c["name"]], F.lit(99)).alias("s"), i.alias("i"), c.alias("c")))
        return F.try_element_at(F.array_sort(F.filter(rated, lambda r: r["c"]["iso"].isNotNull())), F.lit(1))["c"]

    result = lambda best: F.when(best.isNotNull(), F.struct(best["iso"].alias("at"), best["source"].alias("source"), best["confidence"].alias("confidence"), best["name"].alias("step")))
    return let(let(F.transform(texts, lambda s: _read(s, now)), choose), result)


PROVENANCE = {s: "original" for s in ("body_header_label", "jsonld_datePublished", "meta_article_published_time", "opengraph", "pdf_metadata_creation", "rss_pubdate", "sitemap_lastmod", "time_element_datetime", "time_element_text", "wire_header_date")} | {"unknown": "unknown", "url_slug_yyyy_mm": "body_repaired"}


def db_provenance(source: Column) -> Column:
    """The store's word for where a date came from."""
    return F.create_map(*[F.lit(x) for kv in PROVENANCE.items() for x in kv])[source]


def db_confidence(confidence: Column) -> Column:
    """'none' becomes null, which rejects the row."""
    return F.nullif(confidence, F.lit("none"))
