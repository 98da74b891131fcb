"""Gates: each names the first rule that a row fails."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import lexicons as L
from tidemark.functions.text import Finder, let, matches, trim


def cta_density(text: Column, patterns: list[str] = L.CTA) -> Column:
    """How often calls to act occur, all patterns together."""
    f = Finder(patterns)
    count = lambda x: sum((F.when(F.arrays_overlap(x["heads"], F.lit(f.heads[p])), F.regexp_count(x["text"], F.lit(L.java_pattern(p)))).otherwise(0) for p in patterns), F.lit(0))
    return let(f.read(text), count)


def article_reason(title: Column, excerpt: Column, url: Column | None = None) -> Column:
    """Why a row is no article, or null."""
    t, e = trim(F.coalesce(title, F.lit(""))), trim(F.coalesce(excerpt, F.lit("")))
    u = F.coalesce(url, F.lit("")) if url is not None else F.lit("")
    f = Finder(L.LOCKED, L.JUNK_PHRASES)
    low = F.struct(e.alias("text"), F.lower(e).alias("low"))
    video = u.rlike(r"^https?://(?:www\.)?youtube\.com/watch\?v=")
    out = F.when(F.length(t) < 8, "title-short").when(matches(t, L.HUB_TITLES), "title-hub").when(matches(t, L.CTA_TITLES), "title-cta").when(matches(u, L.JUNK_URLS), "url-junk")
    out = out.when(~video & (F.length(e) < 30), "excerpt-short").when(let(low, lambda x: f.any(x, L.LOCKED)), "locked")
    for p in L.JUNK_PHRASES:
        left = F.length(trim(F.regexp_replace(F.regexp_replace(e, L.java_pattern(p), " "), r"\s+", " ")))
        out = out.when(_junk(f, low, p) & (left < 100), "junk-phrase")
    return out.when((F.length(e) > 800) & (cta_density(e) >= 8), "cta-dense")


def _junk(f: Finder, low: Column, p: str) -> Column:
    return let(low, lambda x: f.has(x, p))


def is_hub(title: Column, excerpt: Column) -> Column:
    return matches(trim(title), L.HUB_TITLES) | ((F.length(trim(excerpt)) > 800) & (cta_density(excerpt) >= 8))


def moderate(title: Column, excerpt: Column, topic: list[str] = L.MARITIME, spam: list[str] = L.SPAM) -> Column:
    """struct<decision, reason, hits, matched>: hidden are texts with fewer than two topic hits that match a spam pattern;
    matched is what the first of these found, 50 characters at most."""
    f = Finder(topic, spam)

    def verdict(x: Column) -> Column:
        hide = (x["n"] < 2) & x["what"].isNotNull()
        return F.struct(F.when(hide, "hide").otherwise("pass").alias("decision"), F.when(hide, "spam").when(x["n"] >= 2, "maritime").otherwise("unknown").alias("reason"), x["n"].alias("hits"), F.when(hide, F.substring(x["what"], 1, 50)).alias("matched"))

    def weigh(x: Column) -> Column:
        what = F.coalesce(*[F.when(f.has(x, p), F.regexp_extract(x["text"], L.java_pattern(p), 0)) for p in spam])
        return let(F.least(F.lit(2), f.count(x, topic)), lambda n: verdict(F.struct(n.alias("n"), F.when(n < 2, what).alias("what"))))

    return let(f.read(F.concat_ws("\n", title, excerpt)), weigh)


def visibility(decision: Column, trust: Column) -> Column:
    return F.when(decision == "hide", "hidden").when(trust == "aggregator", "pending").otherwise("visible")


def gate_reason(title: Column, text: Column, boilerplate: list[str] = L.BOILERPLATE) -> Column:
    """Why a text isn't worth its terms: too-short, boilerplate (in the first 150 characters), no-title-overlap; or null."""
    t = trim(F.coalesce(text, F.lit("")))
    words = F.filter(F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(r"[A-Za-z][A-Za-z0-9'-]*"), F.lit(0)), lambda w: F.length(w) > 3)
    low = F.lower(t)
    return F.when(F.length(t) < 25, "too-short").when(matches(F.substring(t, 1, 150), boilerplate), "boilerplate").when((F.size(words) >= 3) & ~F.exists(words, lambda w: F.contains(low, F.lower(w))), "no-title-overlap")


CONNECTORS = ["&", "and", "de", "del", "du", "for", "la", "le", "of", "the", "van", "von"]
STOP_TERMS = sorted(set("""
    according additionally advertisement afp associated author bloomberg byline caption categories category comment comments commercial cookie cookies credit credits
    earlier everyone facebook feature features file getty here home however image images instagram later linkedin listen meanwhile menu more newsletter newsroom photo photos
    post posts press print privacy published read recently related reuters screengrab share source sources spokesperson sponsored staff statement subscribe tag tags telegram
    that the there these this those tiktok today tomorrow twitter update updates video watch whatsapp yesterday youtube january february march april may june july august september
    october november december jan feb mar apr jun jul aug sep sept oct nov dec monday tuesday wednesday thursday friday saturday sunday""".split()))  # fmt: skip
STOP_FIRST = sorted(set("added after also although as authorities authority before built by despite during earlier general given however if instead later meanwhile official officials overall since speaking though unlike when while".split()))


def proper_term(term: Column) -> Column:
    """A name (one to three capitalised words, with connectors) or an acronym."""
    words = F.filter(F.split(trim(term), r"\s+"), lambda w: w != "")
    one = F.coalesce(F.try_element_at(words, F.lit(1)), F.lit(""))
    single = (one.rlike(r"^[A-Za-z0-9][A-Za-z0-9&.\-]*\z") & (F.regexp_count(one, F.lit("[A-Z]")) >= 2)) | one.rlike(r"^[A-Z][a-z]{2,}\z")
    main = F.filter(words, lambda w: ~F.lower(w).isin(CONNECTORS))
    return F.when(F.size(words) == 1, single).otherwise(F.size(main).between(1, 3) & F.forall(main, lambda w: w.rlike("^[A-Z]")))


def filter_terms(title: Column, terms: Column) -> Column:
    """Terms that are names or acronyms, hold no stop word, don't begin with a stop lead and aren't part of the title; first of each, whatever its case."""
    squash = lambda x: trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))
    padded = F.concat(F.lit(" "), squash(F.coalesce(title, F.lit(""))), F.lit(" "))
    bare = lambda t: F.transform(F.split(t, r"\s+"), lambda w: F.regexp_replace(F.lower(w), "[^a-z0-9]", ""))
    ok = lambda t: ~F.exists(bare(t), lambda w: w.isin(STOP_TERMS)) & ~F.element_at(bare(t), 1).isin(STOP_FIRST) & ((squash(t) == "") | ~F.contains(padded, F.concat(F.lit(" "), squash(t), F.lit(" ")))) & proper_term(t)
    first = lambda kept: F.filter(kept, lambda t, i: F.array_position(F.transform(kept, lambda x: F.lower(x)), F.lower(t)) == i + 1)
    return let(F.filter(terms, ok), first)


def paywalled(text: Column, marks: list[str] = L.PAYWALL) -> Column:
    """Whether the text, whatever its case, holds one of the marks."""
    return F.coalesce(let(F.lower(text), lambda low: F.exists(F.lit(marks), lambda m: F.contains(low, m))), F.lit(False))


def outcome(reasons: dict[str, Column]) -> Column:
    """struct<decision, reason>: the first reason (in the order given) that holds rejects; else would_insert."""
    reason = F.coalesce(*[F.when(c, F.lit(k)) for k, c in reasons.items()])
    return F.struct(F.when(reason == "duplicate", "duplicate").when(reason.isNotNull(), "rejected").otherwise("would_insert").alias("decision"), reason.alias("reason"))
