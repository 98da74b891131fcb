"""Listings and detail pages as rows: links, cards, hubs, main bodies, page dates. Pages are parsed in Arrow batches, each once."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.text import strip_title_suffix, url_hash
from tidemark.sources.dom import Node, squash, tree

HOLDERS = ['[itemprop="articleBody"]', "article", '[role="article"]', '[role="main"] article', '[role="main"]', "main article", "main", *[f".{c}" for c in "entry-content post-content article-content article-body story-body content-body post-body content".split()], "body"]
_ROLES = "banner complementary contentinfo navigation search".split()
_CLASSES = """ad ad-container ads adsbygoogle advertisement aside breadcrumb breadcrumbs comment-list comment-section comments cookie cookie-banner cookie-consent cta footer gdpr global-footer global-header header intro-block
    lead-in main-nav masthead menu modal nav navbar navigation newsletter newsletter-signup overlay page-footer page-header popup primary-nav promo promo-banner promo-box promotional recommended related related-articles related-posts
    share share-bar share-buttons sharing side-bar sidebar signup site-footer site-header site-nav social social-share subscribe subscription tease tease-content you-may-also-like""".split()
_PARTS = "ArticleCard Card_ HorizontalCard NewsCard StoryCard VerticalCard additional-articles additional-news latest-news more-articles more-news more-stories next-article next-read other-articles other-news recommended suggested".split()
NOISE = ", ".join(["aside", "footer", "form", "header", "iframe", "nav", "noscript", "style", *[f'[role="{r}"]' for r in _ROLES], *[f".{c}" for c in _CLASSES], *[f'[class*="{c}"]' for c in _PARTS]])
BODY_FIELDS = {y for x in ("bodyPlainText", "articleBody", "bodyText", "plainText", "fullText", "storyBody", "content", "body") for y in (x, x[0].upper() + x[1:])}


def json_body(root, deepest: int = 8, least: int = 200) -> str | None:
    """Breadth first through JSON: the first body field of `least` characters or more, else the longest string that reads like prose."""
    queue, best, at = [(root, 0)], None, 0
    while at < len(queue):
        x, depth = queue[at]
        at += 1
        if depth > deepest or x is None:
            continue
        if isinstance(x, str):
            if len(x) >= least and " " in x and re.search("[.!?]", x) and len(x) > len(best or ""):
                best = x
        elif isinstance(x, list):
            queue += [(y, depth + 1) for y in x]
        elif isinstance(x, dict):
            for k, v in x.items():
                if k in BODY_FIELDS and isinstance(v, str) and len(v) >= least:
                    return v
            queue += [(v, depth + 1) for v in x.values()]
    return best


def main_body(doc: Node, most: int = 2000) -> tuple[str | None, int, str]:
    """Excerpt, how much of it a visitor sees, and where it was found: dom, next_data, meta_description or none. Noise is taken out of doc."""
    data = next((n.text() for n in doc.all("script") if "NEXT_DATA" in n.attrs.get("id", "")), "")
    doc.remove(NOISE)
    for n in doc.all("script"):
        if "NEXT_DATA" not in n.attrs.get("id", "") and n.attrs.get("type") != "application/ld+json":
            n.kids = []
    for holder in HOLDERS:
        n = doc.first(holder)
        paras = [t for p in (n.all("p") if n else []) if len(t := squash(p.text())) >= 40]
        joined = " ".join(paras)[:most].strip()
        if len(joined) >= 80:
            return joined, len(joined), "dom"
    try:
        body = json_body(json.loads(data)) if data.strip() else None
    except ValueError:
        body = None
    if body and len(body) >= 80:
        return squash(body)[:most], 0, "next_data"
    for s in ('meta[name="description"]', 'meta[property="og:description"]', 'meta[name="twitter:description"]'):
        n = doc.first(s)
        if n and len(t := squash(n.attr("content"))[:most]) >= 80:
            return t, 0, "meta_description"
    return None, 0, "none"


def ld_first(doc: Node, deep: bool = True) -> str | None:
    """The date of JSON-LD. deep: all nested objects, last pushed first, three names; else datePublished of objects, lists and @graph alone."""
    names = ("datePublished", "dateCreated", "datePosted") if deep else ("datePublished",)
    for n in doc.all('script[type="application/ld+json"]'):
        try:
            stack = [json.loads(n.text())]
        except ValueError:
            continue
        while stack:
            x = stack.pop() if deep else stack.pop(0)
            if isinstance(x, list):
                stack = stack + x if deep else x + stack
            elif isinstance(x, dict):
                for k in names:
                    if isinstance(x.get(k), str) and x[k].strip():
                        return x[k].strip()
                stack += [v for v in x.values() if isinstance(v, dict | list)] if deep else [x["@graph"]] if isinstance(x.get("@graph"), list) else []
    return None


def _content(doc: Node, *selectors: str) -> str | None:
    for s in selectors:
        n = doc.first(s)
        if n and n.attr("content"):
            return n.attr("content")
    return None


DATE_FIELDS = "selector_datetime string, selector_text string, meta string, json_ld string, time_semantic string, time_loose string, body string, scope string"
SEMANTIC = ", ".join(f"time[{x}][datetime]" for x in ('itemprop="datePublished"', "pubdate", 'class*="publish" i', 'class*="post-date" i', 'class*="entry-date" i'))


def date_fields(html: str | None, date_selector: str | None = None) -> tuple:
    """What a page says of its date, raw."""
    doc = tree(html)
    own = doc.first(date_selector) if date_selector else None
    meta = _content(doc, 'meta[property="article:published_time"]', 'meta[name="article:published_time"]', 'meta[name="publish_date"]', 'meta[name="publication_date"]', 'meta[itemprop="datePublished"]')
    semantic, loose = doc.first(SEMANTIC), doc.first("time[datetime]")
    body = doc.first("body")
    text = squash((body or doc).text())[:30_000]
    scopes = doc.all("article") or doc.all("main")
    heads = frozenset(id(h) for s in scopes for h in s.all("h1, h2"))
    scope = squash("".join(s.text(heads) for s in scopes))[:5000] if scopes else text[:5000]
    return (own.attr("datetime") if own else None, own.text() if own else None, meta, ld_first(doc), semantic.attr("datetime") if semantic else None, None if semantic else loose.attr("datetime") if loose else None, text, scope)


def pieces(b: pa.RecordBatch, col: str, most_rows: int = 256, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """b in runs of at most so many rows and bytes of col, one row at least. Spark's batches fill up to 10,000 rows or 64 MB as
    partitions grow, and what Python makes of a page is several times the page; so only a run is held as Python objects."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(b.column(col)).to_pylist()):
        if i > start and (i - start >= most_rows or held + (n or 0) > most_bytes):
            yield b.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < b.num_rows:
        yield b.slice(start)


def rows_of(df: DataFrame, id_col: str, html_col: str, schema: str, f: Callable[[str | None], list[tuple]], with_url: str | None = None) -> DataFrame:
    """f(html), or f(html, url), -> rows of the schema, with the page's id before them."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = list(to_arrow_schema(types).types)

    def read(b: pa.RecordBatch) -> pa.RecordBatch:
        urls = b.column(with_url).to_pylist() if with_url else None
        got = [f(h, urls[i]) if urls else f(h) for i, h in enumerate(b.column(html_col).to_pylist())]
        at = pa.array([i for i, rows in enumerate(got) for _ in rows], pa.int64())
        cols = list(zip(*[r for rows in got for r in rows], strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([b.column(id_col).take(at), *(pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True))], names=[id_col, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from map(read, pieces(b, html_col))
            del b  # before the next one comes

    return df.select(id_col, html_col, *([with_url] if with_url else [])).mapInArrow(run, f"{id_col} {dict(df.dtypes)[id_col]}, {schema}")


def page_dates(pages: DataFrame, now: Column, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", date_selector: str | None = None) -> DataFrame:
    """id, at, source, confidence, step: the best date of every page, or nulls."""
    raw = rows_of(pages, id_col, html_col, DATE_FIELDS, lambda h: [date_fields(h, date_selector)])
    x = raw.join(pages.select(id_col, F.col(url_col).alias("link")), id_col)
    best = dates.resolve({c: F.col(c) for c in ("selector_datetime", "selector_text", "meta", "json_ld", "time_semantic", "time_loose", "body", "scope", "link")}, now)
    return x.select(id_col, best.alias("b")).select(id_col, F.col("b.at").alias("at"), "b.source", "b.confidence", "b.step")


def bodies(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """id, excerpt, visible_length, found_in, title, paywalled parts of a detail page."""

    def read(h: str | None) -> list[tuple]:
        doc = tree(h)
        t = _content(doc, 'meta[property="og:title"]')
        tag, h1 = doc.first("title"), doc.first("h1")
        title = (t or "").strip() or re.sub(r"\s*[|\-–—]\s*[^|\-–—]+\s*$", "", tag.text().strip()).strip() if (t or "").strip() or (tag and tag.text().strip()) else (h1.text().strip() if h1 else "")
        ld = ld_first(doc, deep=False)
        pdfs = [list(dict.fromkeys(a.attr("href") for a in n.all("a[href]") if re.search(r"\.pdf(\?|#|$)", a.attr("href") or "", re.I))) for n in (doc.first(c) for c in HOLDERS) if n]
        hop = next((p for p in pdfs if p), [])
        excerpt, seen, where = main_body(doc)
        return [(title or None, excerpt, seen, where, ld, hop[0] if len(hop) == 1 and seen < 400 else None)]

    return rows_of(pages, id_col, html_col, "title string, excerpt string, visible_length int, found_in string, json_ld string, embedded_pdf string", read)


ARTICLE_PATH = re.compile(r"/(?:advisor(?:y|ies)|articles?|bulletins?|circulars?|guides?|insights?|news|notices?|publications?|reports?|rules?)/", re.I)
NAV_PATH = re.compile(r"/(?:about|careers|contact|cookie|disclaimer|home|legal|login|privacy|search|sign-in|sign-up|signup|subscribe|terms)(?:\b|/|$)", re.I)


def hub_links(html: str | None, url: str | None) -> list[tuple]:
    """(position, url, link_text) of article-like links of a hub page, on its own host."""
    out: dict[str, str] = {}
    for a in tree(html).all("a[href]"):
        try:
            link = urljoin(url or "", a.attr("href"))
            same = urlsplit(link).hostname == urlsplit(url or "").hostname
        except ValueError:
            continue
        if link.startswith("http") and same and link.split("#")[0] != (url or "").split("#")[0] and link not in out and not NAV_PATH.search(link) and (re.search(r"\.pdf(\?|#|$)", link, re.I) or ARTICLE_PATH.search(link)):
            out[link] = squash(a.text() or a.attr("title"))
    return [(i, u, t) for i, (u, t) in enumerate(out.items())]


def hub_children(pages: DataFrame, known: DataFrame | None = None, most: int = 8, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """id, position, child, link_text: at most `most` children of each hub page, without those already seen (known: url)."""
    x = rows_of(pages, id_col, html_col, "position int, child string, link_text string", hub_links, url_col)
    if known is not None:
        x = x.join(known.select(F.col("url").alias("child")).distinct(), "child", "left_anti")
    w = Window.partitionBy(id_col).orderBy("position")
    return x.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= most).select(id_col, "position", "child", "link_text")


def listing_links(html: str | None, base: str | None, selector: str = "a[href]", pattern: str | None = None, suffix: str = "", limit: int | None = None) -> list[tuple]:
    """(position, url, link_text): links of a listing page, absolute, https, the first of each."""
    out: dict[str, str] = {}
    for a in tree(html).all(selector):
        href = a.attr("href")
        if not href:
            continue
        try:
            link = re.sub("^http:", "https:", urljoin(base or "", href))
        except ValueError:
            continue
        link = re.sub("/$", "", link) + suffix if suffix else link
        if link not in out and (not pattern or re.search(pattern, link)):
            out[link] = squash(a.text() or a.attr("title"))
    return [(i, u, t) for i, (u, t) in enumerate(out.items())][:limit]


def page_urls(list_url: Column, pages: int, template: str | None = None) -> Column:
    """Addresses of a listing's pages: the first as it stands, the others by a template with {n}, else page/n/."""
    rest = lambda n: F.replace(F.lit(template), F.lit("{n}"), n.cast("string")) if template else F.concat(F.regexp_replace(list_url, "/$", ""), F.lit("/page/"), n.cast("string"), F.lit("/"))
    return F.concat(F.array(list_url), F.transform(F.sequence(F.lit(2), F.lit(max(2, pages))), rest)) if pages > 1 else F.array(list_url)


def listing(pages: DataFrame, known: DataFrame | None = None, stop_on_known: int = 5, max_items: int = 15, selector: str = "a[href]", pattern: str | None = None) -> DataFrame:
    """source_id, page, position, url, link_text: the items of listing pages (source_id, page from 1, url, html, status).

    Pages count up to the first that isn't found (404), or whose end has a run of stop_on_known or more known addresses in a row (known: url_hash;
    a new address ends a run, and runs go on over pages). Of an address seen twice the first counts. Known addresses drop out before the limit.
    """
    gone = pages.filter("status = 404").groupBy("source_id").agg(F.min("page").alias("_end"))
    live = pages.join(gone, "source_id", "left").filter(F.col("_end").isNull() | (F.col("page") < F.col("_end"))).withColumn("_key", F.struct("source_id", "page"))
    x = rows_of(live, "_key", "html", "position int, url string, link_text string", lambda h, u: listing_links(h, u, selector, pattern), "url").select("_key.source_id", "_key.page", "position", "url", "link_text")
    by = Window.partitionBy("source_id").orderBy("page", "position")
    x = x.withColumn("_nth", F.row_number().over(Window.partitionBy("source_id", "url").orderBy("page", "position"))).filter("_nth = 1").drop("_nth")
    if known is not None:
        k = known.select(F.col("url_hash").alias("_h"), F.lit(True).alias("_known")).distinct()
        x = x.withColumn("_h", url_hash(F.col("url"))).join(k, "_h", "left").withColumn("_known", F.coalesce("_known", F.lit(False))).drop("_h")
        run = x.withColumn("_i", F.row_number().over(by)).withColumn("_fresh", F.max(F.when(~F.col("_known"), F.col("_i"))).over(by))
        ends = run.groupBy("source_id", "page").agg(F.max("_i").alias("_i"), F.max("_fresh").alias("_fresh")).withColumn("_run", F.col("_i") - F.coalesce("_fresh", F.lit(0)))
        stop = ends.filter(F.col("_run") >= stop_on_known).groupBy("source_id").agg(F.min("page").alias("_stop"))
        x = run.join(stop, "source_id", "left").filter(F.col("_stop").isNull() | (F.col("page") <= F.col("_stop"))).filter(~F.col("_known"))
    return x.withColumn("_n", F.row_number().over(by)).filter(F.col("_n") <= max_items).select("source_id", "page", "position", "url", "link_text")


CARD = "position int, title string, url string, date_text string, image string, excerpt string"


def card_rows(html: str | None, base: str | None, card: str = "article, .card, .post", title: str = "h2, h3", date: str = "time, .date, .publish-date", link: str = "a", image: str = "img", most: int = 25) -> list[tuple]:
    out: dict[str, tuple] = {}
    for c in tree(html).all(card):
        t, a, d, i = c.first(title), c.first(link), c.first(date), c.first(image)
        text = squash(t.text()) if t else ""
        href = a.attr("href") if a else None
        if text and href:
            url = re.sub("^http:", "https:", urljoin(base or "", href))
            when, alt = d.text().strip() if d else "", (i.attr("alt") or "").strip() if i else ""
            src = i.attr("src") if i else None
            out.setdefault(url, (text, url, when or None, re.sub("^http:", "https:", urljoin(base or "", src)) if src else None, " ".join(x for x in (when and when + ".", text, alt if alt != text else "") if x)))
    return [(k, *r) for k, r in enumerate(out.values())][:most]


def cards(pages: DataFrame, now: Column, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Whole rows from a listing alone: a card's title, link, date, image and, as its excerpt, date, title and image text."""
    x = rows_of(pages, id_col, html_col, CARD, card_rows, url_col)
    at = dates.try_parse(F.col("date_text"), now)
    return x.withColumn("published_at", at).withColumn("published_at_source", F.when(at.isNotNull(), "original")).withColumn("published_at_confidence", F.when(at.isNotNull(), "high"))


def fill_images(items: DataFrame, heads: DataFrame) -> DataFrame:
    """items (url, image) whose missing images come from heads (url, html: the beginnings of their pages): og:image either way round, or twitter:image."""
    own = F.coalesce(*[F.nullif(F.regexp_extract("html", p, 1), F.lit("")) for p in (
        r"(?i)<meta[^>]+property=[\"']og:image[\"'][^>]+content=[\"']([^\"']+)", r"(?i)<meta[^>]+content=[\"']([^\"']+)[\"'][^>]+property=[\"']og:image[\"']", r"(?i)<meta[^>]+name=[\"']twitter:image[\"'][^>]+content=[\"']([^\"']+)")])
    h = heads.select("url", F.substring("html", 1, 80 * 1024).alias("html")).select("url", own.alias("_own")).filter("_own is not null").dropDuplicates(["url"])
    return items.join(h, "url", "left").withColumn("image", F.coalesce("image", "_own")).drop("_own")


def media_type(content_type: Column) -> Column:
    return F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))


def is_pdf(url: Column, content_type: Column) -> Column:
    return F.startswith(media_type(content_type), F.lit("application/pdf")) | F.regexp_replace(url, r"[?#].*\z", "").rlike(r"(?i)\.pdf\z")


IMAGES = [('meta[property="og:image"]', "content"), ('meta[name="og:image"]', "content"), ('meta[property="og:image:url"]', "content"), ('meta[name="twitter:image"]', "content"), ('meta[name="twitter:image:src"]', "content"), ('link[rel="image_src"]', "href"), ("article img", "src"), ("main img", "src")]


def detail(html: str | None, url: str | None, title: str = "h1", content: str | None = None, exclude: str | None = None) -> tuple:
    """title, excerpt, image and author of a page. exclude is taken out before the excerpt alone is read, so images and dates still see the whole page."""
    doc = tree(html)
    first, og, tag = doc.first(title), _content(doc, 'meta[property="og:title"]'), doc.first("title")
    name = next((x for x in ((first.text() if first else "").strip(), (og or "").strip(), (tag.text() if tag else "").strip()) if x), None)
    image = next((v for s, a in IMAGES if (n := doc.first(s)) and (v := n.attr(a))), None)
    author = doc.first('meta[name="author"]')
    if exclude:
        doc.remove(exclude)
    if content:
        text = " ".join(t for n in doc.all(content) if (t := squash(n.text())))
    else:
        body = doc.first("article") or doc.first("main") or doc.first("body")
        if body:
            body.remove("script, style")
        text = squash(_spaced(body)) if body else ""
    return name, text[:2000], re.sub("^http:", "https:", urljoin(url or "", image)) if image else None, author.attr("content") if author else None


def _spaced(n: Node) -> str:
    """Text with a blank for every tag."""
    out: list[str] = []
    todo: list[Node | str] = [n]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            out.append(" ")
            todo += [" ", *reversed(x.kids)]
    return "".join(out)


def details(pages_: DataFrame, sites: list[str], id_col: str = "page_id", html_col: str = "html", url_col: str = "url", title: str = "h1", content: str | None = None, exclude: str | None = None) -> DataFrame:
    """id, title (without the site's name), excerpt, image, author."""
    x = rows_of(pages_, id_col, html_col, "title string, excerpt string, image string, author string", lambda h, u: [detail(h, u, title, content, exclude)], url_col)
    return x.withColumn("title", strip_title_suffix(F.col("title"), sites))


def article_text(html: str | None, least: int = 500) -> tuple[str, str]:
    """Text and how it was found: prose paragraphs of 70 characters or more, or, where these are under `least`, all of the article without page furniture if that is more."""
    doc = tree(html)
    doc.remove("script, style, noscript, figcaption")
    scope = doc.first("article") or doc.first("main") or doc.first("body")
    if scope is None:
        return "", "none"
    paras = [t for p in scope.all("p") if len(t := squash(p.text())) >= 70 and re.search("[a-z]", t) and re.search("[.!?]", t) and not re.match(r"by |photo|image|credit|source:|copyright|©", t, re.I)]
    text = " \n ".join(paras)
    if len(text) < least:
        scope.remove(", ".join(["aside", "footer", "form", "header", "nav", *[f'[class*="{c}"]' for c in ("footer", "header", "menu", "nav", "related", "share", "sidebar", "widget")], '[id*="menu"]', '[id*="nav"]']))
        broad = squash(scope.text())
        if len(broad) > len(text):
            return broad, "broad"
    return text, "paragraphs"


def article_texts(pages_: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    return rows_of(pages_, id_col, html_col, "text string, mode string", lambda h: [article_text(h)])
