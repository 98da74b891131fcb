"""Fetched payloads into rows: RSS and Atom, REST posts, sitemaps, pages."""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import html_to_text, https, strip_cache_bust
from tidemark.operators.gates import gate_reason
from tidemark.operators.outcomes import selected_text
from tidemark.sources.pages import rows_of

ITEM = "feed_url string, position int, link string, title string, body string, published string, image string, author string"


def _feed_rows(url: str, text: str | None) -> Iterator[tuple]:
    try:
        root = ET.fromstring(text or "")
    except ET.ParseError:
        return
    bare = lambda e: e.tag.rpartition("}")[2].lower()
    for k, item in enumerate(e for e in root.iter() if bare(e) in ("item", "entry")):
        found: dict[str, str] = {}
        image = None
        for e in item.iter():
            name, own = bare(e), (e.text or "").strip()
            if name == "link" and e.get("href") and e.get("rel", "alternate") == "alternate":
                own = e.get("href", "")
            if name in ("content", "thumbnail") and e.get("url"):
                image = image or (e.get("url") if name == "thumbnail" or "image" in e.get("medium", "") + e.get("type", "image") else None)
            elif name == "enclosure" and e.get("type", "").startswith("image/"):
                image = image or e.get("url")
            elif own:
                found.setdefault("encoded" if name == "encoded" else name, own)
        body = next((found[n] for n in ("encoded", "content", "description", "summary") if n in found), "")
        if not image and (m := re.search(r"<img[^>]+src=[\"']([^\"']+)", body)):
            image = m[1]
        if found.get("link") and found.get("title"):
            yield url, k, found["link"], found["title"], body, next((found[n] for n in ("pubdate", "published", "updated", "date") if n in found), None), image, found.get("creator") or found.get("author") or found.get("name")


def feed_items(payloads: DataFrame) -> DataFrame:
    """(feed_url, payload) -> items with a link and a title. excerpt: at most 2000 characters of the body's text,
    or the title where that has under 30. A payload that isn't XML has no items."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [c.split()[0] for c in ITEM.split(", ")]
        for f in frames:
            yield pd.DataFrame([r for u, p in zip(f["feed_url"], f["payload"], strict=True) for r in _feed_rows(u, p)], columns=cols)

    x = payloads.select("feed_url", "payload").mapInPandas(run, ITEM)
    text = F.substring(html_to_text(F.col("body")), 1, 2000)
    return x.withColumn("title", html_to_text(F.col("title"))).withColumn("excerpt", F.when(F.length(text) < 30, F.col("title")).otherwise(text)).withColumn("published_at_source", F.when(F.col("published").isNotNull(), "original")).withColumn("published_at_confidence", F.when(F.col("published").isNotNull(), "high")).drop("body")


def posts(payloads: DataFrame) -> DataFrame:
    """(site, payload) with a JSON array of REST posts -> a row for each that has a link and a title. GMT dates get their Z where it is missing; an excerpt
    that fails the gate is '', others have at most 500 characters; terms come from content or excerpt."""
    kind = "array<struct<id: long, link: string, date_gmt: string, title: struct<rendered: string>, excerpt: struct<rendered: string>, content: struct<rendered: string>>>"
    p = payloads.select("site", F.explode(F.from_json("payload", kind)).alias("p"))
    plain = lambda c: F.coalesce(html_to_text(F.col(c)), F.lit(""))
    p = p.select("site", "p.id", "p.link", plain("p.title.rendered").alias("title"), plain("p.excerpt.rendered").alias("short"), plain("p.content.rendered").alias("content"), F.col("p.date_gmt").alias("gmt")).filter("link is not null and link <> '' and title <> ''")
    x = p.withColumn("sel", selected_text(F.col("title"), F.col("content"), F.col("short")))
    excerpt = F.when(gate_reason(F.col("title"), F.col("short")).isNull(), F.substring("short", 1, 500)).otherwise("")
    when = F.when(F.col("gmt").rlike("[Zz]$"), F.col("gmt")).otherwise(F.concat("gmt", F.lit("Z")))
    return x.select("site", "id", strip_cache_bust(F.col("link")).alias("link"), "title", excerpt.alias("excerpt"), when.alias("published_at"), F.lit("original").alias("published_at_source"), F.lit("high").alias("published_at_confidence"), "sel.text_source", "sel.content_terms", "sel.gate_reason")


def sitemap_entries(payloads: DataFrame, pattern: str | None = None) -> DataFrame:
    """(sitemap_url, payload) -> sitemap_url, loc, lastmod, nth of leaf entries, newest first in each; no or bad dates last, ties as they stand."""
    block = F.posexplode(F.regexp_extract_all("payload", F.lit(r"(?s)<url>(.*?)</url>"), F.lit(1))).alias("at", "b")
    x = payloads.select("sitemap_url", block).select("sitemap_url", "at", F.trim(F.regexp_extract("b", r"(?s)<loc>\s*(.*?)\s*</loc>", 1)).alias("loc"), F.try_to_timestamp(F.nullif(F.regexp_extract("b", r"<lastmod>\s*(.*?)\s*</lastmod>", 1), F.lit(""))).alias("lastmod"))
    x = x.filter(F.col("loc") != "")
    if pattern:
        x = x.filter(F.col("loc").rlike(pattern))
    w = Window.partitionBy("sitemap_url").orderBy(F.desc_nulls_last("lastmod"), "at")
    return x.withColumn("nth", F.row_number().over(w)).drop("at")


def freshest_child(payloads: DataFrame) -> DataFrame:
    """(sitemap_url, payload) of sitemap indexes -> sitemap_url, child: the child with the latest date, the first of equals."""
    block = F.posexplode(F.regexp_extract_all("payload", F.lit(r"(?s)<sitemap>(.*?)</sitemap>"), F.lit(1))).alias("at", "b")
    when = F.coalesce(F.try_to_timestamp(F.nullif(F.regexp_extract("b", r"<lastmod>\s*(.*?)\s*</lastmod>", 1), F.lit(""))), F.lit("1970-01-01").cast("timestamp"))
    x = payloads.select("sitemap_url", block).select("sitemap_url", F.regexp_extract("b", r"(?s)<loc>\s*(.*?)\s*</loc>", 1).alias("loc"), F.struct(when.alias("when"), (-F.col("at")).alias("at")).alias("key"))
    return x.groupBy("sitemap_url").agg(F.max_by("loc", "key").alias("child"))


SKIP = {"aside", "button", "figcaption", "footer", "form", "head", "header", "iframe", "nav", "noscript", "script", "style", "svg"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.title, self.h1, self.ld, self.time = "", "", [], None
        self.paras: dict[str, list[str]] = {"article": [], "main": [], "body": []}
        self.links: list[tuple[str, str]] = []
        self.image: str | None = None
        self.stack: list[str] = []
        self.para: list[str] | None = None
        self.grab: str | None = None
        self.raw: list[str] = []

    def close_para(self) -> None:
        if self.para is not None:
            text = re.sub(r"\s+", " ", "".join(self.para)).strip()
            if text:
                for k in self.paras:
                    if k == "body" or k in self.stack:
                        self.paras[k].append(text)
            self.para = None

    def handle_starttag(self, tag: str, attrs) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.meta.setdefault((a.get("property") or a.get("name") or "").lower(), a.get("content", ""))
        elif tag == "time" and self.time is None:
            self.time = a.get("datetime")
        elif tag == "a" and a.get("href"):
            self.links.append((a["href"], ""))
        elif tag == "img" and self.image is None and a.get("src"):
            self.image = a["src"]
        if tag == "script" and a.get("type") == "application/ld+json":
            self.grab, self.raw = "ld", []
        elif tag in ("title", "h1") and not getattr(self, tag):
            self.grab, self.raw = tag, []
        if tag == "p":
            self.close_para()
            if not SKIP & set(self.stack):
                self.para = []
        if tag not in VOID and tag != "p":
            self.stack.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("p", "article", "main", "body", "div", "section"):
            self.close_para()
        if self.grab and tag in ("script", "title", "h1"):
            text = "".join(self.raw).strip()
            if self.grab == "ld":
                self.ld.append(text)
            else:
                setattr(self, self.grab, re.sub(r"\s+", " ", text))
            self.grab = None
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self.grab:
            self.raw.append(data)
        if self.para is not None:
            self.para.append(data)


def ld_date(blocks: list[str]) -> str | None:
    """datePublished of JSON-LD, in nested objects too."""
    todo: list = []
    for b in blocks:
        try:
            todo.append(json.loads(b))
        except ValueError:
            pass
    while todo:
        x = todo.pop(0)
        if isinstance(x, dict):
            for k in ("datePublished", "dateCreated", "datePosted"):
                if isinstance(x.get(k), str):
                    return x[k]
            todo += [v for v in x.values() if isinstance(v, dict | list)]
        elif isinstance(x, list):
            todo += x
    return None


PAGE = "title string, body string, image string, author string, description string, ld_date string, meta_date string, time_date string, links array<string>"


def read_page(html: str | None, least: int = 40) -> tuple:
    p = _Page()
    p.feed(html or "")
    p.close()
    p.close_para()
    body = ""
    for k in ("article", "main", "body"):
        long = [x for x in p.paras[k] if len(x) >= least]
        if sum(map(len, long)) >= 80:
            body = "\n".join(long)
            break
    m = p.meta
    body = body or (m.get("description", "") if len(m.get("description", "")) >= 80 else "")
    return (p.h1 or m.get("og:title") or p.title or None, body[:2000] or None, m.get("og:image") or m.get("twitter:image") or p.image, m.get("author") or None, m.get("description") or None, ld_date(p.ld), m.get("article:published_time") or m.get("date") or None, p.time, list(dict.fromkeys(u for u, _ in p.links)))


def page_details(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A row a page: title (h1, og:title, title), body (paragraphs of 40 characters or more, from article, main or body; at most 2000), image, author, dates, links."""
    return rows_of(pages, id_col, html_col, PAGE, lambda h: [read_page(h)])


def pdf_magic(content: Column) -> Column:
    return F.instr(F.substring(content, 1, 1024).cast("string"), "%PDF-") > 0


def absolute(base: Column, link: Column) -> Column:
    """link against base (http and https become https)."""
    root = F.regexp_extract(base, r"^([a-z]+://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*\z", ""), r"(?<=[^/:])/[^/]*\z", "/")
    return https(F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(F.startswith(link, F.lit("//")), F.concat(F.lit("https:"), link)).when(F.startswith(link, F.lit("/")), F.concat(root, link)).otherwise(F.concat(folder, link)))


#: Discovery strategies by name: (payload frame) -> rows.
STRATEGIES: dict[str, Callable[[DataFrame], DataFrame]] = {"rss": feed_items, "rest": posts, "sitemap": sitemap_entries}


def union_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """All parts with the path that each row came by; a column that a part lacks is null there."""
    out = None
    for name, df in parts.items():
        x = df.withColumn("path", F.lit(name))
        out = x if out is None else out.unionByName(x, allowMissingColumns=True)
    if out is None:
        raise ValueError("no sources")
    return out
