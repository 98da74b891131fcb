"""Titles, fields and section splits of PDF documents from their text. The cutting of titles goes character by character, so it
runs in Arrow batches over short strings."""

from __future__ import annotations

import re
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.lexicons import MONTHS

I = re.I  # noqa: E741
LABEL = re.compile(r"^(?:click\s+here|continue|download(?:\s+(?:the\s+)?(?:document|file|here|pdf))?|here|link|more|open|pdf|read\s+(?:more|on)|view(?:\s+pdf)?)\.?$", I)
TEMPLATE = re.compile(r"^(?:.*\bletter\s+template|abc|copy|document\s*\d*|draft|final|layout\s*\d*|master\s*template|print|test|untitled(?:\s*\d*)?)$", I)
FILE = re.compile(r"\.(?:ai|cdr|docx?|indd|pdf|pmd|psd|pub|qxd)\s*$", I)
EXPORT = re.compile(r"^(?:adobe\s+(?:acrobat|indesign)|microsoft\s+word|word)\s*[-–—:]\s*", I)
DATE = re.compile(rf"^(?:[0-9]{{1,2}}[-\s./]+)?(?:{'|'.join(MONTHS)})[a-z]*\.?[-\s.,/]*(?:[0-9]{{1,2}})?[\s,]*[0-9]{{2,4}}$", I)
NUMBER = re.compile(r"^[\d\s.,\-/_]+$")


def tidy(s: str | None) -> str:
    return re.sub(r"\s+", " ", EXPORT.sub("", s or "")).strip()


def running_header(s: str) -> bool:
    """A page number beside a bar, twice, or once with a pair of words that repeats."""
    marks = len(re.findall(r"(?:(?:^|\s)\d{1,3}\s*\|)|(?:\|\s*\d{1,3}(?:\s|$))", s))
    words = re.sub(r"[^A-Z ]+", " ", s.upper()).split()
    pairs = list(zip(words, words[1:], strict=False))
    return marks >= 2 or (marks == 1 and len(set(pairs)) < len(pairs))


def usable(raw: str | None) -> bool:
    s = tidy(raw)
    junk = (FILE.search(s), LABEL.match(s), TEMPLATE.match(s), DATE.match(s), NUMBER.match(s))
    return len(s) >= 12 and not running_header(s) and not any(junk) and bool(re.search("[a-z]", s, I)) and len(s.split()) >= 3


def opening(body: str | None) -> str:
    s = re.sub(r"\s+", " ", body or "").strip()
    m = re.match(r"^(.{15,200}?)(?:[.!?]\s|$)", s[:400])
    if len(s) < 15:
        return ""
    if m and len(m[1].strip()) >= 15:
        return m[1].strip()
    words = " ".join(s.split(" ")[:14])
    return words if len(words) >= 15 else ""


def pick(meta: str | None, link: str | None, body: str | None = None) -> str | None:
    """The link's text, else the metadata title, else the opening sentence, whichever is usable first."""
    return next((x for x in (tidy(link), tidy(meta), opening(body)) if usable(x)), None)


def from_url(url: str | None) -> str | None:
    try:
        u = urlsplit(url or "")
    except ValueError:
        return None
    if not u.scheme or not u.netloc:
        return None
    name = re.sub(r"[\s\-_+]+", " ", re.sub(r"\.[a-z0-9]{2,4}$", "", unquote(u.path.split("/")[-1]), flags=I)).strip()
    n = len(name.split(" "))
    if len(name) < 12 or n < 2:
        return None
    if n == 2:
        return None if any((not re.search("[a-z]", name, I), NUMBER.match(name), DATE.match(name), LABEL.match(name), TEMPLATE.match(name))) else name
    return tidy(name) if usable(name) else None


ADDRESSEES = [re.compile(rf"^{p}\b[ ,:]*", I) for p in (
    "All Shipping Agents,? ?Owners,? ?and Operators", "(?:To )?(?:All )?Members? of the Association", r"(?:To )?All (?:Class [0-9]+ )?\(?[A-Za-z ]{0,20}\)? ?Members", "Dear (?:Madam|Member|Sir or Madam|Sirs?)")]
LETTER = re.compile(" (?:[0-9]{1,2} ?[).] ?[A-Z]|At the |Beginning at|Effective |Following |Further to|In (?:accordance|light|view)|It (?:has|is)|Members? (?:are|should|will)|Please (?:be advised|note)|Reference is made|The [A-Z]|This (?:Advisory|Bulletin|Circular|Notice)|We (?:are|have|write)|Your Managers)")
SHORT = re.compile(r"\b(?:approx|apr|art|aug|co|corp|dec|dr|etc|feb|inc|jan|jul|jun|ltd|mar|mr|mrs|ms|no|nos|nov|oct|ref|sec|sept?|st|vol|vs)$", I)
TAIL = re.compile(r"[\s.,;:–—-]+$")


def _tail(s: str) -> str:
    for p in (r"\s*\.{3,}.*$", r"\s+\d{1,3}$", r"\s*[|·•]\s*\d{1,3}$"):
        s = re.sub(p, "", s, count=1)
    m = LETTER.search(s)
    return TAIL.sub("", s[: m.start()] if m and m.start() > 12 else s).strip()


def _capitals(s: str) -> str:
    m = re.match(r"^((?:[A-Z0-9][A-Z0-9'&()/.,:;\-–—\s]{2,}?))(?=\s+[a-z]|$)", s)
    return _tail(re.sub(r"\s+", " ", m[1]).strip()) if m else ""


def _clean(s: str) -> str:
    s = re.sub(r"\s+", " ", s).strip()
    for p in ADDRESSEES:
        s = p.sub("", s, count=1).strip()
    return _tail(s)


def headline(s: str, most: int = 110) -> str:
    """Up to the first real end of a sentence past 25 characters, at most `most` characters, never within a word."""
    t = re.sub(r"\s+", " ", s).strip()
    for i, c in enumerate(t):
        if c in ".!?" and (i + 1 == len(t) or t[i + 1].isspace()) and not SHORT.search(t[:i]) and i >= 25:
            t = t[:i]
            break
    if len(t) > most:
        at = t[:most].rfind(" ")
        t = t[:at] if at > 60 else t[:most]
    return TAIL.sub("", t).strip()


SUBJECT = re.compile(r"\bSUBJECT ?: (.{10,180}?)(?:\. |$)", I)
SALUTATION = re.compile(r"Dear (?:Madam|Members?|Sirs?(?: or Madam)?)\b[ ,:]+(.{10,300})", I)


def _lettered(text: str) -> str:
    return _capitals(text) or _clean(text)


def _canal(s: str) -> tuple[str, str] | None:
    no, subject = re.search(r"Advisor(?:ies|y) (?:To )?Shipping No\.? ?([A-Z]-[0-9]{1,3}-[0-9]{4})", s, I), SUBJECT.search(s)
    body = _clean(subject[1]) if subject else ""
    return (f"Advisory {no[1].upper()}: {body}" if no else body, "panama-subject") if body else None


def _circular(s: str) -> tuple[str, str] | None:
    no, after = re.search(r"CIRCULAR NO\.? ?([0-9]{1,3}/[0-9]{2,4})", s, I), re.search("Dear Members? ?: ?(.{10,300})", s, I)
    body = _lettered(after[1]) if after else ""
    return (f"Circular {no[1]}: {body}" if no else body, "american-circular") if body else None


def _alert(s: str) -> tuple[str, str] | None:
    m = re.search(r"\b(RA ?[0-9]{1,3}) ?[-–—] ?(.{10,140}?)(?:Contents|Introduction|\. |$)", s, I)
    if m and (body := _clean(m[2])):
        return f"{m[1].replace(" ", "")} – {body}", "steamship-ra"
    m = re.search(r"loss-prevention/? (.{10,140}?)(?:Contents|\. |$)", s, I)
    return (body, "steamship-after-boilerplate") if m and (body := _clean(m[1])) else None


def _salutation(s: str) -> tuple[str, str] | None:
    m = SALUTATION.search(s)
    return (body, "london-salutation") if m and (body := _lettered(m[1])) else None


PUBLISHERS = {"American P&I Club": _circular, "London P&I Club": _salutation, "Panama Canal Authority": _canal, "Steamship Mutual": _alert}


def recover(body: str | None, source: str | None = None) -> tuple[str, str] | None:
    """(title, how) from the text of a document: its publisher's layout, else a subject line, a reference line or a salutation."""
    s = re.sub(r"\s+", " ", body or "").strip()
    if len(s) < 40:
        return None
    found = []
    if source in PUBLISHERS and (x := PUBLISHERS[source](s)):
        found.append(x)
    for p, how, read in ((SUBJECT, "subject", _clean), (re.compile(r"\bRe ?: (.{10,180}?)(?:\. |$)", I), "re", _clean), (SALUTATION, "salutation", _lettered)):
        m = p.search(s)
        if m and (x := read(m[1])):
            found.append((x, how))
    return next(((headline(t), how) for t, how in found if usable(headline(t))), None)


def cascade(meta: str | None, link: str | None, body: str | None, url: str | None, source: str | None) -> str | None:
    again = recover(body, source)
    return pick(meta, link) or (again[0] if again else None) or from_url(url) or pick(None, None, body)


def text_title(text: str | None, least: int = 15, most: int = 200) -> str | None:
    """A line with a marker among the first 15, else the first plausible one of 20."""
    every = [x for x in (y.strip() for y in re.split(r"\r?\n", text or "")) if x]
    for x in every[:15]:
        if re.match(r"^(?:advisory|bulletin|circular|memo|notice|re\s*:|subject\s*:)", x, I) and least <= len(x) <= most:
            return re.sub(r"^re\s*:\s*", "", re.sub(r"^subject\s*:\s*", "", x, flags=I), flags=I).strip()
    bad = [re.compile(p, I) for p in (r"^(?:attention|attn|cc|date|from|to|via)\s*:", r"^v\.?\s*\d", r"^https?://", r"^[\d\s.\-/]+$")]
    admin = re.compile(r"^[A-Z][A-Z\s\d().,\-/&]+$")
    return next((x for x in every[:20] if least <= len(x) <= most and not any(p.search(x) for p in bad) and not (len(x) > 30 and x == x.upper() and admin.match(x))), None)


def _udf(f, n: int):
    if n == 1:
        return F.arrow_udf(lambda a: pa.array([f(x) for x in a.to_pylist()], pa.string()), "string")
    if n == 2:
        return F.arrow_udf(lambda a, b: pa.array([f(*x) for x in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.string()), "string")
    if n == 3:
        return F.arrow_udf(lambda a, b, c: pa.array([f(*x) for x in zip(a.to_pylist(), b.to_pylist(), c.to_pylist(), strict=True)], pa.string()), "string")
    return F.arrow_udf(lambda a, b, c, d, e: pa.array([f(*x) for x in zip(a.to_pylist(), b.to_pylist(), c.to_pylist(), d.to_pylist(), e.to_pylist(), strict=True)], pa.string()), "string")


def usable_title(title: Column) -> Column:
    return F.arrow_udf(lambda a: pa.array([usable(x) for x in a.to_pylist()], pa.bool_()), "boolean")(title)


def pick_title(meta: Column, link: Column, body: Column) -> Column:
    return _udf(pick, 3)(meta, link, body)


def recover_title(body: Column, source: Column) -> Column:
    return _udf(lambda b, s: (recover(b, s) or (None,))[0], 2)(body, source)


def title_from_url(url: Column) -> Column:
    return _udf(from_url, 1)(url)


def title_cascade(meta: Column, link: Column, body: Column, url: Column, source: Column) -> Column:
    return _udf(cascade, 5)(meta, link, body, url, source)


def title_in_text(text: Column) -> Column:
    return _udf(text_title, 1)(text)


DATE_IN_HEAD = r"(?i)\b(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?\s+\d{1,2},?\s+\d{4}\b|\b\d{1,2}\s+(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?\s+\d{4}\b"


def text_fields(text: Column) -> Column:
    """struct<title, excerpt, length, date_label, is_empty> of a document's text: empty under 50 characters; excerpt 600; the date from the first 800."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    empty = F.length(flat) < 50
    when = F.nullif(F.regexp_extract(F.substring(flat, 1, 800), DATE_IN_HEAD, 0), F.lit(""))
    return F.struct(F.when(~empty, title_in_text(text)).alias("title"), F.when(~empty, F.substring(flat, 1, 600)).alias("excerpt"), F.length(flat).alias("length"), F.when(~empty, when).alias("date_label"), empty.alias("is_empty"))


def split_rows(url: Column, found: Column, titles: Column) -> Column:
    """Section rows (part, url, title) where more than one section is there and two, and half of them, have a usable title; else none. titles: pick_title of each section, in order."""
    ok = F.size(F.array_compact(titles))
    rows = F.filter(F.transform(titles, lambda t, i: F.struct((i + 1).alias("part"), F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("part="), (i + 1).cast("string")).alias("url"), t.alias("title"))), lambda r: r["title"].isNotNull())
    return F.when((F.size(found) > 1) & (ok >= 2) & (ok * 2 >= F.size(found)), rows)
