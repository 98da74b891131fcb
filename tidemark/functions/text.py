"""String functions, Column to Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lexicons import HEAD, NOT_BEFORE, TRACKING, any_of, heads, java_pattern, needles


def let(x: Column, f) -> Column:
    """f(x) with x computed once a row, however often f names it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def trim(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\r\f"))


def spread(df: DataFrame) -> DataFrame:
    """df over all cores before work that a core is busy with, where its files are fewer than these (a file of one
    row group is one task). A table of many files is read where it lies, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def word_heads(text: Column, wanted: list[str]) -> Column:
    """Which of the wanted beginnings of words (lexicons.heads) the text has. The text is read once, whatever their
    number, and most texts have few or none."""
    low = F.translate(F.lower(text), "123456789", "000000000")
    words = F.array_distinct(F.split(low, "[^0a-z_]+"))
    return F.array_intersect(F.transform(words, lambda w: F.substring(w, 1, HEAD)), F.lit(wanted))


class Finder:
    """Patterns of several blocks against one text. A pattern is tried only where the text has a word that can begin it,
    or a string that it must hold."""

    def __init__(self, *blocks: list[str]) -> None:
        self.heads = {p: heads(p) for block in blocks for p in block}
        self.wanted = sorted({h for own in self.heads.values() for h in own or []})
        self.last, self.parts = None, {}

    def read(self, text: Column) -> Column:
        low = F.lower(text)
        return F.struct(text.alias("text"), word_heads(text, self.wanted).alias("heads"), low.alias("low"))

    def part(self, x: Column, name: str) -> Column:
        """A field of what read() made; the same Column as long as x is the same, as building one costs more than its use."""
        if self.last is not x:
            self.last, self.parts = x, {}
        if name not in self.parts:
            self.parts[name] = x[name]
        return self.parts[name]

    def has(self, x: Column, p: str) -> Column:
        own, source = self.heads[p], self.part(x, "text")
        found = source.rlike(java_pattern(p) + (f"(?!{NOT_BEFORE[p]})" if p in NOT_BEFORE else ""))
        if own:
            return (F.array_contains(self.part(x, "heads"), own[0]) if len(own) == 1 else F.arrays_overlap(self.part(x, "heads"), F.lit(own))) & found
        must = needles(p)
        return reduce(lambda a, b: a | b, [F.contains(self.part(x, "low"), F.lit(m)) for m in must]) & found if must else found

    def any(self, x: Column, block: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [self.has(x, p) for p in block], F.lit(False))

    def count(self, x: Column, block: list[str]) -> Column:
        return reduce(lambda a, b: a + b, [self.has(x, p).cast("int") for p in block], F.lit(0))


def matches(text: Column, patterns: list[str]) -> Column:
    """Whether a short text matches one of the patterns: one regex for all of them."""
    out = F.lit(False)
    for p in any_of([x for x in patterns if x not in NOT_BEFORE]):
        out = out | text.rlike(p)
    for p in patterns:
        if p in NOT_BEFORE:
            out = out | text.rlike(java_pattern(p) + "(?!" + NOT_BEFORE[p] + ")")
    return out


def strip_html(html: Column) -> Column:
    """Text of HTML: scripts and styles go without a trace, tags become blanks, blanks collapse."""
    x = F.regexp_replace(F.regexp_replace(html, r"(?i)<script\b[\s\S]*?</script>", ""), r"(?i)<style\b[\s\S]*?</style>", "")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"\s+", " "))


def decode_entities(text: Column) -> Column:
    """The named entities of feeds and ASCII numeric ones; &amp; comes last."""
    for name, c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&rsquo;", "’"), ("&lsquo;", "‘"), ("&rdquo;", "”"), ("&ldquo;", "“")):
        text = F.replace(text, F.lit(name), F.lit(c))
    pieces = F.split(text, "&#")
    code = lambda x: F.when(x.rlike("^[0-9]{1,7};"), F.regexp_extract(x, "^([0-9]+)", 1).cast("int")).when(x.rlike("^[xX][0-9a-fA-F]{1,6};"), F.conv(F.regexp_extract(x, "^[xX]([0-9a-fA-F]+)", 1), 16, 10).cast("int"))
    utf = lambda c: F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")
    ok = lambda c: c.isNotNull() & (c > 0) & (c < 0x110000) & ~c.between(0xD800, 0xDFFF)
    rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x: F.when(ok(code(x)), F.concat(utf(F.coalesce(code(x), F.lit(32))), F.regexp_replace(x, "^[^;]*;", ""))).otherwise(F.concat(F.lit("&#"), x)))
    text = F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def html_to_text(html: Column) -> Column:
    return F.trim(F.regexp_replace(decode_entities(strip_html(html)), r"\s+", " "))


def canonical_url(url: Column, drop: list[str] = TRACKING) -> Column:
    """A URL as a browser writes it, without tracking parameters, empty parameters, fragment and a final slash: scheme and host in
    lower case, default ports and dot segments gone, odd characters of the path as UTF-8 percents, the query form-encoded anew.
    What isn't a URL is trimmed only."""
    u = F.trim(url)
    raw = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    head = F.regexp_replace(F.regexp_replace(F.lower(raw), r"^(http://.*):80\z", "$1"), r"^(https://.*):443\z", "$1")
    rest = F.regexp_replace(F.substring(u, F.length(raw) + 1, F.length(u) + 1), r"(?s)#.*\z", "")
    path = F.regexp_extract(rest, r"(?s)^([^?]*)", 1)
    back = lambda x: F.coalesce(F.try_url_decode(x), x)
    name = lambda p: back(F.regexp_extract(p, r"(?s)^([^=]*)", 1))
    value = lambda p: back(F.regexp_replace(p, r"(?s)^[^=]*=?", ""))
    params = F.filter(F.split(F.regexp_replace(rest, r"(?s)^[^?]*\??", ""), "&"), lambda p: (value(p) != "") & ~name(p).isin(drop))
    params = F.transform(params, lambda p: F.concat(F.url_encode(name(p)), F.lit("="), F.url_encode(value(p))))
    out = F.concat(head, _path(path), F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit("")))
    return F.when(head == "", u).otherwise(F.regexp_replace(out, r"/\z", ""))


def _path(path: Column) -> Column:
    chars = F.array_join(F.transform(F.split(path, ""), lambda c: F.when(c.rlike(r"^[!#-;=?-_a-z|~\\]*\z"), c).otherwise(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")))), "")
    clean = F.when(path.rlike(r"[^!#-;=?-_a-z|~\\]"), chars).otherwise(path)
    dots = lambda x: F.lower(F.replace(F.lower(x), F.lit("%2e"), F.lit(".")))
    parts = F.split(clean, "/")
    none = F.array().cast("array<string>")
    step = lambda a, x: F.when(dots(x) == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(1)))).when(dots(x) == ".", a).otherwise(F.concat(a, F.array(x)))
    last = F.element_at(parts, -1)
    joined = F.aggregate(parts, none, step)
    walked = F.concat(F.array_join(joined, "/"), F.when(dots(last).isin(".", "..") & (F.element_at(joined, -1) != ""), "/").otherwise(""))
    return F.when(clean.rlike(r"(?i)(?:^|/)(?:\.|%2e){1,2}(?:/|\z)"), walked).otherwise(clean)


def url_hash(url: Column) -> Column:
    return F.substring(F.sha2(canonical_url(url).cast("binary"), 256), 1, 32)


def strip_cache_bust(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, r"([?&])_=[^&#]*&?", "$1"), r"[?&]\z", ""), r"[?&]#", "#")


def https(url: Column) -> Column:
    return F.regexp_replace(url, r"^http:", "https:")


def summary(excerpt: Column) -> Column:
    """The first two sentences if they have 60 characters or more, at most 320; else the first 280 characters, cut at
    a word. The whole text is searched; possessive repeats keep that linear where it has no full stop. Null: ''."""
    squashed = F.trim(F.regexp_replace(F.coalesce(excerpt, F.lit("")), r"\s+", " "))
    both = r"^[.!?]*+([^.!?]++[.!?]++)([^.!?]++[.!?]++)"

    def pick(c: Column) -> Column:
        two = F.when(c.rlike(both), F.trim(F.concat(F.regexp_extract(c, both, 1), F.lit(" "), F.regexp_extract(c, both, 2))))
        short = F.concat(F.regexp_replace(F.substring(c, 1, 280), r"\s+\S*\z", ""), F.lit("…"))
        return let(two, lambda t: F.when(F.length(t) >= 60, F.substring(t, 1, 320)).when(F.length(c) <= 280, c).otherwise(short))

    return let(squashed, pick)


def build_excerpt(full: Column, feed: Column) -> Column:
    return F.when(F.length(full) > 200, full).when(F.length(feed) > 0, feed).otherwise(full)


#: Where a video's description ends: a line that begins so.
TAILS = [r"\n(?:bluesky|discord|email|facebook|instagram|linkedin|patreon|tiktok|twitter|website|youtube)\s*:", r"\n#\w+(?:\s+#\w+)+", r"\n#supplychain", r"\nchapters?\s*:", r"\nfollow (?:me|on|us)", r"\njoin (?:my|our|the|this)",
    r"\nmarine traffic\s*\n", r"\nsubscribe (?:for|here|now|to)", r"\nsupport (?:me|my|our|the|this|us)", r"\n0?0:00\s", r"\n(?:=+|-{3,})\s*\n"]


def trim_description(text: Column, tails: list[str] = TAILS) -> Column:
    """A video's description up to the earliest of the tails."""
    return F.trim(F.regexp_replace(text, "(?is)(?:" + "|".join(tails) + r").*\z", ""))


def strip_title_suffix(title: Column, sites: list[str]) -> Column:
    names = "|".join(F_escape(s) for s in sites)
    x = F.regexp_replace(title, r"\s*\|\s*[A-Z][A-Za-z0-9 &.'\-]{2,40}\z", "")
    return F.trim(F.regexp_replace(x, rf"(?i)\s+[-–—]\s+(?:{names})\s*\z", "")) if names else F.trim(x)


def F_escape(s: str) -> str:
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}" else c for c in s)


def slugify(name: Column) -> Column:
    x = F.regexp_replace(F.lower(F.replace(name, F.lit("&"), F.lit("and"))), r"[^a-z0-9]+", "-")
    return F.regexp_replace(x, r"^-+|-+\z", "")


def last_segment(url: Column) -> Column:
    """The last part of a URL's path, in lower case; '' for a bare host."""
    path = F.regexp_replace(F.regexp_replace(url, r"(?s)[?#].*\z", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", "")
    return F.lower(F.coalesce(F.try_element_at(F.filter(F.split(path, "/"), lambda x: x != ""), F.lit(-1)), F.lit("")))


def escape_like(text: Column) -> Column:
    return F.regexp_replace(text, r"([%_\\])", r"\\$1")


def status_of(error: Column) -> Column:
    """The HTTP status in an error text, or null."""
    return F.nullif(F.regexp_extract(error, r"(?i)(?:status(?: code)?|http)\s*:?\s*(\d{3})", 1), F.lit("")).cast("int")


def failure_kind(status: Column) -> Column:
    return (
        F.when(status.isNull(), "network").when(status == 403, "forbidden").when(status.isin(404, 410), "not_found").when(status == 429, "rate_limited")
        .when(status >= 500, "server_error").when(status >= 400, "client_error").otherwise("other")
    )


HEADING = r"^([0-9]+)[).]\s+(.{8,200})$"
NAMED = r"(?i)^(?:article|chapter|issue|item|part|section|topic|update)\s+([0-9]+)\s*[-—.:]\s*(.{4,200})$"
FURNITURE = r"(?i)^(?:\d+ of \d+|all rights reserved|confidential|copyright|internal use only|page \d+|www\.|©)"


def sections(text: Column, least: int = 4000) -> Column:
    """array<struct<number, heading, snippet>>: the sections of a text of `least` characters or more, by its longest run of headings numbered 1, 2, 3 ... (the
    first of equals, three or more; '1. Title' or 'Section 1: Title'), each with the first 400 characters up to the next; else null."""
    kind = "array<struct<n: int, at: int, title: string>>"

    def runs(lines: Column) -> Column:
        def heading(x: Column, i: Column) -> Column:
            p = F.when(x.rlike(HEADING), F.struct(F.regexp_extract(x, HEADING, 1).alias("n"), F.regexp_extract(x, HEADING, 2).alias("t"))).when(x.rlike(NAMED), F.struct(F.regexp_extract(x, NAMED, 1).alias("n"), F.regexp_extract(x, NAMED, 2).alias("t")))
            return F.when(p.isNotNull() & ~x.rlike(FURNITURE), F.struct(p["n"].try_cast("int").alias("n"), i.alias("at"), F.trim(p["t"]).alias("title")))

        found = F.filter(F.transform(lines, heading), lambda h: h.isNotNull() & h["n"].isNotNull())
        none = F.array().cast(kind)
        longer = lambda best, now: F.when(F.size(now) > F.size(best), now).otherwise(best)
        step = lambda a, h: F.struct(longer(a["best"], a["now"]).alias("best"), F.when((F.size(a["now"]) > 0) & (h["n"] == F.size(a["now"]) + 1), F.concat(a["now"], F.array(h))).when(h["n"] == 1, F.array(h)).otherwise(none).alias("now"))
        return F.aggregate(found, F.struct(none.alias("best"), none.alias("now")), step, lambda a: longer(a["best"], a["now"]))

    def rows(x: Column) -> Column:
        end = lambda i: F.coalesce(F.try_element_at(x["run"], i + 2)["at"], F.size(x["lines"]))
        body = lambda h, i: F.array_join(F.filter(F.slice(x["lines"], h["at"] + 2, F.greatest(F.lit(0), end(i) - h["at"] - 1)), lambda y: y != ""), " ")
        return F.transform(x["run"], lambda h, i: F.struct(h["n"].alias("number"), h["title"].alias("heading"), F.coalesce(F.nullif(F.substring(body(h, i), 1, 400), F.lit("")), h["title"]).alias("snippet")))

    lines = F.transform(F.split(text, r"\r?\n"), trim)
    got = let(lines, lambda x: let(F.struct(x.alias("lines"), runs(x).alias("run")), lambda y: F.when(F.size(y["run"]) >= 3, rows(y))))
    return F.when(F.length(text) >= least, got)


def label(code: Column, labels: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[code]


def failure_summary(kinds: DataFrame) -> DataFrame:
    """kind, n rows -> one text, kinds with the most failures first: 'forbidden×2, not_found×1'."""
    each = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("kind").alias("kind"))))
    return kinds.agg(F.array_join(F.transform(each, lambda x: F.concat(x["kind"], F.lit("×"), (-x["m"]).cast("string"))), ", ").alias("summary"))
