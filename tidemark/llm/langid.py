"""Language identification of mixed-language text.

Every word (run of letters of one script) gets a score for every language. The range of its script narrows
the candidates first: the languages whose training documents hold at least SHARE of their letters in that
script, or, where none does, the script's own list, told apart by the letters each lacks. Trained languages
score a word by the mean log-probability of its letter trigrams, times its length; the Viterbi algorithm
then labels the words of each text with the languages whose scores less a penalty for each switch are the
best, and equal neighbours become spans. Only the languages that a chunk of texts can hold take part in it,
and all texts of a chunk are run through the algorithm side by side, so Python's loop is over word
positions and not over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, narrow
from tidemark.llm.textvec import chunks, mix, spans

#: Script, its code points, and the languages that a word in it can have where none was trained: the likeliest
#: first, each with the letters of the script that it lacks ('' where nothing tells).
SCRIPTS: list[tuple[str, list[tuple[int, int]], dict[str, str]]] = [
    ("Latin", [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF)], {}),
    ("Greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)], {"el": ""}),
    ("Cyrillic", [(0x400, 0x52F)], {"ru": "іїєґўјљњћђџѓќѕәғқңөұүһ", "uk": "ыэъёўјљњћђџѓќѕәғқңөұүһ", "bg": "ыэёіїєґўјљњћђџѓќѕәғқңөұүһ", "be": "ищъїєґјљњћђџѓќѕәғқңөұүһ", "sr": "йщъыьэюяёіїєґўѓќѕәғқңөұүһ", "mk": "йщъыьэюяёіїєґўћђәғқңөұүһ", "kk": "їєґўјљњћђџѓќѕ"}),
    ("Armenian", [(0x530, 0x58F)], {"hy": ""}),
    ("Hebrew", [(0x590, 0x5FF)], {"he": "װױײ", "yi": ""}),
    ("Arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)], {"ar": "پچژگکیٹڈڑںےہھ", "fa": "كيةىإؤٹڈڑںےہھ", "ur": "كيةىإ"}),
    ("Devanagari", [(0x900, 0x97F)], {"hi": "ळ", "mr": ""}), ("Bengali", [(0x980, 0x9FF)], {"bn": "ৰৱ", "as": "র"}), ("Gurmukhi", [(0xA00, 0xA7F)], {"pa": ""}),
    ("Gujarati", [(0xA80, 0xAFF)], {"gu": ""}), ("Odia", [(0xB00, 0xB7F)], {"or": ""}), ("Tamil", [(0xB80, 0xBFF)], {"ta": ""}), ("Telugu", [(0xC00, 0xC7F)], {"te": ""}),
    ("Kannada", [(0xC80, 0xCFF)], {"kn": ""}), ("Malayalam", [(0xD00, 0xD7F)], {"ml": ""}), ("Sinhala", [(0xD80, 0xDFF)], {"si": ""}), ("Thai", [(0xE00, 0xE7F)], {"th": ""}),
    ("Lao", [(0xE80, 0xEFF)], {"lo": ""}), ("Tibetan", [(0xF00, 0xFFF)], {"bo": ""}), ("Myanmar", [(0x1000, 0x109F)], {"my": ""}), ("Georgian", [(0x10A0, 0x10FF)], {"ka": ""}),
    ("Hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)], {"ko": ""}), ("Ethiopic", [(0x1200, 0x139F)], {"am": ""}), ("Khmer", [(0x1780, 0x17FF)], {"km": ""}),
    ("Mongolian", [(0x1800, 0x18AF)], {"mn": ""}), ("Kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF)], {"ja": ""}), ("Han", [(0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)], {"zh": "", "ja": ""}),
]
UNKNOWN = "und"
OTHER = sorted({x for _, _, langs in SCRIPTS for x in langs})
SLOTS = 1 << 16
NEVER = -1e4
SHARE = 0.05  # of a language's letters, from which on a script is one of its own
ALIEN, LATER = -4.0, -1e-3  # a letter that the language lacks; each place down an untrained script's list

_made: dict[str, np.ndarray] = {}


def kinds() -> np.ndarray:
    """By code point below 0x10000: 0 no letter, else 1 + the script's number."""
    if "k" not in _made:
        k = np.zeros(0x10000, np.uint8)
        for i, (_, ranges, _) in enumerate(SCRIPTS):
            for a, b in ranges:
                k[a : b + 1] = 1 + i
        for c in (0x37E, 0x387, 0x589, 0x60C, 0x61B, 0x61F, 0x6D4, 0x30FB, 0x964, 0x965, 0x104A, 0x104B, 0x10FB, 0x17D4, 0x17D5):
            k[c] = 0
        low = np.arange(0x10000, dtype=np.uint32)
        for c in range(0x2000):
            if len(x := chr(c).lower()) == 1:
                low[c] = ord(x)
        _made["k"], _made["low"] = k, low
    return _made["k"]


def letters(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the offsets in code points. Beyond the first plane rare Han characters
    count as Han and the others as 0."""
    at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offs]
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return np.where(cp < 0x10000, cp, np.where((cp >= 0x20000) & (cp < 0x32000), 0x4E00, 0)), at


def word_spans(cp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words: runs of letters, ended by a change of script, too."""
    kind = kinds()[cp]
    member = kind > 0
    s, e, row = spans(member, at)
    turn = np.flatnonzero((kind[1:] != kind[:-1]) & member[1:] & member[:-1]) + 1
    if len(turn):
        turn = turn[~np.isin(turn, s)]
        s, e = np.sort(np.concatenate((s, turn))), np.sort(np.concatenate((e, turn)))
        row = np.searchsorted(at[1:], s, "right")
    return s, e, row


def trigrams(cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams of each word with a blank at either end, one for each letter, laid end to
    end, and where each word's begin."""
    low = _made["low"][cp]
    n = e - s
    first = np.cumsum(n) - n
    pos = np.arange(int(n.sum())) - np.repeat(first - s, n)
    mid = low[pos]
    left = low[np.maximum(pos - 1, 0)]
    left[first] = 32
    right = low[np.minimum(pos + 1, len(low) - 1)]
    right[first + n - 1] = 32
    h = (left * np.uint32(0x9E3779B1)) ^ (mid * np.uint32(0x85EBCA77)) ^ (right * np.uint32(0xC2B2AE3D))
    h ^= h >> np.uint32(15)
    return (h * np.uint32(0x2C1B3C6D) >> np.uint32(16)).astype(np.int32), first


class Model:
    """langs: the trained languages; table: SLOTS x their number, log-probabilities; own: scripts x their
    number, whether a script is one of the language's (Latin for all, where it isn't given)."""

    def __init__(self, langs: list[str], table: np.ndarray, own: np.ndarray | None = None) -> None:
        if own is None:
            own = np.zeros((len(SCRIPTS), len(langs)), bool)
            own[0] = True
        self.langs, self.table, self.own = langs, table, own
        self.states = [*langs, *[x for x in OTHER if x not in langs], *([UNKNOWN] if UNKNOWN not in langs else [])]
        place = {x: k for k, x in enumerate(self.states)}
        #: by script: the states a word can have, and whether they are trained
        self.trained = [bool(own[i].any()) for i in range(len(SCRIPTS))]
        self.candidates = [np.flatnonzero(own[i]) if self.trained[i] else np.array([place[x] for x in (SCRIPTS[i][2] or {UNKNOWN: ""})]) for i in range(len(SCRIPTS))]

    def word_scores(self, cp: np.ndarray, s: np.ndarray, e: np.ndarray, states: np.ndarray | None = None) -> np.ndarray:
        """Words x states (all, or those given). A word in a script without a list or trained language is 'und'."""
        k = kinds()[cp[s]].astype(np.int64) - 1
        column = np.full(len(self.states), -1)
        column[np.arange(len(self.states)) if states is None else states] = np.arange(len(self.states) if states is None else len(states))
        out = np.full((len(s), int((column >= 0).sum())), NEVER, np.float32)
        for script in np.unique(k):
            every = np.flatnonzero(k == script)
            own = self.candidates[script]
            if self.trained[script]:
                slot, first = trigrams(cp, s[every], e[every])
                table = self.table if len(own) == self.table.shape[1] else np.ascontiguousarray(self.table[:, own])
                out[np.ix_(every, column[own])] = np.add.reduceat(table[slot], first, axis=0)
            else:
                low = _made["low"][cp]
                for nth, (lang, lacks) in enumerate((SCRIPTS[script][2] or {UNKNOWN: ""}).items()):
                    alien = np.concatenate(([0], np.cumsum(np.isin(low, np.array([ord(c) for c in lacks], np.uint32))))) if lacks else np.zeros(len(cp) + 1)
                    out[every, column[self.states.index(lang)]] = ALIEN * (alien[e[every]] - alien[s[every]]) + LATER * nth
        return out

    def states_of(self, cp: np.ndarray, s: np.ndarray) -> np.ndarray:
        """The states that these words can have, sorted."""
        own = [self.candidates[k - 1] for k in np.unique(kinds()[cp[s]])]
        return np.unique(np.concatenate(own)) if own else np.zeros(1, np.int64)


def viterbi(score: np.ndarray, first: np.ndarray, n: np.ndarray, penalty: float) -> np.ndarray:
    """The best state of each word. Texts are runs of n words from first on; ties go to the lower state,
    and to staying."""
    label = np.zeros(len(score), np.int16)
    has = np.flatnonzero(n)
    if not len(has):
        return label
    k = score.shape[1]
    # A text keeps its best single language where no stretch of words gains more elsewhere than a switch costs
    total = np.add.reduceat(score, first[has], axis=0)
    best = total.argmax(axis=1)
    row = np.repeat(np.arange(len(has)), n[has])
    gain = score.astype(np.float64) - score[np.arange(len(score)), best[row]].astype(np.float64)[:, None]
    sums = np.cumsum(gain, axis=0)
    start = np.where(first[has][:, None] > 0, sums[first[has] - 1], 0)
    sums -= start[row]
    drop = float(np.abs(sums).max()) * 2 + 1
    before = np.vstack((np.zeros((1, k)), sums[:-1]))
    before[first[has]] = 0
    least = np.minimum.accumulate(before - row[:, None] * drop, axis=0) + row[:, None] * drop
    most = np.maximum.reduceat((sums - least).max(axis=1), first[has])
    label[:] = best[row]
    # with one switch the gains of both ends together must exceed it; with more, each stretch has at least two thirds of one
    ends = sums[first[has] + n[has] - 1][row] - sums
    once = np.maximum.reduceat(sums.max(axis=1) + ends.max(axis=1), first[has])
    mixed = has[(once > penalty - 1e-3) | (most > penalty * 2 / 3 - 1e-3)]
    if not len(mixed):
        return label
    mixed = mixed[np.argsort(-n[mixed], kind="stable")]
    f, m = first[mixed], n[mixed]
    back = np.zeros((int(m.sum()), k), np.int8)
    base = np.cumsum(m) - m
    v = score[f].astype(np.float64)
    lives, every = np.searchsorted(-m, -np.arange(int(m[0])), "left"), np.arange(k)
    for t in range(1, int(m[0])):
        live = lives[t]
        v_ = v[:live]
        top = v_.argmax(axis=1)
        move = v_.max(axis=1)[:, None] - penalty
        back[base[:live] + t] = np.where(v_ >= move, every, top[:, None])
        v[:live] = np.maximum(v_, move) + score[f[:live] + t]
    at = v.argmax(axis=1)
    for t in range(int(m[0]) - 1, -1, -1):
        live = lives[t]
        label[f[:live] + t] = at[:live]
        at[:live] = back[base[:live] + t, at[:live]]
    return label


Sample = tuple[DataFrame | None, list[str]]


def sample(docs: DataFrame, per_lang: int = 400, most_langs: int = 200) -> Sample:
    """doc_id, text, lang of the documents to train on, and their languages: per_lang documents of each, those with the least hash of
    doc_id (the bound); most_langs bounds the tables (256 KB a language in each task): of more languages those with the most documents here.
    Ids are chosen without reading texts, which are read once, for the few, and kept in the shared folder. Null texts are left out."""
    d = narrow(docs, "doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.col("lang") != UNKNOWN))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = cut(d.select("doc_id", "lang").withColumn("nth", nth).filter(F.col("nth") <= per_lang).select("doc_id", "lang").distinct())
    langs = sorted(r["lang"] for r in ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).collect())
    if not langs:
        return None, []
    ids = ids.filter(F.col("lang").isin(langs))  # at most per_lang * most_langs rows, so their size is bounded
    near = cut(d.filter("text is not null").join(F.broadcast(ids), ["doc_id", "lang"], "left_semi"))
    here = {r["lang"] for r in near.select("lang").distinct().collect()}
    return (near, [x for x in langs if x in here]) if here else (None, [])


def train(docs: DataFrame, per_lang: int = 400, smooth: float = 0.5, most_langs: int = 200, given: Sample | None = None) -> Model:
    """Trigram tables of the languages in docs.lang, whatever their script, from the sample of docs (or the one given).
    Null languages aren't trained."""
    near, langs = given or sample(docs, per_lang, most_langs)
    if near is None:
        return Model([], np.zeros((SLOTS, 0), np.float32))
    places = {x: k for k, x in enumerate(langs)}
    wide = SLOTS + len(SCRIPTS)  # the letters in each script are counted behind the slots

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            own = np.array([places[x] for x in b.column("lang").to_pylist()], np.int64)
            for lo, hi, data, offs in chunks(b.column("text")):
                cp, at = letters(data, offs)
                s, e, row = word_spans(cp, at)
                if len(s):
                    slot, first = trigrams(cp, s, e)
                    word = own[lo:hi][row]
                    each = np.repeat(word, e - s)
                    for k in np.unique(word):
                        t = total.setdefault(int(k), np.zeros(wide, np.int64))
                        t += np.bincount(slot[each == k], minlength=wide)
                        t += np.bincount(SLOTS + kinds()[cp[s[word == k]]].astype(np.int64) - 1, (e - s)[word == k], minlength=wide).astype(np.int64)
        for k, t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(t[at])], names=["k", "slot", "n"])

    c = near.mapInArrow(count, "k int, slot int, n long").groupBy("k", "slot").agg(F.sum("n").alias("n")).toPandas()  # at most 65,563 a language
    table = np.full((wide, len(langs)), smooth)
    table[SLOTS:] = 0
    table[c["slot"], c["k"]] += c["n"]
    script = table[SLOTS:]
    return Model(langs, np.log(table[:SLOTS] / table[:SLOTS].sum(axis=0)).astype(np.float32), script >= np.maximum(1, SHARE * script.sum(axis=0)))


def least_scores(docs: DataFrame, model: Model, per_lang: int = 400, most_langs: int = 200, given: Sample | None = None) -> np.ndarray:
    """For each state the least mean score a letter of a span in that language: halfway between the training
    documents' own score and that of the same documents with the letters of each word's script in another
    order. Untrained languages have no least score."""
    least = np.full(len(model.states), -np.inf)
    near, _ = given or sample(docs, per_lang, most_langs)
    if near is None:
        return least
    places = {x: k for k, x in enumerate(model.langs)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(model.langs), 3))
        for b in batches:
            own = np.array([places[x] for x in b.column("lang").to_pylist()], np.int64)
            for lo, hi, data, offs in chunks(b.column("text")):
                cp, at = letters(data, offs)
                s, e, row = word_spans(cp, at)
                ok = model.own[kinds()[cp[s]].astype(np.int64) - 1, own[lo:hi][row]]
                s, e, row = s[ok], e[ok], row[ok]
                if len(s):
                    k, n = own[lo:hi][row], e - s
                    pos = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - s, n)
                    r = np.repeat(row, n) * 64 + kinds()[cp[pos]]
                    mixed, o = cp.copy(), np.lexsort((pos, r))
                    mixed[pos[o]] = cp[pos[np.lexsort((mix((pos - at[r // 64]).astype(np.uint64)), r))]]
                    for j, c in enumerate((cp, mixed)):
                        total[:, j] += np.bincount(k, model.word_scores(c, s, e)[np.arange(len(s)), k], minlength=len(total))
                    total[:, 2] += np.bincount(k, n, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), *(pa.array(total[:, j]) for j in range(3))], names=["k", "own", "other", "n"])

    for r in near.mapInArrow(score, "k int, own double, other double, n double").groupBy("k").agg(F.sum("own"), F.sum("other"), F.sum("n")).collect():  # a row a language
        if r[3]:
            least[r[0]] = round((r[1] + r[2]) / 2 / r[3], 3)
    return least


def label_batch(model: Model, col, penalty: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, row after the last, word starts and ends, rows, labels, scores of the labels."""
    for lo, hi, data, offs in chunks(col):
        cp, at = letters(data, offs)
        s, e, row = word_spans(cp, at)
        states = model.states_of(cp, s)
        score = model.word_scores(cp, s, e, states)
        n = np.bincount(row, minlength=hi - lo)
        label = viterbi(score, np.cumsum(n) - n, n, penalty)
        yield lo, hi, s - at[row], e - at[row], row, states[label], score[np.arange(len(s)), label]


def spans_of(docs: DataFrame, model: Model, penalty: float = 12.0) -> DataFrame:
    """doc_id, span_no, lang, span_start, span_end, words, mean_score: the spans of every text.

    Starts and ends are in code points, from the first letter of a span to its last. mean_score is the
    score a letter (0 or a little less in a script without trained languages). A text without letters,
    empty or null has one row with lang 'und', span_no 0, span_start and span_end 0, and no words. Latin
    words are 'und' where no language was trained. A null doc_id keeps its rows. Repeated rows give repeated
    spans. Other columns are ignored. An empty table gives no rows. Ties go to the alphabetically first
    trained language, and to staying in a language. Very long texts are labelled whole, by one task each.
    """
    states = model.states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").cast(pa.int64())
            for lo, hi, s, e, row, lab, own in label_batch(model, b.column("text"), penalty):
                new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (lab[1:] != lab[:-1])))) if len(row) else np.zeros(0, np.int64)
                last = (np.append(new[1:], len(row)) - 1)[: len(new)]
                size = np.add.reduceat(e - s, new) if len(new) else np.zeros(0)
                mean = np.add.reduceat(own, new) / size if len(new) else np.zeros(0)
                r = row[new]
                none = np.setdiff1d(np.arange(hi - lo), r)
                first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.zeros(0, np.int64)
                no = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
                z = np.zeros(len(none), np.int64)
                names = pa.array(states).take(pa.array(np.concatenate((lab[new].astype(np.int64), z + states.index(UNKNOWN)))))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo).take(pa.array(np.concatenate((r, none)))), pa.array(np.concatenate((no, z)).astype(np.int32)), names, pa.array(np.concatenate((s[new], z))), pa.array(np.concatenate((e[last], z))), pa.array(np.concatenate((last - new + 1, z))), pa.array(np.concatenate((mean, z)).astype(np.float64))],
                    names=["doc_id", "span_no", "lang", "span_start", "span_end", "words", "mean_score"],
                )

    return narrow(docs, "doc_id", "text").mapInArrow(run, "doc_id long, span_no int, lang string, span_start long, span_end long, words long, mean_score double")


def identify(docs: DataFrame, penalty: float = 12.0, per_lang: int = 400) -> DataFrame:
    """spans_of with a model trained on docs itself."""
    return spans_of(docs, train(docs, per_lang), penalty)


def keep_known(docs: DataFrame, model: Model | None = None, languages: list[str] | None = None, least_share: float = 0.5, penalty: float = 12.0, least: np.ndarray | None = None) -> DataFrame:
    """docs, all columns as they were, whose letters lie at least to least_share in spans of the
    languages (all that the model can name, if none are given). Rejected are texts that have no letters
    (empty and null ones with them) and texts mainly in other languages, or in spans whose mean score a
    letter is below the state's in least. A text with just least_share stays; each row is judged by its own
    text, so repeated rows stay or go together and null doc_ids do no harm. Very long texts are read whole.
    An empty table gives no rows."""
    model = model or train(docs)
    good = np.array([languages is None or x in languages for x in model.states])

    @F.arrow_udf("boolean")
    def known(col: pa.Array) -> pa.Array:
        out = np.zeros(len(col), bool)
        for lo, hi, s, e, row, lab, score in label_batch(model, col, penalty):
            ok = good[lab]
            if least is not None and len(row):
                new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (lab[1:] != lab[:-1]))))
                mean = np.add.reduceat(score.astype(np.float64), new) / np.add.reduceat(e - s, new)
                ok = ok & np.repeat(mean >= least[lab[new]], np.diff(np.append(new, len(row))))
            every = np.bincount(row, e - s, minlength=hi - lo)
            ours = np.bincount(row, (e - s) * ok, minlength=hi - lo)
            out[lo:hi] = (every > 0) & (ours >= least_share * every)
        return pa.array(out)

    names = docs.columns
    tmp = docs.toDF(*[f"_tm{i}" for i in range(len(names))])
    return tmp.filter(known(F.col(f"_tm{names.index('text')}"))).toDF(*names)
