"""Media columns: Matroska files in a binary column, parsed into packet tables.

The parser walks the variable-length EBML elements of Segment, Info, Tracks, Cluster and Cues without
copying payloads, takes laces (Xiph, fixed and EBML) apart, and gives each frame its track, timestamp
and byte range in the file. Only these rows leave the Python worker. The writer below makes the files that the query and
the tests parse.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import narrow

EBML, SEGMENT, INFO, SCALE, TRACKS, ENTRY, NUMBER, CODEC, DEFAULT = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x2AD7B1, 0x1654AE6B, 0xAE, 0xD7, 0x86, 0x23E383
CLUSTER, TIME, SIMPLE, GROUP, BLOCK, DURATION, REFERENCE = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
CUES, POINT, CUE_TIME, POSITIONS, CUE_TRACK, CUE_CLUSTER, CUE_RELATIVE = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1, 0xF0
#: Elements that end a Cluster or a Segment of unknown size.
TOP = {CLUSTER, CUES, INFO, TRACKS, EBML, SEGMENT, 0x114D9B74, 0x1254C367, 0x1941A469, 0x1043A770}
CLUSTER_ID = CLUSTER.to_bytes(4)
LACINGS = ("none", "xiph", "fixed", "ebml")


class Broken(Exception):
    pass


def vint(b, at: int, end: int, keep: bool = False) -> tuple[int | None, int]:
    """The value of the variable-length integer at `at`, and where it ends. None: all value bits are set
    (an unknown size). keep: with its length marker, as IDs are written."""
    if at >= end:
        raise Broken
    n = 9 - b[at].bit_length()
    if n > 8 or at + n > end:
        raise Broken
    v = int.from_bytes(b[at : at + n])
    if keep:
        return v, at + n
    v &= (1 << 7 * n) - 1
    return None if v == (1 << 7 * n) - 1 else v, at + n


def elements(b, at: int, end: int, ends: set[int] = frozenset()) -> Iterator[tuple[int, int, int, int]]:
    """(ID, where it begins, its data's first byte and the byte after the last) up to end, or to an ID of ends."""
    while at < end:
        name, p = vint(b, at, end, True)
        if name in ends:
            return
        size, p = vint(b, p, end)
        stop = end if size is None else p + size
        if stop > end:
            if name in (SEGMENT, CLUSTER, GROUP):  # cut off: what is there counts
                yield name, at, p, end
            raise Broken
        if size is None and name == CLUSTER:
            stop = p
            try:
                for *_, stop in elements(b, p, end, TOP):
                    pass
            except Broken:
                stop = end
        yield name, at, p, stop
        at = stop


def uint(b, at: int, end: int) -> int:
    return int.from_bytes(b[at:end])


def frames(b, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """(start, size) of the frames from at on."""
    if not lacing:
        return [(at, end - at)]
    if at >= end:
        raise Broken
    n, at = b[at] + 1, at + 1
    sizes: list[int] = []
    if lacing == 2:
        if (end - at) % n:
            raise Broken
        sizes = [(end - at) // n] * n
    else:
        for i in range(n - 1):
            if lacing == 1:
                size = 0
                while True:
                    if at >= end:
                        raise Broken
                    size += b[at]
                    at += 1
                    if b[at - 1] < 255:
                        break
            else:
                first = at
                value, at = vint(b, at, end)
                if value is None:
                    raise Broken
                size = value if not i else sizes[-1] + value - ((1 << (7 * (at - first) - 1)) - 1)
            sizes.append(size)
        sizes.append(end - at - sum(sizes))
    if min(sizes) < 0 or at + sum(sizes) > end:
        raise Broken
    out = []
    for s in sizes:
        out.append((at, s))
        at += s
    return out


class _Segment:
    """One Segment's own timestamp scale, tracks, cues and packets. Damage is noted, and reading goes on at the
    next Cluster."""

    def __init__(self, b, cluster: int, block: int) -> None:
        self.b, self.cluster, self.block, self.damaged = b, cluster, block, False
        self.out: list[list] = []
        self.rel: list[tuple[int | None, int | None]] = []  # timestamp and block duration in ticks; the scale may come later
        self.place: dict[tuple[int, int], int] = {}  # (cluster, block) positions -> first packet of the block
        self.scale, self.tracks, self.cues = 1_000_000, {}, []

    def add(self, p: int, end: int, key: bool | None, duration: int | None, where: tuple[int, int], base: int) -> None:
        b = self.b
        track, q = vint(b, p, end)
        if q + 3 > end:
            raise Broken
        ticks = base + int.from_bytes(b[q : q + 2], signed=True)
        flags = b[q + 2]
        lacing = flags >> 1 & 3
        parts = frames(b, q + 3, end, lacing)
        self.block += 1
        self.place[where] = len(self.out)
        for i, (s, n) in enumerate(parts):
            self.out.append([track, None, self.cluster, self.block, i, LACINGS[lacing], len(parts), None, bool(flags & 128) if key is None else key, False, s, n])
            self.rel.append((ticks, duration))

    def head(self, name: int, p: int, stop: int) -> None:
        """Info, Tracks or Cues."""
        b = self.b
        for x, _, lo, hi in elements(b, p, stop):
            if name == INFO and x == SCALE:
                self.scale = uint(b, lo, hi) or self.scale
            elif name == TRACKS and x == ENTRY:
                own = {n: (f, t) for n, _, f, t in elements(b, lo, hi)}
                if NUMBER in own:
                    codec = bytes(b[slice(*own[CODEC])]).decode("ascii", "replace") if CODEC in own else None
                    self.tracks[uint(b, *own[NUMBER])] = codec, uint(b, *own[DEFAULT]) if DEFAULT in own else None
            elif name == CUES and x == POINT:
                time = 0
                for y, _, f, t in elements(b, lo, hi):
                    if y == CUE_TIME:
                        time = uint(b, f, t)
                    elif y == POSITIONS:
                        own = {n: uint(b, u, v) for n, _, u, v in elements(b, f, t)}
                        self.cues.append((time, own.get(CUE_TRACK), own.get(CUE_CLUSTER), own.get(CUE_RELATIVE)))

    def blocks(self, at: int, p: int, stop: int) -> int:
        """A Cluster's packets; where it ends. at: its place in the Segment's data."""
        b, base, done = self.b, 0, p
        self.cluster += 1
        try:
            for x, q, lo, hi in elements(b, p, stop, TOP):
                if x == TIME:
                    base = uint(b, lo, hi)
                elif x == SIMPLE:
                    self.add(lo, hi, None, None, (at, q - p), base)
                elif x == GROUP:
                    own = {n: (f, t) for n, _, f, t in elements(b, lo, hi)}
                    if BLOCK in own:
                        self.add(*own[BLOCK], REFERENCE not in own, uint(b, *own[DURATION]) if DURATION in own else None, (at, q - p), base)
                done = hi
        except Broken:
            self.damaged = True
            again = bytes(b[done + 1 : stop]).find(CLUSTER_ID)
            return stop if again < 0 else done + 1 + again
        self.damaged |= done < stop  # a Segment's own element inside: the Cluster's size was wrong
        return done

    def read(self, p: int, end: int, open_end: bool) -> int:
        """The Segment's elements; where it ends."""
        b, start = self.b, p
        while p < end:
            at = p
            try:
                for name, at, lo, stop in elements(b, p, end, {EBML, SEGMENT} if open_end else frozenset()):
                    p = stop
                    if name == CLUSTER:
                        p = self.blocks(at - start, lo, stop)
                        if p != stop:
                            break
                    elif name in (INFO, TRACKS, CUES):
                        self.head(name, lo, stop)
                else:
                    return p
            except Broken:
                self.damaged = True
                p = max(p, at + 1)
                again = bytes(b[p:end]).find(CLUSTER_ID)
                if again < 0:
                    return end
                p += again
        return p

    def packets(self) -> list[list]:
        first = {(pos, self.out[k][0], self.rel[k][0]): k for (pos, _), k in reversed(self.place.items())}
        for time, track, pos, inside in self.cues:
            k = self.place.get((pos, inside)) if inside is not None else first.get((pos, track, time))
            if k is not None:
                self.out[k][9] = True
        for x, (ticks, duration) in zip(self.out, self.rel, strict=True):
            x[1], step = self.tracks.get(x[0], (None, None))
            each = step if step else duration * self.scale // x[6] if duration is not None else None
            x[6] = ticks * self.scale + x[4] * each if x[4] and each is not None else None if x[4] else ticks * self.scale
            x[7] = each
        return self.out


def parse(b: bytes | None) -> tuple[str, list[list]]:
    """State and packets: [track, codec, cluster, block, lace, lacing, timestamp_ns, duration_ns, keyframe, cued, start, size].

    State: 'ok'; 'empty' (null or no bytes); 'not matroska'; 'damaged' (what is whole before the damage and in
    later clusters is given). Chained Segments are read one after the other; clusters and blocks count on.
    """
    if not b:
        return "empty", []
    if b[:4] != EBML.to_bytes(4):
        return "not matroska", []
    out: list[list] = []
    damaged, at, cluster, block = False, 0, -1, -1
    try:
        while at < len(b):
            name, p = vint(b, at, len(b), True)
            size, p = vint(b, p, len(b))
            stop = len(b) if size is None else p + size
            damaged |= stop > len(b)
            if name == SEGMENT:
                one = _Segment(b, cluster, block)
                stop = one.read(p, min(stop, len(b)), size is None) if size is None else (one.read(p, min(stop, len(b)), False), stop)[1]
                out += one.packets()
                damaged, cluster, block = damaged | one.damaged, one.cluster, one.block
            at = stop
    except Broken:
        damaged = True
    return "damaged" if damaged else "ok", out


NAMES = ["track", "codec", "cluster", "block", "lace", "lacing", "timestamp_ns", "duration_ns", "keyframe", "cued", "start", "size"]
KINDS = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
SCHEMA = "doc_id long, state string, track long, codec string, cluster int, block int, lace int, lacing string, timestamp_ns long, duration_ns long, keyframe boolean, cued boolean, start long, size long, crc32 long"


def packets(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """doc_id, state and the packet columns: a row for each frame of each file, in file order.

    start and size are the frame's byte range in the file, crc32 its checksum. A file without a frame (null,
    empty, not Matroska, damaged before its first frame) has one row that is null but for doc_id and state.
    A damaged file gives the frames before the damage and those of later clusters. Very long files are read
    whole, one at a time; their payloads aren't copied. A laced frame after the first has no timestamp
    where neither the track nor the block says how long a frame is. Frames of unknown tracks have a null
    codec. Repeated rows give repeated packets. Other columns are ignored. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), *(pa.array(c, k) for c, k in zip(cols[2:14], KINDS, strict=True)), pa.array(cols[14], pa.int64())], names=["doc_id", "state", *NAMES, "crc32"]
            )

        rows: list[tuple] = []
        for b in batches:
            ids = b.column(id_col).cast(pa.int64()).to_pylist()
            col = b.column(media_col)
            for i, doc in enumerate(ids):
                x = col[i].as_py()
                state, found = parse(x)
                view = memoryview(x or b"")
                rows += [(doc, state, *p, zlib.crc32(view[p[10] : p[10] + p[11]])) for p in found] or [(doc, state, *[None] * 13)]
                if len(rows) >= 20_000:
                    yield batch()
                    rows.clear()
            if rows:
                yield batch()
                rows.clear()

    return narrow(media, id_col, media_col).mapInArrow(run, SCHEMA)


# The writer


def _id(n: int) -> bytes:
    return n.to_bytes((n.bit_length() + 7) // 8)


def _size(n: int, width: int = 0) -> bytes:
    w = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * w).to_bytes(w)


def element(name: int, data: bytes, width: int = 0) -> bytes:
    return _id(name) + _size(len(data), width) + data


def _uint(name: int, n: int) -> bytes:
    return element(name, n.to_bytes(max(1, (n.bit_length() + 7) // 8)))


def lace(sizes: list[int], lacing: int) -> bytes:
    out = bytes([len(sizes) - 1])
    if lacing == 1:
        for s in sizes[:-1]:
            out += b"\xff" * (s // 255) + bytes([s % 255])
    elif lacing == 3:
        out += _size(sizes[0])
        for a, b in zip(sizes[:-1], sizes[1:-1], strict=False):
            w = next(w for w in range(1, 9) if abs(b - a) < (1 << (7 * w - 1)) - 1)
            out += _size(b - a + (1 << (7 * w - 1)) - 1, w)
    return out


def mux(payloads: list[bytes], lacing: int = 0, per_block: int = 1, per_cluster: int = 8, track: int = 1, codec: str = "S_TEXT/UTF8", frame_ms: int = 40, grouped: bool = False, unknown: bool = False, default: bool = True) -> bytes:
    """A file of one track. per_block frames to a block (1 without lacing), per_cluster blocks to a
    cluster; grouped: BlockGroups instead of SimpleBlocks; unknown: clusters of unknown size; default:
    the track states its frame duration. The first block of each cluster is a keyframe and has a cue."""
    entry = _uint(NUMBER, track) + _uint(0x83, 17) + element(CODEC, codec.encode()) + (_uint(DEFAULT, frame_ms * 1_000_000) if default else b"")
    body = element(INFO, _uint(SCALE, 1_000_000)) + element(TRACKS, element(ENTRY, entry))
    blocks = [payloads[i : i + per_block] for i in range(0, len(payloads), per_block)]
    cues, out, at = [], [body], len(body)
    for c in range(0, len(blocks), per_cluster):
        time = c * per_block * frame_ms
        inner = [_uint(TIME, time)]
        cues.append(element(POINT, _uint(CUE_TIME, time) + element(POSITIONS, _uint(CUE_TRACK, track) + _uint(CUE_CLUSTER, at) + _uint(CUE_RELATIVE, len(inner[0])))))
        for k, parts in enumerate(blocks[c : c + per_cluster]):
            head = _size(track) + (k * per_block * frame_ms).to_bytes(2, signed=True)
            data = b"".join(parts)
            use = lacing if len(parts) > 1 else 0
            data = (lace([len(x) for x in parts], use) if use else b"") + data
            if grouped:
                inner.append(element(GROUP, element(BLOCK, head + bytes([use << 1]) + data) + _uint(DURATION, frame_ms * len(parts)) + (element(REFERENCE, b"\xff") if k else b"")))
            else:
                inner.append(element(SIMPLE, head + bytes([use << 1 | (0 if k else 128)]) + data))
        data = b"".join(inner)
        own = _id(CLUSTER) + (b"\xff" if unknown else _size(len(data), 4)) + data
        out.append(own)
        at += len(own)
    if cues:
        out.append(element(CUES, b"".join(cues)))
    return element(EBML, _uint(0x4286, 1) + element(0x4282, b"matroska")) + element(SEGMENT, b"".join(out), 8)


def text_file(number: int, text: bytes, frame: int = 2048) -> bytes:
    """A text as a media file: frames of at most `frame` bytes; lacing, grouping and cluster form follow number."""
    lacing = number % 4
    parts = [text[i : i + frame] for i in range(0, len(text), frame)]
    per = 4 if lacing else 1
    if lacing == 2 and (len(parts) - 1) % per:  # fixed laces hold equal frames, and the last may be shorter
        per = 1
    return mux(parts, lacing, per, track=1 + number % 200, grouped=number % 3 == 0, unknown=number % 5 == 0, default=number % 7 != 0)


def with_media(docs: DataFrame) -> DataFrame:
    """doc_id, media: each text's bytes in a file of its own, one row for each row of docs. A null text has null
    media, an empty one a file without frames. Repeated rows and null doc_ids (numbered 0) keep their rows. Very
    long texts make one file each. Other columns are ignored. An empty table gives no rows."""

    @F.arrow_udf("binary")
    def made(ids: pa.Array, col: pa.Array) -> pa.Array:
        return pa.array((None if t is None else text_file(i or 0, t.encode()) for i, t in zip(ids.to_pylist(), col.to_pylist(), strict=True)), pa.binary())

    return narrow(docs, "doc_id", "text").select("doc_id", made("doc_id", "text").alias("media"))
