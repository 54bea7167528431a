"""Matroska media in binary columns: packet tables with timestamps, tracks and byte ranges.

The reader walks EBML elements (variable-length ids and sizes, also clusters and segments of unknown size), takes apart
blocks with all kinds of lacing, and resolves cues. The writer makes a file of one 8-bit PCM track, for columns of bytes
that are to be stored losslessly as samples. Each file is read in one task; files are spread over tasks.

Defined results: a null or empty file has no packets; a file that is cut or damaged gives the packets before the damage
and `complete` false. Damage is also a sampling rate that is no positive number, a timestamp scale of 0, times beyond
64-bit nanoseconds and elements nested deeper than MAX_DEPTH (the format has 8 levels). Rows are read one by one, so ids may repeat or be missing. The payload of a null or empty text is
one frame of padding.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetables.llm.common import table, to_bytes

# Fixed values of the format: element ids.
EBML, DOC_TYPE = 0x1A45DFA3, 0x4282
SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TIMESTAMP_SCALE, MUXING_APP, WRITING_APP = 0x2AD7B1, 0x4D80, 0x5741
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, CODEC_ID = 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION = 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
_PARENTS = {SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_TRACK_POSITIONS}
_TOP = {INFO, TRACKS, CLUSTER, CUES}
MAX_DEPTH = 32
LACING = ("none", "xiph", "fixed", "ebml")

FRAME, RATE = 576, 8000
FRAME_MS = FRAME * 1000 // RATE
FRAMES_PER_BLOCK, BLOCKS_PER_CLUSTER = 8, 16


# ---- writing


def vint(value: int) -> bytes:
    """A size: as few bytes as hold it; all ones are reserved for unknown sizes."""
    n = 1
    while value >= (1 << (7 * n)) - 1:
        n += 1
    return (value | 1 << (7 * n)).to_bytes(n, "big")


def element(ident: int, data: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(data)) + data


def number(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def _laced(frames: list[bytes], kind: str) -> bytes:
    """The frames of a block after its head: their sizes as the kind of lacing has them, then their bytes."""
    if kind == "none":
        return frames[0]
    out = bytearray([len(frames) - 1])
    if kind == "xiph":
        for f in frames[:-1]:
            out += b"\xff" * (len(f) // 255) + bytes([len(f) % 255])
    elif kind == "ebml":
        out += vint(len(frames[0]))
        for a, b in zip(frames[:-2], frames[1:-1]):
            d = len(b) - len(a)
            n = 1
            while not -(1 << (7 * n - 1)) < d < 1 << (7 * n - 1):
                n += 1
            out += (d + (1 << (7 * n - 1)) - 1 | 1 << (7 * n)).to_bytes(n, "big")
    return bytes(out) + b"".join(frames)


def write_pcm(payload: bytes) -> bytes:
    """A file of one 8-bit track of 8000 samples a second in frames of 576, with cues for its clusters."""
    head = element(EBML, element(DOC_TYPE, b"matroska"))
    info = element(INFO, number(TIMESTAMP_SCALE, 1_000_000) + element(MUXING_APP, b"codetables") + element(WRITING_APP, b"codetables"))
    audio = element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + number(CHANNELS, 1) + number(BIT_DEPTH, 8))
    entry = number(TRACK_NUMBER, 1) + number(TRACK_UID, 1) + number(TRACK_TYPE, 2) + number(FLAG_LACING, 1) + element(CODEC_ID, b"A_PCM/INT/LIT")
    tracks = element(TRACKS, element(TRACK_ENTRY, entry + audio))
    body, cues = [info, tracks], []
    at, step = len(info) + len(tracks), FRAME * FRAMES_PER_BLOCK
    for first in range(0, len(payload), step * BLOCKS_PER_CLUSTER):
        begin = first // FRAME * FRAME_MS
        blocks = [number(TIMESTAMP, begin)]
        for start in range(first, min(first + step * BLOCKS_PER_CLUSTER, len(payload)), step):
            frames = [payload[i : i + FRAME] for i in range(start, min(start + step, len(payload)), FRAME)]
            kind = "none" if len(frames) == 1 else ("fixed", "xiph", "ebml")[start // step % 3]
            flags = 0x80 | LACING.index(kind) << 1
            relative = start // FRAME * FRAME_MS - begin
            blocks.append(element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", relative, flags) + _laced(frames, kind)))
        cluster = element(CLUSTER, b"".join(blocks))
        cues.append(element(CUE_POINT, number(CUE_TIME, begin) + element(CUE_TRACK_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER_POSITION, at))))
        body.append(cluster)
        at += len(cluster)
    body.append(element(CUES, b"".join(cues)))
    return head + element(SEGMENT, b"".join(body))


# ---- reading


@dataclass
class Media:
    scale: int = 1_000_000
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[tuple] = field(default_factory=list)  # track, timestamp_ns, start, end, cluster, lacing, key
    clusters: list[int] = field(default_factory=list)  # their places in the file
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time_ns, track, place in the file
    complete: bool = True


class Damaged(ValueError):
    pass


def _length(data: bytes, at: int, limit: int) -> int:
    if at >= limit or not data[at]:
        raise Damaged(at)
    n = 9 - data[at].bit_length()
    if at + n > limit:
        raise Damaged(at)
    return n


def _vint(data: bytes, at: int, limit: int) -> tuple[int | None, int]:
    """The value without its marker (None: unknown) and the place behind it."""
    n = _length(data, at, limit)
    value = int.from_bytes(data[at : at + n], "big") & (1 << 7 * n) - 1
    return (None if value == (1 << 7 * n) - 1 else value), at + n


def _elements(data: bytes, at: int, limit: int, unknown_parent: int | None = None) -> Iterator[tuple[int, int, int, int]]:
    """(id, start of the element, start and end of its data). In a cluster of unknown size the next top element ends it."""
    while at < limit:
        begin = at
        n = _length(data, at, limit)
        ident, at = int.from_bytes(data[at : at + n], "big"), at + n
        if unknown_parent == CLUSTER and ident in _TOP:
            return
        size, at = _vint(data, at, limit)
        if size is None:
            if ident not in (SEGMENT, CLUSTER):
                raise Damaged(begin)
            end = limit
            if ident == CLUSTER:
                for _, _, _, stop in _elements(data, at, limit, CLUSTER):
                    end = stop
                end = end if end != limit else limit
        else:
            end = at + size
            if end > limit:
                if ident not in (SEGMENT, CLUSTER):
                    raise Damaged(begin)
                yield ident, begin, at, limit  # what there is of it
                raise Damaged(begin)
        yield ident, begin, at, end
        at = end


def _uint(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def _frame_sizes(data: bytes, at: int, end: int, kind: int) -> tuple[list[int], int]:
    if kind == 0:
        return [end - at], at
    if at >= end:
        raise Damaged(at)
    n, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if kind == 2:
        if (end - at) % n:
            raise Damaged(at)
        return [(end - at) // n] * n, at
    for k in range(n - 1):
        if kind == 1:
            size = 0
            while True:
                if at >= end:
                    raise Damaged(at)
                size, at = size + data[at], at + 1
                if data[at - 1] != 255:
                    break
        else:
            width = _length(data, at, end)
            value, at = _vint(data, at, end)
            if value is None:
                value = (1 << 7 * width) - 1
            size = value if not k else sizes[-1] + value - ((1 << (7 * width - 1)) - 1)
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise Damaged(at)
    return sizes, at


def read_media(data: bytes | None) -> Media:
    media = Media()
    if not data:
        return media
    base = 0

    def timed(value: int) -> int:
        if not -(1 << 63) <= value < 1 << 63:
            raise Damaged(value)
        return value

    def block(a: int, b: int, cluster_time: int, simple: bool) -> None:
        track, at = _vint(data, a, b)
        if track is None or at + 3 > b:
            raise Damaged(a)
        relative, flags = struct.unpack_from(">hB", data, at)
        sizes, at = _frame_sizes(data, at + 3, b, flags >> 1 & 3)
        # Frames in a lace follow each other; all of them but the first are timed by the track's frame length.
        step = media.tracks.get(track, {}).get("frame_ns")
        time = (cluster_time + relative) * media.scale
        for k, size in enumerate(sizes):
            each = step(size) if step else 0
            media.packets.append((track, timed(time + k * each), at, at + size, len(media.clusters) - 1, LACING[flags >> 1 & 3], bool(flags & 0x80) if simple else None))
            at += size

    def walk(a: int, b: int, time: int, path: tuple[int, ...]) -> None:
        nonlocal base
        if len(path) > MAX_DEPTH:
            raise Damaged(a)
        track: dict = {}
        cue: dict = {}
        for ident, begin, x, y in _elements(data, a, b, CLUSTER if path[-1:] == (CLUSTER,) else None):
            if ident == SEGMENT:
                base = x
            if ident == CLUSTER:
                media.clusters.append(begin)
            if ident == TIMESTAMP:
                time = _uint(data, x, y)
            elif ident == TIMESTAMP_SCALE:
                media.scale = _uint(data, x, y)
                if not media.scale:
                    raise Damaged(x)
            elif ident in (SIMPLE_BLOCK, BLOCK):
                block(x, y, time, ident == SIMPLE_BLOCK)
            elif ident == TRACK_NUMBER:
                track["number"] = _uint(data, x, y)
            elif ident == TRACK_TYPE:
                track["type"] = _uint(data, x, y)
            elif ident == CODEC_ID:
                track["codec"] = data[x:y].decode("ascii", "replace")
            elif ident == AUDIO:
                found = {i: data[s:e] for i, _, s, e in _elements(data, x, y)}
                rate = found.get(SAMPLING_FREQUENCY, b"")
                track["rate"] = struct.unpack(">d" if len(rate) == 8 else ">f", rate)[0] if len(rate) in (4, 8) else 8000.0
                if not 0 < track["rate"] < math.inf:
                    raise Damaged(x)
                track["width"] = max(1, int.from_bytes(found.get(BIT_DEPTH, b"\x08"), "big") // 8) * max(1, int.from_bytes(found.get(CHANNELS, b"\x01"), "big"))
            elif ident == CUE_TIME:
                cue["time"] = _uint(data, x, y)
            elif ident == CUE_TRACK_POSITIONS:
                found = {i: _uint(data, s, e) for i, _, s, e in _elements(data, x, y)}
                media.cues.append((timed(cue.get("time", 0) * media.scale), found.get(CUE_TRACK, 0), base + found.get(CUE_CLUSTER_POSITION, 0)))
            elif ident in _PARENTS:
                walk(x, y, time, (*path, ident))
        if "number" in track:
            if track.get("codec", "").startswith("A_PCM"):
                rate, width = track.get("rate", 8000.0), track.get("width", 1)
                track["frame_ns"] = lambda size: round(min(size // width * 1e9 / rate, 2.0**64))
            media.tracks[track["number"]] = track

    try:
        walk(0, len(data), 0, ())
    except Damaged:
        media.complete = False
    return media


PACKET = "packet int, track long, timestamp_ns long, start long, end long, cluster int, lacing string, key boolean"


def packet_table(media: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """One row for each packet of each file: id, PACKET (byte ranges of the file), cue (a cue points to its cluster)."""
    kind = media.schema[id_col].dataType.simpleString()

    def emit(batches):
        for pdf in batches:
            for ident, data in zip(pdf.iloc[:, 0], pdf.iloc[:, 1]):
                found = read_media(data)
                cued = {place for _, _, place in found.cues}
                rows = [(ident, k, *p, found.clusters[p[4]] in cued) for k, p in enumerate(found.packets)]
                if rows:
                    import pandas as pd

                    yield pd.DataFrame(rows, columns=[id_col, *[x.split()[0] for x in PACKET.split(", ")], "cue"])

    return media.select(id_col, media_col).mapInPandas(emit, f"`{id_col}` {kind}, {PACKET}, cue boolean")


def padded(text: str | None) -> tuple[bytes, int]:
    data = to_bytes(text)
    size = max(1, -(-len(data) // FRAME)) * FRAME
    return data + b"\xff" * (size - len(data)), len(data)


def feature(media: Media, payload: bytes) -> str:
    """What the packets and samples say: numbers of packets, clusters and cues that point to a cluster, kinds of
    lacing, length in ms, and mean, power and changes of direction of the samples."""
    samples = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    kinds = [sum(p[5] == k for p in media.packets) for k in LACING]
    places = set(media.clusters)
    cued = sum(place in places for _, _, place in media.cues)
    last = media.packets[-1] if media.packets else (0, 0)
    turns = int(np.count_nonzero(np.diff(np.signbit(samples)))) if len(samples) else 0
    n = max(1, len(samples))
    return f"packets={len(media.packets)} clusters={len(media.clusters)} cues={cued} lacing={'/'.join(map(str, kinds))} ms={last[1] // 1_000_000 + FRAME_MS} mean={int(samples.sum()) * 1000 // n} power={int((samples**2).sum()) // n} turns={turns}"


def stored_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text as a Matroska file: id, n_bytes (of the text), media (the file)."""

    @F.pandas_udf("n_bytes long, media binary")
    def stored(texts):
        import pandas as pd

        made = [(n, write_pcm(p)) for p, n in map(padded, texts)]
        return pd.DataFrame(made, columns=["n_bytes", "media"])

    return docs.select(id_col, stored(F.col(text_col)).alias("_m")).select(id_col, "_m.*")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files are made and read back in the same task, so that their bytes needn't cross to it a second time."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for text in batch.column(1):
                payload, n = padded(text.as_py())
                media = write_pcm(payload)
                found = read_media(media)
                back = b"".join([media[p[2] : p[3]] for p in found.packets])
                row = (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(found, back))
                for c, v in zip(cols, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols)], names=[x.split()[0] for x in schema.split(", ")])

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(emit, schema)
