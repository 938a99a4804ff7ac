"""Matroska: writing and parsing of EBML files, and media columns of Spark tables.

``parse`` walks the variable-length elements of a file: header, segment (of known
or unknown size), track entries, clusters, simple blocks and block groups with
all four lacings, and cues.  Its packet table has a row for each frame: track,
time stamp, byte range, key flag.  ``write`` makes a file with one PCM audio track.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .packing import slices

# Element ids and the codec name of the public Matroska specification (fixed values).
EBML, EBML_VERSION, EBML_READ_VERSION, MAX_ID_LENGTH, MAX_SIZE_LENGTH = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3
DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, MUXING_APP, WRITING_APP, DURATION = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4D80, 0x5741, 0x4489
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, FLAG_LACING, DEFAULT_DURATION = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x9C, 0x23E383
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION, REFERENCE_BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
PCM_CODEC = b"A_PCM/INT/LIT"
#: Elements that end a cluster or segment of unknown size.
_TOP = {SEGMENT, INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1043A770, 0x1254C367, 0x1941A469, EBML}

FRAME, FRAMES_PER_BLOCK, BLOCKS_PER_CLUSTER, RATE = 576, 8, 256, 48_000
MS_PER_FRAME = FRAME * 1000 // RATE


class BadMedia(ValueError):
    """The bytes are not a Matroska file, or one that breaks off."""


def _size(n: int) -> bytes:
    for length in range(1, 9):
        if n < (1 << (7 * length)) - 1:
            return (n | 1 << (7 * length)).to_bytes(length, "big")
    raise ValueError(n)


def _id(n: int) -> bytes:
    return n.to_bytes((n.bit_length() + 7) // 8, "big")


def _element(ident: int, body: bytes) -> bytes:
    return _id(ident) + _size(len(body)) + body


def _uint(ident: int, n: int) -> bytes:
    return _element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def _float(ident: int, x: float) -> bytes:
    return _element(ident, struct.pack(">d", x))


def lace(track: int, time: int, frames: list[bytes], lacing: str = "fixed", key: bool = True) -> bytes:
    """The body of a (simple) block: ``lacing`` is none, xiph, fixed or ebml; ``time`` is relative to the cluster."""
    code = {"none": 0, "xiph": 1, "fixed": 2, "ebml": 3}[lacing if len(frames) > 1 else "none"]
    head = _size(track) + struct.pack(">hB", time, (0x80 if key else 0) | code << 1)
    if code:
        head += bytes([len(frames) - 1])
    sizes = [len(f) for f in frames]
    if code == 1:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif code == 3:
        head += _size(sizes[0])
        for a, b in zip(sizes[:-2], sizes[1:-1], strict=True):
            d = b - a
            length = next(k for k in range(1, 9) if abs(d) < 1 << (7 * k - 1))
            head += ((d + (1 << (7 * length - 1)) - 1) | 1 << (7 * length)).to_bytes(length, "big")
    return head + b"".join(frames)


def write(payload: bytes, frame: int = FRAME) -> bytes:
    """A Matroska file that holds ``payload`` as 8-bit mono samples; its size must be a multiple of ``frame``."""
    if len(payload) % frame:
        raise ValueError("the payload is not a whole number of frames")
    n = len(payload) // frame
    head = _element(
        EBML,
        _uint(EBML_VERSION, 1) + _uint(EBML_READ_VERSION, 1) + _uint(MAX_ID_LENGTH, 4) + _uint(MAX_SIZE_LENGTH, 8) + _element(DOC_TYPE, b"matroska") + _uint(DOC_TYPE_VERSION, 4) + _uint(
            DOC_TYPE_READ_VERSION, 2
        )
    )
    info = _element(
        INFO,
        _uint(TIMESTAMP_SCALE, 1_000_000) + _float(
            DURATION, float(n * MS_PER_FRAME)
        ) + _element(MUXING_APP, b"settleforge") + _element(WRITING_APP, b"settleforge")
    )
    audio = _element(AUDIO, _float(SAMPLING_FREQUENCY, float(RATE)) + _uint(CHANNELS, 1) + _uint(BIT_DEPTH, 8))
    tracks = _element(
        TRACKS,
        _element(
            TRACK_ENTRY,
            _uint(TRACK_NUMBER, 1) + _uint(TRACK_UID, 1) + _uint(TRACK_TYPE, 2) + _uint(FLAG_LACING, 1) + _uint(
                DEFAULT_DURATION, MS_PER_FRAME * 1_000_000
            ) + _element(CODEC_ID, PCM_CODEC) + audio
        )
    )
    parts, at, cues = [info, tracks], len(info) + len(tracks), []
    per_cluster = FRAMES_PER_BLOCK * BLOCKS_PER_CLUSTER
    for first in range(0, n, per_cluster):
        body = [_uint(TIMESTAMP, first * MS_PER_FRAME)]
        for k in range(first, min(first + per_cluster, n), FRAMES_PER_BLOCK):
            count = min(FRAMES_PER_BLOCK, n - k)
            raw = payload[k * frame : (k + count) * frame]
            # Frames of one size need no sizes in the block, so they need not be cut apart here.
            lacing = b"\x81" + struct.pack(
                ">hB", (k - first) * MS_PER_FRAME, 0x84 if count > 1 else 0x80
            ) + (bytes([count - 1]) if count > 1 else b"")
            body.append(_element(SIMPLE_BLOCK, lacing + raw))
        cluster = _element(CLUSTER, b"".join(body))
        cues.append(
            _element(
                CUE_POINT,
                _uint(CUE_TIME, first * MS_PER_FRAME) + _element(
                    CUE_TRACK_POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER_POSITION, at)
                )
            )
        )
        parts.append(cluster)
        at += len(cluster)
    parts.append(_element(CUES, b"".join(cues)))
    return head + _element(SEGMENT, b"".join(parts))


@dataclass
class Media:
    """What a file holds; packets are columns of equal length."""

    doc_type: str = ""
    timestamp_scale: int = 1_000_000
    duration: float | None = None
    tracks: list[dict] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time, track, cluster position in the segment
    clusters: list[tuple[int, int]] = field(default_factory=list)  # position in the segment, time
    track: list[int] = field(default_factory=list)
    time: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    size: list[int] = field(default_factory=list)
    key: list[bool] = field(default_factory=list)


def _vint(data: bytes, at: int, marker: bool = False) -> tuple[int, int]:
    """A variable-length number and the place after it; a size of all ones (unknown) is -1."""
    if at >= len(data) or not data[at]:
        raise BadMedia(f"no variable-length number at {at}")
    length = 9 - data[at].bit_length()
    end = at + length
    if end > len(data):
        raise BadMedia("the file breaks off")
    n = int.from_bytes(data[at:end], "big")
    if marker:
        return n, end
    n &= (1 << (7 * length)) - 1
    return (-1 if n == (1 << (7 * length)) - 1 else n), end


def _elements(data: bytes, at: int, end: int):
    """Id, start and end of the body of each child; an unknown size lasts until the next top-level element or the end."""
    while at < end:
        ident, at = _vint(data, at, True)
        size, at = _vint(data, at)
        stop = end if size < 0 else at + size
        if stop > end:
            raise BadMedia(f"element {ident:x} goes beyond its parent")
        if size < 0 and ident == CLUSTER:
            stop = at
            while stop < end:
                child, body = _vint(data, stop, True)
                if child in _TOP:
                    break
                n, body = _vint(data, body)
                stop = end if n < 0 else body + n
        yield ident, at, stop
        at = stop


def _number(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def _real(data: bytes, a: int, b: int) -> float:
    return 0.0 if a == b else struct.unpack(">f" if b - a == 4 else ">d", data[a:b])[0]


def _block(data: bytes, a: int, b: int, cluster_time: int, key: bool | None, step: dict[int, int], out: Media) -> None:
    track, at = _vint(data, a)
    if at + 3 > b:
        raise BadMedia("a block has no header")
    time, flags = struct.unpack_from(">hB", data, at)
    at += 3
    kind = flags >> 1 & 3
    count = 1
    if kind:
        if at >= b:
            raise BadMedia("a laced block has no count")
        count, at = data[at] + 1, at + 1
    if kind == 1:
        sizes = []
        for _ in range(count - 1):
            n = 0
            while True:
                x = data[at]
                n, at = n + x, at + 1
                if x < 255:
                    break
            sizes.append(n)
        sizes.append(b - at - sum(sizes))
    elif kind == 3:
        n, at = _vint(data, at)
        sizes = [n]
        for _ in range(count - 2):
            start = at
            d, at = _vint(data, at)
            d = d if d >= 0 else (1 << (7 * (at - start))) - 1
            n += d - ((1 << (7 * (at - start) - 1)) - 1)
            sizes.append(n)
        sizes = sizes[: count - 1]
        sizes.append(b - at - sum(sizes))
    else:
        if (b - at) % count:
            raise BadMedia("fixed lacing does not divide the block")
        sizes = [(b - at) // count] * count
    if min(sizes) < 0:
        raise BadMedia("lace sizes go beyond the block")
    per = step.get(track, 0)
    for i, n in enumerate(sizes):
        out.offset.append(at)
        out.size.append(n)
        out.time.append(cluster_time + time + i * per)
        at += n
    out.track += [track] * count
    out.key += [bool(flags & 0x80) if key is None else key] * count


def parse(data: bytes) -> Media:
    """Read a whole file.  Raises ``BadMedia`` on bytes that are no Matroska file."""
    out, step = Media(), {}
    for ident, a, b in _elements(data, 0, len(data)):
        if ident == EBML:
            for k, x, y in _elements(data, a, b):
                if k == DOC_TYPE:
                    out.doc_type = data[x:y].rstrip(b"\0").decode("ascii", "replace")
        elif ident == SEGMENT:
            start = a  # of the element itself, as cues count it
            for k, x, y in _elements(data, a, b):
                if k == INFO:
                    for f, u, v in _elements(data, x, y):
                        if f == TIMESTAMP_SCALE:
                            out.timestamp_scale = _number(data, u, v)
                        elif f == DURATION:
                            out.duration = _real(data, u, v)
                elif k == TRACKS:
                    for f, u, v in _elements(data, x, y):
                        if f == TRACK_ENTRY:
                            track = _track(data, u, v)
                            out.tracks.append(track)
                            step[track.get("number", 0)] = track.get("default_duration", 0) // out.timestamp_scale
                elif k == CLUSTER:
                    _cluster(data, x, y, step, out, start - a)
                elif k == CUES:
                    for f, u, v in _elements(data, x, y):
                        if f == CUE_POINT:
                            _cue(data, u, v, out)
                start = y
    if not out.doc_type:
        raise BadMedia("no EBML header")
    return out


def _track(data: bytes, a: int, b: int) -> dict:
    out = {}
    for k, x, y in _elements(data, a, b):
        if k in (TRACK_NUMBER, TRACK_TYPE, DEFAULT_DURATION):
            out[
                {TRACK_NUMBER: "number", TRACK_TYPE: "type", DEFAULT_DURATION: "default_duration"}[k]
            ] = _number(data, x, y)
        elif k == CODEC_ID:
            out["codec"] = data[x:y].decode("ascii", "replace")
        elif k == AUDIO:
            for f, u, v in _elements(data, x, y):
                if f == SAMPLING_FREQUENCY:
                    out["rate"] = _real(data, u, v)
                elif f in (CHANNELS, BIT_DEPTH):
                    out["channels" if f == CHANNELS else "bits"] = _number(data, u, v)
    return out


def _cluster(data: bytes, a: int, b: int, step: dict, out: Media, position: int) -> None:
    time, head = 0, True
    for k, x, y in _elements(data, a, b):
        if k == TIMESTAMP:
            time = _number(data, x, y)
        elif k == SIMPLE_BLOCK:
            _block(data, x, y, time, None, step, out)
        elif k == BLOCK_GROUP:
            found, key = None, True
            for f, u, v in _elements(data, x, y):
                if f == BLOCK:
                    found = (u, v)
                elif f == REFERENCE_BLOCK:
                    key = False
            if found:
                _block(data, *found, time, key, step, out)
    out.clusters.append((position, time))


def _cue(data: bytes, a: int, b: int, out: Media) -> None:
    time = 0
    for k, x, y in _elements(data, a, b):
        if k == CUE_TIME:
            time = _number(data, x, y)
        elif k == CUE_TRACK_POSITIONS:
            track = position = 0
            for f, u, v in _elements(data, x, y):
                if f == CUE_TRACK:
                    track = _number(data, u, v)
                elif f == CUE_CLUSTER_POSITION:
                    position = _number(data, u, v)
            out.cues.append((time, track, position))


def payload_of(data: bytes, media: Media, track: int = 1) -> bytes:
    """The bytes of a track's packets, one after another."""
    return b"".join(
        [data[o : o + n] for o, n, t in zip(media.offset, media.size, media.track, strict=True) if t == track]
    )


def feature_of(payload: bytes, media: Media) -> str:
    """Packets, milliseconds, clusters, and of the samples: mean in thousandths, mean square, crossings of the middle, peak."""
    x = np.frombuffer(payload, np.uint8)
    y = x.astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    n = max(1, len(x))
    per = media.tracks[0].get("default_duration", 0) // media.timestamp_scale if media.tracks else 0
    return f"packets={len(media.size)};ms={(media.time[-1] + per) if media.time else 0};clusters={len(media.clusters)};cues={len(media.cues)};mean={int(y.sum()) * 1000 // n};power={int((y * y).sum()) // n};crossings={crossings};peak={int(x.max()) if len(x) else 0}"


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each text as a Matroska file, read the file back and describe what it holds.

    Returns a row for each input row: the id, ``n_bytes`` (of the text in UTF-8),
    ``media`` (the file), ``payload`` (as read back: the text and bytes 255 up to
    a positive multiple of 576) and ``feature``.

    * null and empty texts give one frame of bytes 255; null ids stay null;
    * repeated rows are stored each on its own, equal texts equally;
    * an empty table gives no rows; texts of any length are stored whole.
    """

    def store(batches):
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                buf, off = T.column_bytes(part.column(1))
                data, sizes, files, loads, features = buf.tobytes(), np.diff(off), [], [], []
                for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                    files.append(write(data[a:b].ljust(max(1, -(-(b - a) // FRAME)) * FRAME, b"\xff")))
                    media = parse(files[-1])
                    loads.append(payload_of(files[-1], media))
                    features.append(feature_of(loads[-1], media))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(sizes, pa.int64()), pa.array(files, pa.binary()),
                        pa.array(loads, pa.binary()), pa.array(features)
                    ],
                    names=["id", "n_bytes", "media", "payload", "feature"]
                )

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = src.mapInArrow(
        store,
        f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, media binary, payload binary, feature string"
    )
    return out.withColumnRenamed("id", id_col)


def packet_table(files: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row for each packet of each file: id, ``packet``, ``track``, ``time``, ``offset``, ``size``, ``key``, ``crc32``.

    Files that do not parse, and null ones, give one row with a null packet and
    the reason in ``error``.
    """

    def packets(batches):
        for batch in batches:
            for ident, data in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                error, m = None, Media()
                try:
                    m = parse(data) if data is not None else None
                except (BadMedia, struct.error, IndexError) as e:
                    error, m = str(e) or "broken", None
                if m is None or not m.size:
                    rows = {
                        "packet": [None], "track": [None], "time": [None], "offset": [None], "size": [None],
                        "key": [None], "crc32": [None], "error": [error or ("no packets" if m else "no file")]
                    }
                else:
                    n = len(m.size)
                    rows = {
                        "packet": list(range(n)), "track": m.track, "time": m.time, "offset": m.offset, "size": m.size,
                        "key": m.key,
                        "crc32": [zlib.crc32(data[o : o + k]) for o, k in zip(m.offset, m.size, strict=True)],
                        "error": [None] * n
                    }
                kinds = {"key": pa.bool_(), "error": pa.string()}
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ident.as_py()] * len(rows["key"]), batch.schema.field(0).type),
                        *[pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()]
                    ],
                    names=["id", *rows]
                )

    src = files.select(F.col(id_col).alias("id"), F.col(media_col).alias("media"))
    out = src.mapInArrow(
        packets,
        f"id {files.schema[id_col].dataType.simpleString()}, packet long, track long, time long, offset long, size long, key boolean, crc32 long, error string"
    )
    return out.withColumnRenamed("id", id_col)
