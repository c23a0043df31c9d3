"""Media columns: AVI motion-JPEG without a codec library.

``read_avi`` parses a RIFF index and its frames' bounds; ``decode_frames`` decodes the
luma of baseline JPEG frames, all restart intervals of a batch side by side in numpy;
``find_clips`` cuts where the histogram difference stands out from its neighbours.

``write_avi`` stores bytes losslessly as 8-bit samples: a byte becomes one flat 8 x 8
block (DC step 8, so that the DC level is the sample less 128), 64 blocks a row, one
restart interval a row. Every JPEG decoder reads the same samples back.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.io import table

ROW = 64  # blocks, so payload bytes, in a row of a frame
MAX_ROWS = 64  # rows of blocks in a frame
FRAME_US = 40_000
#: Payload bytes that are encoded, or decoded, together.
PIECE = 1_000_000
#: DC categories in order of code length for stored text, and their code lengths: a fixed format value.
DC_LENGTHS = {0: 4, 1: 4, 2: 3, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3, 8: 4}
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))


def _canonical(lengths: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """Symbol -> (code, length) of (symbol, length) in order of length."""
    out, code, size = {}, 0, 0
    for symbol, n in lengths:
        code <<= n - size
        out[symbol], size = (code, n), n
        code += 1
    return out


_DC_ORDER = sorted(DC_LENGTHS.items(), key=lambda x: (x[1], x[0]))
_DC_CODES = _canonical(_DC_ORDER)


def _diff_codes() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each DC difference from -255 on, with the block's end (one 0)."""
    bits, size = np.zeros(511, np.int32), np.zeros(511, np.int32)
    for d in range(-255, 256):
        category = abs(d).bit_length()
        code, n = _DC_CODES[category]
        extra = d if d >= 0 else d + (1 << category) - 1
        bits[d + 255] = ((code << category) | extra) << 1
        size[d + 255] = n + category + 1
    return bits, size


_BITS, _SIZE = _diff_codes()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _dht(kind: int, order: list[tuple[int, int]]) -> bytes:
    counts = [sum(1 for _, n in order if n == k) for k in range(1, 17)]
    return bytes([kind, *counts, *[s for s, _ in order]])


def _jpeg_head(rows: int) -> bytes:
    quant = bytes([0, *[8] * 64])
    sof = struct.pack(">BHHBBBB", 8, rows * 8, ROW * 8, 1, 1, 0x11, 0)
    return (
        b"\xff\xd8" + _segment(0xDB, quant) + _segment(0xC0, sof)
        + _segment(0xC4, _dht(0x00, _DC_ORDER) + _dht(0x10, [(0, 1)]))
        + _segment(0xDD, struct.pack(">H", ROW)) + _segment(0xDA, bytes([1, 1, 0, 0, 63, 0]))
    )


def _rows_to_scans(rows: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of rows of samples, each followed by FF and its tail byte; row ends."""
    diff = np.diff(rows.astype(np.int16), axis=1, prepend=np.int16(128)) + 255
    bits, size = _BITS[diff], _SIZE[diff]
    ends = np.cumsum(size, axis=1, dtype=np.int32)
    row_bytes = (ends[:, -1] + 7) // 8
    base = np.concatenate(([0], np.cumsum(row_bytes, dtype=np.int32))).astype(np.int32)
    at = (ends - size) + base[:-1, None] * 8
    # A row's last byte is filled with ones: one more code of up to 7 bits.
    fill = row_bytes * 8 - ends[:, -1]
    at = np.concatenate([at.ravel(), base[1:] * 8 - fill])
    bits = np.concatenate([bits.ravel(), (1 << fill) - 1])
    size = np.concatenate([size.ravel(), fill])
    word = bits << (24 - (at & 7) - size)
    first = at >> 3
    total = int(base[-1])
    raw = np.zeros(total + 3, np.float64)
    for k, shift in enumerate((16, 8, 0)):
        raw[k : k + total] += np.bincount(first, (word >> shift) & 255, minlength=total)[:total]
    raw = raw[:total].astype(np.uint8)
    # Byte stuffing (FF 00) and a marker after each row.
    room = 1 + (raw == 255).astype(np.int64)
    room[base[1:] - 1] += 2
    start = np.cumsum(room) - room
    out = np.zeros(int(room.sum()), np.uint8)
    out[start] = raw
    ends_at = start[base[1:] - 1] + room[base[1:] - 1]
    out[ends_at - 2] = 255
    out[ends_at - 1] = tail
    return out, ends_at


def write_avi(payloads: list[bytes], info: list[str]) -> list[bytes]:
    """An AVI for each payload (a positive multiple of 64 bytes), with a text in its INFO list."""
    n_rows = [len(p) // ROW for p in payloads]
    height = [min(n, MAX_ROWS) for n in n_rows]
    frames = [-(-n // h) for n, h in zip(n_rows, height)]
    padded = [p + bytes(f * h * ROW - len(p)) for p, f, h in zip(payloads, frames, height)]
    rows = np.frombuffer(b"".join(padded), np.uint8).reshape(-1, ROW)
    per_frame = np.repeat(height, frames)
    last = np.cumsum(per_frame) - 1
    within = np.arange(len(rows)) - np.repeat(last - per_frame + 1, per_frame)
    tail = (0xD0 + within % 8).astype(np.uint8)
    tail[last] = 0xD9  # the image's end in place of a restart marker
    coded, ends = _rows_to_scans(rows, tail)
    coded = coded.tobytes()
    bounds = [0, *ends[last].tolist()]
    heads = {h: _jpeg_head(h) for h in set(height)}
    out, k = [], 0
    for f, h, text in zip(frames, height, info):
        out.append(_riff([heads[h] + coded[bounds[i] : bounds[i + 1]] for i in range(k, k + f)], h, text))
        k += f
    return out


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def _riff(frames: list[bytes], height: int, info: str) -> bytes:
    largest = max(map(len, frames))
    avih = struct.pack("<14I", FRAME_US, 0, 0, 0x10, len(frames), 0, 1, largest, ROW * 8, height * 8, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIIIhhhh", b"vids", b"MJPG", 0, 0, 0, 0, FRAME_US, 1_000_000, 0, len(frames), largest, 0, 0, 0, 0, ROW * 8, height * 8)
    strf = struct.pack("<IiiHH4sIiiII", 40, ROW * 8, height * 8, 1, 24, b"MJPG", ROW * height * 192, 0, 0, 0, 0)
    head = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    note = _chunk(b"LIST", b"INFO" + _chunk(b"ICMT", info.encode() + b"\0"))
    index, at, chunks = [], 4, []
    for f in frames:
        chunks.append(_chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(chunks[-1])
    return _chunk(b"RIFF", b"AVI " + head + note + _chunk(b"LIST", b"movi" + b"".join(chunks)) + _chunk(b"idx1", b"".join(index)))


@dataclass
class Avi:
    frames: list[tuple[int, int]]  # offset and size of each frame's JPEG
    frame_us: int = 0
    width: int = 0
    height: int = 0
    info: str = ""


def read_avi(data: bytes) -> Avi:
    """Header fields and frame bounds of an AVI: from its ``idx1`` index, else from its ``movi`` list.

    Raises ValueError for what is no AVI. A cut file gives the frames that are whole.
    """
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI")
    avi, movi, index = Avi([]), None, b""
    todo = [(12, len(data))]
    while todo:
        at, end = todo.pop()
        while at + 8 <= end:
            name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
            body, stop = at + 8, min(at + 8 + size, end)
            if name == b"LIST":
                if data[body : body + 4] == b"movi":
                    movi = (body, stop)
                else:
                    todo.append((body + 4, stop))
            elif name == b"avih" and stop - body >= 40:
                avi.frame_us = struct.unpack_from("<I", data, body)[0]
                avi.width, avi.height = struct.unpack_from("<II", data, body + 32)
            elif name == b"ICMT":
                avi.info = data[body:stop].rstrip(b"\0").decode("utf-8", "replace")
            elif name == b"idx1":
                index = data[body:stop]
            at = body + size + size % 2
    if movi is None:
        return avi
    entries = list(struct.iter_unpack("<4sIII", index[: len(index) // 16 * 16]))
    video = [(o, n) for name, _, o, n in entries if name[2:] in (b"dc", b"db")]
    if video:
        # Offsets count from the list's name, or from the file's start.
        base = movi[0] if data[movi[0] + video[0][0] : movi[0] + video[0][0] + 4] == entries[0][0] else 0
        avi.frames = [(base + o + 8, n) for o, n in video if base + o + 8 + n <= len(data)]
    else:
        at = movi[0] + 4
        while at + 8 <= movi[1]:
            size = struct.unpack_from("<I", data, at + 4)[0]
            if data[at + 2 : at + 4] in (b"dc", b"db") and at + 8 + size <= len(data):
                avi.frames.append((at + 8, size))
            at += 8 + size + size % 2
    return avi


#: Huffman tables that motion-JPEG frames may leave out: fixed values of the JPEG standard (K.3-K.6).
#: Kind, numbers of codes of 1 to 16 bits, symbols in order of their codes; hexadecimal.
STANDARD_TABLES = [
    (  # luma DC
        0x00,
        "00 01 05 01 01 01 01 01 01 00 00 00 00 00 00 00",
        "00 01 02 03 04 05 06 07 08 09 0a 0b",
    ),
    (  # chroma DC
        0x01,
        "00 03 01 01 01 01 01 01 01 01 01 00 00 00 00 00",
        "00 01 02 03 04 05 06 07 08 09 0a 0b",
    ),
    (  # luma AC
        0x10,
        "00 02 01 03 03 02 04 03 05 05 04 04 00 00 01 7d",
        "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 "
        "23 42 b1 c1 15 52 d1 f0 24 33 62 72 82 09 0a 16 17 18 19 1a 25 26 27 28 "
        "29 2a 34 35 36 37 38 39 3a 43 44 45 46 47 48 49 4a 53 54 55 56 57 58 59 "
        "5a 63 64 65 66 67 68 69 6a 73 74 75 76 77 78 79 7a 83 84 85 86 87 88 89 "
        "8a 92 93 94 95 96 97 98 99 9a a2 a3 a4 a5 a6 a7 a8 a9 aa b2 b3 b4 b5 b6 "
        "b7 b8 b9 ba c2 c3 c4 c5 c6 c7 c8 c9 ca d2 d3 d4 d5 d6 d7 d8 d9 da e1 e2 "
        "e3 e4 e5 e6 e7 e8 e9 ea f1 f2 f3 f4 f5 f6 f7 f8 f9 fa",
    ),
    (  # chroma AC
        0x11,
        "00 02 01 02 04 04 03 04 07 05 04 04 00 01 02 77",
        "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 "
        "a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1 17 18 19 1a 26 "
        "27 28 29 2a 35 36 37 38 39 3a 43 44 45 46 47 48 49 4a 53 54 55 56 57 58 "
        "59 5a 63 64 65 66 67 68 69 6a 73 74 75 76 77 78 79 7a 82 83 84 85 86 87 "
        "88 89 8a 92 93 94 95 96 97 98 99 9a a2 a3 a4 a5 a6 a7 a8 a9 aa b2 b3 b4 "
        "b5 b6 b7 b8 b9 ba c2 c3 c4 c5 c6 c7 c8 c9 ca d2 d3 d4 d5 d6 d7 d8 d9 da "
        "e2 e3 e4 e5 e6 e7 e8 e9 ea f2 f3 f4 f5 f6 f7 f8 f9 fa",
    ),
]


@functools.lru_cache(maxsize=64)
def _lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """For every 16 bits the symbol << 5 | length of the code that they begin with (0: none)."""
    out, code, k = np.zeros(1 << 16, np.int32), 0, 0
    for n in range(1, 17):
        for _ in range(counts[n - 1]):
            out[code << (16 - n) : (code + 1) << (16 - n)] = symbols[k] << 5 | n
            code, k = code + 1, k + 1
        code <<= 1
    return out


@dataclass
class Jpeg:
    """A baseline frame's layout: blocks of an MCU as (component, DC table, AC table)."""

    width: int
    height: int
    mcu: list[tuple[int, int, int]]
    sampling: list[tuple[int, int]]
    quant: list[np.ndarray]  # by component, in zigzag order
    tables: dict[int, np.ndarray]
    interval: int
    scan: int  # where the entropy-coded bytes begin

    @property
    def coding(self) -> tuple:
        """What frames must share to be decoded together: all but their dimensions."""
        used = sorted({t for _, *two in self.mcu for t in two})
        return tuple(self.mcu), self.interval, *(q.tobytes() for q in self.quant), *(id(self.tables[t]) for t in used)

    @property
    def mcus(self) -> int:
        h, v = max(s[0] for s in self.sampling), max(s[1] for s in self.sampling)
        return -(-self.width // (8 * h)) * -(-self.height // (8 * v))


def _parse_head(data: bytes) -> Jpeg:
    tables = {k: _lookup(bytes.fromhex(c), bytes.fromhex(s)) for k, c, s in STANDARD_TABLES}
    quant, interval, at, frame = {}, 0, 2, None
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("no JPEG frame")
        marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        if marker == 0xDB:
            while body:
                n = 128 if body[0] >> 4 else 64
                quant[body[0] & 15] = np.frombuffer(body[1 : n + 1], ">u2" if n == 128 else np.uint8).astype(np.int64)
                body = body[n + 1 :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = _lookup(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            interval = struct.unpack(">H", body[:2])[0]
        elif marker in (0xC0, 0xC1):
            height, width, n = struct.unpack_from(">HHB", body, 1)
            frame = height, width, [tuple(body[6 + 3 * i : 9 + 3 * i]) for i in range(n)]
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("only baseline frames")
        elif marker == 0xDA:
            break
        at += 2 + size
    if frame is None:
        raise ValueError("no frame header")
    height, width, parts = frame
    chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
    mcu = []
    for c, (name, hv, _) in enumerate(parts):
        blocks = (hv >> 4) * (hv & 15) if len(parts) > 1 else 1
        mcu += [(c, chosen[name] >> 4, 0x10 | chosen[name] & 15)] * blocks
    sampling = [(hv >> 4, hv & 15) for _, hv, _ in parts] if len(parts) > 1 else [(1, 1)]
    return Jpeg(width, height, mcu, sampling, [quant[q] for _, _, q in parts], tables, interval, at + 2 + size)


@dataclass
class Luma:
    """A frame's luma blocks in scan order: the DC samples, and the pixels of blocks with detail."""

    jpeg: Jpeg
    dc: np.ndarray  # uint8, one sample a block: the block's mean
    detail: dict[int, np.ndarray]  # block -> 64 pixels

    def histogram(self, bins: int = 32) -> np.ndarray:
        flat = np.ones(len(self.dc), bool)
        flat[list(self.detail)] = False
        out = np.bincount(self.dc[flat] // (256 // bins), minlength=bins) * 64
        for pixels in self.detail.values():
            out = out + np.bincount(pixels // (256 // bins), minlength=bins)
        return out


def _idct(coefficients: np.ndarray) -> np.ndarray:
    x = np.arange(8)
    basis = np.cos((2 * x[:, None] + 1) * x[None, :] * np.pi / 16) / 2
    basis[:, 0] /= np.sqrt(2)
    pixels = basis @ coefficients.reshape(-1, 8, 8) @ basis.T
    return np.clip(np.rint(pixels + 128), 0, 255).astype(np.uint8).reshape(-1, 64)


def decode_frames(frames: list[bytes]) -> list[Luma | None]:
    """The luma of each JPEG frame; None for what is no baseline JPEG frame or is damaged: an
    unknown code, more than 64 coefficients, a level out of range, a restart interval that does
    not end at its marker, or markers missing, out of turn or too many."""
    heads: dict[bytes, Jpeg | None] = {}
    groups: dict[tuple, list[tuple[int, Jpeg]]] = defaultdict(list)
    out: list[Luma | None] = [None] * len(frames)
    for i, f in enumerate(frames):
        sos = f.find(b"\xff\xda")
        key = f[: sos + 2 + struct.unpack_from(">H", f, sos + 2)[0]] if 0 < sos < len(f) - 4 else b""
        if key not in heads:
            try:
                heads[key] = _parse_head(key)
            except (ValueError, KeyError, IndexError, struct.error):
                heads[key] = None
        if heads[key] is not None:
            groups[heads[key].coding].append((i, heads[key]))
    for members in groups.values():
        lumas = _decode_group([j for _, j in members], [frames[i] for i, _ in members])
        for (i, _), luma in zip(members, lumas):
            out[i] = luma
    return out


_flat: dict[tuple[int, int], tuple] = {}


def _flat_blocks(jpeg: Jpeg) -> np.ndarray:
    """For every 16 bits that begin with a whole block without AC coefficients: its DC
    difference << 5 | its length; else 0."""
    dc, ac = (jpeg.tables[t] for t in jpeg.mcu[0][1:])
    if (id(dc), id(ac)) not in _flat:
        _flat.clear()
        _flat[id(dc), id(ac)] = _flat_table(dc, ac), dc, ac
    return _flat[id(dc), id(ac)][0]


def _flat_table(found: np.ndarray, ends: np.ndarray) -> np.ndarray:
    p = np.arange(1 << 16, dtype=np.int64)
    size, n = found >> 5 & 15, found & 31
    used = n + size
    value = (p >> np.maximum(16 - used, 0)) & ((1 << size) - 1)
    value = np.where(value < (1 << size >> 1), value - (1 << size) + 1, value)
    end = ends[(p << np.minimum(used, 16)) & 0xFFFF]
    ok = (n > 0) & ((end & 31) > 0) & (end >> 5 == 0) & (used + (end & 31) <= 16)
    return np.where(ok, value << 5 | used + (end & 31), 0)


def _decode_group(jpegs: list[Jpeg], frames: list[bytes]) -> list[Luma | None]:
    """Frames with the same tables: every restart interval is a stream of its own."""
    jpeg = jpegs[0]
    scans = [f[j.scan :] for f, j in zip(frames, jpegs)]
    mcus = np.array([j.mcus for j in jpegs])
    raw = np.frombuffer(b"".join(scans) + bytes(8), np.uint8)
    frame_start = np.concatenate(([0], np.cumsum([len(s) for s in scans])))
    after_ff = np.flatnonzero(raw[:-8] == 255)
    follow = raw[after_ff + 1]
    marks = after_ff[(follow >= 0xD0) & (follow <= 0xD7)]
    closes = after_ff[(follow >= 0xD0) & (follow <= 0xD9)]  # restart markers and images' ends
    drop = np.zeros(len(raw), bool)
    drop[after_ff[follow == 0] + 1] = True
    starts = np.sort(np.concatenate([frame_start[:-1], marks + 2]))
    owner = np.searchsorted(frame_start, starts, side="right") - 1
    kept_before = np.cumsum(~drop) - ~drop
    data = raw[~drop].astype(np.int64)
    bit = kept_before[starts] * 8
    order = np.arange(len(starts)) - np.searchsorted(owner, owner, side="left")
    interval = np.full(len(owner), jpeg.interval) if jpeg.interval else mcus[owner]
    # A stream reaches up to the next marker; markers count from 0 to 7 in turn, the end is last.
    close = np.append(closes, len(raw) - 8)[np.searchsorted(closes, starts)]
    end = kept_before[close] * 8
    streams = np.bincount(owner, minlength=len(frames))[owner]
    final = order == streams - 1
    bad = (close >= frame_start[owner + 1]) | (raw[close + 1] != np.where(final, 0xD9, 0xD0 + order % 8))
    bad |= streams != -(-mcus[owner] // np.maximum(interval, 1))
    first = order * interval
    count = np.clip(mcus[owner] - first, 0, interval)
    # 40-bit windows at each byte hold a code and its extra bits from any bit on.
    data = np.concatenate([data, np.zeros(8, np.int64)])
    window = (data[:-4] << 32) | (data[1:-3] << 24) | (data[2:-2] << 16) | (data[3:-1] << 8) | data[4:]
    limit = len(window) * 8 - 8

    luma_blocks = sum(c == 0 for c, _, _ in jpeg.mcu)
    frame_at = np.concatenate(([0], np.cumsum(mcus * luma_blocks)))
    base = frame_at[owner] + first * luma_blocks
    dc = np.zeros(frame_at[-1], np.int64)
    detail: list[tuple[np.ndarray, int, np.ndarray]] = []
    last = np.zeros((len(starts), len(jpeg.quant)), np.int64)

    def take(where: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbol, extra bits' number and value at the streams ``where``; moves them on."""
        at = np.minimum(bit[where], limit)
        w = window[at >> 3] << (at & 7) & 0xFFFFFFFFFF
        found = table[w >> 24]
        symbol, n = found >> 5, found & 31
        size = symbol & 15
        value = (w >> (40 - n - size)) & ((1 << size) - 1)
        value = np.where(value < (1 << size >> 1), value - (1 << size) + 1, value)
        bit[where] = at + n + size
        bad[where[n == 0]] = True
        return symbol, size, value

    flat = _flat_blocks(jpeg) if len(jpeg.mcu) == 1 else None
    most = -(-1024 // max(int(jpeg.quant[0][0]), 1))  # a level of 8-bit samples, quantised
    for m in range(int(count.max(initial=0))):
        live = np.flatnonzero(count > m)
        n_luma = 0
        if flat is not None:
            at = np.minimum(bit[live], limit)
            found = flat[(window[at >> 3] >> (24 - (at & 7))) & 0xFFFF]
            ok = found & 31
            last[live, 0] += found >> 5
            bit[live] = at + ok
            dc[base[live] + m] = last[live, 0]
            bad[live] |= np.abs(last[live, 0]) > most
            live = live[ok == 0]
            if not len(live):
                continue
        for c, dc_table, ac_table in jpeg.mcu:
            _, _, value = take(live, jpeg.tables[dc_table])
            last[live, c] += value
            bad[live] |= (c == 0) & (np.abs(last[live, c]) > most)
            block = base[live] + m * luma_blocks + n_luma
            if c == 0:
                dc[block] = last[live, 0]
                n_luma += 1
            todo, k = np.arange(len(live)), np.ones(len(live), np.int64)
            while len(todo):
                symbol, size, value = take(live[todo], jpeg.tables[ac_table])
                k[todo] += symbol >> 4
                bad[live[todo[(k[todo] > 63) & (size > 0)]]] = True
                if c == 0 and size.any():
                    has = (size > 0) & (k[todo] < 64)
                    detail.append((block[todo[has]], k[todo[has]], value[has]))
                k[todo] += 1
                todo = todo[((size > 0) | (symbol == 0xF0)) & (k[todo] < 64)]
    q = jpeg.quant[0]
    means = np.clip(np.floor_divide(dc * q[0] + 4, 8) + 128, 0, 255).astype(np.uint8)
    which, pixels = np.zeros(0, np.int64), np.zeros((0, 64), np.uint8)
    if detail:
        block, k, value = (np.concatenate([d[i] for d in detail]) for i in range(3))
        which, at = np.unique(block, return_inverse=True)
        coefficients = np.zeros((len(which), 64))
        coefficients[:, 0] = dc[which] * q[0]
        coefficients[at, ZIGZAG[k]] = value * q[k]
        pixels = _idct(coefficients)
    bad |= (bit + 7) // 8 * 8 != end
    broken = np.bincount(owner[bad], minlength=len(frames)) > 0
    cuts = np.searchsorted(which, frame_at)
    out: list[Luma | None] = []
    for i in range(len(frames)):
        lo, hi, own = int(frame_at[i]), int(frame_at[i + 1]), slice(cuts[i], cuts[i + 1])
        luma = Luma(jpegs[i], means[lo:hi], dict(zip((which[own] - lo).tolist(), pixels[own])))
        out.append(None if broken[i] else luma)
    return out


def find_clips(histograms: list[np.ndarray], window: int = 8, factor: float = 2.5, least: float = 0.12) -> list[tuple[int, int]]:
    """(first, last) frame of each clip.

    A cut lies before a frame whose histogram differs from its predecessor's by ``least`` at
    least and by more than mean + ``factor`` deviations of the ``window`` differences before it.
    """
    if not histograms:
        return []
    h = np.asarray(histograms, float)
    h /= np.maximum(h.sum(axis=1, keepdims=True), 1)
    d = np.abs(np.diff(h, axis=0)).sum(axis=1) / 2
    cuts = [0]
    for i in range(len(d)):
        near = d[max(0, i - window, cuts[-1]) : i]
        if d[i] >= least and (not len(near) or d[i] > near.mean() + factor * near.std()):
            cuts.append(i + 1)
    return [(a, b - 1) for a, b in zip(cuts, [*cuts[1:], len(h)])]


CLIP = "clip int, first_frame int, last_frame int, start_s double, end_s double, mean_luma double"


def clip_rows(df: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """A row for each clip of each AVI: id, clip number from 0, frames, seconds, mean luma.

    Null, empty or broken media and media without a decodable frame give no row; a damaged
    frame repeats its predecessor's mean and histogram. Null ids and repeated rows pass through.
    """
    from pyspark.sql.types import StructType

    d = df.select(F.col(id_col).alias(id_col), F.col(media_col).alias("media"))
    schema = StructType([d.schema[0], *StructType.fromDDL(CLIP).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names
        for batch in batches:
            rows = []
            for key, media in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = analyse(media.as_py())
                if found:
                    rows += [dict(zip(names, (key, *c))) for c in found.clips]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return d.mapInArrow(run, schema)


@dataclass
class Found:
    payload: bytes
    info: str
    clips: list[tuple]
    frames: int
    damaged: int = 0


def analyse(media: bytes | None) -> Found | None:
    return next(iter(analyse_many([media])))


def analyse_many(media: list[bytes | None]) -> list[Found | None]:
    """Samples read back, clips and frame count of each AVI; None for what is none."""
    avis, frames = [], []
    for data in media:
        try:
            avi = read_avi(data or b"")
        except ValueError:
            avi = None
        avis.append((avi, len(frames)))
        if avi:
            frames += [data[o : o + n] for o, n in avi.frames]
    lumas = decode_frames(frames)
    out: list[Found | None] = []
    for avi, k in avis:
        own = lumas[k : k + len(avi.frames)] if avi else []
        good = [x for x in own if x is not None]
        if not good:
            out.append(None)
            continue
        histograms, means, before = [], [], None
        for x in own:
            before = x if x is not None else before or good[0]
            histograms.append(before.histogram())
            means.append(float(before.dc.mean()))
        second = (avi.frame_us or FRAME_US) / 1e6
        clips = [
            (i, a, b, round(a * second, 6), round((b + 1) * second, 6), round(sum(means[a : b + 1]) / (b + 1 - a), 4))
            for i, (a, b) in enumerate(find_clips(histograms))
        ]
        out.append(Found(b"".join([x.dc.tobytes() for x in good]), avi.info, clips, len(own), len(own) - len(good)))
    return out


def _pieces(values: pa.Array) -> Iterator[list]:
    some, size = [], 0
    for v in values:
        some.append(v.as_py())
        size += len(some[-1] or "")
        if size > PIECE:
            yield some
            some, size = [], 0
    if some:
        yield some


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, media): each text's UTF-8 bytes, zero-padded to a positive multiple of 64, as an AVI.

    Null text: empty. The AVI's note keeps the bytes' number before padding. No shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType, StructField, StructType

    d = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text"))
    schema = StructType([d.schema[0], StructField("media", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _pieces(batch.column(1)):
                raw = [(t or "").encode() for t in texts]
                padded = [r + bytes(-len(r) % ROW or (ROW if not r else 0)) for r in raw]
                media = write_avi(padded, [f"bytes={len(r)} padded={len(p)}" for r, p in zip(raw, padded)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(media, pa.binary())], schema=arrow)
                at += len(texts)

    return d.mapInArrow(run, schema)


DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_clips int"


def read_back(stored: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Digests of what the stored media hold, read from their frames, and their clips as a text.

    Media that are null or no AVI give nulls, and so do those with a damaged or missing frame,
    as their payload is not whole.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    d = stored.select(F.col(id_col).alias(id_col), F.col(media_col).alias("media"))
    schema = StructType([d.schema[0], *StructType.fromDDL(DIGEST).fields])
    arrow = to_arrow_schema(schema)

    def digest(media: bytes | None, found: Found | None) -> tuple:
        if found is None or found.damaged:
            return (None,) * 8
        notes = dict(x.split("=") for x in found.info.split() if x.count("=") == 1)
        padded = notes.get("padded", str(len(found.payload)))
        if not padded.isdecimal() or int(padded) > len(found.payload):
            return (None,) * 8
        payload = found.payload[: int(padded)]
        feature = f"frames={found.frames};" + "|".join(f"{a}-{b}:{m:.4f}" for _, a, b, _, _, m in found.clips)
        return (
            int(notes.get("bytes", len(payload))), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]),
            len(media), hashlib.sha256(media).hexdigest(), feature, len(found.clips),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for media in _pieces(batch.column(1)):
                rows = [digest(m, f) for m, f in zip(media, analyse_many(media))]
                columns = [batch.column(0).slice(at, len(media))]
                columns += [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                at += len(media)

    return d.mapInArrow(run, schema)


def op1_media_avi(spark, sf_dir: str) -> DataFrame:
    """Every document's text stored as AVI motion-JPEG and read back."""
    return read_back(store_texts(table(spark, sf_dir, "documents")))
