"""Operator 6, media columns: AVI motion-JPEG.

Writing: bytes become grey frames of 16 x 12 samples; a sample is one flat 8 x 8 block, so every JPEG decoder gives it
back exactly.  The Huffman tables are chosen so that the code of a DC difference and its extra bits always take 9 bits
together; with the one-bit end of block a sample takes 10.  Frames are ordinary baseline JPEG files in an AVI file with
an ``idx1`` index.

Reading: the RIFF chunks and the index are parsed, every frame is decoded on its own (frames whose tables are of that
fixed width in bulk, any other baseline grey frame symbol by symbol), and a shot begins where the difference between
the histograms of neighbouring frames exceeds the mean and a multiple of the deviation of the differences around it.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from silverbrook.llm import wordarrays as wa

WIDE, HIGH = 16, 12
FRAME = WIDE * HIGH
MICROSECONDS = 40_000
#: Histogram bins; differences on either side that a cut is judged by; deviations above their mean; least difference.
BINS, AROUND, DEVIATIONS, LEAST = 16, 8, 2.0, 0.1

# Fixed values of the JPEG format: the order of a block's coefficients is by diagonals, in turns.
ZIGZAG = sorted(range(64), key=lambda i: (s := i // 8 + i % 8, i // 8 if s % 2 else i % 8))


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _header() -> bytes:
    dc = bytes([1] * 9 + [0] * 7) + bytes(range(8, -1, -1))  # size s has a code of 9 - s bits
    ac = bytes([1] + [0] * 15) + bytes([0])  # the end of a block alone
    return b"".join(
        [
            b"\xff\xd8",
            _segment(0xE0, b"AVI1" + bytes(10)),
            _segment(0xDB, bytes([0]) + bytes([8] + [1] * 63)),
            _segment(0xC0, struct.pack(">BHHB", 8, HIGH * 8, WIDE * 8, 1) + bytes([1, 0x11, 0])),
            _segment(0xC4, bytes([0x00]) + dc + bytes([0x10]) + ac),
            _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
        ]
    )


HEADER = np.frombuffer(_header(), np.uint8)


def _dc_codes() -> tuple[np.ndarray, np.ndarray]:
    """(the 10-bit field of each difference from -255 to 255, the difference of each 10-bit field)."""
    field, back = np.zeros(511, np.uint16), np.full(1024, 9999, np.int16)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        prefix = (1 << (9 - size)) - 2  # canonical: 8 - size ones and a zero
        value = ((prefix << size) | (d if d > 0 else d + (1 << size) - 1 if d else 0)) << 1
        field[d + 255] = value
        back[value] = d
    return field, back


FIELD, BACK = _dc_codes()


def encode_frames(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """JPEG files end to end and their sizes, for samples of shape (frames, FRAME)."""
    frames = len(samples)
    level = samples.astype(np.int16) - 128
    diff = level.copy()
    diff[:, 1:] -= level[:, :-1]
    field = FIELD[diff + 255].reshape(frames, FRAME // 4, 4).astype(np.uint64)
    packed = (field[..., 0] << np.uint64(30)) | (field[..., 1] << np.uint64(20)) | (field[..., 2] << np.uint64(10)) | field[..., 3]
    body = packed.astype(">u8").view(np.uint8).reshape(frames, FRAME // 4, 8)[:, :, 3:].reshape(frames, -1)
    # a 0 follows each 255; the fields of a frame fill whole bytes
    mark = body == 0xFF
    size = body.shape[1] + mark.sum(1)
    total = size + len(HEADER) + 2
    at = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), np.uint8)
    out[at[:, None] + np.arange(len(HEADER))] = HEADER
    place = np.cumsum(mark, 1) - mark + np.arange(body.shape[1]) + (at + len(HEADER))[:, None]
    out[place] = body
    end = at + len(HEADER) + size
    out[end], out[end + 1] = 0xFF, 0xD9
    return out, total


def write_avi(payload: bytes) -> bytes:
    """An AVI file of the payload, whose length is a positive multiple of ``FRAME``."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, FRAME)
    data, size = encode_frames(samples)
    frames, padded = len(size), size + (size & 1)
    whole = padded + 8
    at = np.cumsum(whole) - whole
    movi = np.zeros(int(whole.sum()), np.uint8)
    head = np.zeros((frames, 8), np.uint8)
    head[:, :4] = np.frombuffer(b"00dc", np.uint8)
    head[:, 4:] = size.astype("<u4").view(np.uint8).reshape(frames, 4)
    movi[at[:, None] + np.arange(8)] = head
    start = np.cumsum(size) - size
    movi[np.arange(len(data)) + np.repeat(at + 8 - start, size)] = data
    index = np.zeros(frames, [("name", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")])
    index["name"], index["flags"], index["at"], index["size"] = b"00dc", 0x10, at + 4, size
    chunk = lambda name, body: name + struct.pack("<I", len(body)) + body + bytes(len(body) & 1)
    avih = struct.pack("<14I", MICROSECONDS, 0, 0, 0x10, frames, 0, 1, int(size.max()), WIDE * 8, HIGH * 8, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, MICROSECONDS, 1_000_000, 0, frames, int(size.max()), 0xFFFFFFFF, 0, 0, 0, WIDE * 8, HIGH * 8)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDE * 8, HIGH * 8, 1, 24, b"MJPG", WIDE * HIGH * 192, 0, 0, 0, 0)
    hdrl = b"hdrl" + chunk(b"avih", avih) + chunk(b"LIST", b"strl" + chunk(b"strh", strh) + chunk(b"strf", strf))
    body = b"AVI " + chunk(b"LIST", hdrl) + chunk(b"LIST", b"movi" + movi.tobytes()) + chunk(b"idx1", index.tobytes())
    return chunk(b"RIFF", body)


def read_index(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(positions, sizes) of the video frames of an AVI file, and microseconds a frame; ValueError for other bytes."""
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    at, end, movi, index, micro = 12, min(len(data), 8 + int.from_bytes(data[4:8], "little")), None, None, MICROSECONDS
    while at + 8 <= end:
        name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        if name == b"LIST" and data[at + 8 : at + 12] == b"movi":
            movi = (at + 8, size)
        elif name == b"LIST" and data[at + 8 : at + 12] == b"hdrl" and data[at + 12 : at + 16] == b"avih":
            micro = int.from_bytes(data[at + 20 : at + 24], "little") or MICROSECONDS
        elif name == b"idx1":
            index = np.frombuffer(data, [("name", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")], size // 16, at + 8)
        at += 8 + size + (size & 1)
    if movi is None:
        raise ValueError("no movi list")
    if index is None:  # walk the chunks
        found, at = [], movi[0] + 4
        while at + 8 <= movi[0] + movi[1]:
            size = int.from_bytes(data[at + 4 : at + 8], "little")
            if data[at + 2 : at + 4] in (b"dc", b"db"):
                found.append((at + 8, size))
            at += 8 + size + (size & 1)
        where = np.array(found, np.int64).reshape(-1, 2)
        return where[:, 0], where[:, 1], micro
    video = index[np.isin(index["name"], [b"00dc", b"00db"])]
    begin = video["at"].astype(np.int64)
    # offsets count from the list's name, or in some files from the start of the file
    base = movi[0] if not len(begin) or data[movi[0] + begin[0] : movi[0] + begin[0] + 4] == video["name"][0] else 0
    return begin + base + 8, video["size"].astype(np.int64), micro


def _bulk(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray | None:
    """The samples of frames that all have HEADER, else None."""
    n = len(HEADER)
    if not len(at) or (size < n + 2).any() or (data[at[:, None] + np.arange(n)] != HEADER).any():
        return None
    length = size - n - 2
    flat = np.arange(int(length.sum())) + np.repeat(at + n - (np.cumsum(length) - length), length)
    body = data[flat]
    stuffed = np.zeros(len(body), bool)
    stuffed[1:] = (body[1:] == 0) & (body[:-1] == 0xFF)
    body = body[~stuffed]
    if len(body) != len(at) * FRAME * 10 // 8:
        return None
    b = body.reshape(-1, 5).astype(np.uint16)
    field = np.stack([(b[:, 0] << 2) | (b[:, 1] >> 6), ((b[:, 1] & 63) << 4) | (b[:, 2] >> 4), ((b[:, 2] & 15) << 6) | (b[:, 3] >> 2), ((b[:, 3] & 3) << 8) | b[:, 4]], 1)
    diff = BACK[field].reshape(len(at), FRAME)
    if (diff == 9999).any():
        return None
    return (np.cumsum(diff, 1, dtype=np.int32) + 128).astype(np.uint8)


def decode_frame(jpeg: bytes) -> np.ndarray:
    """The pixels of a baseline grey JPEG file, one symbol after the other."""
    at, tables, codes, shape, interval = 2, {}, {}, (0, 0), 0
    while True:
        marker, size = jpeg[at + 1], int.from_bytes(jpeg[at + 2 : at + 4], "big")
        body = jpeg[at + 4 : at + 2 + size]
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                tables[body[0] & 15] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1).astype(np.int64)
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                counts, code, k = body[1:17], 0, 17
                for bits, n in enumerate(counts, 1):
                    for _ in range(n):
                        codes[body[0], bits, code] = body[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                body = body[k:]
        elif marker == 0xC0:
            shape, quant = struct.unpack(">HH", body[1:5]), body[8]
            if body[5] != 1:
                raise ValueError("only grey frames are read")
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif 0xC1 <= marker <= 0xCF and marker != 0xC8:
            raise ValueError("only baseline frames are read")
        at += 2 + size
        if marker == 0xDA:
            dc_id, ac_id = body[2] >> 4, 16 | (body[2] & 15)
            break
    parts, begin = [], at
    while jpeg[at : at + 2] != b"\xff\xd9":  # restart markers part the data
        if jpeg[at] == 0xFF and 0xD0 <= jpeg[at + 1] <= 0xD7:
            parts.append(jpeg[begin:at])
            begin = at + 2
            at += 1
        at += 1
    parts.append(jpeg[begin:at])
    high, wide = -(-shape[0] // 8), -(-shape[1] // 8)
    cosine = np.cos((2 * np.arange(8)[:, None] + 1) * np.arange(8) * np.pi / 16) / 2
    cosine[:, 0] /= np.sqrt(2)
    out = np.zeros((high * 8, wide * 8), np.uint8)
    part = iter(parts)
    for block in range(high * wide):
        if block == 0 or interval and block % interval == 0:
            bits, place, dc = np.unpackbits(np.frombuffer(next(part).replace(b"\xff\x00", b"\xff"), np.uint8)).tolist(), 0, 0
        coefficient, k = np.zeros(64, np.int64), 0
        while k < 64:
            code = length = 0
            while (symbol := codes.get((ac_id if k else dc_id, length, code))) is None:
                code, place, length = code * 2 + bits[place], place + 1, length + 1
            if k and symbol == 0:
                break
            k += symbol >> 4
            extra = symbol & 15
            value = int("".join(map(str, bits[place : place + extra])) or "0", 2)
            place += extra
            if extra and value < 1 << (extra - 1):
                value -= (1 << extra) - 1
            if k == 0:
                dc = value = dc + value
            if k < 64:
                coefficient[ZIGZAG[k]] = value * tables[quant][k]
            k += 1
        pixels = cosine @ coefficient.reshape(8, 8) @ cosine.T + 128
        y, x = divmod(block, wide)
        out[y * 8 : y * 8 + 8, x * 8 : x * 8 + 8] = np.clip(np.rint(pixels), 0, 255)
    return out[: shape[0], : shape[1]]


def read_samples(data: bytes) -> tuple[np.ndarray, int]:
    """(samples of each frame, microseconds a frame); other files than ours give the mean of each 8 x 8 block."""
    at, size, micro = read_index(data)
    samples = _bulk(np.frombuffer(data, np.uint8), at, size)
    if samples is None:
        frames = []
        for i, n in zip(at.tolist(), size.tolist(), strict=True):
            p = decode_frame(data[i : i + n])
            p = np.pad(p, ((0, -p.shape[0] % 8), (0, -p.shape[1] % 8)), "edge")
            frames.append(np.rint(p.reshape(p.shape[0] // 8, 8, p.shape[1] // 8, 8).mean((1, 3))).astype(np.uint8).ravel())
        samples = np.stack(frames) if frames else np.zeros((0, FRAME), np.uint8)
    return samples, micro


def find_shots(samples: np.ndarray) -> np.ndarray:
    """The first frame of each shot."""
    frames = len(samples)
    if frames < 2:
        return np.arange(frames)
    bins = (samples >> 4).astype(np.int64) + np.arange(frames)[:, None] * BINS
    histogram = np.bincount(bins.ravel(), minlength=frames * BINS).reshape(frames, BINS)
    change = np.abs(np.diff(histogram, axis=0)).sum(1) / (2.0 * samples.shape[1])
    n = len(change)
    sums = np.concatenate([[0.0], np.cumsum(change)])
    squares = np.concatenate([[0.0], np.cumsum(change * change)])
    low, high = np.maximum(np.arange(n) - AROUND, 0), np.minimum(np.arange(n) + AROUND + 1, n)
    count = high - low - 1
    mean = np.where(count > 0, (sums[high] - sums[low] - change) / np.maximum(count, 1), 0)
    spread = np.sqrt(np.maximum((squares[high] - squares[low] - change**2) / np.maximum(count, 1) - mean**2, 0))
    return np.concatenate([[0], 1 + np.flatnonzero(change > np.maximum(LEAST, mean + DEVIATIONS * spread))])


def payload_of(text: bytes) -> bytes:
    """UTF-8 with spaces up to a positive multiple of ``FRAME``."""
    return text + b" " * (max(FRAME, -(-len(text) // FRAME) * FRAME) - len(text))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in wa.slices(batches, "text", 1 << 20):
        data, offsets = wa.raw(part.column("text"))
        memory, rows = data.tobytes(), []
        for i, j in zip(offsets[:-1], offsets[1:], strict=True):
            media = write_avi(payload_of(memory[i:j]))
            samples, _ = read_samples(media)
            back, shots = samples.tobytes(), find_shots(samples)
            feature = f"frames={len(samples)};mean={int(samples.sum(dtype=np.int64)) / samples.size:.4f};shots={','.join(map(str, shots.tolist()))}"
            rows.append((int(j - i), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature))
        columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *_DIGEST])


_DIGEST = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def media_digests(docs: DataFrame) -> DataFrame:
    """Store each text as an AVI file, read it back and describe both; a null text is an empty one, whose file has one
    frame of spaces.  One row per row of ``docs``; doc_id may be null or repeated, other columns are ignored, and an empty
    table gives no rows.  A task needs some 55 times the bytes of the largest single text: its frames are made at once."""
    return _docs(docs).mapInArrow(_digest, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in wa.slices(batches, "text", 1 << 20):
        data, offsets = wa.raw(part.column("text"))
        memory = data.tobytes()
        media = [write_avi(payload_of(memory[i:j])) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(media, pa.binary())], ["doc_id", "media"])


def text_videos(docs: DataFrame) -> DataFrame:
    """``doc_id, media``: each text as an AVI file, a null one as an empty one; for odd rows see :func:`media_digests`."""
    return _docs(docs).mapInArrow(_files, "doc_id long, media binary")


def _clips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in wa.slices(batches, "media", 4 << 20):
        rows = []
        for name, media in zip(batch.column("id").to_pylist(), batch.column("media").to_pylist(), strict=True):
            try:
                samples, micro = read_samples(media or b"")
            except (ValueError, IndexError, KeyError, struct.error, StopIteration) as e:
                rows.append((name, None, None, None, None, None, str(e)[:200] or type(e).__name__))
                continue
            first = find_shots(samples).tolist()
            for k, (a, b) in enumerate(zip(first, [*first[1:], len(samples)], strict=True)):
                rows.append((name, k, a, b, a * micro / 1e6, b * micro / 1e6, None))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string())
        columns = list(zip(*rows, strict=True)) or [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["id", "clip", "first_frame", "end_frame", "start_s", "end_s", "error"])


def clips(videos: DataFrame, id_column: str = "doc_id", media_column: str = "media") -> DataFrame:
    """``id, clip, first_frame, end_frame, start_s, end_s, error``: a row per shot of each AVI file.  Null media, and
    bytes that aren't an AVI file of grey baseline frames, give one row that has only ``error``.  Ids may be null or
    repeated; each row is a file of its own."""
    chosen = videos.select(F.col(id_column).cast("long").alias("id"), F.col(media_column).cast("binary").alias("media"))
    return chosen.mapInArrow(_clips, "id long, clip long, first_frame long, end_frame long, start_s double, end_s double, error string")
