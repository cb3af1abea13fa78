"""Media columns: payloads stored losslessly in baseline JPEG and read back as DC-only luminance thumbnails.

A payload byte is one 8x8 block of a greyscale image: with a DC quantiser of 8 the block's DC
coefficient is the byte less 128, all AC coefficients are zero. The thumbnail that the DC coefficients
give (one pixel a block) is the payload. The Huffman table gives DC category c a code of 9-c bits, so
a difference takes 9 bits whatever its size, and end-of-block takes 1 bit. Any JPEG reader can decode it,
and ours unpacks it with numpy at once. `decode_dc` reads other baseline files too (several components,
sampling factors, restart markers), block by block.

Frames are 64 blocks wide and at most 8,191 high; a longer payload is a sequence of frames. Work and
memory are bounded by a frame.

Defined results: null or empty text is 64 zero bytes; equal texts give equal values; empty tables give an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDE, HIGH = 64, 8191
_EOI = b"\xff\xd9"


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _dc_table() -> tuple[bytes, np.ndarray]:
    """DHT body, and by difference + 255 the 9 bits that code it."""
    codes, code = {}, 0
    for length in range(1, 10):  # canonical codes: one of each length
        codes[9 - length] = (code, length)
        code = (code + 1) << 1
    out = np.zeros(511, np.uint64)
    for d in range(-255, 256):
        cat = abs(d).bit_length()
        bits = d if d > 0 else d + (1 << cat) - 1
        out[d + 255] = codes[cat][0] << cat | bits
    return bytes([0]) + bytes([1] * 9 + [0] * 7) + bytes(range(8, -1, -1)), out


_DC_BODY, _CODE = _dc_table()
_DIFF = np.full(512, 9999, np.int64)
_DIFF[_CODE.astype(np.int64)] = np.arange(-255, 256)
_AC_BODY = bytes([0x10]) + bytes([1] + [0] * 15) + bytes([0])
_DQT = bytes([0]) + bytes([8] + [1] * 63)


def encode_frame(pixels: np.ndarray) -> bytes:
    """A JPEG file with one 8x8 block for each of pixels (uint8, a multiple of 64 of them)."""
    rows = len(pixels) // WIDE
    v = pixels.astype(np.int64) - 128
    words = _CODE[np.diff(v, prepend=0) + 255] << np.uint64(1)  # and end-of-block, one bit 0
    q = words.reshape(-1, 4)
    packed = q[:, 0] << np.uint64(30) | q[:, 1] << np.uint64(20) | q[:, 2] << np.uint64(10) | q[:, 3]
    scan = packed.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().replace(b"\xff", b"\xff\x00")
    frame = bytes([8]) + (rows * 8).to_bytes(2, "big") + (WIDE * 8).to_bytes(2, "big") + bytes([1, 1, 0x11, 0])
    return b"\xff\xd8" + _segment(0xDB, _DQT) + _segment(0xC0, frame) + _segment(0xC4, _DC_BODY) + _segment(0xC4, _AC_BODY) + _segment(0xDA, bytes([1, 1, 0, 0, 63, 0])) + scan + _EOI


def encode(payload: bytes) -> bytes:
    raw = np.frombuffer(payload, np.uint8)
    return b"".join(encode_frame(raw[at : at + WIDE * HIGH]) for at in range(0, len(raw), WIDE * HIGH))


def _huffman(body: bytes) -> dict[int, dict[tuple[int, int], int]]:
    """By class and id: (length, code) -> symbol."""
    out, at = {}, 0
    while at < len(body):
        counts, symbols, code, table = body[at + 1 : at + 17], at + 17, 0, {}
        for length, n in enumerate(counts, 1):
            for _ in range(n):
                table[length, code] = body[symbols]
                symbols, code = symbols + 1, code + 1
            code <<= 1
        out[body[at]] = table
        at = symbols
    return out


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """Markers of the JPEG file that starts at `at`: width, height, components, tables, scan; and its end."""
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no JPEG file")
    info: dict = {"q": {}, "huff": {}, "restart": 0}
    at += 2
    while True:
        while data[at + 1] == 0xFF:
            at += 1
        marker, n = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + n]
        at += 2 + n
        if marker == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                values = np.frombuffer(body[k + 1 : k + 1 + 64 * (1 + wide)], ">u2" if wide else np.uint8)
                info["q"][body[k] & 15] = values
                k += 1 + 64 * (1 + wide)
        elif marker == 0xC0:
            info |= {"height": int.from_bytes(body[1:3], "big"), "width": int.from_bytes(body[3:5], "big")}
            info["parts"] = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])]
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not baseline")
        elif marker == 0xC4:
            info["huff"] |= _huffman(body)
        elif marker == 0xDD:
            info["restart"] = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            info["scan"] = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])}
            break
    end = at
    while True:  # a 0xFF in the scan is followed by 0 or a restart marker
        end = data.index(b"\xff", end)
        if data[end + 1] and not 0xD0 <= data[end + 1] <= 0xD7:
            break
        end += 2
    info["bits"] = data[at:end]
    if data[end : end + 2] != _EOI:
        raise ValueError("more than one scan")
    return info, end + 2


def _even(info: dict) -> bool:
    """Whether every block takes 10 bits, as ours do: 9 of DC, 1 of end-of-block."""
    dc = info["huff"].get(0, {})
    ours = len(info["parts"]) == 1 and not info["restart"] and info["parts"][0][1:3] == (1, 1)
    return ours and dc == _huffman(_DC_BODY)[0] and info["huff"].get(16) == {(1, 0): 0}


def _pixels(dc: np.ndarray, q: int) -> np.ndarray:
    return np.clip(np.rint(dc * q / 8) + 128, 0, 255).astype(np.uint8)


def decode_dc(info: dict) -> np.ndarray:
    """The luminance thumbnail: a pixel for each 8x8 block of the first component."""
    parts = info["parts"]
    hmax, vmax = max(p[1] for p in parts), max(p[2] for p in parts)
    if len(parts) == 1:
        hmax = vmax = 1
        parts = [(parts[0][0], 1, 1, parts[0][3])]
    wide, high = -(-info["width"] // (8 * hmax)), -(-info["height"] // (8 * vmax))
    q = int(info["q"][parts[0][3]][0])
    if _even(info):
        raw = np.frombuffer(info["bits"].replace(b"\xff\x00", b"\xff"), np.uint8)
        n = wide * high
        raw = np.concatenate([raw, np.zeros(-len(raw) % 5 + 5, np.uint8)])[: -(-n // 4) * 5].reshape(-1, 5).astype(np.uint64)
        packed = raw[:, 0] << np.uint64(32) | raw[:, 1] << np.uint64(24) | raw[:, 2] << np.uint64(16) | raw[:, 3] << np.uint64(8) | raw[:, 4]
        words = np.stack([packed >> np.uint64(s) & np.uint64(1023) for s in (30, 20, 10, 0)], axis=1).ravel()[:n].astype(np.int64)
        diffs = _DIFF[words >> 1]
        if (words & 1).any() or (diffs == 9999).any():
            raise ValueError("broken scan")
        return _pixels(np.cumsum(diffs), q).reshape(high, wide)
    return _by_block(info, parts, wide, high, q)


def _by_block(info, parts, wide, high, q) -> np.ndarray:
    pieces, at = [], 0  # between restart markers
    data = info["bits"]
    start = 0
    while (k := data.find(b"\xff", at)) >= 0:
        at = k + 2
        if 0xD0 <= data[k + 1] <= 0xD7:
            pieces.append(data[start:k])
            start = at
    pieces.append(data[start:])
    _, h, v, _ = parts[0]
    out = np.zeros((high * v, wide * h), np.int64)
    every = info["restart"] or wide * high
    for i, piece in enumerate(pieces):
        bits = "".join(f"{b:08b}" for b in piece.replace(b"\xff\x00", b"\xff")) + "1" * 64
        pos, last = 0, dict.fromkeys((p[0] for p in parts), 0)

        def symbol(table):
            nonlocal pos
            code = 0
            for length in range(1, 17):
                code = code << 1 | (bits[pos] == "1")
                pos += 1
                if (length, code) in table:
                    return table[length, code]
            raise ValueError("broken scan")

        for mcu in range(i * every, min((i + 1) * every, wide * high)):
            for p, (name, ph, pv, _) in enumerate(parts):
                dc, ac = info["huff"][info["scan"][name][0]], info["huff"][16 + info["scan"][name][1]]
                for k in range(ph * pv):
                    cat = symbol(dc)
                    if cat:
                        d = int(bits[pos : pos + cat], 2)
                        pos += cat
                        last[name] += d if d >> (cat - 1) else d - (1 << cat) + 1
                    z = 1
                    while z < 64:
                        s = symbol(ac)
                        if s == 0:
                            break
                        z += (s >> 4) + 1
                        pos += s & 15
                    if p == 0:
                        out[mcu // wide * v + k // ph, mcu % wide * h + k % ph] = last[name]
    rows, cols = -(-info["height"] * v // (8 * max(p[2] for p in parts))), -(-info["width"] * h // (8 * max(p[1] for p in parts)))
    return _pixels(out, q)[:rows, :cols]


def read_back(data: bytes) -> tuple[bytes, str]:
    """(payload, feature): the thumbnails' bytes; dimensions, an average hash and the thumbnail's CRC, by frame."""
    at, out, features = 0, [], []
    while at < len(data):
        info, at = parse(data, at)
        thumb = decode_dc(info)
        out.append(thumb.tobytes())
        cells = np.array([[c.mean() if c.size else 0.0 for c in np.array_split(r, 8, axis=1)] for r in np.array_split(thumb, 8, axis=0)])
        mark = "".join(f"{int(''.join('01'[x] for x in row), 2):02x}" for row in (cells > cells.mean()).astype(int))
        features.append(f"{info['width']}x{info['height']}:{mark}:{zlib.crc32(out[-1]):08x}")
    return b"".join(out), features[0] if len(features) == 1 else f"{len(features)}:" + hashlib.sha256(",".join(features).encode()).hexdigest()


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % 64 if raw else 64), len(raw)


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _run(batches):
    import pyarrow as pa

    for batch in batches:
        rows = []
        for text in batch.column(1):
            payload, n = payload_of(text.as_py())
            media = encode(payload)
            back, feature = read_back(media)
            rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[c.split()[0] for c in SCHEMA.split(", ")])


def media_digest(docs: DataFrame) -> DataFrame:
    """A row for each row of docs (doc_id, text); see SCHEMA."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_run, SCHEMA)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, media (binary), width, height, feature: the media column itself."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            media = [encode(payload_of(t.as_py())[0]) for t in batch.column(1)]
            infos = [parse(m)[0] for m in media]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(media, pa.binary()), *(pa.array([i[k] for i in infos], pa.int32()) for k in ("width", "height")), pa.array([read_back(m)[1] for m in media])], names=["doc_id", "media", "width", "height", "feature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, media binary, width int, height int, feature string")
