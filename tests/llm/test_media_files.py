"""The Huffman decoder on JPEG files that are not our own: several components, sampling factors, restart markers, AC coefficients."""

from __future__ import annotations

import random

import numpy as np
import pytest

from loomgraph.llm import media

#: A DC table with codes of 2 to 9 bits, and an AC table with end-of-block, runs and a long zero run.
DC = [(2, 0), (3, 1), (3, 2), (3, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 8), (8, 9)]
AC = [(2, 0x00), (2, 0x01), (3, 0x12), (4, 0x23), (5, 0xF0)]


def table(kind: int, symbols: list[tuple[int, int]]) -> tuple[bytes, dict[int, str]]:
    code, last, codes = 0, symbols[0][0], {}
    for n, s in symbols:
        code <<= n - last
        codes[s], last = f"{code:0{n}b}", n
        code += 1
    counts = [sum(n == k for n, _ in symbols) for k in range(1, 17)]
    return bytes([kind, *counts, *(s for _, s in symbols)]), codes


def bits_of(value: int, size: int) -> str:
    return f"{value if value >= 0 else value + (1 << size) - 1:0{size}b}" if size else ""


def jpeg(width, height, sampling, restart, rng, q=5):
    """(file, luminance DC of each 8x8 block of the first component) of a file with random coefficients."""
    dht0, dc = table(0x00, DC)
    dht1, ac = table(0x10, AC)
    parts = [(i + 1, h, v) for i, (h, v) in enumerate(sampling)]
    hmax, vmax = (max(p[k] for p in parts) for k in (1, 2))
    if len(parts) == 1:
        grid, hmax, vmax, parts = [(1, 1, 1)], 1, 1, [(1, 1, 1)]
    else:
        grid = parts
    wide, high = -(-width // (8 * hmax)), -(-height // (8 * vmax))
    first = np.zeros((high * grid[0][2], wide * grid[0][1]), int)
    pieces, bits, last = [], "", {}
    for mcu in range(wide * high):
        if restart and mcu % restart == 0 and mcu:
            pieces.append(bits)
            bits, last = "", {}
        for p, (name, h, v) in enumerate(grid):
            for k in range(h * v):
                value = rng.randint(-120, 120)
                if p == 0:
                    first[mcu // wide * v + k // h, mcu % wide * h + k % h] = value
                d = value - last.get(name, 0)
                last[name] = value
                bits += dc[abs(d).bit_length()] + bits_of(d, abs(d).bit_length())
                for s in rng.choices([0x01, 0x12, 0x23, 0xF0], k=rng.randint(0, 3)):
                    bits += ac[s] + bits_of(rng.choice([-1, 1]) * (1 << (s & 15)) // 2 if s & 15 else 0, s & 15)
                bits += ac[0]
    pieces.append(bits)
    scan = b""
    for i, piece in enumerate(pieces):
        piece += "1" * (-len(piece) % 8)
        scan += int(piece, 2).to_bytes(len(piece) // 8, "big").replace(b"\xff", b"\xff\x00")
        if i < len(pieces) - 1:
            scan += bytes([0xFF, 0xD0 + i % 8])
    seg = media._segment
    frame = bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(sampling)]) + b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(sampling))
    sos = bytes([len(sampling)]) + b"".join(bytes([i + 1, 0]) for i in range(len(sampling))) + bytes([0, 63, 0])
    out = b"\xff\xd8" + seg(0xE0, b"JFIF\0") + seg(0xFE, b"a comment \xff") + seg(0xDB, bytes([0, q] + [1] * 63)) + seg(0xC0, frame) + seg(0xC4, dht0 + dht1)
    if restart:
        out += seg(0xDD, restart.to_bytes(2, "big"))
    rows, cols = (-(-n * grid[0][k] // (8 * m)) for n, k, m in ((height, 2, vmax), (width, 1, hmax)))
    return out + seg(0xDA, sos) + scan + b"\xff\xd9", np.clip(np.rint(first * q / 8) + 128, 0, 255).astype(np.uint8)[:rows, :cols]


@pytest.mark.parametrize("sampling", [[(1, 1)], [(2, 2)], [(1, 1)] * 3, [(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)], [(1, 2), (1, 1), (1, 1)]])
@pytest.mark.parametrize("restart", [0, 1, 3])
def test_thumbnails_of_any_baseline_file(sampling, restart):
    rng = random.Random(f"{sampling}{restart}")
    for width, height in ((8, 8), (17, 9), (64, 40), (100, 75)):
        data, want = jpeg(width, height, sampling, restart, rng)
        info, end = media.parse(data)
        assert end == len(data) and (info["width"], info["height"]) == (width, height)
        assert np.array_equal(media.decode_dc(info), want)


def test_files_that_are_not_baseline_are_refused():
    data, _ = jpeg(16, 16, [(1, 1)], 0, random.Random(1))
    for bad in (data.replace(b"\xff\xc0", b"\xff\xc2"), data[1:]):
        with pytest.raises(ValueError):
            media.parse(bad)


def test_media_of_clashing_and_empty_tables(spark):
    rows = [(1, "text", "x"), (None, None, "y"), (1, "text", "x")]
    out = media.media_digest(spark.createDataFrame(rows, "doc_id long, text string, feature string")).collect()
    assert len(out) == 3 and out[0] == out[2]
    assert media.media_digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    stored = media.store(spark.createDataFrame(rows, "doc_id long, text string, media string")).collect()
    assert all(media.read_back(bytes(r["media"]))[1] == r["feature"] for r in stored)
