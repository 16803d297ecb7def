"""Lossless WebP: a decoder for whole batches of images, and an encoder.

The decoder reads headers, transforms and prefix codes of each image, then all
images' pixels in lock step: at each step numpy decodes one pixel of every image
that has pixels left, be it a literal, a back-reference or a colour-cache entry.
Inverse transforms (predictor, cross-colour, green, palette) follow.

Pixels are 32-bit ARGB numbers in rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

# Fixed values of the format: the order of code-length codes, and the short
# distances as (columns back, rows back).
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0),
    (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1),
    (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5),
    (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0),
    (1, 6), (-1, 6), (6, 1), (-6, 1), (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6),
    (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4),
    (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7),
    (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7),
    (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
CACHE_FACTOR = 0x1E35A7BD
LENGTH_CODES, DISTANCE_CODES = 24, 40
#: So few images left are finished one by one, not in lock step.
FEW = 40
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
_REVERSED: dict[int, np.ndarray] = {}


def _reversed_bits(bits: int) -> np.ndarray:
    """0 .. 2^bits - 1 with their bits in reverse."""
    if bits not in _REVERSED:
        out = np.zeros(1, dtype=np.int64)
        for _ in range(bits):
            out = np.concatenate([out * 2, out * 2 + 1])
        _REVERSED[bits] = out
    return _REVERSED[bits]


class Bits:
    """Reads numbers from a stream, least significant bit first."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at, self.end = data, at, 8 * len(data)

    def read(self, n: int) -> int:
        at = self.at
        self.at = at + n
        if self.at > self.end + 64:
            raise ValueError("the stream ends early")
        return int.from_bytes(self.data[at >> 3 : (at + n + 7) >> 3], "little") >> (at & 7) & ((1 << n) - 1)


class Code:
    """A prefix code as a table: symbol << 4 | length for the next ``bits`` bits."""

    __slots__ = ("bits", "table")

    def __init__(self, lengths: list[int] | np.ndarray):
        lengths = np.asarray(lengths)
        used = lengths.nonzero()[0]
        if len(used) <= 1:
            self.bits, self.table = 0, np.array([int(used[0]) << 4 if len(used) else 0], dtype=np.uint16)
            return
        size = lengths[used]
        order = size.argsort(kind="stable")
        order, size = used[order], size[order]
        self.bits = int(size[-1])
        spread = np.repeat((order << 4 | size).astype(np.uint16), 1 << (self.bits - size))
        if len(spread) != 1 << self.bits:
            raise ValueError("the prefix code isn't complete")
        self.table = spread[_reversed_bits(self.bits)]

    def read(self, source: Bits) -> int:
        entry = int(self.table[source.read(self.bits)])
        source.at += (entry & 15) - self.bits
        return entry >> 4


def _single(symbol: int) -> Code:
    code = Code([])
    code.table = np.array([symbol << 4], dtype=np.uint16)
    return code


@lru_cache(maxsize=4096)
def _code_of_lengths(n: int, packed: int) -> tuple[list[int], int]:
    """Table and bits of the code that code lengths are written in."""
    of_lengths = [0] * 19
    for i in range(n):
        of_lengths[CODE_LENGTH_ORDER[i]] = packed >> (3 * i) & 7
    code = Code(of_lengths)
    return code.table.tolist(), code.bits


def _read_code(source: Bits, size: int, known: dict) -> Code:
    """A prefix code; one that is written just like the last of its size is that one."""
    begin = source.at
    if (last := known.get(size)) is not None and begin + last[0] <= source.end:
        if source.read(last[0]) == last[1]:
            return last[2]
        source.at = begin
    code = _read_new_code(source, size, known)
    end, source.at = source.at, begin
    if end <= source.end:
        known[size] = (end - begin, source.read(end - begin), code)
    source.at = end
    return code


def _read_new_code(source: Bits, size: int, known: dict) -> Code:
    if source.read(1):
        two, wide = source.read(1), source.read(1)
        first = source.read(8 if wide else 1)
        if not two:
            return _single(first)
        second = source.read(8)
        lengths = [0] * max(size, first + 1, second + 1)
        lengths[first] = lengths[second] = 1
        return Code(lengths)
    n = 4 + source.read(4)
    table, bits = _code_of_lengths(n, source.read(3 * n))
    left = 2 + source.read(2 + 2 * source.read(3)) if source.read(1) else size
    lengths: list[int] = []
    last, data, at = 8, source.data, source.at
    mask, value, end = (1 << bits) - 1, 0, 0
    while len(lengths) < size and left:
        left -= 1
        if end - at < 14:  # a code and its extra bits
            value, end = int.from_bytes(data[at >> 3 : (at >> 3) + 16], "little") >> (at & 7), (at & ~7) + 128
        entry = table[value & mask]
        at += entry & 15
        value >>= entry & 15
        symbol = entry >> 4
        if symbol < 16:
            lengths.append(symbol)
            last = symbol or last
        elif symbol == 16:
            lengths.extend([last] * (3 + (value & 3)))
            at += 2
            value >>= 2
        elif symbol == 17:
            lengths.extend([0] * (3 + (value & 7)))
            at += 3
            value >>= 3
        else:
            lengths.extend([0] * (11 + (value & 127)))
            at += 7
            value >>= 7
    source.at = at
    key = tuple(lengths)
    if key not in known:
        known[key] = Code(lengths)
    return known[key]


class Image:
    """One entropy-coded image, ready for its pixels."""

    def __init__(self, source: Bits, width: int, height: int, main: bool):
        self.source, self.width, self.height = source, width, height
        self.cache_bits = source.read(4) if source.read(1) else 0
        self.tile_bits, self.tiles, groups = 0, None, 1
        if main and source.read(1):
            self.tile_bits = source.read(3) + 2
            tiles = [-(-x >> self.tile_bits) for x in (width, height)]
            self.tiles = read_image(source, *tiles).reshape(tiles[1], tiles[0]) >> 8 & 0xFFFF
            groups = int(self.tiles.max()) + 1
        cache = 1 << self.cache_bits if self.cache_bits else 0
        known: dict = {}
        sizes = (256 + LENGTH_CODES + cache, 256, 256, 256, DISTANCE_CODES)
        self.groups = [[_read_code(source, size, known) for size in sizes] for _ in range(groups)]


def read_image(source: Bits, width: int, height: int) -> np.ndarray:
    """A transform's image, read in full."""
    image = Image(source, width, height, main=False)
    return read_pixels([image])[0]


def read_pixels(images: list[Image]) -> list[np.ndarray]:
    """The pixels of each image; each ``source`` moves to its end."""
    order = sorted(range(len(images)), key=lambda i: -images[i].width * images[i].height)
    jobs = [images[i] for i in order]
    n = np.array([j.width * j.height for j in jobs])
    # All streams in one buffer, so that a number at any bit is one unaligned read.
    starts, parts, total = [], [], 0
    for j in jobs:
        starts.append(8 * total + j.source.at)
        parts += [j.source.data, bytes(16)]
        total += len(j.source.data) + 16
    buffer = b"".join(parts)
    words = np.ndarray((len(buffer) - 8,), dtype="<u8", buffer=buffer, strides=(1,))
    begin = np.array(starts, dtype=np.int64)
    at = begin.copy()

    tables: list[np.ndarray] = []
    placed: dict[int, int] = {}
    size = 0
    offset = np.zeros((5, sum(len(j.groups) for j in jobs)), dtype=np.int64)
    mask = np.zeros(offset.shape, dtype=np.uint64)
    group0, row = [], 0
    for j in jobs:
        group0.append(row)
        for codes in j.groups:
            for k, code in enumerate(codes):
                if id(code) not in placed:
                    placed[id(code)] = size
                    tables.append(code.table)
                    size += len(code.table)
                offset[k, row], mask[k, row] = placed[id(code)], (1 << code.bits) - 1
            row += 1
    flat = np.concatenate(tables).astype(np.int32)
    group0 = np.array(group0)
    tiled = [i for i, j in enumerate(jobs) if j.tiles is not None]
    cached = np.array([j.cache_bits for j in jobs])
    # Images without a cache have one cell, which nothing reads.
    cache_at = np.concatenate([[0], np.cumsum(1 << cached)])
    cache, shift = np.zeros(int(cache_at[-1]), dtype=np.int64), 32 - cached
    cache_at = cache_at[:-1]
    base = np.concatenate([[0], np.cumsum(n)])[:-1]
    out = np.zeros(int(n.sum()), dtype=np.int64)
    copy_left, copy_back = np.zeros(len(jobs), dtype=np.int64), np.zeros(len(jobs), dtype=np.int64)
    near = np.array(NEAR)
    width = np.array([j.width for j in jobs])
    u = np.uint64
    group = group0.copy()
    off, msk = offset[:, group], mask[:, group]
    any_cache, any_copy = bool(cached.any()), False
    active = len(jobs)

    def entries(k, todo, value):
        return flat[off[k, todo] + (value & msk[k, todo]).view(np.int64)]

    def window(where):
        return words[where >> 3] >> (where & 7).view(u)

    def extended(prefix, where):
        """The number of a length or distance prefix."""
        extra = np.maximum(prefix - 2, 0) >> 1
        value = window(where).astype(np.int64) & ((1 << extra.astype(np.int64)) - 1)
        return np.where(prefix < 4, prefix + 1, ((2 + (prefix & 1)).astype(np.int64) << extra) + value + 1), where + np.where(prefix < 4, 0, extra)

    for step in range(int(n[0]) if len(n) else 0):
        while n[active - 1] <= step:
            active -= 1
        if active <= FEW and not (tiled and tiled[0] < active):
            for i in range(active):
                whole = slice(int(base[i]), int(base[i] + n[i]))
                own = cache[int(cache_at[i]) : int(cache_at[i]) + (1 << int(cached[i]))].tolist()
                state = step, int(at[i]), int(copy_left[i]), int(copy_back[i])
                out[whole], at[i] = _alone(buffer, jobs[i], out[whole].tolist(), own, *state)
            break
        for i in tiled:
            if i < active:
                j = jobs[i]
                y, x = divmod(step, j.width)
                g = group0[i] + int(j.tiles[y >> j.tile_bits, x >> j.tile_bits])
                off[:, i], msk[:, i] = offset[:, g], mask[:, g]
        todo = slice(0, active)
        if any_copy:
            still = copy_left[:active] > 0
            if any_copy := bool(still.any()):
                todo = np.flatnonzero(~still)
        where = at[todo]
        value = window(where)
        entry = entries(0, todo, value)
        symbol, used = entry >> 4, entry & 15
        # As if all were literals; what isn't takes its pixel from elsewhere, and only its first symbol's bits.
        entry = entries(1, todo, value >> used.astype(u))
        red, size = entry >> 4, used + (entry & 15)
        value = window(where + size)
        entry = entries(2, todo, value)
        blue, more = entry >> 4, entry & 15
        entry = entries(3, todo, value >> more.astype(u))
        pixel = (entry >> 4).astype(np.int64) << 24 | (red << 16 | symbol << 8 | blue)
        size += more + (entry & 15)
        if symbol.size and symbol.max() >= 256:
            literal = symbol < 256
            size = np.where(literal, size, used)
            if any_cache:
                stored = symbol - 256 - LENGTH_CODES
                pixel = np.where(literal, pixel, cache[cache_at[todo] + np.where(stored > 0, stored, 0)])
            at[todo] = where + size
            copies = np.flatnonzero(~literal & (symbol < 256 + LENGTH_CODES))
            if len(copies):
                one = copies if isinstance(todo, slice) else todo[copies]
                count, w = extended(symbol[copies] - 256, at[one])
                entry = entries(4, one, window(w))
                code, w = extended(entry >> 4, w + (entry & 15))
                at[one] = w
                close = near[np.minimum(code, len(NEAR)) - 1]
                back = np.where(code > len(NEAR), code - len(NEAR), np.maximum(1, close[:, 0] + close[:, 1] * width[one]))
                if (back > step).any():
                    raise ValueError("a back-reference goes before the image")
                copy_left[one], copy_back[one], any_copy = count, back, True
        else:
            at[todo] = where + size
        out[base[todo] + step] = pixel
        if any_copy:
            copying = np.flatnonzero(copy_left[:active] > 0)
            out[base[copying] + step] = out[base[copying] + step - copy_back[copying]]
            copy_left[copying] -= 1
        if any_cache:
            pixel = out[base[:active] + step]
            cache[cache_at[:active] + ((pixel * CACHE_FACTOR & 0xFFFFFFFF) >> shift[:active])] = pixel
    result: list = [None] * len(images)
    for k, i in enumerate(order):
        images[i].source.at += int(at[k] - begin[k])
        if images[i].source.at > images[i].source.end:
            raise ValueError("the stream ends early")
        result[i] = out[base[k] : base[k] + n[k]]
    return result


def _alone(buffer: bytes, image: Image, pixels: list[int], cache: list[int], step: int, at: int, left: int, back: int) -> tuple[list[int], int]:
    """An image's pixels from ``step`` on, one by one, and where its stream ends."""
    (t0, m0), (t1, m1), (t2, m2), (t3, m3), (t4, m4) = ((c.table.tolist(), (1 << c.bits) - 1) for c in image.groups[0])
    shift, number, n = 32 - image.cache_bits, int.from_bytes, len(pixels)
    first = 256 + LENGTH_CODES

    def extended(prefix: int, at: int) -> tuple[int, int]:
        if prefix < 4:
            return prefix + 1, at
        extra = (prefix - 2) >> 1
        value = number(buffer[at >> 3 : (at >> 3) + 8], "little") >> (at & 7) & ((1 << extra) - 1)
        return ((2 + (prefix & 1)) << extra) + value + 1, at + extra

    while step < n:
        if left:
            pixel = pixels[step - back]
            left -= 1
        else:
            value = number(buffer[at >> 3 : (at >> 3) + 8], "little") >> (at & 7)
            entry = t0[value & m0]
            symbol, used = entry >> 4, entry & 15
            at += used
            if symbol < 256:
                entry = t1[value >> used & m1]
                red, at = entry >> 4, at + (entry & 15)
                value = number(buffer[at >> 3 : (at >> 3) + 8], "little") >> (at & 7)
                entry = t2[value & m2]
                blue, used = entry >> 4, entry & 15
                entry = t3[value >> used & m3]
                at += used + (entry & 15)
                pixel = (entry >> 4) << 24 | red << 16 | symbol << 8 | blue
            elif symbol >= first:
                pixel = cache[symbol - first]
            else:
                left, at = extended(symbol - 256, at)
                entry = t4[number(buffer[at >> 3 : (at >> 3) + 8], "little") >> (at & 7) & m4]
                code, at = extended(entry >> 4, at + (entry & 15))
                near = NEAR[min(code, len(NEAR)) - 1]
                back = code - len(NEAR) if code > len(NEAR) else max(1, near[0] + near[1] * image.width)
                if back > step:
                    raise ValueError("a back-reference goes before the image")
                continue
        pixels[step] = pixel
        step += 1
        if image.cache_bits:
            cache[(pixel * CACHE_FACTOR & 0xFFFFFFFF) >> shift] = pixel
    return pixels, at


def _channels(pixels: np.ndarray) -> np.ndarray:
    return np.stack([pixels >> s & 255 for s in (24, 16, 8, 0)], axis=-1)


def _joined(channels: np.ndarray) -> np.ndarray:
    c = channels & 255
    return c[..., 0] << 24 | c[..., 1] << 16 | c[..., 2] << 8 | c[..., 3]


def predicted(mode: int, left, top, top_right, top_left) -> list[int]:
    """The predicted channels from four neighbours' channels."""
    mean = lambda a, b: [(x + y) >> 1 for x, y in zip(a, b, strict=True)]
    clamp = lambda x: 0 if x < 0 else 255 if x > 255 else x
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(top, top_left, strict=True))
        to_top = sum(abs(x - c) for x, c in zip(left, top_left, strict=True))
        return left if to_left < to_top else top
    if mode == 12:
        return [clamp(x + t - c) for x, t, c in zip(left, top, top_left, strict=True)]
    if mode == 13:
        return [clamp(a + int((a - c) / 2)) for a, c in zip(mean(left, top), top_left, strict=True)]
    return {
        1: left, 2: top, 3: top_right, 4: top_left, 5: mean(mean(left, top_right), top), 6: mean(left, top_left),
        7: mean(left, top), 8: mean(top_left, top), 9: mean(top, top_right), 10: mean(mean(left, top_left), mean(top, top_right)),
    }.get(mode, [255, 0, 0, 0])


def _predict(pixels: np.ndarray, modes: np.ndarray, bits: int, sign: int) -> np.ndarray:
    """Add (sign 1) or subtract (-1) the prediction; ``modes`` for each tile."""
    height, width = pixels.shape
    if (modes == 1).all() or (modes == 2).all():
        return _along(pixels, int(modes.flat[0]), sign)
    given = _channels(pixels).reshape(-1, 4).tolist()
    done: list[list[int]] = []
    whole = done if sign > 0 else given
    for i, pixel in enumerate(given):
        y, x = divmod(i, width)
        if not i:
            guess = [255, 0, 0, 0]
        elif not y:
            guess = whole[i - 1]
        elif not x:
            guess = whole[i - width]
        else:
            # The right-hand neighbour of a row's last pixel is that row's own first.
            guess = predicted(int(modes[y >> bits, x >> bits]), whole[i - 1], whole[i - width], whole[i - width + 1], whole[i - width - 1])
        done.append([(p + sign * g) & 255 for p, g in zip(pixel, guess, strict=True)])
    return _joined(np.array(done, dtype=np.int64).reshape(height, width, 4))


def _along(pixels: np.ndarray, mode: int, sign: int) -> np.ndarray:
    """The prediction from the left (1) or from above (2) throughout, as running sums or differences."""
    c = _channels(pixels)
    black = np.array([255, 0, 0, 0])
    if sign > 0:
        c[0, 0] += black
        if mode == 1:
            c[:, 0] = np.cumsum(c[:, 0], axis=0)
            return _joined(np.cumsum(c, axis=1))
        c[0] = np.cumsum(c[0], axis=0)
        return _joined(np.cumsum(c, axis=0))
    out = c.copy()
    if mode == 1:
        out[:, 1:] -= c[:, :-1]
        out[1:, 0] -= c[:-1, 0]
    else:
        out[1:] -= c[:-1]
        out[0, 1:] -= c[0, :-1]
    out[0, 0] -= black
    return _joined(out)


def _cross(pixels: np.ndarray, tiles: np.ndarray, bits: int, sign: int) -> np.ndarray:
    height, width = pixels.shape
    t = tiles[np.arange(height)[:, None] >> bits, np.arange(width)[None] >> bits]
    signed = lambda x: ((x & 255) ^ 128) - 128
    c = _channels(pixels)
    red, green, blue = c[..., 1].copy(), c[..., 2], c[..., 3]
    other = red + sign * (signed(t) * signed(green) >> 5)
    true_red = other if sign > 0 else red
    c[..., 1] = other
    c[..., 3] = blue + sign * ((signed(t >> 8) * signed(green) >> 5) + (signed(t >> 16) * signed(true_red) >> 5))
    return _joined(c)


def _green(pixels: np.ndarray, sign: int) -> np.ndarray:
    c = _channels(pixels)
    c[..., 1] += sign * c[..., 2]
    c[..., 3] += sign * c[..., 2]
    return _joined(c)


def _palette_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def _unindex(pixels: np.ndarray, colours: np.ndarray, width: int) -> np.ndarray:
    bits = _palette_bits(len(colours))
    per, depth = 1 << bits, 8 >> bits
    index = (pixels >> 8 & 255)[..., None] >> (depth * np.arange(per)) & ((1 << depth) - 1)
    index = index.reshape(len(pixels), -1)[:, :width]
    return np.where(index < len(colours), colours[np.minimum(index, len(colours) - 1)], 0)


def decode(files: Iterable[bytes]) -> list[np.ndarray]:
    """Each file's pixels, (height, width) of ARGB numbers; ValueError if one isn't lossless WebP."""
    images, steps = [], []
    for data in files:
        if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
            raise ValueError("not a WebP file")
        at, end = 12, min(len(data), 8 + int.from_bytes(data[4:8], "little"))
        while at + 8 <= end and data[at : at + 4] != b"VP8L":
            at += 8 + (int.from_bytes(data[at + 4 : at + 8], "little") + 1) // 2 * 2
        body = data[at + 8 : at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")]
        source = Bits(body)
        if source.read(8) != 0x2F:
            raise ValueError("no lossless image")
        width, height = source.read(14) + 1, source.read(14) + 1
        source.read(1)
        if source.read(3):
            raise ValueError("unknown version")
        todo, inner = [], width
        while source.read(1):
            kind = source.read(2)
            if any(kind == k for k, *_ in todo):
                raise ValueError("a transform occurs twice")
            if kind in (PREDICTOR, CROSS_COLOUR):
                bits = source.read(3) + 2
                shape = -(-height >> bits), -(-inner >> bits)
                tiles = read_image(source, shape[1], shape[0]).reshape(shape)
                todo.append((kind, bits, tiles))
            elif kind == PALETTE:
                size = source.read(8) + 1
                colours = _joined(np.cumsum(_channels(read_image(source, size, 1)), axis=0))
                todo.append((kind, inner, colours))
                inner = -(-inner >> _palette_bits(size))
            else:
                todo.append((kind,))
        images.append(Image(source, inner, height, main=True))
        steps.append(todo)
    out = []
    for image, todo, pixels in zip(images, steps, read_pixels(images) if images else [], strict=True):
        pixels = pixels.reshape(image.height, image.width)
        for kind, *rest in reversed(todo):
            if kind == PREDICTOR:
                pixels = _predict(pixels, rest[1] >> 8 & 15, rest[0], 1)
            elif kind == CROSS_COLOUR:
                pixels = _cross(pixels, rest[1], rest[0], 1)
            elif kind == SUBTRACT_GREEN:
                pixels = _green(pixels, 1)
            else:
                pixels = _unindex(pixels, rest[1], rest[0])
        out.append(pixels)
    return out


# Encoding ------------------------------------------------------------------------------------------------


def code_lengths(counts: list[int] | np.ndarray, most: int = 12) -> list[int]:
    """Huffman code lengths of at most ``most`` bits."""
    counts = np.asarray(counts)
    lengths, used = [0] * len(counts), counts.nonzero()[0]
    if len(used) == 1:
        lengths[int(used[0])] = 1
    if len(used) < 2:
        return lengths
    weights = counts[used]
    order = weights.argsort(kind="stable")
    used, weights, n, far = used[order], weights[order].tolist(), len(used), float("inf")
    while True:
        # Leaves in order, and joined nodes, which come in order, too.
        joined, parent, leaf, node = [far] * n, [0] * (2 * n - 1), 0, 0
        queue = [*weights, far]
        for k in range(n - 1):
            one, ready = queue[leaf], joined[node]
            if one <= ready:
                parent[leaf] = n + k
                leaf += 1
            else:
                one = ready
                parent[n + node] = n + k
                node += 1
                ready = joined[node]
            other = queue[leaf]
            if other <= ready:
                joined[k] = one + other
                parent[leaf] = n + k
                leaf += 1
            else:
                joined[k] = one + ready
                parent[n + node] = n + k
                node += 1
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth[:n]) <= most:
            for i, d in zip(used.tolist(), depth, strict=False):
                lengths[i] = d
            return lengths
        weights = sorted(w // 2 + 1 for w in weights)


def spelled(lengths: list[int]) -> dict[int, str]:
    """Canonical codes by symbol, their bits in stream order."""
    out, code, last = {}, 0, 0
    for size, i in sorted((x, i) for i, x in enumerate(lengths) if x):
        code <<= size - last
        last = size
        out[i] = f"{code:0{size}b}"
        code += 1
    return out


def codes(lengths: list[int]) -> list[int]:
    """Canonical codes as numbers, the first bit lowest."""
    out = [0] * len(lengths)
    for i, bits in spelled(lengths).items():
        out[i] = int(bits[::-1], 2)
    return out


def _lowest_first(value: int, bits: int) -> str:
    return f"{value:0{bits}b}"[::-1] if bits else ""


_GAPS = {n: (17, _lowest_first(n - 3, 3)) if n <= 10 else (18, _lowest_first(n - 11, 7)) for n in range(3, 139)}
_SIZES_SPELLED = [_lowest_first(n, 3) for n in range(8)]


#: Bits of the longest code in files of ``encode_samples``.
MOST_BITS = 11
# The code in which lengths up to that are written: runs of zeros and lengths of 7 in three bits, the others in four.
_COMMON_SIZES = [3 if s in (7, 17) else 4 if s <= MOST_BITS or s == 18 else 0 for s in range(19)]
_COMMON_SPELLED = spelled(_COMMON_SIZES)
_COMMON_GAPS = {n: _COMMON_SPELLED[symbol] + extra for n, (symbol, extra) in _GAPS.items()}


class Writer:
    """Collects numbers, least significant bit first."""

    def __init__(self):
        self.value, self.size = 0, 0

    def write(self, value: int, bits: int) -> None:
        self.value |= value << self.size
        self.size += bits

    def write_code(self, lengths: list[int]) -> None:
        used = np.flatnonzero(lengths).tolist()
        if len(used) <= 1 and (not used or used[0] < 256):
            symbol = used[0] if used else 0
            self.write(0b101 if symbol > 1 else 0b001, 3)
            self.write(symbol, 8 if symbol > 1 else 1)
            return
        common = max(lengths) <= MOST_BITS
        # Each item is a symbol and extra bits; in the common code, what they are written as.
        gaps, sizes, short = (_COMMON_GAPS, _COMMON_SIZES, _COMMON_SPELLED) if common else (_GAPS, [], {s: (s, "") for s in range(16)})
        items: list = []
        last = -1
        for i in used:
            gap = i - last - 1
            while gap >= 3:
                items.append(gaps[min(gap, 138)])
                gap -= min(gap, 138)
            if gap:
                items.extend([short[0]] * gap)
            items.append(short[lengths[i]])
            last = i
        if not common:
            counts = [0] * 19
            for s, _ in items:
                counts[s] += 1
            sizes = code_lengths(counts, 7)
            short = spelled(sizes) if sum(1 for x in sizes if x) > 1 else dict.fromkeys(range(19), "")
            items = [short[s] + extra for s, extra in items]
        n = max(0, -(-max(1, (len(items) - 2).bit_length()) // 2) - 1)
        bits = ["01111", *[_SIZES_SPELLED[sizes[s]] for s in CODE_LENGTH_ORDER], "1", _lowest_first(n, 3), _lowest_first(len(items) - 2, 2 + 2 * n)]
        stream = "".join(bits + items)
        self.write(int(stream[::-1], 2), len(stream))


def _file(body: bytes) -> bytes:
    pad = len(body) % 2
    return struct.pack("<4sI4s4sI", b"RIFF", 12 + len(body) + pad, b"WEBP", b"VP8L", len(body)) + body + b"\0" * pad


def _header(width: int, height: int) -> Writer:
    w = Writer()
    w.write(0x2F, 8)
    w.write(width - 1, 14)
    w.write(height - 1, 14)
    w.write(1, 1)
    w.write(0, 3)
    return w


#: Bits of the largest cache, and of tiles.
MOST_CACHE, TILE_BITS = 7, 9
#: What a part of the format must save, as a share of the estimate without it.
WORTH = 0.97
_CROSS_ELEMENT = 16 | 16 << 8  # half of green from red and from blue


def _bits_needed(*parts: np.ndarray) -> float:
    """Entropy of bytes."""
    counts = np.bincount(parts[0], minlength=256)
    for data in parts[1:]:
        counts += np.bincount(data, minlength=256)
    counts = counts[counts > 0]
    return float((counts * np.log2(counts.sum() / counts)).sum())


def _transform(samples: bytes, pixels: np.ndarray) -> tuple[str, np.ndarray | int | None]:
    """The transform that promises the smallest file: (its name, what it needs).

    Estimates are entropies of all the bytes that are left (of all but the first
    row or pixel, where these are told from others).
    """
    data, width = np.frombuffer(samples, dtype=np.uint8), pixels.shape[1]
    ordered = np.sort(np.frombuffer(samples, dtype="<u4"))
    new = (ordered[1:] != ordered[:-1]).nonzero()[0]
    if 1 <= len(new) <= 255 and 3 * len(new) + 3 <= len(ordered):
        return "palette", ordered[np.append(0, new + 1)].astype(np.int64)
    best, name, given = WORTH * _bits_needed(data), "none", None
    blue, green, red, alpha = (data[i::4] for i in range(4))
    half = (green.view(np.int8) >> 1).view(np.uint8)
    # Red alone tells whether it follows green, or half of it, at all.
    alone, tries = _bits_needed(red), [("predictor", 1, (data[4:] - data[:-4],))]
    for kind, of_green in (("green", green), ("cross", half)):
        if _bits_needed(red - of_green) < alone:
            tries.append((kind, None, (red - of_green, blue - of_green, green, alpha)))
    if len(data) > 8 * width:
        tries.append(("predictor", 2, (data[4 * width :] - data[: -4 * width],)))
    for kind, mode, parts in tries:
        if (bits := _bits_needed(*parts)) < best:
            best, name, given = bits, kind, mode
    return name, given


def _copies(pixels: np.ndarray) -> list[tuple[int, int, int]]:
    """(place, count, distance) of back-references, apart from each other: runs of three pixels or more that came before."""
    n = len(pixels)
    if n < 4:
        return []
    p = pixels.astype(np.uint64)
    key = (p[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ p[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93) ^ p[2:]
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if not len(same):
        return []
    here, before = order[same + 1], order[same]
    right = (p[here] == p[before]) & (p[here + 1] == p[before + 1]) & (p[here + 2] == p[before + 2])
    back = np.zeros(n, dtype=np.int64)
    back[here[right]] = here[right] - before[right]
    edges = np.flatnonzero(np.diff(back, prepend=0, append=0))
    out, end = [], 0
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if distance := int(back[a]):
            a, stop = max(a, end), b + 2
            while stop - a >= 3:
                count = min(4096, stop - a)
                out.append((a, count, distance))
                a += count
            end = max(end, a)
    return out


def _stored(pixels: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cache's cell of each pixel, and whether it holds the pixel when it comes to it."""
    slot = (pixels * CACHE_FACTOR & 0xFFFFFFFF) >> (32 - bits)
    order = slot.astype(np.uint16).argsort(kind="stable")  # by digits
    hit, there, own = np.zeros(len(pixels), dtype=bool), slot[order], pixels[order]
    hit[order[1:]] = (there[1:] == there[:-1]) & (own[1:] == own[:-1])
    return slot, hit


def _packed(head: Writer, values: np.ndarray, sizes: np.ndarray) -> bytes:
    """The writer's bits, then ``sizes`` bits of each value (64 at most, others not set)."""
    ends = np.cumsum(sizes) + head.size % 8
    at = ends - sizes
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    last = int(ends[-1]) if len(ends) else head.size % 8
    packed = np.zeros((last >> 6) + 2, dtype=np.uint64)
    if len(ends):
        heads = np.append(True, word[1:] != word[:-1]).nonzero()[0]
        packed[word[heads]] = np.bitwise_or.reduceat(values << shift, heads)
        over = ((at & 63) + sizes > 64).nonzero()[0]
        packed[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    start = head.value.to_bytes((head.size + 7) // 8, "little")
    body = packed.astype("<u8").tobytes()[: (last + 7) // 8]
    return start[: head.size // 8] + bytes([start[-1] | body[0]]) + body[1:] if head.size % 8 else start + body


def encode_samples(samples: bytes, width: int, height: int, used: dict[str, int] | None = None) -> bytes:
    """A file of 4 * width * height 8-bit samples (blue, green, red, alpha).

    The transform, the colour cache and back-references are used where they make
    the file smaller, by estimate; ``used`` counts what is.
    """
    w = _header(width, height)
    pixels = np.frombuffer(samples, dtype="<u4").astype(np.int64).reshape(height, width)
    name, given = _transform(samples, pixels)
    tiles = -(-height >> TILE_BITS) * -(-width >> TILE_BITS)
    if name == "palette":
        w.write(1 | PALETTE << 1, 3)
        w.write(len(given) - 1, 8)
        steps = _channels(given)
        steps[1:] -= _channels(given)[:-1]
        _write_image(w, _joined(steps).tolist())
        bits = _palette_bits(len(given))
        index = np.pad(np.searchsorted(given, pixels), ((0, 0), (0, -width % (1 << bits))))
        pixels = (index.reshape(height, -1, 1 << bits) << ((8 >> bits) * np.arange(1 << bits))).sum(axis=2) << 8 | 0xFF << 24
    elif name == "predictor":
        w.write(1 | PREDICTOR << 1, 3)
        w.write(TILE_BITS - 2, 3)
        _write_image(w, [given << 8 | 0xFF << 24] * tiles)
        pixels = _along(pixels, given, -1)
    elif name == "cross":
        w.write(1 | CROSS_COLOUR << 1, 3)
        w.write(TILE_BITS - 2, 3)
        _write_image(w, [_CROSS_ELEMENT | 0xFF << 24] * tiles)
        pixels = _cross(pixels, np.full((1, 1), _CROSS_ELEMENT), 14, -1)
    elif name == "green":
        w.write(1 | SUBTRACT_GREEN << 1, 3)
        pixels = _green(pixels, -1)
    w.write(0, 1)
    pixels = pixels.ravel()
    n = len(pixels)
    copies = _copies(pixels)
    token = np.ones(n, dtype=bool)  # places where a symbol is written
    for a, count, _ in copies:
        token[a + 1 : a + count] = False
    bits = min(MOST_CACHE, max(1, (n // 2).bit_length()))
    slot, hit = _stored(pixels, bits)
    starts = np.array([a for a, *_ in copies], dtype=np.int64)
    hit &= token
    hit[starts] = False
    # A hit saves three symbols; each cell in use needs a code.
    cells = np.unique(slot[hit])
    if 12 * int(hit.sum()) <= 64 + 10 * len(cells):
        bits, hit[:] = 0, False
    if used is not None:
        for part, is_used in ((name, True), ("copies", bool(copies)), ("cache", bits > 0)):
            used[part] = used.get(part, 0) + int(is_used)
    w.write(bool(bits), 1)
    if bits:
        w.write(bits, 4)
    w.write(0, 1)  # one group of codes

    first = pixels >> 8 & 255
    first[hit] = slot[hit] + 256 + LENGTH_CODES
    lengths_, distances = [_prefix(c) for _, c, _ in copies], [_prefix(d + len(NEAR)) for *_, d in copies]
    first[starts] = [256 + x[0] for x in lengths_]
    places = token.nonzero()[0]
    literal = token & ~hit
    literal[starts] = False
    whole, symbols = pixels[literal], first[places]
    others = whole >> 16 & 255, whole & 255, whole >> 24 & 255
    counts = np.bincount(symbols, minlength=256 + LENGTH_CODES + (1 << bits if bits else 0))
    green = code_lengths(counts, MOST_BITS)
    rest = code_lengths(np.bincount(np.concatenate(others), minlength=256), MOST_BITS)
    far = code_lengths(np.bincount([x[0] for x in distances], minlength=DISTANCE_CODES), MOST_BITS) if copies else [1]
    w.write_code(green)
    described = Writer()
    described.write_code(rest)
    for _ in range(3):
        w.write(described.value, described.size)
    w.write_code(far)

    def coded(lengths):
        """Codes, their first bits lowest, and sizes by symbol; a code of one symbol has no bits."""
        size = np.array(lengths, dtype=np.int64)
        there = size.nonzero()[0]
        out = np.zeros(len(size), dtype=np.uint64)
        if len(there) <= 1:
            return out, np.zeros(len(size), dtype=np.int64)
        there = there[size[there].argsort(kind="stable")]
        share = 1 << (MOST_BITS - size[there])
        out[there] = _reversed_bits(MOST_BITS)[np.cumsum(share) - share]
        return out, size

    # A number for each token: a literal's four codes (44 bits), or a copy's codes and extra bits (58).
    code, size = coded(green)
    values, sizes = code[symbols], size[symbols]
    code, size = coded(rest)
    at = literal[places].nonzero()[0]
    value, bits = values[at], sizes[at]
    for part in others:
        value |= code[part] << bits.view(np.uint64)
        bits += size[part]
    values[at], sizes[at] = value, bits
    if copies:
        code, size = (x.tolist() for x in coded(far))
        tails = [(extra | code[s] << b | value << (b + size[s]), b + size[s] + more) for (_, extra, b), (s, value, more) in zip(lengths_, distances, strict=True)]
        at = np.searchsorted(places, starts)
        values[at] |= np.array([x[0] for x in tails], dtype=np.uint64) << sizes[at].view(np.uint64)
        sizes[at] += np.array([x[1] for x in tails], dtype=np.int64)
    return _file(_packed(w, values, sizes))


def _prefix(value: int) -> tuple[int, int, int]:
    """(prefix code, extra value, its bits) of a length or distance."""
    value -= 1
    if value < 4:
        return value, 0, 0
    high = value.bit_length() - 1
    bits = high - 1
    return 2 * high + (value >> bits & 1), value & ((1 << bits) - 1), bits


def _tokens(pixels: list[int], cache_bits: int, references: bool) -> list[tuple]:
    """Literals, cache entries, and back-references to the last place of three equal pixels."""
    out, seen, cache, i = [], {}, {}, 0
    slot = lambda p: (p * CACHE_FACTOR & 0xFFFFFFFF) >> (32 - cache_bits)
    while i < len(pixels):
        key, n = tuple(pixels[i : i + 3]), 0
        if references and len(key) == 3 and key in seen:
            j = seen[key]
            while i + n < len(pixels) and n < 4096 and pixels[j + n] == pixels[i + n]:
                n += 1
            out.append(("copy", n, i - j))
        elif cache_bits and cache.get(slot(pixels[i])) == pixels[i]:
            out.append(("cache", slot(pixels[i])))
            n = 1
        else:
            out.append(("pixel", pixels[i]))
            n = 1
        for k in range(i, i + n):
            seen[tuple(pixels[k : k + 3])] = k
            if cache_bits:
                cache[slot(pixels[k])] = pixels[k]
        i += n
    return out


def _write_image(w: Writer, pixels: list[int], cache_bits: int = 0, references: bool = False, tiles: tuple | None = None, main: bool = False) -> None:
    """An entropy-coded image; ``tiles``: (bits, group of each tile, width)."""
    w.write(bool(cache_bits), 1)
    if cache_bits:
        w.write(cache_bits, 4)
    groups = 1
    if main:
        w.write(tiles is not None, 1)
        if tiles is not None:
            w.write(tiles[0] - 2, 3)
            _write_image(w, [int(g) << 8 | 0xFF << 24 for g in tiles[1].ravel()])
            groups = int(tiles[1].max()) + 1
    sizes = (256 + LENGTH_CODES + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_CODES)
    counts = [[[0] * s for s in sizes] for _ in range(groups)]
    tokens, place, stream = _tokens(pixels, cache_bits, references), 0, []
    for kind, *value in tokens:
        g = int(tiles[1][place // tiles[2] >> tiles[0], place % tiles[2] >> tiles[0]]) if tiles else 0
        if kind == "pixel":
            p = value[0]
            symbols = [(0, p >> 8 & 255, 0, 0), (1, p >> 16 & 255, 0, 0), (2, p & 255, 0, 0), (3, p >> 24, 0, 0)]
            place += 1
        elif kind == "cache":
            symbols = [(0, 256 + LENGTH_CODES + value[0], 0, 0)]
            place += 1
        else:
            a, b = _prefix(value[0]), _prefix(value[1] + len(NEAR))
            symbols = [(0, 256 + a[0], *a[1:]), (4, b[0], *b[1:])]
            place += value[0]
        for k, s, *_ in symbols:
            counts[g][k][s] += 1
        stream.append((g, symbols))
    lengths = [[code_lengths(c, 15) for c in group] for group in counts]
    coded = [[codes(x) for x in group] for group in lengths]
    alone = [[sum(1 for v in x if v) <= 1 for x in group] for group in lengths]
    for group in lengths:
        for x in group:
            w.write_code(x)
    for g, symbols in stream:
        for k, s, extra, bits in symbols:
            if not alone[g][k]:
                w.write(coded[g][k][s], lengths[g][k][s])
            w.write(extra, bits)


def encode(
    pixels: np.ndarray, predictor: np.ndarray | None = None, cross: np.ndarray | None = None, green: bool = False,
    palette: bool = False, cache_bits: int = 0, references: bool = False, groups: np.ndarray | None = None, tile_bits: int = 2,
) -> bytes:
    """A file of ``pixels`` with the named parts of the format in use.

    ``predictor``: modes, ``cross``: colour elements, ``groups``: code groups, each
    for tiles of 2^tile_bits pixels.
    """
    height, width = pixels.shape
    w, pixels = _header(width, height), pixels.astype(np.int64)
    if palette:
        colours, index = np.unique(pixels, return_inverse=True)
        if len(colours) > 256:
            raise ValueError("over 256 colours")
        w.write(1 | PALETTE << 1, 3)
        w.write(len(colours) - 1, 8)
        steps = _channels(colours)
        steps[1:] -= _channels(colours)[:-1]
        _write_image(w, _joined(steps).tolist())
        bits = _palette_bits(len(colours))
        index = np.pad(index.reshape(height, width), ((0, 0), (0, -width % (1 << bits))))
        packed = (index.reshape(height, -1, 1 << bits) << ((8 >> bits) * np.arange(1 << bits))).sum(axis=2)
        pixels = packed << 8 | 0xFF << 24
    if predictor is not None:
        w.write(1 | PREDICTOR << 1, 3)
        w.write(tile_bits - 2, 3)
        _write_image(w, [int(m) << 8 | 0xFF << 24 for m in predictor.ravel()])
        pixels = _predict(pixels, predictor, tile_bits, -1)
    if cross is not None:
        w.write(1 | CROSS_COLOUR << 1, 3)
        w.write(tile_bits - 2, 3)
        _write_image(w, [int(x) | 0xFF << 24 for x in cross.ravel()])
        pixels = _cross(pixels, cross, tile_bits, -1)
    if green:
        w.write(1 | SUBTRACT_GREEN << 1, 3)
        pixels = _green(pixels, -1)
    w.write(0, 1)
    tiles = None if groups is None else (tile_bits, groups, pixels.shape[1])
    _write_image(w, pixels.ravel().tolist(), cache_bits, references, tiles, main=True)
    return _file(w.value.to_bytes((w.size + 7) // 8, "little"))
