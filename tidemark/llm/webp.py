"""Lossless WebP (VP8L): a decoder of the whole format and an encoder.

Pixels are uint32 ARGB arrays of shape (height, width). Decoding covers prefix
codes (simple and normal, with groups chosen by an entropy image), literals,
back-references, the colour cache, and the predictor, cross-colour,
subtract-green and palette transforms. Pixels are read one by one where an entropy
image chooses among groups. In main images of one group the token that would begin
at each bit is looked up for a stretch of the stream at once, and the tokens that
do begin are the chain from its first bit.
"""

from __future__ import annotations

from collections import Counter
from itertools import groupby

import numpy as np

PREDICTOR, CROSS, GREEN, PALETTE = range(4)

# Fixed values of the format: the order of code-length code lengths, and the
# alphabet sizes besides the colour cache.
LENGTH_ORDER = [17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
ALPHABETS = [256 + 24, 256, 256, 256, 40]

#: Short distance codes: offsets (x, y) into the rows above, nearest first.
NEAR = sorted(
    ((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0)
)
_NEAR_XY = np.array(NEAR)
BLACK = 0xFF000000
MAX_SIDE = 1 << 14


class WebPError(ValueError):
    """The bytes are not a lossless WebP image."""


# --- bits --------------------------------------------------------------------


class Reader:
    def __init__(self, data: bytes):
        self.data, self.at, self.end = data + bytes(16), 0, 8 * len(data)

    def peek(self, n: int) -> int:
        a = self.at >> 3
        return (int.from_bytes(self.data[a : a + ((n + 14) >> 3) + 1], "little") >> (self.at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        value = self.peek(n)
        self.at += n
        if self.at > self.end:
            raise WebPError("the stream ends early")
        return value


class Writer:
    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n

    def bytes(self) -> bytes:
        return self.value.to_bytes((self.n + 7) >> 3, "little")


# --- prefix codes ------------------------------------------------------------


def _reversed(depth: int) -> np.ndarray:
    """Every number of ``depth`` bits with its bits in reverse order."""
    if depth not in _REVERSED:
        order = np.zeros(1, np.intp)
        for _ in range(depth):
            order = np.concatenate([2 * order, 2 * order + 1])
        _REVERSED[depth] = order
    return _REVERSED[depth]


_REVERSED: dict[int, np.ndarray] = {}


def _canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols by code, how many slots of a table each fills, table depth)."""
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    depth = int(lengths[used[-1]])
    return used, np.left_shift(1, depth - lengths[used].astype(np.intp)), depth


class Code:
    """A prefix code for reading: a table over ``depth`` bits, by the bits as
    they stand in the stream. ``only`` is the symbol of a code without bits."""

    def __init__(self, lengths: list[int]):
        self.only, self.depth, self._lists = None, 0, None
        if lengths.count(0) > len(lengths) - 2:
            self.only = lengths.index(max(lengths))
            return
        sizes = np.array(lengths, np.uint8)
        used, slots, self.depth = _canonical(sizes)
        if int(slots.sum()) != 1 << self.depth:
            raise WebPError("a prefix code is incomplete or overfull")
        order = _reversed(self.depth)
        self.symbols = np.repeat(used.astype(np.uint16), slots)[order]
        self.sizes = np.repeat(sizes[used], slots)[order]

    def lists(self) -> tuple[list[int], list[int]]:
        if self._lists is None:
            self._lists = (self.symbols.tolist(), self.sizes.tolist())
        return self._lists

    def read(self, bits: Reader) -> int:
        if self.only is not None:
            return self.only
        symbols, sizes = self.lists()
        at = bits.peek(self.depth)
        bits.at += sizes[at]
        if bits.at > bits.end:
            raise WebPError("the stream ends early")
        return symbols[at]


def _read_code(bits: Reader, size: int) -> Code:
    lengths = [0] * size
    if bits.read(1):  # simple: one or two symbols
        two = bits.read(1)
        first = bits.read(8 if bits.read(1) else 1)
        lengths[first] = 1
        if two:
            lengths[bits.read(8)] = 1
        return Code(lengths)
    of = [0] * 19
    for k in range(4 + bits.read(4)):
        of[LENGTH_ORDER[k]] = bits.read(3)
    of = Code(of)
    left = size
    if bits.read(1):
        left = 2 + bits.read(2 + 2 * bits.read(3))
    symbols, sizes = ([of.only], [0]) if of.only is not None else of.lists()
    mask, at, last, window, have = (1 << of.depth) - 1, 0, 8, 0, 0
    while at < size and left:
        left -= 1
        if have < 14:  # a symbol and what it may take with it
            window, have = bits.peek(600), 600
        slot = window & mask
        n, taken = symbols[slot], sizes[slot]
        if n < 16:
            lengths[at] = n
            last, at = n or last, at + 1
        else:
            more, least, value = ((2, 3, last), (3, 3, 0), (7, 11, 0))[n - 16]
            count = least + ((window >> taken) & ((1 << more) - 1))
            taken += more
            if at + count > size:
                raise WebPError("code lengths overrun their alphabet")
            lengths[at : at + count] = [value] * count
            at += count
        window >>= taken
        have -= taken
        bits.at += taken
    if bits.at > bits.end:
        raise WebPError("the stream ends early")
    return Code(lengths)


def _read_group(bits: Reader, cache: int) -> list[Code]:
    return [_read_code(bits, size + (cache if not k else 0)) for k, size in enumerate(ALPHABETS)]


def _length(bits: Reader, prefix: int) -> int:
    if prefix < 4:
        return prefix + 1
    extra = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << extra) + bits.read(extra) + 1


# --- pixels ------------------------------------------------------------------


def _cache_key(argb: int, width: int) -> int:
    return ((0x1E35A7BD * argb) & 0xFFFFFFFF) >> (32 - width)


def _read_pixels(bits: Reader, width: int, height: int, main: bool) -> np.ndarray:
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise WebPError("the colour cache is too large")
    cache = [0] * (1 << cache_bits) if cache_bits else []
    block, of_block = 0, None
    if main and bits.read(1):
        block = bits.read(3) + 2
        image = _read_pixels(bits, -(-width >> block), -(-height >> block), False)
        of_block = ((image >> 8) & 0xFFFF).tolist()
    groups = [_read_group(bits, len(cache)) for _ in range(1 + max(map(max, of_block)) if of_block else 1)]
    n = width * height
    green, red, blue, alpha, distance = groups[0]
    if len(groups) == 1:
        constant = None not in (red.only, blue.only, alpha.only)
        if constant and green.only is not None and green.only < 256:
            return np.full((height, width), (alpha.only << 24) | (red.only << 16) | (green.only << 8) | blue.only, np.uint32)
        if main and green.only is None:
            start = bits.at
            out = _one_group(bits, groups[0], n, width, cache_bits)
            if out is not None:
                return out.reshape(height, width)
            bits.at = start
    out = [0] * n
    at = 0
    while at < n:
        if of_block:
            green, red, blue, alpha, distance = groups[of_block[at // width >> block][at % width >> block]]
        else:
            green, red, blue, alpha, distance = groups[0]
        s = green.read(bits)
        if s < 256:
            r, b = red.read(bits), blue.read(bits)
            out[at] = (alpha.read(bits) << 24) | (r << 16) | (s << 8) | b
            fresh = 1
        elif s < 280:
            fresh = _length(bits, s - 256)
            far = _length(bits, distance.read(bits))
            if far > 120:
                far -= 120
            else:
                x, y = NEAR[far - 1]
                far = max(1, x + y * width)
            if far > at or at + fresh > n:
                raise WebPError("a back-reference leaves the image")
            for k in range(at, at + fresh):
                out[k] = out[k - far]
        else:
            out[at] = cache[s - 280]
            fresh = 1
        if cache:
            for argb in out[at : at + fresh]:
                cache[_cache_key(argb, cache_bits)] = argb
        at += fresh
    return np.array(out, np.uint32).reshape(height, width)


#: Bytes of the stream whose tokens are looked up together.
STRETCH = 1 << 15


def _values(prefix: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Lengths or distances of prefixes, with extra bits from ``window``."""
    extra = np.where(prefix < 4, 0, (prefix - 2) >> 1)
    large = ((2 + (prefix & 1)) << extra) + (window & ((1 << extra) - 1)) + 1
    return np.where(prefix < 4, prefix + 1, large)


#: Extra bits of each prefix of a length or distance.
EXTRA = np.array([max(0, p - 2) >> 1 for p in range(40)], np.uint8)


def _one_group(bits: Reader, group: list[Code], n: int, width: int, cache_bits: int) -> np.ndarray | None:
    """Pixels of one group, whose green code has more than one symbol; None where
    the cache gives a colour that was not put there."""
    green, red, blue, alpha, distance = group
    # channels that are read after green, and what the others always are
    more_of = [(code, shift) for code, shift in ((red, 16), (blue, 0), (alpha, 24)) if code.only is None]
    rest = sum(code.only << shift for code, shift in ((red, 16), (blue, 0), (alpha, 24)) if code.only is not None)
    whole = len(bits.data) - 8
    words = np.ndarray((whole,), "<u8", bits.data, 0, (1,))  # at each byte, what follows it

    def window(at: np.ndarray) -> np.ndarray:
        return (words[np.minimum(at >> 3, whole - 1)] >> (at & 7).astype(np.uint64)).astype(np.int64)

    def far_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, length) of the distance codes that begin at bits ``at``."""
        if distance.only is not None:
            return np.full(len(at), distance.only, np.uint16), np.zeros(len(at), np.uint8)
        slot = window(at) & ((1 << distance.depth) - 1)
        return distance.symbols[slot], distance.sizes[slot]

    # what a token takes, without its distance; copies have the highest bit, literals of several channels the next
    copying = (green.symbols > 255) & (green.symbols < 280)
    table = green.sizes + np.where(copying, 128 + EXTRA[(green.symbols - 256) * copying], 0).astype(np.uint8)
    if more_of:
        table += np.where(green.symbols < 256, 64, 0).astype(np.uint8)

    def channels(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(what the other channels add to a literal, where it ends)."""
        values, at = np.full(len(at), rest, np.uint32), at.astype(np.int64)
        for code, shift in more_of:
            slot = window(at) & ((1 << code.depth) - 1)
            values |= code.symbols[slot].astype(np.uint32) << np.uint32(shift)
            at += code.sizes[slot]
        return values, at

    kinds, places, made, at = np.arange(8, dtype=np.uint32), [], 0, bits.at
    mask, shorts = np.uint32((1 << green.depth) - 1), np.ndarray((whole,), "<u4", bits.data, 0, (1,))
    while made < n and at < bits.end:
        first = at >> 3
        slot = ((shorts[first : first + STRETCH, None] >> kinds) & mask).astype(np.intp).ravel()
        size = table[slot]
        copies = np.flatnonzero(size & 128)
        if len(copies):  # a copy takes its length's extra bits and a distance with it
            taken = size[copies] & 127
            far, more = far_of(copies + 8 * first + taken)
            size[copies] = taken + more + EXTRA[far]
        if more_of:
            literals = np.flatnonzero(size & 64 if not len(copies) else (table[slot] & 64))
            begin = literals + 8 * first
            size[literals] = channels(begin + (size[literals] & 63))[1] - begin
        # two tokens a step: the second adds nothing where it begins beyond the stretch
        step = np.concatenate([size, np.zeros(256, np.uint8)])
        pairs = (size + step[np.arange(len(size)) + size]).tobytes()
        here, p, limit = [], at - 8 * first, min(len(size), bits.end - 8 * first)
        add = here.append
        while p < limit:
            add(p)
            p += pairs[p]
        here = np.array(here)
        here = np.stack([here, here + size[here]], 1).ravel()
        here = here[here < limit]
        places.append(here + 8 * first)
        at = p + 8 * first
        made += len(here)  # at least: a copy makes more than one
    if not places:
        raise WebPError("the stream ends early")
    place = np.concatenate(places)
    slot = window(place) & ((1 << green.depth) - 1)
    symbol = green.symbols[slot].astype(np.int64)
    fresh, copy = np.ones(len(symbol), np.int64), np.flatnonzero((symbol > 255) & (symbol < 280))
    after = place[copy] + green.sizes[slot[copy]]
    prefix = symbol[copy] - 256
    fresh[copy] = _values(prefix, window(after))
    ends = np.cumsum(fresh)
    last = int(np.searchsorted(ends, n))
    if last == len(ends) or ends[last] != n:
        raise WebPError("a back-reference leaves the image" if last < len(ends) else "the stream ends early")
    copy, after, prefix = (x[: np.searchsorted(copy, last, "right")] for x in (copy, after, prefix))
    after = after + EXTRA[prefix]
    far, more = far_of(after)
    far = _values(far.astype(np.int64), window(after + more))
    far = np.where(far > 120, far - 120, np.maximum(1, _NEAR_XY @ (1, width))[np.minimum(far, 120) - 1])
    begins = ends[: last + 1] - fresh[: last + 1]
    if (far > begins[copy]).any():
        raise WebPError("a back-reference leaves the image")
    symbol = symbol[: last + 1]
    literal = np.flatnonzero(symbol < 256)
    if more_of:
        values, literal_ends = channels(place[literal] + green.sizes[slot[literal]])
        values |= symbol[literal].astype(np.uint32) << np.uint32(8)
    if cache_bits:
        back = np.zeros(last + 1, np.int64)
        back[copy] = far
    tokens = zip(begins[copy].tolist(), fresh[copy].tolist(), far.tolist(), strict=True)
    if cache_bits and more_of:
        argb = np.zeros(last + 1, np.uint32)
        argb[literal] = values
        out = np.array(_any_with_cache(n, symbol.tolist(), argb.tolist(), fresh.tolist(), back.tolist(), cache_bits), np.uint32)
    elif cache_bits:
        green_only = bytearray(n)
        if not _with_cache(green_only, symbol.tolist(), fresh.tolist(), back.tolist(), rest, cache_bits):
            return None
        out = (np.frombuffer(green_only, np.uint8).astype(np.uint32) << 8) | np.uint32(rest)
    elif more_of:
        out = np.zeros(n, np.uint32)
        out[begins[literal]] = values
        for to, length, far_ in tokens:
            out[to : to + length] = out[to - far_ : to - far_ + length] if far_ >= length else np.resize(out[to - far_ : to], length)
    else:
        green_only = bytearray(n)
        np.frombuffer(green_only, np.uint8)[begins[literal]] = symbol[literal]
        for to, length, far_ in tokens:
            if far_ >= length:
                green_only[to : to + length] = green_only[to - far_ : to - far_ + length]
            else:
                green_only[to : to + length] = (green_only[to - far_ : to] * (length // far_ + 1))[:length]
        out = (np.frombuffer(green_only, np.uint8).astype(np.uint32) << 8) | np.uint32(rest)
    bits.at = int(place[last]) + int(green.sizes[slot[last]])
    if len(copy) and copy[-1] == last:
        bits.at = int(after[-1] + more[-1]) + int(EXTRA[far_of(after[-1:])[0][0]])
    elif more_of and len(literal) and literal[-1] == last:
        bits.at = int(literal_ends[-1])
    if bits.at > bits.end:
        raise WebPError("the stream ends early")
    return out


def _any_with_cache(n: int, symbols: list[int], argb: list[int], fresh: list[int], back: list[int], cache_bits: int) -> list[int]:
    """Pixels of tokens; every pixel goes into the cache as it comes."""
    out, cache, at = [0] * n, [0] * (1 << cache_bits), 0
    for s, value, count, far in zip(symbols, argb, fresh, back, strict=False):
        for k in range(at, at + count):
            pixel = out[k] = out[k - far] if far else value if s < 256 else cache[s - 280]
            cache[_cache_key(pixel, cache_bits)] = pixel
        at += count
    return out


def _with_cache(out: bytearray, symbols: list[int], fresh: list[int], back: list[int], rest: int, cache_bits: int) -> bool:
    """Fills ``out`` from tokens; False where a cache entry still is as it began."""
    keys = [_cache_key(rest | g << 8, cache_bits) for g in range(256)]
    cache: list[int | None] = [None] * (1 << cache_bits)
    at = 0
    for s, n, far in zip(symbols, fresh, back, strict=False):
        if s < 256:
            out[at] = s
            cache[keys[s]] = s
        elif far:
            same = (out[at - far : at] * (n // far + 1))[:n]
            out[at : at + n] = same
            for s in same[-far:]:
                cache[keys[s]] = s
        else:
            s = cache[s - 280]
            if s is None:
                return False
            out[at] = s
        at += n
    return True


# --- transforms, inverted ----------------------------------------------------


def _split(argb: np.ndarray) -> list[np.ndarray]:
    return [(argb >> s).astype(np.uint8) for s in (24, 16, 8, 0)]


def _merge(a, r, g, b) -> np.ndarray:
    a, r, g, b = (x.astype(np.uint32) for x in (a, r, g, b))
    return (a << 24) | (r << 16) | (g << 8) | b


def _add_green(argb: np.ndarray, sign: int = 1) -> np.ndarray:
    green = (argb >> 8) & np.uint32(0xFF)
    both = green | (green << 16)
    if sign < 0:
        both = np.uint32(0x01000100) - both
    return (((argb & np.uint32(0x00FF00FF)) + both) & np.uint32(0x00FF00FF)) | (argb & np.uint32(0xFF00FF00))


def _spread(image: np.ndarray, block: int, shape: tuple[int, int]) -> np.ndarray:
    return image.repeat(1 << block, 0).repeat(1 << block, 1)[: shape[0], : shape[1]]


def _cross(argb: np.ndarray, elements: np.ndarray, block: int, sign: int = 1) -> np.ndarray:
    _, to_blue_r, to_blue_g, to_red = (x.view(np.int8).astype(np.int32) for x in _split(_spread(elements, block, argb.shape)))
    a, r, g, b = _split(argb)
    signed = lambda x: x.view(np.int8).astype(np.int32)
    new_r = (r.astype(np.int32) + sign * ((to_red * signed(g)) >> 5)).astype(np.uint8)
    red = new_r if sign > 0 else r
    new_b = (b.astype(np.int32) + sign * ((to_blue_g * signed(g)) >> 5) + sign * ((to_blue_r * signed(red)) >> 5)).astype(np.uint8)
    return _merge(a, new_r, g, new_b)


def _unbundle(argb: np.ndarray, colors: np.ndarray, width: int, pack: int) -> np.ndarray:
    index = (argb >> 8) & 0xFF
    if pack:
        each = 8 >> pack
        index = (index[:, :, None] >> (each * np.arange(1 << pack, dtype=np.uint32))) & ((1 << each) - 1)
        index = index.reshape(argb.shape[0], -1)[:, :width]
    table = np.zeros(256, np.uint32)
    table[: len(colors)] = colors
    return table[index]


def _avg(a: int, b: int) -> int:
    return (((a ^ b) & 0xFEFEFEFE) >> 1) + (a & b)


def _each(f, *colors: int) -> int:
    return sum(f(*[(c >> s) & 255 for c in colors]) << s for s in (24, 16, 8, 0))


def _clamp(x: int) -> int:
    return 0 if x < 0 else 255 if x > 255 else x


def _select(left: int, top: int, corner: int) -> int:
    to_left = to_top = 0
    for s in (24, 16, 8, 0):
        x, t, c = (left >> s) & 255, (top >> s) & 255, (corner >> s) & 255
        to_left += abs(t - c)
        to_top += abs(x - c)
    return left if to_left < to_top else top


def _predict(mode: int, left: int, top: int, right: int, corner: int) -> int:
    """From the pixel to the left, above, above right and above left."""
    if mode == 11:
        return _select(left, top, corner)
    if mode == 12:
        return _each(lambda x, t, c: _clamp(x + t - c), left, top, corner)
    if mode == 13:
        half = _avg(left, top)
        return _each(lambda h, c: _clamp(h + int((h - c) / 2)), half, corner)
    return {
        1: left, 2: top, 3: right, 4: corner,
        5: _avg(_avg(left, right), top), 6: _avg(left, corner), 7: _avg(left, top),
        8: _avg(corner, top), 9: _avg(top, right), 10: _avg(_avg(left, corner), _avg(top, right)),
    }.get(mode, BLACK)


def _add(a: int, b: int, sign: int = 1) -> int:
    return sum(((((a >> s) & 255) + sign * ((b >> s) & 255)) & 255) << s for s in (24, 16, 8, 0))


def _predictions(pixels: list[int], width: int, at: int, mode: int) -> int:
    y, x = divmod(at, width)
    if y == 0:
        return pixels[at - 1] if x else BLACK
    if x == 0:
        return pixels[at - width]
    # above the last column's right neighbour stands the current row's first pixel
    return _predict(mode, pixels[at - 1], pixels[at - width], pixels[at - width + 1], pixels[at - width - 1])


def _unpredict(argb: np.ndarray, modes: np.ndarray, block: int) -> np.ndarray:
    """Rows of one mode that looks only left or only up are summed at once."""
    height, width = argb.shape
    modes = (modes >> 8) & 15
    channels = argb.astype("<u4").view(np.uint8).reshape(height, width, 4).copy()
    for y in range(height):
        own = modes[y >> block]
        mode = 1 if not y else int(own[0]) if (own == own[0]).all() else -1
        if mode == 1:
            channels[y, 0] += channels[y - 1, 0] if y else np.array([0, 0, 0, 255], np.uint8)
            channels[y] = np.cumsum(channels[y], axis=0, dtype=np.uint8)
        elif mode == 2:
            channels[y] += channels[y - 1]
        else:
            pixels = channels[y - 1 : y + 1].view("<u4").ravel().tolist()
            for x in range(width):
                at = width + x
                # above the last column's right neighbour stands the current row's first pixel
                guess = _predict(int(own[x >> block]), pixels[at - 1], pixels[x], pixels[x + 1], pixels[x - 1]) if x else pixels[0]
                pixels[at] = _add(pixels[at], guess)
            channels[y] = np.array(pixels[width:], "<u4").view(np.uint8).reshape(width, 4)
    return channels.view("<u4").reshape(height, width).astype(np.uint32)


# --- files -------------------------------------------------------------------


def files(data: bytes) -> list[bytes]:
    """The RIFF files in a row of them."""
    out, at = [], 0
    while at < len(data):
        if data[at : at + 4] != b"RIFF" or data[at + 8 : at + 12] != b"WEBP":
            raise WebPError("no WebP file begins here")
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        out.append(data[at:end])
        at = end
    return out


def _payload(data: bytes) -> bytes:
    at = 12
    while at + 8 <= len(data):
        n = int.from_bytes(data[at + 4 : at + 8], "little")
        if data[at : at + 4] == b"VP8L":
            return data[at + 8 : at + 8 + n]
        at += 8 + n + (n & 1)
    raise WebPError("there is no VP8L chunk")


def decode(data: bytes) -> np.ndarray:
    """uint32 ARGB pixels of one WebP file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise WebPError("not a WebP file")
    bits = Reader(_payload(data))
    if bits.read(8) != 0x2F:
        raise WebPError("no VP8L signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    opaque = not bits.read(1)
    if bits.read(3):
        raise WebPError("unknown version")
    undo, now, kinds = [], width, set()
    while bits.read(1):
        kind = bits.read(2)
        if kind in kinds:
            raise WebPError("a transform comes twice")
        kinds.add(kind)
        if kind in (PREDICTOR, CROSS):
            block = bits.read(3) + 2
            image = _read_pixels(bits, -(-now >> block), -(-height >> block), False)
            undo.append((_unpredict if kind == PREDICTOR else _cross, (image, block)))
        elif kind == GREEN:
            undo.append((_add_green, ()))
        else:
            size = bits.read(8) + 1
            deltas = _read_pixels(bits, size, 1, False)[0]
            colors = _merge(*[np.cumsum(c, dtype=np.uint8) for c in _split(deltas)])
            pack = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
            undo.append((_unbundle, (colors, now, pack)))
            now = -(-now >> pack)
    pixels = _read_pixels(bits, now, height, True)
    for f, args in reversed(undo):
        pixels = f(pixels, *args)
    return pixels | np.uint32(BLACK) if opaque else pixels


def _file(bits: bytes) -> bytes:
    bits = bits + bytes(len(bits) & 1) if len(bits) & 1 else bits
    return b"RIFF" + (len(bits) + 12).to_bytes(4, "little") + b"WEBPVP8L" + len(bits).to_bytes(4, "little") + bits


# --- encoding ----------------------------------------------------------------


def _huffman(counts: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """(symbol, code length) of (symbol, count) pairs, at most ``limit`` long;
    counts are flattened until it fits. Leaves and joined nodes each come in
    order of weight, so the two lightest are at the heads of two queues."""
    while True:
        counts = sorted(counts, key=lambda c: c[1])
        weights = [c for _, c in counts]
        n = len(weights)
        above, leaf, node = [0] * (2 * n), 0, n
        for k in range(n, 2 * n - 1):
            total = 0
            for _ in (0, 1):
                if leaf < n and (node >= k or weights[leaf] <= weights[node]):
                    least, leaf = leaf, leaf + 1
                else:
                    least, node = node, node + 1
                above[least] = k
                total += weights[least]
            weights.append(total)
        far = [0] * (2 * n)
        for k in range(2 * n - 3, -1, -1):
            far[k] = far[above[k]] + 1
        if max(far[:n]) <= limit:
            return [(s, far[k]) for k, (s, _) in enumerate(counts)]
        counts = [(s, (c + 1) // 2) for s, c in counts]


def _put_code(w: Writer, counts: list[tuple[int, int]], size: int, limit: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Writes a code for the counted symbols; bits and lengths by symbol."""
    codes, sizes = np.zeros(size, np.int64), np.zeros(size, np.int64)
    used = sorted(s for s, _ in counts) or [0]
    if len(used) <= 2 and used[-1] < 256:
        w.put(1 | (len(used) - 1) << 1 | int(used[0] > 1) << 2, 3)
        w.put(used[0], 8 if used[0] > 1 else 1)
        if len(used) == 2:
            w.put(used[1], 8)
            codes[used[1]] = 1
            sizes[used] = 1
        return codes, sizes
    if len(used) == 1:  # beyond 255: two symbols, of which one stays unused
        counts = [*counts, (0, 1)]
    for s, n in _huffman(counts, limit):
        sizes[s] = n
    lengths = sizes.tolist()
    tokens = []
    for n, same in groupby(lengths):
        run = len(list(same))
        if n:  # the first as it is, then repeats of it by three to six
            tokens.append((n, 0, 0))
            run -= 1
        most, least = (6, 3) if n else (138, 3)
        while run >= least:
            k = min(run, most)
            tokens.append((16, k - 3, 2) if n else (18, k - 11, 7) if k >= 11 else (17, k - 3, 3))
            run -= k
        tokens += [(n, 0, 0)] * run
    of = Counter(t[0] for t in tokens)
    if len(of) == 1:
        of[0 if 0 not in of else 1] += 1
    of_sizes = [0] * 19
    for s, n in _huffman(list(of.items()), 7):
        of_sizes[s] = n
    w.put(15 << 1, 5)
    for k in LENGTH_ORDER:
        w.put(of_sizes[k], 3)
    w.put(0, 1)
    of_codes = _stream_codes(np.array(of_sizes)).tolist()
    own = Writer()
    for s, extra, n in tokens:
        own.put(of_codes[s] | extra << of_sizes[s], of_sizes[s] + n)
    w.put(own.value, own.n)
    return _stream_codes(sizes), sizes


def _stream_codes(sizes: np.ndarray) -> np.ndarray:
    """The canonical code of each symbol, first bit lowest."""
    used, slots, depth = _canonical(sizes)
    codes = np.zeros(len(sizes), np.int64)
    codes[used] = _reversed(depth)[np.cumsum(slots) - slots]  # only the first bits of a slot's number are set
    return codes


def _prefixed(value: int) -> tuple[int, int, int]:
    """(prefix, extra value, extra bits) of a length or distance from 1 up."""
    if value <= 4:
        return value - 1, 0, 0
    v = value - 1
    top = v.bit_length() - 1
    second = (v >> (top - 1)) & 1
    return 2 * top + second, v - ((2 + second) << (top - 1)), top - 1


def _tokens(pixels: list[int], cache_bits: int, references: bool) -> list[tuple]:
    out, at, cache, last = [], 0, [0] * (1 << cache_bits) if cache_bits else [], {}
    while at < len(pixels):
        run, far = 0, 0
        if references and at + 3 <= len(pixels):
            then = last.get(tuple(pixels[at : at + 3]))
            if then is not None:
                far = at - then
                while at + run < len(pixels) and run < 4096 and pixels[at + run] == pixels[at + run - far]:
                    run += 1
        if run >= 3:
            out.append(("copy", run, far))
        elif cache and cache[_cache_key(pixels[at], cache_bits)] == pixels[at]:
            out.append(("cache", _cache_key(pixels[at], cache_bits)))
            run = 1
        else:
            out.append(("literal", pixels[at]))
            run = 1
        for k in range(at, at + run):
            last[tuple(pixels[k : k + 3])] = k
            if cache:
                cache[_cache_key(pixels[k], cache_bits)] = pixels[k]
        at += run
    return out


def _write_pixels(w: Writer, image: np.ndarray, main: bool, cache_bits: int = 0, references: bool = False, block: int = 0) -> None:
    """``block`` over 1: a group of prefix codes for each second block of that size."""
    height, width = image.shape
    w.put(int(cache_bits > 0), 1)
    if cache_bits:
        w.put(cache_bits, 4)
    of_block = None
    if main:
        w.put(int(block > 1), 1)
        if block > 1:
            shape = (-(-height >> block), -(-width >> block))
            of_block = np.indices(shape).sum(0) % 2
            w.put(block - 2, 3)
            _write_pixels(w, (of_block.astype(np.uint32)) << 8, False)
    near = {x + y * width: k + 1 for k, (x, y) in reversed(list(enumerate(NEAR))) if x + y * width >= 1}
    coded, at = [], 0
    for token in _tokens(image.ravel().tolist(), cache_bits, references):
        group = int(of_block[at // width >> block][at % width >> block]) if of_block is not None else 0
        if token[0] == "literal":
            p = token[1]
            coded.append((group, [(0, (p >> 8) & 255), (1, (p >> 16) & 255), (2, p & 255), (3, p >> 24)], []))
            at += 1
        elif token[0] == "cache":
            coded.append((group, [(0, 280 + token[1])], []))
            at += 1
        else:
            length, distance = _prefixed(token[1]), _prefixed(near.get(token[2], token[2] + 120))
            coded.append((group, [(0, 256 + length[0]), (4, distance[0])], [length[1:], distance[1:]]))
            at += token[1]
    counts = [[Counter() for _ in range(5)] for _ in range(2 if of_block is not None and of_block.max() else 1)]
    for group, symbols, _ in coded:
        for which, s in symbols:
            counts[group][which][s] += 1
    cache = 1 << cache_bits if cache_bits else 0
    codes = [[_put_code(w, list(c.items()), ALPHABETS[k] + (cache if not k else 0)) for k, c in enumerate(g)] for g in counts]
    for group, symbols, extras in coded:
        for k, (which, s) in enumerate(symbols):
            bits, sizes = codes[group][which]
            w.put(int(bits[s]), int(sizes[s]))
            if extras:
                w.put(*extras[k])


def encode(
    argb: np.ndarray,
    modes: np.ndarray | None = None,
    elements: np.ndarray | None = None,
    green: bool = False,
    palette: bool = False,
    transform_block: int = 2,
    cache_bits: int = 0,
    references: bool = True,
    group_block: int = 0,
) -> bytes:
    """A WebP file of uint32 ARGB pixels, with the transforms asked for:
    ``modes`` (predictor) and ``elements`` (cross-colour) are images with a
    pixel for each block of ``1 << transform_block`` pixels."""
    height, width = argb.shape
    w = Writer()
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(int(bool((argb >> 24 != 255).any())), 1)
    w.put(0, 3)
    image = argb.astype(np.uint32)
    if palette:
        colors = np.unique(image)
        pack = 3 if len(colors) <= 2 else 2 if len(colors) <= 4 else 1 if len(colors) <= 16 else 0
        w.put(1 | PALETTE << 1, 3)
        w.put(len(colors) - 1, 8)
        deltas = _merge(*[np.diff(c, prepend=np.uint8(0)) for c in _split(colors)])
        _write_pixels(w, deltas[None], False)
        index = np.searchsorted(colors, image).astype(np.uint32)
        index = np.pad(index, ((0, 0), (0, -width % (1 << pack)))).reshape(height, -1, 1 << pack)
        image = (index << ((8 >> pack) * np.arange(1 << pack, dtype=np.uint32))).sum(2, dtype=np.uint32) << 8
    if modes is not None:
        w.put(1 | PREDICTOR << 1, 3)
        w.put(transform_block - 2, 3)
        _write_pixels(w, modes, False)
        mode = ((_spread(modes, transform_block, image.shape) >> 8) & 15).ravel().tolist()
        pixels = image.ravel().tolist()
        left = [_add(p, _predictions(pixels, image.shape[1], k, mode[k]), -1) for k, p in enumerate(pixels)]
        image = np.array(left, np.uint32).reshape(image.shape)
    if elements is not None:
        w.put(1 | CROSS << 1, 3)
        w.put(transform_block - 2, 3)
        _write_pixels(w, elements, False)
        image = _cross(image, elements, transform_block, -1)
    if green:
        w.put(1 | GREEN << 1, 3)
        image = _add_green(image, -1)
    w.put(0, 1)
    _write_pixels(w, image, True, cache_bits, references, group_block)
    return _file(w.bytes())


#: Shortest copy that is worth its length and distance.
COPY = 8

#: Longest copy, and the format's largest distance; 120 codes are for near ones.
LONGEST, FARTHEST = 4096, (1 << 20) - 120

#: Longest prefix code that is written: tables of readers stay small.
DEEPEST = 10

#: Share of pixels equal to the one before them above which the cache is tried.
ALIKE = 0.2


def _copies(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, distances) of back-references in ``data``. Each position
    refers to the last place with the same ``COPY`` values; where the next ones
    refer as far, one copy covers them all."""
    n = len(data)
    m = n - COPY + 1
    if m < 2:
        return (np.zeros(0, np.int64),) * 3
    key = np.ndarray((m,), "<u8", data.tobytes() + bytes(8), 0, (1,)) & np.uint64((1 << 8 * COPY) - 1)
    # a hash above the position: sorted, equal hashes are neighbours in order
    low = np.uint64(max(1, (m - 1).bit_length()))
    mixed = ((key * np.uint64(0x9E3779B97F4A7C15)) >> low) << low
    mixed |= np.arange(m, dtype=np.uint64)
    mixed.sort()
    place = (mixed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    step = np.diff(place)
    mixed >>= low
    hit = np.flatnonzero(mixed[1:] == mixed[:-1])
    to = place[hit + 1]
    far = np.zeros(m + 1, np.int64)
    far[to] = np.where((step[hit] <= FARTHEST) & (key[to] == key[place[hit]]), step[hit], 0)
    # the run of equal distances that a position is in ends at ``end``
    turns = np.flatnonzero(far[1:] != far[:-1]) + 1
    if not len(turns):
        return (np.zeros(0, np.int64),) * 3
    heads = np.r_[0, turns]
    far_of, ends = far[heads], np.r_[turns, m + 1] + COPY - 1
    some = far_of > 0
    heads, ends, far_of = heads[some].tolist(), ends[some].tolist(), far_of[some].tolist()
    starts, runs, fars, at = [], [], [], 0
    for head, end, back in zip(heads, ends, far_of, strict=True):
        if at > head:
            if end - at < COPY:
                continue
            head = at
        while head < end:
            run = min(end - head, LONGEST)
            if run < COPY:
                break
            starts.append(head)
            runs.append(run)
            fars.append(back)
            head += run
        at = head
    return np.array(starts, np.int64), np.array(runs, np.int64), np.array(fars, np.int64)


def _cost(counts: np.ndarray) -> float:
    """Estimated bits of symbols with these counts and of the code for them."""
    counts = counts[counts > 0]
    return float((counts * np.log2(counts.sum() / counts)).sum()) + 5 * len(counts) if len(counts) else 0.0


def _prefix_table(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_prefixed`` of each value."""
    v = values - 1
    extra = np.maximum(np.frexp(np.maximum(v, 1).astype(float))[1].astype(np.int64) - 2, 0)
    return np.where(v < 4, v, 2 * extra + (v >> extra)), np.where(v < 4, 0, v & ((1 << extra) - 1)), np.where(v < 4, 0, extra)


_SMALL = _prefix_table(np.arange(1 << 13))


def _prefixes_of(values: np.ndarray) -> tuple[np.ndarray, ...]:
    if len(values) and values.max() >= len(_SMALL[0]):
        return _prefix_table(values)
    return tuple(of[values] for of in _SMALL)


def _residues(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the left and the upper predictor leave of grey samples."""
    flat, width = samples.ravel(), samples.shape[1]
    left, upper = flat.copy(), flat.copy()
    left[1:] -= flat[:-1]
    upper[width:] -= flat[:-width]
    upper[1:width] = left[1:width]
    left[width::width] = upper[width::width]
    return left, upper


def _cached(data: np.ndarray, literal: np.ndarray, alpha: int) -> tuple[float, np.ndarray, int]:
    """The least (cost, symbols, bits) of literals with a colour cache or without."""
    best = (_cost(np.bincount(data[literal])), data.astype(np.int64), 0)
    if np.count_nonzero(data[1:] == data[:-1]) <= ALIKE * len(data):
        return best
    for trial in (1, 2, 4):
        if (alpha, trial) not in _KEYS:
            _KEYS[alpha, trial] = np.array([_cache_key((alpha << 24) | (v << 8), trial) for v in range(256)], np.uint8)
        key = _KEYS[alpha, trial][data]
        order = np.argsort(key, kind="stable")
        hit = np.zeros(len(data), bool)
        hit[order[1:]] = data[order[1:]] == data[order[:-1]]  # a key's last colour is this one
        symbols = np.where(hit, 280 + key.astype(np.int64), data)
        cost = _cost(np.bincount(symbols[literal])) + 4
        if cost < best[0]:
            best = (cost, symbols, trial)
    return best


_KEYS: dict[tuple[int, int], np.ndarray] = {}
_NEAR: dict[int, np.ndarray] = {}


def _distance_codes(fars: np.ndarray, width: int) -> np.ndarray:
    if width not in _NEAR:
        _NEAR.clear()
        of = np.arange(121, 121 + 8 * width + 16)
        for k, (x, y) in reversed(list(enumerate(NEAR))):
            if x + y * width >= 1:
                of[x + y * width - 1] = k + 1
        _NEAR[width] = of
    of = _NEAR[width]
    return np.where(fars <= len(of), of[np.minimum(fars, len(of)) - 1], fars + 120)


def encode_grey(samples: np.ndarray) -> bytes:
    """A WebP file of 8-bit grey samples (height, width): subtract-green, prefix
    codes by frequency and back-references; the left or upper predictor, a packed
    palette (of at most 16 values) and the colour cache where they cost fewer bits
    by estimate. Cross-colour has nothing to take away: red and blue are zero once
    green is subtracted."""
    height, width = samples.shape
    w = Writer()
    w.put(0x2F | (width - 1) << 8 | (height - 1) << 22, 40)
    w.put(1 | GREEN << 1, 3)
    left, upper = _residues(samples)
    plain = np.ascontiguousarray(samples).ravel()
    counts = [np.bincount(x, minlength=256) for x in (plain, left, upper)]
    costs = [_cost(c) + 300 * bool(k) for k, c in enumerate(counts)]
    if min(costs) < costs[0]:  # against a predictor stands what the cache could do without one
        costs[0] = _cached(plain, np.ones(len(plain), bool), 255)[0]
    kind = costs.index(min(costs))
    data, alpha, pixels_wide = (plain, left, upper)[kind], 0 if kind else 255, width
    seen = np.flatnonzero(counts[0])
    pack = 3 if len(seen) <= 2 else 2 if len(seen) <= 4 else 1 if len(seen) <= 16 else 0
    if pack:
        rank = np.zeros(256, np.uint8)
        rank[seen] = np.arange(len(seen))
        index = np.pad(rank[samples], ((0, 0), (0, -width % (1 << pack)))).reshape(height, -1, 1 << pack)
        packed = (index << ((8 >> pack) * np.arange(1 << pack, dtype=np.uint8))).sum(2, dtype=np.uint8)
        if _cost(np.bincount(packed.ravel())) + 16 * len(seen) < costs[kind]:
            kind, data, alpha, pixels_wide = 3, packed.ravel(), 0, packed.shape[1]
    if kind == 3:
        w.put(1 | PALETTE << 1, 3)
        w.put(len(seen) - 1, 8)
        colors = np.uint32(BLACK) | seen.astype(np.uint32) << 8
        _write_pixels(w, _merge(*[np.diff(c, prepend=np.uint8(0)) for c in _split(colors)])[None], False)
    elif kind:
        w.put(1 | PREDICTOR << 1, 3)
        w.put(7, 3)
        _write_pixels(w, np.full((-(-height >> 9), -(-width >> 9)), kind << 8, np.uint32), False)
    w.put(0, 1)
    starts, runs, fars = _copies(data)
    covered = np.zeros(len(data) + 1, np.int64)
    covered[starts] = 1
    covered[starts + runs] -= 1
    literal = np.cumsum(covered[:-1]) == 0
    _, symbols, cache_bits = _cached(data, literal, alpha)
    w.put(int(cache_bits > 0), 1)
    if cache_bits:
        w.put(cache_bits, 4)
    w.put(0, 1)
    length, distance = _prefixes_of(runs), _prefixes_of(_distance_codes(fars, pixels_wide))
    symbols[starts] = 256 + length[0]
    literal[starts] = True
    tokens = symbols[literal]
    size = ALPHABETS[0] + (1 << cache_bits if cache_bits else 0)
    used = np.bincount(tokens, minlength=size)
    seen = np.flatnonzero(used)
    bits, sizes = _put_code(w, list(zip(seen.tolist(), used[seen].tolist(), strict=True)), size, DEEPEST)
    w.put(0b00010001, 8)  # red and blue: simple codes of one symbol, 0
    w.put(alpha << 3 | 5 if alpha else 1, 11 if alpha else 4)
    far_bits, far_sizes = _put_code(w, list(Counter(distance[0].tolist()).items()), ALPHABETS[4], DEEPEST)
    # two items a copy: its length and its distance, each with extra bits
    copying = (tokens > 255) & (tokens < 280)
    copy = np.flatnonzero(copying)
    values, widths = bits[tokens], sizes[tokens]
    values[copy] |= length[1] << widths[copy]
    widths[copy] += length[2]
    values, widths = np.repeat(values, copying + 1), np.repeat(widths, copying + 1)
    second = copy + np.arange(1, len(copy) + 1)
    values[second] = far_bits[distance[0]] | distance[1] << far_sizes[distance[0]]
    widths[second] = far_sizes[distance[0]] + distance[2]
    return _file(_joined(w, values, widths))


def _joined(w: Writer, items: np.ndarray, sizes: np.ndarray) -> bytes:
    """What ``w`` holds and the items behind it, each of at most 31 bits."""
    head = w.value >> (w.n & ~31), w.n & 31
    ends = head[1] + np.cumsum(sizes)
    at = ends - sizes
    total, word = int(ends[-1]) if len(ends) else head[1], at >> 5
    items = items << (at & 31)
    # no two items share a bit, so sums are unions, and exact below 2**53
    out = np.zeros((total >> 5) + 2)
    low = np.bincount(word, (items & 0xFFFFFFFF).astype(float), len(out))
    high = np.bincount(word + 1, (items >> 32).astype(float), len(out))
    out = (low[: len(out)] + high[: len(out)]).astype("<u4")
    out[0] |= np.uint32(head[0])
    start = (w.value & ((1 << (w.n & ~31)) - 1)).to_bytes((w.n & ~31) >> 3, "little")
    return start + out.tobytes()[: (total + 7) >> 3]


def samples_of(argb: np.ndarray) -> np.ndarray:
    """The grey samples of ``argb``: its green channel."""
    return ((argb >> 8) & 0xFF).astype(np.uint8)
