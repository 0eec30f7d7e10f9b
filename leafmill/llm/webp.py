"""Lossless WebP (VP8L): a decoder of every feature of the format, and encoders.

decode() reads prefix codes (one set or one per tile), back-references, the colour cache, and inverts the
predictor, cross-colour, subtract-green and palette transforms. encode() writes any of these.
encode_texts() and decode_many() are for many images with the fixed text code below and no
transforms: the images are decoded together, one symbol of each per step. Any other file among them goes
to decode(); webp_many reads and writes many with codes of their own. Pixels are arrays of R, G, B, A bytes.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import struct
from collections import Counter

import numpy as np

#: Values fixed by the format: order of code-length codes, the near pixels of distance codes 1 to 120, and the least repeats and extra bits of codes of repeated lengths.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3),
    (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0),
    (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4),
    (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
REPEATS = {16: (3, 2), 17: (3, 3), 18: (11, 7)}
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
HASH = 0x1E35A7BD
BLACK = 0xFF000000


class BitReader:
    """Bits of `data` from the bit `at`; `words` has the 64 bits from each byte on, so up to 57 bits are one look."""

    def __init__(self, data: bytes):
        self.at, self.end = 0, 8 * len(data) + 64
        wide = np.frombuffer(data + bytes(24), np.uint8).astype(np.uint64)
        words = wide[:-8].copy()
        for k in range(1, 8):
            words |= wide[k : k - 8] << np.uint64(8 * k)
        self.words: list[int] = words.tolist()

    def bits(self, n: int) -> int:
        at, self.at = self.at, self.at + n
        if at + n > self.end:
            raise ValueError("the image ends too early")
        return (self.words[at >> 3] >> (at & 7)) & ((1 << n) - 1)


class BitWriter:
    def __init__(self):
        self.value, self.n = 0, 0
        self.out = bytearray()

    def bits(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n
        while self.n >= 8:
            self.out.append(self.value & 255)
            self.value >>= 8
            self.n -= 8

    def many(self, value: int, n: int) -> None:
        value, n = self.value | value << self.n, self.n + n
        self.out += (value & ((1 << (n & ~7)) - 1)).to_bytes(n >> 3, "little")
        self.value, self.n = value >> (n & ~7), n & 7

    def fields(self, values: np.ndarray, sizes: np.ndarray) -> None:
        """Many values (unsigned 64-bit) of up to 32 bits each."""
        values, sizes = np.append(np.uint64(self.value), values), np.append(np.int64(self.n), sizes)
        ends = np.cumsum(sizes)
        at = ends - sizes
        word = at >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        joined = np.bitwise_or.reduceat(values << (at & 31).astype(np.uint64), first)
        out = np.zeros(int(word[-1]) + 2, np.uint32)
        out[word[first]] = (joined & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        out[word[first] + 1] |= (joined >> np.uint64(32)).astype(np.uint32)
        raw, total = out.tobytes(), int(ends[-1])
        self.out += raw[: total >> 3]
        self.n = total & 7
        self.value = raw[total >> 3] & ((1 << self.n) - 1) if self.n else 0

    def done(self) -> bytes:
        return bytes(self.out) + (bytes([self.value & 255]) if self.n else b"")


#: The 15 bits of each number in the other order.
REVERSED = np.array([int(f"{k:08b}"[::-1], 2) for k in range(256)])
REVERSED = ((REVERSED[np.arange(1 << 15) & 255] << 7) | (REVERSED[np.arange(1 << 15) >> 8] >> 1)).tolist()


def _canonical(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """Bit-reversed code and its length for each symbol with a length over 0."""
    code, last, found = 0, 0, {}
    for length, symbol in sorted([(n, s) for s, n in enumerate(lengths) if n]):
        code <<= length - last
        last = length
        found[symbol] = (REVERSED[code] >> (15 - length), length)
        code += 1
    return found


class Prefix:
    """A prefix code, read through one table of its longest length; an entry is a symbol and, in its last four bits, the length."""

    def __init__(self, lengths: list[int]):
        used = [s for s, n in enumerate(lengths) if n]
        self.longest, self.only = 0, used[0] if len(used) == 1 else None
        if len(used) > 1:
            self.longest = max(lengths)
            if sum(1 << (self.longest - n) for n in lengths if n) != 1 << self.longest:
                raise ValueError("not a complete prefix code")
            self.table: list[int] = [0] * (1 << self.longest)
            for s, (code, n) in _canonical(lengths).items():
                self.table[code :: 1 << n] = [s << 4 | n] * (1 << (self.longest - n))
        elif not used:
            self.only = 0
        if self.only is not None:
            self.table = [self.only << 4]
        self.mask = (1 << self.longest) - 1

    def read(self, r: BitReader) -> int:
        found = self.table[(r.words[r.at >> 3] >> (r.at & 7)) & self.mask]
        r.at += found & 15
        if r.at > r.end:
            raise ValueError("the image ends too early")
        return found >> 4


def _read_code(r: BitReader, alphabet: int) -> Prefix:
    lengths = [0] * alphabet
    if r.bits(1):
        two = r.bits(1)
        lengths[r.bits(8 if r.bits(1) else 1)] = 1
        if two:
            lengths[r.bits(8)] = 1
        return Prefix(lengths)
    own = [0] * 19
    for i in range(4 + r.bits(4)):
        own[LENGTH_ORDER[i]] = r.bits(3)
    code = Prefix(own)
    left = 2 + r.bits(2 + 2 * r.bits(3)) if r.bits(1) else alphabet
    at, before = 0, 8
    words, place, table, mask = r.words, r.at, code.table, code.mask
    while at < alphabet and left > 0:
        if place > r.end:
            raise ValueError("the image ends too early")
        left -= 1
        bits = words[place >> 3] >> (place & 7)
        found = table[bits & mask]
        n, k = found >> 4, found & 15
        place += k
        if n < 16:
            lengths[at] = n
            before = n or before
            at += 1
            continue
        times, value = REPEATS[n]
        times += bits >> k & ((1 << value) - 1)
        place += value
        if at + times > alphabet:
            raise ValueError("too many code lengths")
        if n == 16:
            lengths[at : at + times] = [before] * times
        at += times
    r.at = place
    return Prefix(lengths)


def _extra(r: BitReader, prefix: int) -> int:
    if prefix < 4:
        return prefix + 1
    n = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << n) + r.bits(n) + 1


def _read_pixels(r: BitReader, width: int, height: int, main: bool) -> list[int]:
    """Pixels as 0xAARRGGBB."""
    cache_bits = r.bits(4) if r.bits(1) else 0
    if cache_bits > 11:
        raise ValueError("the colour cache is too large")
    tile_bits, tiles, groups = 0, None, 1
    if main and r.bits(1):
        tile_bits = r.bits(3) + 2
        tiles = [(p >> 8) & 0xFFFF for p in _read_pixels(r, _tiles(width, tile_bits), _tiles(height, tile_bits), False)]
        groups = max(tiles) + 1
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    codes = [[_read_code(r, n) for n in sizes] for _ in range(groups)]
    cache, shift = [0] * (1 << cache_bits), 32 - cache_bits
    out: list[int] = []
    total, done = width * height, 0
    across = _tiles(width, tile_bits)
    words, place, last = r.words, r.at, r.end
    one = None if tiles else codes[0]
    while (at := len(out)) < total:
        green, red, blue, alpha, distance = one or codes[tiles[(at // width >> tile_bits) * across + (at % width >> tile_bits)]]
        if place > last:
            raise ValueError("the image ends too early")
        bits = words[place >> 3] >> (place & 7)
        found = green.table[bits & green.mask]
        s, n = found >> 4, found & 15
        if s < 256:
            bits >>= n
            place += n
            found = red.table[bits & red.mask]
            p, n = found >> 4 << 16 | s << 8, found & 15
            bits >>= n
            place += n
            found = blue.table[bits & blue.mask]
            n = found & 15
            p |= found >> 4
            place += n
            found = alpha.table[(words[place >> 3] >> (place & 7)) & alpha.mask]
            place += found & 15
            out.append(found >> 4 << 24 | p)
            continue
        r.at = place + n
        if s < 280:
            n = _extra(r, s - 256)
            d = _extra(r, distance.read(r))
            d = d - 120 if d > 120 else max(1, NEAR[d - 1][0] + NEAR[d - 1][1] * width)
            if d > at or at + n > total:
                raise ValueError("a back-reference leaves the image")
            for _ in range(n):
                out.append(out[-d])
        else:
            while done < at:
                cache[(HASH * out[done] & 0xFFFFFFFF) >> shift] = out[done]
                done += 1
            out.append(cache[s - 280])
        place = r.at
    r.at = place
    if place > last:
        raise ValueError("the image ends too early")
    return out


def _tiles(n: int, bits: int) -> int:
    return (n + (1 << bits) - 1) >> bits


def _add(a: int, b: int) -> int:
    return ((a & 0xFF00FF00) + (b & 0xFF00FF00)) & 0xFF00FF00 | ((a & 0x00FF00FF) + (b & 0x00FF00FF)) & 0x00FF00FF


def _sub(a: int, b: int) -> int:
    return (0x00FF00FF + (a & 0xFF00FF00) - (b & 0xFF00FF00)) & 0xFF00FF00 | (0xFF00FF00 + (a & 0x00FF00FF) - (b & 0x00FF00FF)) & 0x00FF00FF


def _each(f, *pixels: int) -> int:
    return sum(f(*[(p >> s) & 255 for p in pixels]) << s for s in (0, 8, 16, 24))


def _half(a: int, b: int) -> int:
    return _each(lambda x, y: (x + y) >> 1, a, b)


def _clip(x: int) -> int:
    return min(255, max(0, x))


def _select(left: int, top: int, corner: int) -> int:
    apart = lambda a: sum(abs(((left >> s) & 255) + ((top >> s) & 255) - ((corner >> s) & 255) - ((a >> s) & 255)) for s in (0, 8, 16, 24))
    return left if apart(left) < apart(top) else top


def _predict(mode: int, left: int, top: int, corner: int, right: int) -> int:
    """The 14 predictors; right: the pixel above and to the right."""
    if mode == 11:
        return _select(left, top, corner)
    if mode == 12:
        return _each(lambda a, b, c: _clip(a + b - c), left, top, corner)
    if mode == 13:
        return _each(lambda a, c: _clip(a + int((a - c) / 2)), _half(left, top), corner)
    return (
        lambda: BLACK, lambda: left, lambda: top, lambda: right, lambda: corner, lambda: _half(_half(left, right), top), lambda: _half(left, corner), lambda: _half(left, top),
        lambda: _half(corner, top), lambda: _half(top, right), lambda: _half(_half(left, corner), _half(top, right)),
    )[mode if mode < 11 else 0]()


def _predicted(pixels: list[int], at: int, width: int, mode: int) -> int:
    y, x = divmod(at, width)
    if not y:
        return pixels[at - 1] if x else BLACK
    if not x:
        return pixels[at - width]
    return _predict(mode, pixels[at - 1], pixels[at - width], pixels[at - width - 1], pixels[at - width + 1])


def _signed(x: int) -> int:
    return (x & 255) - 256 * ((x >> 7) & 1)


def _cross(p: int, element: int, sign: int) -> int:
    """Add (sign 1) or take away (-1) what green gives red and blue, and red gives blue."""
    red, green, blue = p >> 16 & 255, p >> 8 & 255, p & 255
    part = lambda factor, value: _signed(factor) * _signed(value) >> 5
    new_red = (red + sign * part(element, green)) & 255
    new_blue = (blue + sign * (part(element >> 8, green) + part(element >> 16, new_red if sign > 0 else red))) & 255
    return p & 0xFF00FF00 | new_red << 16 | new_blue


def _green(p: int, sign: int) -> int:
    g = p >> 8 & 255
    return p & 0xFF00FF00 | ((p >> 16) + sign * g & 255) << 16 | ((p & 255) + sign * g & 255)


def _bundle_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def decode(data: bytes) -> np.ndarray:
    """The pixels of a lossless WebP file, as (height, width, 4) bytes R, G, B, A."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP" or data[12:16] != b"VP8L" or data[20:21] != b"\x2f":
        raise ValueError("not a lossless WebP file")
    r = BitReader(data[21 : 20 + struct.unpack_from("<I", data, 16)[0]])
    width, height = r.bits(14) + 1, r.bits(14) + 1
    r.bits(1)
    if r.bits(3):
        raise ValueError("unknown version")
    transforms, now = [], width
    while r.bits(1):
        kind = r.bits(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            bits = r.bits(3) + 2
            transforms.append((kind, now, bits, _read_pixels(r, _tiles(now, bits), _tiles(height, bits), False)))
        elif kind == SUBTRACT_GREEN:
            transforms.append((kind, now, 0, []))
        else:
            colours = _read_pixels(r, r.bits(8) + 1, 1, False)
            for i in range(1, len(colours)):
                colours[i] = _add(colours[i], colours[i - 1])
            bits = _bundle_bits(len(colours))
            transforms.append((kind, now, bits, colours))
            now = _tiles(now, bits)
    pixels = _read_pixels(r, now, height, True)
    for kind, w, bits, side in reversed(transforms):
        across = _tiles(w, bits)
        if kind == PREDICTOR:
            for at in range(len(pixels)):
                mode = side[(at // w >> bits) * across + (at % w >> bits)] >> 8 & 15
                pixels[at] = _add(pixels[at], _predicted(pixels, at, w, mode))
        elif kind == CROSS_COLOUR:
            pixels = [_cross(p, side[(i // w >> bits) * across + (i % w >> bits)], 1) for i, p in enumerate(pixels)]
        elif kind == SUBTRACT_GREEN:
            pixels = [_green(p, 1) for p in pixels]
        else:
            depth = 8 >> bits
            index = [pixels[y * across + (x >> bits)] >> 8 >> depth * (x & ((1 << bits) - 1)) & ((1 << depth) - 1) for y in range(height) for x in range(w)]
            pixels = [side[i] if i < len(side) else 0 for i in index]
    argb = np.array(pixels, np.uint32).reshape(height, width)
    return np.stack([argb >> 16 & 255, argb >> 8 & 255, argb & 255, argb >> 24], axis=-1).astype(np.uint8)


def code_lengths(weights: dict[int, float], alphabet: int, longest: int = 15) -> list[int]:
    """Lengths of a Huffman code; weights are raised until none is over `longest`."""
    lengths = [0] * alphabet
    if len(weights) == 1:
        lengths[next(iter(weights))] = 1
        return lengths
    least = 0.0
    while True:
        symbols = sorted(weights)
        heap = [(max(weights[s], least), s, k) for k, s in enumerate(symbols)]
        heapq.heapify(heap)
        above = [0] * len(symbols)
        while len(heap) > 1:
            a = heapq.heappop(heap)
            b = heap[0]
            above[a[2]] = above[b[2]] = len(above)
            heapq.heapreplace(heap, (a[0] + b[0], min(a[1], b[1]), len(above)))
            above.append(0)
        depths = [0] * len(above)
        for k in range(len(above) - 2, -1, -1):
            depths[k] = depths[above[k]] + 1
        depth = dict(zip(symbols, depths, strict=False))
        if not depth or max(depth.values()) <= longest:
            for s, n in depth.items():
                lengths[s] = n
            return lengths
        least = max(2 * least, max(weights.values()) / (1 << longest))


def _write_code(w: BitWriter, lengths: list[int]) -> None:
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and all(s < 256 for s in used):
        used = used or [0]
        w.bits(1, 1)
        w.bits(len(used) - 1, 1)
        w.bits(1, 1)
        for s in used:
            w.bits(s, 8)
        return
    steps: list[tuple[int, int, int]] = []  # symbol, extra value, extra bits
    for value, same in itertools.groupby(lengths):
        n = len(list(same))
        if value:
            steps.append((value, 0, 0))
            n -= 1
        while n:
            kind, least, bits = (16, 3, 2) if value else (17, 3, 3) if n < 11 else (18, 11, 7)
            if n < least:
                steps += [(value, 0, 0)] * n
                break
            take = min(n, least + (1 << bits) - 1)
            steps.append((kind, take - least, bits))
            n -= take
    own = code_lengths(Counter([s for s, _, _ in steps]), 19, 7)
    code = _canonical(own) if sum(map(bool, own)) > 1 else {}
    w.bits(0, 1)
    w.bits(15, 4)
    for k in LENGTH_ORDER:
        w.bits(own[k], 3)
    w.bits(0, 1)
    held, size = 0, 0
    for s, value, n in steps:
        if code:
            c, k = code[s]
            held |= c << size
            size += k
        if n:
            held |= value << size
            size += n
        if size > 400:
            w.many(held, size)
            held, size = 0, 0
    w.many(held, size)


def _prefix_of(value: int) -> tuple[int, int, int]:
    """Prefix symbol, extra value and extra bits of a length or distance code of 1 or more."""
    value -= 1
    if value < 4:
        return value, 0, 0
    n = value.bit_length() - 2
    return 2 * n + 2 + (value >> n & 1), value & ((1 << n) - 1), n


def _write_pixels(w: BitWriter, pixels: list[int], width: int, main: bool, cache_bits: int = 0, references: bool = False, tile_bits: int = 0) -> None:
    w.bits(1 if cache_bits else 0, 1)
    if cache_bits:
        w.bits(cache_bits, 4)
    height = len(pixels) // width
    across = _tiles(width, tile_bits) if tile_bits else 1
    if main:
        w.bits(1 if tile_bits else 0, 1)
        if tile_bits:
            w.bits(tile_bits - 2, 3)
            _write_pixels(w, [t << 8 for t in range(across * _tiles(height, tile_bits))], across, False)
    groups = across * _tiles(height, tile_bits) if tile_bits else 1
    size = 280 + (1 << cache_bits if cache_bits else 0)
    argb = np.array(pixels, np.uint32)
    before = [-1] * len(pixels)
    if references:  # the last place before with the same three pixels
        seen: dict[tuple[int, int, int], int] = {}
        for k, key in enumerate(zip(pixels, pixels[1:], pixels[2:])):  # noqa: B905
            before[k] = seen.get(key, -1)
            seen[key] = k
    slots = (HASH * argb.astype(np.uint64) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - cache_bits) if cache_bits else np.zeros(len(pixels), np.uint64)
    cached = [False] * len(pixels)
    if cache_bits:  # the pixel is the last one before of its slot, which was 0 at first
        order = np.argsort(slots, kind="stable")
        held = np.append(np.uint32(0), argb[order[:-1]])
        held[np.diff(slots[order], prepend=slots[order[0]]) != 0] = 0
        hit = np.empty(len(pixels), bool)
        hit[order] = held == argb[order]
        hit[0] = False
        cached = hit.tolist()
    near = _near(width)
    places, runs = [], []
    at, total = 0, len(pixels)
    while at < total:
        places.append(at)
        if (start := before[at]) >= 0:
            n, most = 3, min(4096, total - at)
            while n < most and pixels[start + n] == pixels[at + n]:
                n += 1
            d = at - start
            runs.append((len(places) - 1, *_prefix_of(n), *_prefix_of(near.get(d, d + 120))))
            at += n
        else:
            at += 1
    at = np.array(places)
    group = np.zeros(len(at), np.int64) if not tile_bits else (at // width >> tile_bits) * across + (at % width >> tile_bits)
    hit, p = np.array(cached)[at], argb[at].astype(np.int64)
    run = np.array(runs, np.int64).reshape(-1, 7)
    hit[run[:, 0]] = False
    literal = ~hit
    literal[run[:, 0]] = False
    symbols = np.stack([p >> 8 & 255, p >> 16 & 255, p & 255, p >> 24], axis=1)
    symbols[hit, 0] = 280 + slots[at[hit]].astype(np.int64)
    symbols[run[:, 0], 0] = 256 + run[:, 1]
    values, sizes = np.zeros((len(at), 4), np.uint64), np.zeros((len(at), 4), np.int64)
    alphabets, codes = (size, 256, 256, 256, 40), []
    for c, n in enumerate(alphabets):
        own = run[:, 4] if c == 4 else symbols[literal, c] if c else symbols[:, 0]
        of = group[run[:, 0]] if c == 4 else group[literal] if c else group
        codes.append((of, own, np.bincount(of * n + own, minlength=groups * n).reshape(groups, n)))
    tables = []
    for g in range(groups):
        for c, n in enumerate(alphabets):
            weights = {s: k for s, k in enumerate(codes[c][2][g].tolist()) if k}
            lengths = code_lengths(weights, n) if weights else [0] * n
            _write_code(w, lengths)
            code, bits = np.zeros(n, np.uint64), np.zeros(n, np.int64)
            if len(weights) > 1:
                made = _canonical(lengths)
                code[list(made)], bits[list(made)] = np.array(list(made.values())).T
            tables.append((code, bits))
    for c, (of, own, _) in enumerate(codes):
        code, bits = np.stack([x[0] for x in tables[c::5]]), np.stack([x[1] for x in tables[c::5]])
        rows = (run[:, 0], 2) if c == 4 else (literal, c) if c else (slice(None), 0)
        values[rows], sizes[rows] = code[of, own], bits[of, own]
    for c, k in ((1, 2), (3, 5)):
        values[run[:, 0], c], sizes[run[:, 0], c] = run[:, k], run[:, k + 1]
    w.fields(values.ravel(), sizes.ravel())


@functools.lru_cache(64)
def _near(width: int) -> dict[int, int]:
    """The codes of near distances in an image of that width."""
    return {max(1, x + y * width): k for k, (x, y) in reversed(list(enumerate(NEAR, 1)))}


def encode(rgba: np.ndarray, transforms: tuple[int, ...] = (), cache_bits: int = 0, references: bool = False, tile_bits: int = 0, mode: int = 11, element: int = 0x00102030) -> bytes:
    """A file with the given transforms, in that order; mode: of the predictor, or -1 for all by turns; element: of the cross-colour transform."""
    height, width, _ = rgba.shape
    r, g, b, a = (rgba[..., c].astype(np.uint32).ravel() for c in range(4))
    pixels = (a << 24 | r << 16 | g << 8 | b).tolist()
    w, now = _head(width, height), width
    for kind in transforms:
        w.bits(1, 1)
        w.bits(kind, 2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            bits, across = 3, _tiles(now, 3)
            w.bits(bits - 2, 3)
            tiles = range(across * _tiles(height, bits))
            side = [(i % 14 if mode < 0 else mode) << 8 if kind == PREDICTOR else element for i in tiles]
            _write_pixels(w, side, across, False)
            of = lambda at: side[(at // now >> bits) * across + (at % now >> bits)]  # noqa: B023, E731
            pixels = [_sub(p, _predicted(pixels, i, now, of(i) >> 8)) if kind == PREDICTOR else _cross(p, of(i), -1) for i, p in enumerate(pixels)]
        elif kind == SUBTRACT_GREEN:
            pixels = [_green(p, -1) for p in pixels]
        else:
            colours = sorted(set(pixels))
            w.bits(len(colours) - 1, 8)
            _write_pixels(w, [colours[0], *[_sub(y, x) for x, y in zip(colours, colours[1:])]], len(colours), False)  # noqa: B905
            place, bits = {c: i for i, c in enumerate(colours)}, _bundle_bits(len(colours))
            across, depth = _tiles(now, bits), 8 >> bits
            packed = [0] * (across * height)
            for i, p in enumerate(pixels):
                y, x = divmod(i, now)
                packed[y * across + (x >> bits)] |= place[p] << depth * (x & ((1 << bits) - 1)) << 8
            pixels, now = [BLACK | p for p in packed], across
    w.bits(0, 1)
    _write_pixels(w, pixels, now, True, cache_bits, references, tile_bits)
    return _riff(w.done())


def _head(width: int, height: int) -> BitWriter:
    w = BitWriter()
    w.bits(width - 1, 14)
    w.bits(height - 1, 14)
    w.bits(1, 1)
    w.bits(0, 3)
    return w


def _riff(bits: bytes) -> bytes:
    chunk = b"\x2f" + bits
    pad = b"\0" * (len(chunk) & 1)
    return b"RIFF" + struct.pack("<I", 12 + len(chunk) + len(pad)) + b"WEBPVP8L" + struct.pack("<I", len(chunk)) + chunk + pad


def _text_weights() -> dict[int, float]:
    """Bytes of running text: frequent letters by falling weight, the other bytes alike."""
    weights = {b: 0.7 for b in range(256)}
    for i, c in enumerate("etaoinshrdlucmfwygpbvk"):
        weights[ord(c)] = 90 / (1 + i * 0.16)
        weights[ord(c.upper())] = 2.0
    return weights | {32: 170.0, 46: 12.0, 44: 8.0, 10: 6.0, 0xC3: 12.0, 255: 4.0} | {b: 1.5 for b in range(0xA0, 0xC0)}


#: The fixed code of text images, of 12 bits at most for each channel.
TEXT_BITS = 12
TEXT = code_lengths(_text_weights(), 256, TEXT_BITS)


def _text_tables() -> tuple[np.ndarray, ...]:
    code, size = np.zeros(256, np.uint64), np.zeros(256, np.int64)
    symbol, step = np.zeros(1 << TEXT_BITS, np.uint8), np.zeros(1 << TEXT_BITS, np.int64)
    for s, (c, n) in _canonical(TEXT).items():
        code[s], size[s] = c, n
        symbol[c :: 1 << n], step[c :: 1 << n] = s, n
    return code, size, symbol, step


CODE, SIZE, SYMBOL, STEP = _text_tables()


def _text_header() -> tuple[int, int]:
    """The bits between the sizes and the pixels of a text image, as a number, and how many they are."""
    w = BitWriter()
    w.bits(1, 1)
    w.bits(0, 3)
    w.bits(0, 1)  # no transform
    w.bits(0, 1)  # no colour cache
    w.bits(0, 1)  # one set of codes
    for lengths in (TEXT + [0] * 24, TEXT, TEXT, TEXT, [0] * 40):
        _write_code(w, lengths)
    n = 8 * len(w.out) + w.n
    return int.from_bytes(w.done(), "little"), n


HEADER, HEADER_BITS = _text_header()
DATA_AT = 28 + HEADER_BITS
#: Payload bytes of a pixel row: 144 pixels of R, G, B, A.
ROW, PIXELS = 576, 144
#: The order of a pixel's samples in the bit stream.
STREAM = np.array([1, 0, 2, 3])


def encode_texts(payloads: list[bytes]) -> list[bytes]:
    """A file of 144 pixels across for each payload (a multiple of 576 bytes, up to 16,384 rows), with the fixed text code."""
    if not payloads:
        return []
    sizes = np.array([len(p) for p in payloads])
    if (sizes % ROW).any() or (sizes == 0).any() or (sizes > ROW << 14).any():
        raise ValueError("a payload has 1 to 16,384 rows of 576 bytes")
    samples = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, 4)[:, STREAM].ravel()
    bits = SIZE[samples]
    ends = np.cumsum(bits)
    last = ends[np.cumsum(sizes) - 1]
    used = np.diff(last, prepend=0)
    chunk = (DATA_AT + used + 7) // 8
    words = (chunk + 3) // 4 + 2  # each image has 32-bit words of its own
    base = np.concatenate([[0], np.cumsum(words)])
    at = ends - bits + np.repeat(base[:-1] * 32 + DATA_AT - (last - used), sizes)
    value = CODE[samples] << (at & 31).astype(np.uint64)
    word = at >> 5
    first = np.flatnonzero(np.diff(word, prepend=-1))
    joined = np.bitwise_or.reduceat(value, first)
    out = np.zeros(base[-1] + 1, np.uint32)
    out[word[first]] |= (joined & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out[word[first] + 1] |= (joined >> np.uint64(32)).astype(np.uint32)
    raw = out.view(np.uint8)
    files = []
    for i, n in enumerate(chunk.tolist()):
        start = 4 * int(base[i])
        head = (PIXELS - 1) | (int(sizes[i]) // ROW - 1) << 14 | HEADER << 28
        own = bytearray(raw[start : start + n].tobytes())
        lead = head.to_bytes((DATA_AT + 7) // 8, "little")
        own[: len(lead) - 1] = lead[:-1]
        own[len(lead) - 1] |= lead[-1]
        files.append(_riff(bytes(own)))
    return files


def is_text(file: bytes) -> bool:
    """Whether the file has the fixed text code and no transforms."""
    return file[12:16] == b"VP8L" and int.from_bytes(file[21 : 21 + (DATA_AT + 7) // 8], "little") >> 28 & ((1 << HEADER_BITS) - 1) == HEADER


def decode_many(files: list[bytes]) -> list[bytes]:
    """The samples (R, G, B, A by rows) of each file; those with the fixed text code are decoded together."""
    out: list[bytes] = [b""] * len(files)
    lanes, rows = [], []
    for i, f in enumerate(files):
        if is_text(f):
            head = int.from_bytes(f[21:25], "little")
            lanes.append(i)
            rows.append((((head >> 14) & 0x3FFF) + 1) * ((head & 0x3FFF) + 1) * 4)
        else:
            out[i] = decode(f).tobytes()
    if not lanes:
        return out
    order = sorted(range(len(lanes)), key=lambda k: -rows[k])
    lanes, counts = [lanes[k] for k in order], np.array([rows[k] for k in order])
    starts = np.cumsum([0] + [len(files[i]) for i in lanes])[:-1]
    data = np.frombuffer(b"".join([files[i] for i in lanes]) + bytes(8), np.uint8).astype(np.uint32)
    window = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16 | data[3:] << 24
    at = (starts + 21) * 8 + DATA_AT
    most = int(counts[0])
    table = np.zeros((most, len(lanes)), np.uint8)
    alive = np.searchsorted(-counts, -np.arange(most), side="left")  # lanes with over k samples
    mask, limit = (1 << TEXT_BITS) - 1, len(window) - 1
    for k in range(most):
        n = alive[k]
        now = at[:n]
        bits = (window[np.minimum(now >> 3, limit)] >> (now & 7).astype(np.uint32)) & mask
        table[k, :n] = SYMBOL[bits]
        now += STEP[bits]
    samples = np.ascontiguousarray(table.T)
    for k, i in enumerate(lanes):
        if at[k] > 8 * (starts[k] + len(files[i])):
            raise ValueError("the image ends too early")
        own = samples[k, : counts[k]].reshape(-1, 4)
        out[i] = own[:, np.argsort(STREAM)].tobytes()
    return out
