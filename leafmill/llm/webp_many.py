"""Lossless WebP images with prefix codes of their own, many at a time.

encode_many() writes, byte for byte, what webp.encode() writes of each image without transforms; decode_many() reads
files together, one token of each per step, and then settles references and the colour cache for all of their
pixels at once. Files with transforms or several sets of codes go to webp.decode(), as does whatever looks wrong: it
says what. Nothing depends on the other images of a call.
"""

from __future__ import annotations

import struct

import numpy as np

from leafmill.llm import webp

U = np.uint64
LONGEST = 15
#: Symbols of green (with a cache of 8 bits), red, blue, alpha and distances, and where they start when put one after another.
CACHE_BITS = 8
ALPHABETS = np.array([280 + (1 << CACHE_BITS), 256, 256, 256, 40])
FROM = np.cumsum(ALPHABETS) - ALPHABETS
SYMBOLS = int(ALPHABETS.sum())
#: A symbol's place beside its weight in one number.
KEY_BITS = 10
ORDER = np.array(webp.LENGTH_ORDER)
REVERSED = np.array(webp.REVERSED)
#: Codes that are built side by side.
BESIDE = 2048
#: Pixels of a file at most that are read together with others: their extra bits are 15 at most, and so are their bytes under PAST.
MOST_PIXELS, PAST = 1 << 14, 1 << 17
#: Images that are written together, files that are read together, and those whose references are settled together.
WRITTEN, READ, SETTLED = 400, 3000, 200


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... inside each of the groups of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def code_lengths(lane: np.ndarray, symbol: np.ndarray, weight: np.ndarray, longest: int, least: np.ndarray | None = None) -> np.ndarray:
    """What webp.code_lengths() gives each code: rows are (lane, symbol, weight), ordered by lane; least: by lane, in units of 1 / 2 ** longest."""
    out = np.ones(len(lane), np.int64)
    if not len(lane):
        return out
    lanes = int(lane[-1]) + 1
    size = np.bincount(lane, minlength=lanes)
    first = np.cumsum(size) - size
    scaled = weight.astype(np.int64) << longest
    least = np.zeros(lanes, np.int64) if least is None else least
    key = np.maximum(scaled, least[lane]) << KEY_BITS | symbol
    by_size = np.argsort(-size, kind="stable")
    by_size = by_size[size[by_size] > 1]
    for start in range(0, len(by_size), BESIDE):
        own = by_size[start : start + BESIDE]
        m = size[own]
        wide = int(m[0])
        rows, cols = np.repeat(np.arange(len(own)), m), _within(m)
        source = first[own][rows] + cols
        keys = np.full((len(own), wide), np.iinfo(np.int64).max)
        keys[rows, cols] = key[source]
        node = np.tile(np.arange(wide), (len(own), 1))
        above = np.zeros((len(own), 2 * wide), np.int64)
        live = np.searchsorted(-m, -np.arange(2, wide + 1), side="right")  # codes with a t-th merge
        every = np.arange(len(own))
        for t, n in enumerate(live.tolist()):
            part, r = keys[:n], every[:n]
            a = part.argmin(axis=1)
            one = part[r, a]
            part[r, a] = np.iinfo(np.int64).max
            b = part.argmin(axis=1)
            two = part[r, b]
            above[r, node[r, a]] = above[r, node[r, b]] = wide + t
            low = (1 << KEY_BITS) - 1
            part[r, b] = (one >> KEY_BITS) + (two >> KEY_BITS) << KEY_BITS | np.minimum(one & low, two & low)
            node[r, b] = wide + t
        depth = np.zeros((len(own), 2 * wide), np.int64)
        for t in range(wide - 3, -1, -1):
            r = every[: live[t + 1]]
            depth[r, wide + t] = depth[r, above[r, wide + t]] + 1
        out[source] = depth[rows, above[rows, cols]] + 1
    over = np.maximum.reduceat(out, first[size > 0]) > longest
    if over.any():
        over = np.flatnonzero(size)[over]
        mine = np.isin(lane, over)
        heaviest = np.maximum.reduceat(scaled, first[size > 0])[np.searchsorted(np.flatnonzero(size), over)]
        raised = np.maximum(2 * least[over], heaviest >> longest)
        out[mine] = code_lengths(np.searchsorted(over, lane[mine]), symbol[mine], weight[mine], longest, raised)
    return out


def canonical(lane: np.ndarray, symbol: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bit-reversed code of each row (lane, symbol, length over 0)."""
    order = np.lexsort((symbol, length, lane))
    share = np.int64(1) << (LONGEST - length[order])
    before = np.cumsum(share) - share
    start = np.flatnonzero(np.diff(lane[order], prepend=-1))
    before -= np.repeat(before[start], np.diff(np.append(start, len(order))))
    code = np.empty(len(order), np.int64)
    code[order] = REVERSED[before & ((1 << LONGEST) - 1)]
    return code


def _prefix_of(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """webp._prefix_of() of each."""
    value = value - 1
    n = np.maximum(np.frexp(value.astype(float))[1] - 2, 0)
    small = value < 4
    return np.where(small, value, 2 * n + 2 + (value >> n & 1)), np.where(small, 0, value & ((1 << n) - 1)), np.where(small, 0, n)


def _before(argb: np.ndarray, image: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The last place before in the image with the same three pixels, or -1; left: pixels from here to the image's end."""
    found = np.full(len(argb), -1)
    at = np.flatnonzero(left >= 3)
    one, two, three, of = argb[at].astype(U), argb[at + 1].astype(U), argb[at + 2].astype(U), image[at].astype(U)
    low, high = one | two << U(32), three | of << U(32)
    mixed = (low * U(0x9E3779B97F4A7C15) ^ low >> U(29)) * U(0xBF58476D1CE4E5B9) + high * U(0xD6E8FEB86659FD93)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    equal = (low[order[1:]] == low[order[:-1]]) & (high[order[1:]] == high[order[:-1]])
    if (same & ~equal).any():  # two kinds under one hash
        order = np.lexsort((low, high))
        equal = (low[order[1:]] == low[order[:-1]]) & (high[order[1:]] == high[order[:-1]])
    found[at[order[1:][equal]]] = at[order[:-1][equal]]
    return found


def _runs(argb: np.ndarray, before: np.ndarray, ends: np.ndarray, image: np.ndarray) -> np.ndarray:
    """References (place, pixels, distance) from the left to the right of each image."""
    has = before >= 0
    apart = np.where(has, np.arange(len(argb)) - before, 0)
    change = np.flatnonzero((np.diff(apart, append=0) != 0) | (np.diff(image, append=-1) != 0)) + 1
    until = np.repeat(change, np.diff(change, prepend=0)).tolist()  # as far as the distance stays
    places = np.flatnonzero(has)
    end_of, start_of = ends[image[places]].tolist(), before[places].tolist()
    pixels, found, free = argb.tolist(), [], 0
    for at, start, end in zip(places.tolist(), start_of, end_of, strict=True):
        if at < free:
            continue
        most = min(4096, end - at)
        n = min(until[at] - at + 2, most)
        while n < most and pixels[start + n] == pixels[at + n]:
            n += 1
        found.append((at, n, at - start))
        free = at + n
    return np.array(found, np.int64).reshape(-1, 3)


def _cached(argb: np.ndarray, slots: np.ndarray, image: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether the pixel is the last one before of its slot, which was 0 at first."""
    group = image << CACHE_BITS | slots
    order = np.argsort(group, kind="stable")
    held = np.append(np.uint32(0), argb[order[:-1]])
    held[np.diff(group[order], prepend=-1) != 0] = 0
    hit = np.empty(len(argb), bool)
    hit[order] = held == argb[order]
    hit[starts] = False
    return hit


def _slots(argb: np.ndarray) -> np.ndarray:
    return ((argb.astype(U) * U(webp.HASH) & U(0xFFFFFFFF)) >> U(32 - CACHE_BITS)).astype(np.int64)


def _written_codes(lengths: np.ndarray, lanes: np.ndarray, alphabets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fields (lane, value, bits) that tell the lengths (lanes, alphabet), ordered by lane; lanes: the numbers of the rows, rising."""
    used = lengths > 0
    count = used.sum(axis=1)
    simple = (count <= 2) & ~used[:, 256:].any(axis=1)
    low = np.where(count > 0, used.argmax(axis=1), 0)
    high = lengths.shape[1] - 1 - used[:, ::-1].argmax(axis=1)
    two = simple & (count == 2)
    lane = [lanes[simple]]
    value = [(5 | two << 1 | low << 3 | np.where(two, high, 0) << 11)[simple]]
    bits = [np.where(two, 19, 11)[simple]]
    rows = np.flatnonzero(~simple)
    if len(rows):
        inside = np.arange(lengths.shape[1]) < alphabets[rows][:, None]
        flat, of = lengths[rows][inside].astype(np.int64), np.repeat(np.arange(len(rows)), alphabets[rows])
        start = np.flatnonzero((np.diff(flat, prepend=-1) != 0) | (np.diff(of, prepend=-1) != 0))
        n, same, of = np.diff(np.append(start, len(flat))), flat[start], of[start]
        lead = (same > 0).astype(np.int64)
        chunk = np.where(same > 0, 6, 138)
        full, rest = (n - lead) // chunk, (n - lead) % chunk
        steps = lead + full + np.where(rest < 3, rest, 1)
        r, j = np.repeat(np.arange(len(n)), steps), _within(steps)
        same, of, rest, lead, full = same[r], of[r], rest[r], lead[r], full[r]
        middle, tail = (j >= lead) & (j < lead + full), (j >= lead + full) & (rest >= 3)
        kind = np.where(same > 0, 16, np.where(middle | (rest >= 11), 18, 17))
        plain = ~(middle | tail)
        symbol = np.where(plain, same, kind)
        fewest, size = np.choose(kind - 16, (3, 3, 11)), np.choose(kind - 16, (2, 3, 7))
        extra = np.where(plain, 0, np.where(middle, (1 << size) - 1, rest - fewest))
        size = np.where(plain, 0, size)
        counts = np.bincount(of * 19 + symbol, minlength=19 * len(rows)).reshape(-1, 19)
        code_of, code_symbol = np.nonzero(counts)
        length = code_lengths(code_of, code_symbol, counts[code_of, code_symbol], 7)
        own, code = np.zeros((2, len(rows), 19), np.int64)
        own[code_of, code_symbol] = length
        told = own[:, ORDER]
        first = 15 << 1 | (told[:, :9] << (5 + 3 * np.arange(9))).sum(axis=1)
        second = (told[:, 9:] << 3 * np.arange(10)).sum(axis=1)
        code[code_of, code_symbol] = canonical(code_of, code_symbol, length)
        alone = (counts > 0).sum(axis=1) == 1
        wide = np.where(alone[:, None], 0, own)
        code[alone] = 0
        k = wide[of, symbol]
        lane += [lanes[rows], lanes[rows], lanes[rows][of]]
        value += [first, second, code[of, symbol] | extra << k]
        bits += [np.full(len(rows), 32), np.full(len(rows), 31), k + size]
    lane, value, bits = (np.concatenate(x) for x in (lane, value, bits))
    order = np.argsort(lane, kind="stable")
    return lane[order], value[order], bits[order]


def encode_many(images: list[np.ndarray], references: np.ndarray, cache: np.ndarray) -> list[bytes]:
    """The file of each image of (height, webp.PIXELS, 4) samples: with references or a colour cache of CACHE_BITS where these arrays say so."""
    if not images:
        return []
    if len(images) > WRITTEN:
        return [f for a in range(0, len(images), WRITTEN) for f in encode_many(images[a : a + WRITTEN], references[a : a + WRITTEN], cache[a : a + WRITTEN])]
    sizes = np.array([i.shape[0] * i.shape[1] for i in images])
    if (sizes > 1 << 20).any():  # a weight's key has to fit
        return [webp.encode(i, (), CACHE_BITS if c else 0, bool(r)) for i, r, c in zip(images, references, cache, strict=True)]
    n, total = len(images), int(sizes.sum())
    samples = np.concatenate([i.reshape(-1, 4) for i in images]).astype(np.uint32)
    argb = samples[:, 3] << 24 | samples[:, 0] << 16 | samples[:, 1] << 8 | samples[:, 2]
    image, ends = np.repeat(np.arange(n), sizes), np.cumsum(sizes)
    starts = ends - sizes
    left = np.where(references[image], ends[image] - np.arange(total), 0)
    run = _runs(argb, _before(argb, image, left), ends, image)
    slots = _slots(argb)
    hit = _cached(argb, slots, image, starts) & cache[image]
    inner = np.zeros(total + 1, np.int64)
    inner[run[:, 0] + 1] += 1
    np.subtract.at(inner, run[:, 0] + run[:, 1], 1)
    token = np.flatnonzero(np.cumsum(inner[:-1]) == 0)
    place = np.searchsorted(token, run[:, 0])
    of, p = image[token], argb[token].astype(np.int64)
    hit = hit[token]
    hit[place] = False
    literal = ~hit
    literal[place] = False
    near = webp._near(webp.PIXELS)
    nearer = np.arange(max(near) + 1) + 120
    nearer[list(near)] = list(near.values())
    distance = np.where(run[:, 2] < len(nearer), nearer[np.minimum(run[:, 2], len(nearer) - 1)], run[:, 2] + 120)
    long, long_extra, long_bits = _prefix_of(run[:, 1])
    far, far_extra, far_bits = _prefix_of(distance)
    green = np.where(hit, 280 + slots[token], p >> 8 & 255)
    green[place] = 256 + long
    counts = np.bincount(of * SYMBOLS + green, minlength=n * SYMBOLS).reshape(n, SYMBOLS)
    at = np.flatnonzero(literal)
    lit = [FROM[c] + (p[at] >> s & 255) for c, s in ((1, 16), (2, 0), (3, 24))]
    for own in lit:
        counts += np.bincount(of[at] * SYMBOLS + own, minlength=n * SYMBOLS).reshape(n, SYMBOLS)
    counts += np.bincount(of[place] * SYMBOLS + FROM[4] + far, minlength=n * SYMBOLS).reshape(n, SYMBOLS)
    channel = np.repeat(np.arange(5), ALPHABETS)
    code_image, flat = np.nonzero(counts)
    lane, symbol = code_image * 5 + channel[flat], flat - FROM[channel[flat]]
    length = code_lengths(lane, symbol, counts[code_image, flat], LONGEST)
    lengths, code, bits = np.zeros((3, n, SYMBOLS), np.int64)
    lengths[code_image, flat] = length
    several = np.bincount(lane, minlength=5 * n)[lane] > 1
    code[code_image, flat] = np.where(several, canonical(lane, symbol, length), 0)
    bits[code_image, flat] = np.where(several, length, 0)
    # the fields of each image: its head, its five codes, and two of each token
    told = []
    for c in range(5):
        sizes_of = np.where(cache, ALPHABETS[0], 280) if c == 0 else np.full(n, ALPHABETS[c])
        told.append(_written_codes(lengths[:, FROM[c] : FROM[c] + ALPHABETS[c]], np.arange(n), sizes_of))
    value, size = np.zeros((2, len(token), 2), np.int64)
    value[:, 0], size[:, 0] = code[of, green], bits[of, green]
    red, blue, alpha = lit
    k = size[at, 0]
    value[at, 0] |= code[of[at], red] << k
    size[at, 0] += bits[of[at], red]
    k = bits[of[at], blue]
    value[at, 1], size[at, 1] = code[of[at], blue] | code[of[at], alpha] << k, k + bits[of[at], alpha]
    value[place, 0] |= long_extra << size[place, 0]
    size[place, 0] += long_bits
    k = bits[of[place], FROM[4] + far]
    value[place, 1], size[place, 1] = code[of[place], FROM[4] + far] | far_extra << k, k + far_bits
    head = (webp.PIXELS - 1) | (sizes // webp.PIXELS - 1) << 14 | 1 << 28
    flags = np.where(cache, 1 << 1 | CACHE_BITS << 2, 0)  # no transform, the cache, one set of codes
    every = np.arange(n)
    parts = [(every, head, np.full(n, 32)), (every, flags, np.where(cache, 7, 3)), *told, (np.repeat(of, 2), value.ravel(), size.ravel())]
    held = np.stack([np.bincount(x[0], minlength=n) for x in parts])
    start = (np.cumsum(held.sum(axis=0)) - held.sum(axis=0)) + np.cumsum(held, axis=0) - held
    values, widths = np.zeros((2, int(held.sum())), np.int64)
    for (x, v, s), from_, k in zip(parts, start, held, strict=True):
        to = from_[x] + _within(k)
        values[to], widths[to] = v, s
    return [webp._riff(b) for b in _packed(values.astype(U), widths, held.sum(axis=0))]


def _packed(values: np.ndarray, widths: np.ndarray, fields: np.ndarray) -> list[bytes]:
    """The bits of each group of fields (32 bits at most each)."""
    ends = np.cumsum(widths)
    last = ends[np.cumsum(fields) - 1]
    used = np.diff(last, prepend=0)
    words = (used + 31) // 32 + 2  # each group has 32-bit words of its own
    base = np.cumsum(words) - words
    at = ends - widths + np.repeat(base * 32 - (last - used), fields)
    word = at >> 5
    first = np.flatnonzero(np.diff(word, prepend=-1))
    joined = np.bitwise_or.reduceat(values << (at & 31).astype(U), first)
    out = np.zeros(int(words.sum()) + 1, np.uint32)
    out[word[first]] |= (joined & U(0xFFFFFFFF)).astype(np.uint32)
    out[word[first] + 1] |= (joined >> U(32)).astype(np.uint32)
    raw = out.astype("<u4").tobytes()
    return [raw[4 * b : 4 * b + (n + 7) // 8] for b, n in zip(base.tolist(), used.tolist(), strict=True)]


#: Each byte's bits in the other order.
TURNED = np.array([int(f"{k:08b}"[::-1], 2) for k in range(256)], np.uint8)


class Bits:
    """Bits of many files; those of file k start at the bit at[k]. A look gives the next bits from the highest down."""

    def __init__(self, files: list[bytes]):
        sizes = np.array([len(f) for f in files])
        data = TURNED[np.frombuffer(b"".join(files) + bytes(PAST), np.uint8)].astype(U)
        self.words = data[:-7].copy()
        for k in range(1, 8):
            self.words = self.words << U(8) | data[k : len(data) - 7 + k]
        starts = np.cumsum(sizes) - sizes
        self.at = (starts + 21) * 8
        chunk = np.array([struct.unpack_from("<I", f, 16)[0] for f in files])
        self.end = (starts + np.minimum(20 + chunk, sizes)) * 8
        self.last = len(self.words) - 1

    def look(self, at: np.ndarray) -> np.ndarray:
        """57 bits or more from `at` on, then zeros."""
        return self.words[np.minimum(at >> 3, self.last)] << (at & 7).astype(U)

    def take(self, who: np.ndarray, n: int) -> np.ndarray:
        """The next n bits, 15 at most, of each of these files as numbers."""
        if not n:
            return np.zeros(len(who), np.int64)
        at = self.at[who]
        self.at[who] = at + n
        return REVERSED[(self.look(at) >> U(64 - n)).astype(np.int64)] >> (15 - n)


class Tables:
    """Prefix codes by lane: (lanes, alphabet) lengths; an entry is a symbol and, in its last four bits, the length. bad: lanes without a complete code."""

    def __init__(self, lengths: np.ndarray):
        lane, symbol = np.nonzero(lengths)
        length = lengths[lane, symbol].astype(np.int64)
        used = np.bincount(lane, minlength=len(lengths))
        filled = np.bincount(lane, 1 << (LONGEST - length), len(lengths))
        self.bad = (used > 1) & (filled != 1 << LONGEST)
        self.longest = np.where((used > 1) & ~self.bad, lengths.max(axis=1), 1).astype(np.int64)
        size = np.int64(1) << self.longest
        self.base = np.cumsum(size) - size
        table = np.zeros(int(size.sum()), np.uint16)
        one = np.flatnonzero(used == 1)
        table[self.base[one]] = table[self.base[one] + 1] = lengths[one].argmax(axis=1) << 4
        several = (used > 1) & ~self.bad
        keep = several[lane]
        lane, symbol, length = lane[keep], symbol[keep], length[keep]
        order = np.lexsort((symbol, length, lane))
        lane, symbol, length = lane[order], symbol[order], length[order]
        entries = np.repeat((symbol << 4 | length).astype(np.uint16), np.int64(1) << (self.longest[lane] - length))
        table[np.repeat(several, size)] = entries
        self.table = table
        self.shift = (64 - self.longest).astype(U)

    def find(self, bits: np.ndarray, who: np.ndarray) -> np.ndarray:
        return self.table[self.base[who] + (bits >> self.shift[who]).astype(np.int64)].astype(np.int64)


def _read_lengths(r: Bits, alphabets: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The lengths of the next code of each file."""
    n = len(alphabets)
    lengths = np.zeros((n, int(alphabets.max())), np.uint8)
    every = np.arange(n)
    simple = r.take(every, 1) > 0
    own = np.flatnonzero(simple)
    if len(own):
        two = r.take(own, 1) > 0
        eight = r.take(own, 1) > 0
        for part, size in ((own[eight], 8), (own[~eight], 1)):
            s = r.take(part, size)
            bad[part] |= s >= alphabets[part]
            lengths[part, np.minimum(s, alphabets[part] - 1)] = 1
        s = r.take(own[two], 8)
        bad[own[two]] |= s >= alphabets[own[two]]
        lengths[own[two], np.minimum(s, alphabets[own[two]] - 1)] = 1
    own = np.flatnonzero(~simple)
    if not len(own):
        return lengths
    told = 4 + r.take(own, 4)
    code = np.zeros((len(own), 19), np.uint8)
    for i, s in enumerate(webp.LENGTH_ORDER):
        more = np.flatnonzero(told > i)
        code[more, s] = r.take(own[more], 3)
    bad[own] |= r.take(own, 1) > 0  # fewer lengths than symbols
    tables = Tables(code)
    bad[own] |= tables.bad
    live = np.flatnonzero(~bad[own])
    place, before = np.zeros(len(own), np.int64), np.full(len(own), 8)
    found = []
    while len(live):
        who = own[live]
        at = r.at[who]
        bits = r.look(at)
        e = tables.find(bits, live)
        s, k = e >> 4, e & 15
        repeat = np.maximum(s - 15, 0)
        size = np.array([0, 2, 3, 7])[repeat]
        extra = REVERSED[((bits << k.astype(U)) >> U(49)).astype(np.int64)] & ((1 << size) - 1)
        times = np.array([1, 3, 3, 11])[repeat] + extra
        value = np.where(repeat == 0, s, np.where(repeat == 1, before[live], 0))
        before[live] = np.where((repeat == 0) & (s > 0), s, before[live])
        found.append((who, place[live], times, value))
        r.at[who] = at + k + size
        place[live] += times
        wrong = (place[live] > alphabets[who]) | (r.at[who] > r.end[who])
        bad[who[wrong]] = True
        live = live[~wrong & (place[live] < alphabets[who])]
    who, at, times, value = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4
    keep = ~bad[who] & (value > 0)
    who, at, times, value = who[keep], at[keep], times[keep], value[keep]
    lengths[np.repeat(who, times), np.repeat(at, times) + _within(times)] = np.repeat(value, times)
    return lengths


def _extra(r: Bits, at: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths or distances of these prefixes, the bits that they took after `at`, and which have over 15."""
    n = np.where(prefix < 4, 0, (prefix - 2) >> 1)
    wrong = n > 15
    n = np.minimum(n, 15)
    value = REVERSED[(r.look(at) >> U(49)).astype(np.int64)] & ((1 << n) - 1)
    return np.where(prefix < 4, prefix, ((2 + (prefix & 1)) << n) + value) + 1, n, wrong


NEAR_X, NEAR_Y = np.array(webp.NEAR).T


def _settled(pointer: np.ndarray) -> np.ndarray:
    """Where each chain of pointers to earlier places ends."""
    open_ = np.flatnonzero(pointer != np.arange(len(pointer)))
    while len(open_):
        further = pointer[pointer[open_]]
        moved = further != pointer[open_]
        pointer[open_] = further
        open_ = open_[moved]
    return pointer


def decode_many(files: list[bytes]) -> list[bytes]:
    """The samples (R, G, B, A by rows) of each file."""
    out: list[bytes | None] = [None] * len(files)
    text = [i for i, f in enumerate(files) if webp.is_text(f)]
    for i, p in zip(text, webp.decode_many([files[i] for i in text]), strict=True):
        out[i] = p
    own = [i for i, f in enumerate(files) if out[i] is None and len(f) > 25 and f[:4] == b"RIFF" and f[8:16] == b"WEBPVP8L" and f[20] == 0x2F]
    for a in range(0, len(own), READ):
        for i, p in zip(own[a : a + READ], _decode([files[i] for i in own[a : a + READ]]), strict=True):
            out[i] = p
    return [webp.decode(f).tobytes() if p is None else p for f, p in zip(files, out, strict=True)]


def _decode(files: list[bytes]) -> list[bytes | None]:
    """The samples of each file, or None for those that have to be read alone."""
    if not files:
        return []
    r, n = Bits(files), len(files)
    every = np.arange(n)
    width, height = r.take(every, 14) + 1, r.take(every, 14) + 1
    r.take(every, 1)
    bad = (r.take(every, 3) > 0) | (width * height > MOST_PIXELS)
    bad |= r.take(every, 1) > 0  # a transform
    cache = r.take(every, 1) > 0
    held = np.flatnonzero(cache)
    bad[held] |= r.take(held, 4) != CACHE_BITS
    bad |= r.take(every, 1) > 0  # several sets of codes
    tables = []
    for c in range(5):
        sizes = np.where(cache, ALPHABETS[0], 280) if c == 0 else np.full(n, ALPHABETS[c])
        tables.append(Tables(_read_lengths(r, sizes, bad)))
        bad |= tables[-1].bad
    far = tables[4]
    size = np.where(bad, 0, width * height)
    base = np.cumsum(size + 1) - size - 1  # and one place for what finished files still read
    tokens = np.zeros(int(base[-1]) + int(size[-1]) + 1, U)
    runs = []
    live = np.flatnonzero(~bad)
    at, to, until, first, shift, once = _gathered(r, tables, live, base, base + size)
    step = 0
    while len(live):
        go = to < until
        step += 1
        if not step % 16 and not go.all():
            r.at[live], live = at, live[go]
            at, to, until, first, shift, once = _gathered(r, tables, live, to[go], until[go])
            continue
        bits = r.words[at >> 3] << (at & 7).astype(U)
        found, taken = [], []
        for c in range(4):
            e = tables[c].table.take((bits >> shift[c]).view(np.int64) + first[c]).astype(U)
            found.append(e)
            taken.append(e & U(15))
            if c < 2 or once:
                bits <<= taken[c]
            elif c == 2:
                bits = r.look(at + (taken[0] + taken[1] + taken[2]).view(np.int64))
        g = found[0]
        tokens[to] = g | found[1] << U(16) | found[2] << U(32) | found[3] << U(48)
        literal = g < U(256 << 4)
        k = np.where(literal, taken[0] + taken[1] + taken[2] + taken[3], taken[0]).view(np.int64)
        some = np.flatnonzero(~literal & (g < U(280 << 4)) & go)
        at += k * go
        if len(some):
            who, where = live[some], at[some]
            long, more, wrong = _extra(r, where, (g[some] >> U(4)).view(np.int64) - 256)
            where = where + more
            e = far.find(r.look(where), who)
            where = where + (e & 15)
            d, more, wrong_d = _extra(r, where, e >> 4)
            at[some] = where + more
            close = np.minimum(d, 120) - 1
            d = np.where(d > 120, d - 120, np.maximum(1, NEAR_X[close] + NEAR_Y[close] * width[who]))
            wrong |= wrong_d | (d > to[some] - base[who]) | (to[some] + long > until[some])
            bad[who[wrong]] = True
            until[some[wrong]] = to[some[wrong]]
            long = np.where(wrong, 1, long)
            runs.append((to[some][~wrong], long[~wrong], d[~wrong]))
            to[some] += long - 1
        to += go
        to = np.minimum(to, until)
    bad |= r.at > r.end
    tokens[base + size] = 0
    to, long, d = (np.concatenate(x) for x in zip(*runs, strict=True)) if runs else (np.zeros(0, np.int64),) * 3
    order = np.argsort(to)
    to, long, d = to[order], long[order], d[order]
    out: list[bytes | None] = []
    for a in range(0, n, SETTLED):
        b = min(n, a + SETTLED)
        start, end = int(base[a]), int(base[b - 1] + size[b - 1] + 1)
        x, y = np.searchsorted(to, (start, end))
        own = _pixels(tokens[start:end], to[x:y] - start, long[x:y], d[x:y], np.repeat(np.arange(b - a), size[a:b] + 1), bad[a:b])
        out += [None if w else own[k : k + m].tobytes() for w, k, m in zip(bad[a:b].tolist(), (base[a:b] - start).tolist(), size[a:b].tolist(), strict=True)]
    return out


def _gathered(r: Bits, tables: list[Tables], live: np.ndarray, to: np.ndarray, until: np.ndarray) -> tuple:
    """What the files `live` are read by: bits, places and their ends, the starts and shifts of four tables, and whether one look has a whole pixel."""
    if len(to) != len(live):
        to, until = to[live], until[live]
    longest = sum(t.longest[live] for t in tables[:4])
    return r.at[live], to.copy(), until.copy(), [t.base[live] for t in tables[:4]], [t.shift[live] for t in tables[:4]], not len(live) or int(longest.max()) <= 57


def _pixels(tokens: np.ndarray, to: np.ndarray, long: np.ndarray, d: np.ndarray, image: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Samples (pixels, R G B A) from the entries of four codes each; to, long, d: places, lengths and distances of references."""
    green, red, blue, alpha = ((tokens >> U(16 * c + 4) & U(0xFFF)).astype(np.uint32) for c in range(4))
    argb = alpha << 24 | red << 16 | green << 8 | blue
    copied = np.repeat(to, long) + _within(long)
    green[copied] = 0
    hit = green >= 280
    pointer = np.arange(len(argb))
    pointer[copied] = copied - np.repeat(d, long)
    pointer = _settled(pointer)
    if hit.any():
        # a pixel from the cache is the last one before in its slot; slots are known without the pixels
        slot = np.where(hit, green.astype(np.int64) - 280, _slots(argb))[pointer]
        group = image << CACHE_BITS | slot
        order = np.argsort(group, kind="stable")
        first = np.diff(group[order], prepend=-1) != 0
        earlier = np.empty(len(order), np.int64)
        earlier[order[1:]] = order[:-1]
        start = order[first]
        earlier[start] = start
        empty = start[hit[start]]  # nothing yet in that slot: 0, of slot 0
        bad[image[empty[slot[empty] != 0]]] = True
        argb[empty] = 0
        pointer = _settled(np.where(hit, earlier, pointer))
    argb = argb[pointer]
    return np.stack([argb >> 16 & 255, argb >> 8 & 255, argb & 255, argb >> 24], axis=1).astype(np.uint8)
