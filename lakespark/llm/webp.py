"""Lossless WebP of 8-bit samples: a decoder of the whole bitstream, and an encoder, in numpy.

Many pictures are decoded side by side: every step adds one pixel to each of them, read at the
picture's own bit position. A picture has at most ``TILE`` pixels; a payload of more is stored as an
animation whose frames are the tiles of one canvas.
"""

from __future__ import annotations

import struct

import numpy as np

WIDTH, TILE = 64, 2048
#: Fixed values of the format: the order of code lengths, the sizes of alphabets, the hash of the colour cache.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
LITERALS, LENGTHS, DISTANCES = 256, 24, 40
CACHE_FACTOR = 0x1E35A7BD
PREDICTOR, CROSS_COLOR, SUBTRACT_GREEN, PALETTE = range(4)
#: Offsets (x, y) of the distance codes 1 to 120: nearest first, then upper rows first, then right before left.
NEAR = sorted(
    ((x, y) for y in range(8) for x in range(-7, 9) if y > 0 or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, -p[1], p[0] < 0)
)
_REVERSED = np.zeros(1 << 15, dtype=np.int32)
for _i in range(15):
    _REVERSED |= ((np.arange(1 << 15, dtype=np.int32) >> _i) & 1) << (14 - _i)


def _up(a: int, bits: int) -> int:
    return (a + (1 << bits) - 1) >> bits


# --- prefix codes ------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Lengths of a prefix code for the symbols with counts, none above ``longest``; a lone symbol gets 1."""
    lengths = np.zeros(len(counts), dtype=np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    weight = counts[used].astype(np.int64)
    while True:
        order = np.argsort(weight, kind="stable")
        n = len(used)
        # both lists end in a number that is above all weights
        above = int(weight.sum()) + 1
        leaves, joined = [*weight[order].tolist(), above], [above] * n
        parent = [0] * (2 * n - 1)
        i = j = 0
        # the lightest is at the front of the leaves or of the nodes made so far
        for node in range(n - 1):
            a, b = leaves[i], joined[j]
            if a <= b:
                pair, parent[i] = a, n + node
                i += 1
                a = leaves[i]
            else:
                pair, parent[n + j] = b, n + node
                j += 1
                b = joined[j]
            if a <= b:
                pair += a
                parent[i] = n + node
                i += 1
            else:
                pair += b
                parent[n + j] = n + node
                j += 1
            joined[node] = pair
        by_weight = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            by_weight[k] = by_weight[parent[k]] + 1
        depth = np.zeros(n, dtype=np.int64)
        depth[order] = by_weight[:n]
        if depth.max() <= longest:
            lengths[used] = depth
            return lengths
        weight = (weight + 1) // 2


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes, first bit lowest, as they stand in the stream."""
    out = np.zeros(len(lengths), dtype=np.int64)
    used = np.flatnonzero(lengths)
    if len(used):
        of = used[np.argsort(lengths[used], kind="stable")]
        room = 1 << (15 - lengths[of])
        out[of] = _REVERSED[np.cumsum(room) - room]
    return out


class Tables:
    """Prefix codes of many pictures, each as 16 limits and offsets into one list of symbols."""

    def __init__(self):
        self.limits, self.offsets, self.symbols, self.size = [], [], [], 0
        self.known: dict[tuple[bytes, bytes], int] = {}

    def add(self, lengths: np.ndarray) -> int:
        """Number of the table of a code; equal codes share one."""
        used = np.flatnonzero(lengths)
        key = (used.tobytes(), lengths[used].tobytes())
        if key not in self.known:
            self.known[key] = self._add(lengths, used)
        return self.known[key]

    def _add(self, lengths: np.ndarray, used: np.ndarray) -> int:
        if len(used) <= 1:
            symbols = used if len(used) else np.zeros(1, np.int64)
            limit, offset = np.full(15, 1 << 15), np.full(16, self.size)
        else:
            per = np.bincount(lengths[used], minlength=16)
            limit = np.cumsum(per[:15] << (15 - np.arange(15)))
            if int(limit[14] + per[15]) != 1 << 15:
                raise ValueError("a prefix code is not complete")
            symbols = used[np.argsort(lengths[used], kind="stable")]
            start = np.concatenate(([0], limit)) >> (15 - np.arange(16))
            offset = self.size + np.concatenate(([0], np.cumsum(per)[:-1])) - start
        self.limits.append(limit)
        self.offsets.append(offset)
        self.symbols.append(symbols)
        self.size += len(symbols)
        return len(self.limits) - 1

    def freeze(self) -> None:
        self.limits = np.array(self.limits, dtype=np.int32)
        self.offsets = np.array(self.offsets, dtype=np.int32)
        self.symbols = np.concatenate(self.symbols).astype(np.int32)
        # lengths that no code has are not looked at
        below, above = (self.limits == 0).all(axis=0), (self.limits == 1 << 15).all(axis=0)
        self.low, self.high = int(np.argmin(np.append(below, False))), 15 - int(np.argmin(np.append(above[::-1], False)))
        self.high = max(self.high, self.low)

    def read(self, window: np.ndarray, limits: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next symbol of each window, and its width; a row of limits and offsets for each."""
        peek = _REVERSED[(window & np.uint64(0x7FFF)).astype(np.int32)]
        n = (peek[:, None] >= limits[:, self.low : self.high]).sum(axis=1, dtype=np.int32)
        n += self.low
        first = offsets.ravel()[np.arange(0, offsets.size, 16, dtype=np.int32) + n]
        return self.symbols[first + (peek >> (15 - n))], n


# --- reading -------------------------------------------------------------------------------------


class Bits:
    """Reads numbers of up to 32 bits, lowest bit first, from one chunk."""

    def __init__(self, data: bytes):
        self.data, self.at, self.counted = data, 0, False

    def peek(self, n: int, at: int | None = None) -> int:
        at = self.at if at is None else at
        return (int.from_bytes(self.data[at >> 3 : (at + n + 7) >> 3], "little") >> (at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        a, b = self.at >> 3, (self.at + n + 7) >> 3
        value = int.from_bytes(self.data[a:b], "little") >> (self.at & 7)
        self.at += n
        return value & ((1 << n) - 1)


def _read_code(bits: Bits, alphabet: int) -> np.ndarray:
    lengths = np.zeros(alphabet, dtype=np.int64)
    bits.counted = False
    if bits.read(1):
        two, eight = bits.read(1), bits.read(1)
        lengths[bits.read(8 if eight else 1)] = 1
        if two:
            lengths[bits.read(8)] = 1
        return lengths
    inner = [0] * 19
    for i in range(4 + bits.read(4)):
        inner[LENGTH_ORDER[i]] = bits.read(3)
    bits.counted = bool(bits.read(1))
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.counted else alphabet
    # a table of seven bits: symbol and length
    coded = np.array(inner)
    used = np.flatnonzero(coded)
    if len(used) == 1:
        table = [int(used[0])] * 128
        inner[used[0]] = 0
    else:
        of = used[np.argsort(coded[used], kind="stable")]
        filled = np.repeat(of, 1 << (7 - coded[of]))
        if len(filled) != 128:
            raise ValueError("a prefix code is not complete")
        table = filled[_REVERSED[:128] >> 8].tolist()
    at, before, out = 0, 8, [0] * alphabet
    data, p = bits.data, bits.at
    while at < alphabet and left:
        left -= 1
        window = int.from_bytes(data[p >> 3 : (p >> 3) + 3], "little") >> (p & 7)
        s = table[window & 127]
        n = inner[s]
        p += n
        window >>= n
        if s < 16:
            out[at] = s
            at += 1
            before = s or before
            continue
        if s == 16:
            value, count, n = before, 3 + (window & 3), 2
        elif s == 17:
            value, count, n = 0, 3 + (window & 7), 3
        else:
            value, count, n = 0, 11 + (window & 127), 7
        p += n
        if at + count > alphabet:
            raise ValueError("code lengths run over the alphabet")
        if value:
            out[at : at + count] = [value] * count
        at += count
    bits.at = p
    return np.array(out, dtype=np.int64)


class Picture:
    """A VP8L chunk, read as far as its main pixels: transforms, prefix codes, and where the pixels begin."""

    def __init__(self, data: bytes):
        bits = Bits(data)
        if bits.read(8) != 0x2F:
            raise ValueError("not a lossless picture")
        self.width, self.height = bits.read(14) + 1, bits.read(14) + 1
        bits.read(1)
        if bits.read(3):
            raise ValueError("unknown version")
        self.data, self.transforms = data, []
        self.coded_width = self.width
        while bits.read(1):
            kind = bits.read(2)
            if kind in (PREDICTOR, CROSS_COLOR):
                size = bits.read(3) + 2
                inner = _sub_image(bits, _up(self.coded_width, size), _up(self.height, size))
                self.transforms.append((kind, self.coded_width, size, inner))
            elif kind == PALETTE:
                n = bits.read(8) + 1
                delta = _sub_image(bits, n, 1)[0]
                colours = np.cumsum(delta[:, None] >> np.array([0, 8, 16, 24]) & 255, axis=0) & 255
                size = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
                self.transforms.append((kind, self.coded_width, size, (colours << np.array([0, 8, 16, 24])).sum(axis=1)))
                self.coded_width = _up(self.coded_width, size)
            else:
                self.transforms.append((kind, self.coded_width, 0, None))
        self.cache_bits = bits.read(4) if bits.read(1) else 0
        self.meta, self.meta_bits, groups = None, 0, 1
        if bits.read(1):
            self.meta_bits = bits.read(3) + 2
            image = _sub_image(bits, _up(self.coded_width, self.meta_bits), _up(self.height, self.meta_bits))
            self.meta = image >> 8 & 0xFFFF
            groups = int(self.meta.max()) + 1
        self.groups = [_read_group(bits, self.cache_bits) for _ in range(groups)]
        self.at = bits.at


def _read_group(bits: Bits, cache_bits: int) -> list[np.ndarray]:
    green = LITERALS + LENGTHS + ((1 << cache_bits) if cache_bits else 0)
    out: list[np.ndarray] = []
    before = wide = 0
    for alphabet in (green, LITERALS, LITERALS, LITERALS, DISTANCES):
        start = bits.at
        # the same bits again are the same code, if they say how many lengths follow and these fit
        if out and wide > 64 and alphabet == LITERALS and not out[-1][alphabet:].any() and bits.peek(wide) == before:
            bits.at += wide
            out.append(out[-1][:alphabet])
            continue
        counted = _read_code(bits, alphabet)
        out.append(counted)
        wide = bits.at - start if bits.counted else 0
        before = bits.peek(wide, start) if wide else 0
    return out


class _Part:
    """What ``decode_pixels`` needs of a picture inside a picture."""

    def __init__(self, bits: Bits, width: int, height: int):
        self.coded_width, self.height, self.data = width, height, bits.data
        self.cache_bits = bits.read(4) if bits.read(1) else 0
        self.meta, self.meta_bits = None, 0
        self.groups = [_read_group(bits, self.cache_bits)]
        self.at = bits.at


def _sub_image(bits: Bits, width: int, height: int) -> np.ndarray:
    pixels, ends = decode_pixels([_Part(bits, width, height)])
    bits.at = int(ends[0])
    return pixels[0].astype(np.int64).reshape(height, width)


def decode_pixels(pictures: list) -> tuple[list[np.ndarray], np.ndarray]:
    """Pixels (before transforms are inverted) of every picture, and the bit at which each ends.

    All pictures advance together, a pixel at a step; long ones go on after short ones have ended.
    """
    total = np.array([p.coded_width * p.height for p in pictures])
    order = np.argsort(-total, kind="stable")
    lanes = [pictures[i] for i in order]
    sizes = total[order]
    tables, groups, first_group = Tables(), [], []
    for p in lanes:
        first_group.append(len(groups))
        groups += [[tables.add(lengths) for lengths in group] for group in p.groups]
    tables.freeze()
    groups, first_group = np.array(groups), np.array(first_group)
    with_meta = [lane for lane, p in enumerate(lanes) if p.meta is not None]
    # rows of limits and offsets of each picture's green, red, blue and alpha; equal ones are one array
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for code in range(4):
        own = groups[first_group, code]
        same = next((k for k in range(code) if (groups[first_group, k] == own).all()), None)
        rows.append(rows[same] if same is not None else (tables.limits[own], tables.offsets[own]))
    alpha = groups[first_group, 3]
    opaque = bool((tables.limits[alpha, 0] == 1 << 15).all()) and not with_meta
    solid = tables.symbols[tables.offsets[alpha, 0]].astype(np.uint32) << np.uint32(24)
    # 16 spare bytes after each chunk, so that a window of eight never leaves it
    stream = np.frombuffer(b"".join(p.data + bytes(16) for p in lanes), dtype=np.uint8)
    windows = np.ndarray((len(stream) - 7,), dtype="<u8", buffer=stream, strides=(1,))
    begin = np.cumsum([0] + [len(p.data) + 16 for p in lanes[:-1]])
    stop = (begin + np.array([len(p.data) for p in lanes])) * 8
    at = begin * 8 + np.array([p.at for p in lanes], dtype=np.int64)
    width = np.array([p.coded_width for p in lanes])
    cache_bits = np.array([p.cache_bits for p in lanes])
    # a picture without a cache has two slots that nothing reads
    cached = bool(cache_bits.any())
    held = np.where(cache_bits > 0, cache_bits, 1)
    first_slot, cache_shift = np.cumsum(1 << held) - (1 << held), (32 - held).astype(np.uint32)
    cache = np.zeros(int((1 << held).sum()) + 1, dtype=np.uint32)
    out = np.zeros((int(sizes.max(initial=0)), len(lanes)), dtype=np.uint32)
    left, distance = np.zeros(len(lanes), dtype=np.int64), np.zeros(len(lanes), dtype=np.int64)
    near = np.array(NEAR)

    def number(lane: np.ndarray, count: np.ndarray) -> np.ndarray:
        value = windows[at[lane] >> 3] >> (at[lane] & 7).astype(np.uint64)
        at[lane] += count
        return (value & ((np.uint64(1) << count.astype(np.uint64)) - np.uint64(1))).astype(np.int64)

    def prefixed(lane: np.ndarray, code: np.ndarray) -> np.ndarray:
        extra = np.maximum(code - 2, 0) >> 1
        return np.where(code < 4, code, ((2 + (code & 1)) << extra)) + number(lane, extra) + 1

    everyone = np.arange(len(lanes))
    for t in range(len(out)):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        free = not left[:n].any()
        reading = everyone[:n] if free else np.flatnonzero(left[:n] == 0)
        if len(reading):
            pick = slice(0, n) if free else reading
            group = first_group[pick]
            if with_meta:
                group = group.copy()
                for i, lane in enumerate(reading):
                    p = lanes[lane]
                    if p.meta is not None:
                        y, x = divmod(t, p.coded_width)
                        group[i] += int(p.meta[y >> p.meta_bits, x >> p.meta_bits])
            bit = at[pick]
            window = windows[bit >> 3] >> (bit & 7).astype(np.uint64)
            values, used = [], np.zeros(len(reading), dtype=np.int64)
            for code in range(3 if opaque else 4):
                if with_meta:
                    own = groups[group, code]
                    limits, offsets = tables.limits[own], tables.offsets[own]
                else:
                    limits, offsets = (x[pick] for x in rows[code])
                if code == 3:
                    # three codes and the place in the byte leave no room for a fourth
                    later = bit + used
                    window = windows[later >> 3] >> (later & 7).astype(np.uint64)
                value, wide = tables.read(window, limits, offsets)
                values.append(value)
                used += wide
                window = window >> wide.astype(np.uint64)
                if code == 0:
                    after_green = used.copy()
            green = values[0]
            plain = green < LITERALS
            whole = bool(plain.all())
            argb = green.astype(np.uint32) << np.uint32(8)
            argb |= values[1].astype(np.uint32) << np.uint32(16)
            argb |= values[2].astype(np.uint32)
            argb |= solid[pick] if opaque else values[3].astype(np.uint32) << np.uint32(24)
            if whole:
                out[t, pick] = argb
                at[pick] = bit + used
            else:
                at[pick] = bit + np.where(plain, used, after_green)
                kept = green >= LITERALS + LENGTHS
                slot = first_slot[pick] + np.where(kept, green - (LITERALS + LENGTHS), 0)
                # what stands here for a copy is overwritten below
                out[t, pick] = np.where(kept, cache[slot], argb)
                copy = ~(plain | kept)
                lane = reading[copy]
                if not len(lane):
                    lane = None
            if not whole and lane is not None:
                left[lane] = prefixed(lane, green[copy].astype(np.int64) - LITERALS)
                own = groups[group[copy], 4]
                code, wide = tables.read(windows[at[lane] >> 3] >> (at[lane] & 7).astype(np.uint64), tables.limits[own], tables.offsets[own])
                at[lane] += wide
                code = prefixed(lane, code.astype(np.int64))
                shift = near[np.minimum(code, len(NEAR)) - 1]
                distance[lane] = np.where(code > len(NEAR), code - len(NEAR), np.maximum(1, shift[:, 0] + shift[:, 1] * width[lane]))
                if (distance[lane] > t).any() or (left[lane] > sizes[lane] - t).any():
                    raise ValueError("a back-reference leaves the picture")
            if (at[reading] > stop[reading]).any():
                raise ValueError("the stream is too short")
        copying = np.flatnonzero(left[:n])
        if len(copying):
            out[t, copying] = out[t - distance[copying], copying]
            left[copying] -= 1
        if cached:
            argb = out[t, :n]
            # a product of numbers of 32 bits keeps the lowest 32
            cache[first_slot[:n] + ((argb * np.uint32(CACHE_FACTOR)) >> cache_shift[:n])] = argb
    columns = np.ascontiguousarray(out.T)
    result: list = [None] * len(lanes)
    ends = np.zeros(len(lanes), dtype=np.int64)
    for i, lane in enumerate(order):
        result[lane] = columns[i, : sizes[i]]
        ends[lane] = at[i] - begin[i] * 8
    return result, ends


# --- transforms -----------------------------------------------------------------------------------


def _channels(argb: np.ndarray) -> np.ndarray:
    return (argb[..., None].astype(np.int64) >> np.array([24, 16, 8, 0])) & 255


def _packed(c: np.ndarray) -> np.ndarray:
    return ((c & 255) << np.array([24, 16, 8, 0])).sum(axis=-1)


def predicted(mode: int, left: np.ndarray, top: np.ndarray, right: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """The prediction of a pixel's channels from its neighbours left, above, above right and above left."""
    half = lambda a, b: (a + b) >> 1
    if mode == 11:
        # the neighbour that the gradient points to
        to_left, to_top = np.abs(top - corner).sum(), np.abs(left - corner).sum()
        return left if to_left < to_top else top
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    if mode == 13:
        middle = half(left, top)
        change = middle - corner
        return np.clip(middle + np.sign(change) * (np.abs(change) >> 1), 0, 255)
    simple = {
        1: lambda: left,
        2: lambda: top,
        3: lambda: right,
        4: lambda: corner,
        5: lambda: half(half(left, right), top),
        6: lambda: half(left, corner),
        7: lambda: half(left, top),
        8: lambda: half(corner, top),
        9: lambda: half(top, right),
        10: lambda: half(half(left, corner), half(top, right)),
    }
    return simple[mode]() if mode in simple else np.array([255, 0, 0, 0])


#: Modes that look at the row above only; the others need the pixel to the left first.
ABOVE = (0, 2, 3, 4, 8, 9)


def _unpredict(argb: np.ndarray, size: int, modes: np.ndarray) -> np.ndarray:
    c = _channels(argb)
    height, width = argb.shape
    c[0, 0] += np.array([255, 0, 0, 0])
    c[0] = np.cumsum(c[0], axis=0) & 255
    kinds = (modes >> 8 & 15)[np.arange(height)[:, None] >> size, np.arange(width) >> size]
    for y in range(1, height):
        top, kind = c[y - 1], kinds[y]
        c[y, 0] = (c[y, 0] + top[0]) & 255
        # right of the last column stands the first pixel of the row itself
        right = np.concatenate((top[1:], c[y, :1]))
        corner = np.concatenate((top[:1], top[:-1]))
        above = np.isin(kind, ABOVE)
        above[0] = False
        for mode in np.unique(kind[above]):
            at = above & (kind == mode)
            c[y, at] = (c[y, at] + predicted(int(mode), top[at], top[at], right[at], corner[at])) & 255
        x = 1
        while x < width:
            if above[x]:
                x += 1
                continue
            end = x + 1
            if kind[x] == 1:
                while end < width and kind[end] == 1:
                    end += 1
                c[y, x:end] = np.cumsum(c[y, x - 1 : end], axis=0)[1:] & 255
            else:
                c[y, x] = (c[y, x] + predicted(int(kind[x]), c[y, x - 1], top[x], right[x], corner[x])) & 255
            x = end
    return _packed(c)


def _residuals(c: np.ndarray, mode: int) -> np.ndarray:
    """Channels less their prediction by one mode, for all pixels; the first row and column have modes of their own."""
    left, top = np.roll(c, 1, axis=1)[1:, :], c[:-1]
    right, corner = np.concatenate((c[:-1, 1:], c[1:, :1]), axis=1), np.roll(c, 1, axis=1)[:-1]
    if mode == 11:
        to_left, to_top = np.abs(top - corner).sum(axis=2), np.abs(left - corner).sum(axis=2)
        guess = np.where((to_left < to_top)[..., None], left, top)
    else:
        guess = predicted(mode, left, top, right, corner)
    out = c.copy()
    out[1:] -= guess
    out[1:, 0] = c[1:, 0] - c[:-1, 0]
    out[0, 1:] = c[0, 1:] - c[0, :-1]
    out[0, 0] -= np.array([255, 0, 0, 0], dtype=out.dtype)
    return out & 255


def _signed_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (((a + 128 & 255) - 128) * ((b + 128 & 255) - 128)) >> 5


def cross_colour(argb: np.ndarray, size: int, factors: np.ndarray, sign: int = 1) -> np.ndarray:
    """Adds (or with -1 takes away) what green says of red, and green and red say of blue."""
    c, height, width = _channels(argb), *argb.shape
    f = _channels(factors)[np.arange(height)[:, None] >> size, np.arange(width) >> size]
    red = (c[..., 1] + sign * _signed_product(f[..., 3], c[..., 2])) & 255
    known = red if sign > 0 else c[..., 1]
    c[..., 3] += sign * (_signed_product(f[..., 2], c[..., 2]) + _signed_product(f[..., 1], known))
    c[..., 1] = red
    return _packed(c)


def invert(picture: Picture, pixels: np.ndarray) -> np.ndarray:
    """Pixels (height, width) with the picture's transforms undone, last first."""
    argb = pixels.astype(np.int64).reshape(picture.height, picture.coded_width)
    for kind, width, size, data in reversed(picture.transforms):
        if kind == PREDICTOR:
            argb = _unpredict(argb, size, data)
        elif kind == CROSS_COLOR:
            argb = cross_colour(argb, size, data)
        elif kind == SUBTRACT_GREEN:
            green = argb >> 8 & 255
            argb = argb & 0xFF00FF00 | ((argb >> 16 & 255) + green & 255) << 16 | (argb & 255) + green & 255
        else:
            x = np.arange(width)
            depth = 8 >> size
            index = (argb[:, x >> size] >> 8 & 255) >> (depth * (x & ((1 << size) - 1))) & ((1 << depth) - 1)
            argb = np.append(data, 0)[np.minimum(index, len(data))]
    return argb


# --- writing ---------------------------------------------------------------------------------------


class Writer:
    """Collects numbers and their widths in bits."""

    def __init__(self):
        self.values, self.widths = [], []

    def put(self, value: int, width: int) -> None:
        self.values.append([value])
        self.widths.append([width])

    def many(self, values: np.ndarray, widths: np.ndarray) -> None:
        self.values.append(values)
        self.widths.append(widths)

    def bytes(self) -> bytes:
        values, widths = np.concatenate(self.values).astype(np.uint64), np.concatenate(self.widths).astype(np.int64)
        at = np.cumsum(widths) - widths
        words = np.zeros((int(at[-1] + widths[-1]) >> 6) + 2, dtype=np.uint64)
        # no two numbers share a bit, so sums join them
        shift = (at & 63).astype(np.uint64)
        np.add.at(words, at >> 6, values << shift)
        np.add.at(words, (at >> 6) + 1, np.where(shift > 0, values >> ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0)))
        return words.tobytes()[: (int(at[-1] + widths[-1]) + 7) >> 3]


def _write_code(w: Writer, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Write a prefix code for symbols with counts; returns code and width of every symbol."""
    used = np.flatnonzero(counts)
    if len(used) <= 1 and (len(used) == 0 or used[0] < 256):
        symbol = int(used[0]) if len(used) else 0
        w.many(np.array([1, 0, int(symbol > 1), symbol]), np.array([1, 1, 1, 8 if symbol > 1 else 1]))
        return np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    if len(used) == 1:
        counts = counts.copy()
        counts[0] = 1
    lengths = code_lengths(counts, 15)
    last = int(np.flatnonzero(lengths)[-1]) + 1
    edges = np.flatnonzero(np.concatenate(([True], lengths[1:last] != lengths[: last - 1], [True]))).tolist()
    plain = lengths[:last].tolist()
    tokens: list[int] = []  # symbol, extra bits and their number, as bits 0-4, 5-11 and 12-14
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        n = b - a
        if plain[a] or n < 3:
            tokens += plain[a:b]
            continue
        while n >= 11:
            step = min(n, 138)
            tokens.append(18 | (step - 11) << 5 | 7 << 12)
            n -= step
        if n >= 3:
            tokens.append(17 | (n - 3) << 5 | 3 << 12)
        else:
            tokens += [0] * n
    t = np.array(tokens)
    t, extra, width = t & 31, t >> 5 & 127, t >> 12
    seen = np.bincount(t, minlength=19)
    if (seen > 0).sum() < 2:
        seen[0 if not seen[0] else 1] += 1
    inner = code_lengths(seen, 7)
    count = max(4, 1 + max(i for i, s in enumerate(LENGTH_ORDER) if inner[s]))
    w.many(np.array([0, count - 4, *inner[list(LENGTH_ORDER[:count])]]), np.array([1, 4, *[3] * count]))
    # the number of tokens, in as many bits as it needs
    pairs = next(k for k in range(8) if len(tokens) - 2 < 1 << (2 + 2 * k)) if len(tokens) >= 2 else 0
    if len(tokens) < 2:
        w.put(0, 1)
    else:
        w.many(np.array([1, pairs, len(tokens) - 2]), np.array([1, 3, 2 + 2 * pairs]))
    code = codes(inner)
    w.many(np.stack((code[t], extra), axis=1).ravel(), np.stack((inner[t], width), axis=1).ravel())
    return codes(lengths), lengths


def _prefix(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix code, extra bits and their number of values from 1."""
    v = value - 1
    top = np.floor(np.log2(np.maximum(v, 1))).astype(np.int64)
    second = v >> np.maximum(top - 1, 0) & 1
    extra = np.where(v < 4, 0, top - 1)
    return np.where(v < 4, v, 2 * top + second), v & ((1 << extra) - 1), extra


#: A copy of fewer pixels (the hash is one of six) costs about as much as the pixels. Bits of a copy, and of the codes that copies bring with them.
SHORTEST, COPY_BITS, COPY_CODES = 6, 24, 500
#: Copies, a colour cache or a transform must leave at most this share of the bits: each costs time whenever the picture is read.
PAYS = 0.92
_MIX = np.array([0x9E3779B97F4A7C15 ** k & 0xFFFFFFFFFFFFFFFF for k in range(1, 4)], dtype=np.uint64)


def _copies(argb: np.ndarray, pixel_bits: float) -> list[tuple[int, int, int]]:
    """(start, length, distance) of stretches that repeat earlier pixels of the picture, if they save more than they cost."""
    n = len(argb) - SHORTEST + 1
    if n < 2:
        return []
    a = argb.astype(np.uint64)
    two = a[:-1] * _MIX[0] + a[1:]
    four = two[:-2] * _MIX[1] + two[2:]
    window = four[:n] * _MIX[2] + two[4 : 4 + n]
    # 16 bits of the mix sort fast; windows that share them by chance are told apart by the whole of it
    order = np.argsort((window >> np.uint64(48)).astype(np.uint16), kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return []
    distance = np.zeros(n + 1, dtype=np.int64)
    distance[order[1:][same]] = order[1:][same] - order[:-1][same]
    edges = np.flatnonzero(np.diff(distance, prepend=0))
    lengths = np.diff(np.append(edges, n + 1))
    out, end = [], 0
    for x, m, d in zip(edges.tolist(), lengths.tolist(), distance[edges].tolist(), strict=True):
        stop = x + m + SHORTEST - 1
        x = max(x, end)
        if d and stop - x >= SHORTEST and (argb[x:stop] == argb[x - d : stop - d]).all():
            out.append((x, stop - x, d))
            end = stop
    saved = sum(m for _, m, _ in out) * pixel_bits - COPY_BITS * len(out) - COPY_CODES
    return out if saved > (1 - PAYS) * pixel_bits * len(argb) else []


_LOG = np.arange(1, 3 * TILE + 2, dtype=np.float64)
_LOG = np.concatenate(([0.0], _LOG * np.log2(_LOG)))


#: Bits of a code that green has for itself.
OWN_CODE = 400


def _entropy(counts: np.ndarray) -> float:
    """Bits that an ideal code takes for symbols with counts."""
    total = int(counts.sum())
    if total < len(_LOG):
        return float(_LOG[total] - _LOG.take(counts).sum())
    return float(total * np.log2(total) - (counts * np.log2(np.maximum(counts, 1))).sum())


def _colours(argb: np.ndarray) -> np.ndarray:
    """Red, green and blue of pixels, one row each."""
    return np.stack((argb >> 16 & 255, argb >> 8 & 255, argb & 255))


def cache_hits(argb: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The slot of the colour cache of each pixel, and whether the pixel is what the slot holds then."""
    slots = ((argb * CACHE_FACTOR) & 0xFFFFFFFF) >> (32 - bits)
    order = np.argsort(slots.astype(np.int16), kind="stable")
    hit = np.zeros(len(argb), dtype=bool)
    hit[order[1:]] = (slots[order[1:]] == slots[order[:-1]]) & (argb[order[1:]] == argb[order[:-1]])
    return slots, hit


def write_pixels(w: Writer, argb: np.ndarray, width: int, cache_bits: int = 0, main: bool = True, bits: float | None = None) -> None:
    """Write pixels: cache size, one group of prefix codes, then literals, back-references and cache hits.

    ``bits``: what an ideal code of the colours takes, where it is known.
    """
    argb = argb.astype(np.int64)
    w.many(np.array([int(cache_bits > 0), cache_bits]), np.array([1, 4 if cache_bits else 0]))
    if main:
        w.put(0, 1)
    if bits is None:
        bits = _entropy(np.bincount(_colours(argb).ravel(), minlength=LITERALS))
    copies = _copies(argb, bits / max(1, len(argb)))
    start = np.ones(len(argb), dtype=bool)
    for a, n, _ in copies:
        start[a + 1 : a + n] = False
    at = np.flatnonzero(start)
    c = _channels(argb[at] if copies else argb)
    green, kind = c[:, 2].copy(), np.zeros(len(at), dtype=np.int64)
    extra = np.zeros((len(at), 4), dtype=np.int64)
    if copies:
        a, n, d = np.array(copies).T
        i = np.searchsorted(at, a)
        kind[i] = 1
        code, extra[i, 0], extra[i, 1] = _prefix(n)
        green[i] = LITERALS + code
        distance, extra[i, 2], extra[i, 3] = _prefix(d + len(NEAR))
    if cache_bits:
        slots, hit = cache_hits(argb, cache_bits)
        kept = (kind == 0) & hit[at]
        kind[kept], green[kept] = 2, LITERALS + LENGTHS + slots[at][kept]
    plain = kind == 0
    alphabet = LITERALS + LENGTHS + ((1 << cache_bits) if cache_bits else 0)
    # red and blue share their code, and green too where it has nothing but literals and is like them
    whole = bool(plain.all())
    literal = c if whole else c[plain]
    sides = np.bincount(literal[:, 1], minlength=LITERALS) + np.bincount(literal[:, 3], minlength=LITERALS)
    shared = sides + np.bincount(literal[:, 2], minlength=LITERALS)
    apart = not whole or _entropy(sides) + _entropy(shared - sides) + OWN_CODE < _entropy(shared)
    if apart:
        shared = sides
    once = Writer()
    of_literals = _write_code(once, shared)
    bits, wide = np.concatenate(once.values), np.concatenate(once.widths)
    if not apart:
        written = [of_literals]
        w.many(bits, wide)
    else:
        written = [_write_code(w, np.bincount(green, minlength=alphabet))]
    for _ in range(2):
        w.many(bits, wide)
        written.append(of_literals)
    written.append(_write_code(w, np.bincount(literal[:, 0], minlength=LITERALS)))
    written.append(_write_code(w, np.bincount(distance, minlength=DISTANCES) if copies else np.zeros(DISTANCES, np.int64)))
    if not apart and not copies and not written[3][1].any():
        # one code for all three channels, none for alpha
        code, size = written[0]
        g, r, b = c[:, 2], c[:, 1], c[:, 3]
        wide = size[g]
        joined = code[g] | code[r] << wide
        wide = wide + size[r]
        w.many(joined | code[b] << wide, wide + size[b])
        return
    values, widths = np.zeros((len(at), 4), np.int64), np.zeros((len(at), 4), np.int64)
    values[:, 0], widths[:, 0] = written[0][0][green], written[0][1][green]
    for column, j in ((1, 1), (2, 3), (3, 0)):
        values[plain, column], widths[plain, column] = (x[literal[:, j]] for x in written[column])
    if copies:
        values[i, 1], widths[i, 1] = extra[i, 0], extra[i, 1]
        values[i, 2], widths[i, 2] = (x[distance] for x in written[4])
        values[i, 3], widths[i, 3] = extra[i, 2], extra[i, 3]
    # the numbers of a pixel make one of at most 60 bits
    joined, wide = values[:, 0], widths[:, 0]
    for j in range(1, 4):
        joined = joined | values[:, j] << wide
        wide = wide + widths[:, j]
    w.many(joined, wide)


def begin_picture(width: int, height: int) -> Writer:
    w = Writer()
    w.many(np.array([0x2F, width - 1, height - 1, 0, 0]), np.array([8, 14, 14, 1, 3]))
    return w


#: Bits that the length of one more symbol takes in a code.
SYMBOL_BITS = 3


def _cache_bits(argb: np.ndarray, rgb: np.ndarray, plain: float) -> int:
    """Size of the colour cache that pays for these pixels, 0 for none; ``plain``: bits of their colours in an ideal code."""
    n = len(argb)
    bits = 4 if n < 256 else 6 if n < 1024 else 8 if n < 1800 else 9
    slots, hit = cache_hits(argb, bits)
    # hits spare at most what their pixels take
    if hit.sum() * plain < (1 - PAYS) * plain * n:
        return 0
    used, missed = np.bincount(slots[hit]), rgb[:, ~hit]
    green = np.bincount(missed[1], minlength=LITERALS)
    rest = np.bincount(missed[::2].ravel(), minlength=LITERALS)
    held = _entropy(np.concatenate((green, used))) + _entropy(rest)
    return bits if held + SYMBOL_BITS * (np.count_nonzero(used) + np.count_nonzero(green) - np.count_nonzero(rest)) < PAYS * plain else 0


def _palette(argb: np.ndarray, width: int) -> tuple[tuple, np.ndarray, int] | None:
    """The colours, the pixels as numbers of colours side by side, and their width; None where colours are too many to pay."""
    ordered = np.sort(argb.astype(np.uint32))
    n = 1 + int(np.count_nonzero(ordered[1:] != ordered[:-1]))
    if n > 256 or 4 * n > len(argb):
        return None
    colours, number = np.unique(argb, return_inverse=True)
    size = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
    depth, wide = 8 >> size, _up(width, size)
    rows = np.zeros((len(argb) // width, wide << size), dtype=np.int64)
    rows[:, :width] = number.reshape(-1, width)
    packed = (rows.reshape(len(rows), wide, 1 << size) << (depth * np.arange(1 << size))).sum(axis=2)
    return (PALETTE, 0, _packed(np.diff(_channels(colours), axis=0, prepend=0))), (0xFF000000 | packed << 8).ravel(), wide


_DISTANCE = np.log2(1.0 + np.minimum(np.arange(256), 256 - np.arange(256))).astype(np.float32)


def _predict(argb: np.ndarray, width: int, size: int = 4) -> tuple[tuple, np.ndarray]:
    """For each block the mode that leaves the least, and what it leaves."""
    c = _channels(argb.reshape(-1, width)).astype(np.int16)
    height = len(c)
    left = np.stack([_residuals(c, mode).astype(np.uint8) for mode in range(14)])
    cost = _DISTANCE[left].sum(axis=3)
    down, across = _up(height, size), _up(width, size)
    padded = np.zeros((14, down << size, across << size))
    padded[:, :height, :width] = cost
    modes = padded.reshape(14, down, 1 << size, across, 1 << size).sum(axis=(2, 4)).argmin(axis=0)
    chosen = modes[np.arange(height)[:, None] >> size, np.arange(width) >> size]
    best = left[chosen, np.arange(height)[:, None], np.arange(width)]
    return (PREDICTOR, size, 0xFF000000 | modes << 8), _packed(best.astype(np.int64)).ravel()


def _less_green(argb: np.ndarray) -> np.ndarray:
    g = argb >> 8 & 255
    return argb & 0xFF00FF00 | ((argb >> 16) - g & 255) << 16 | (argb & 255) - g & 255


def _slopes(rgb: np.ndarray) -> tuple[int, int, int] | None:
    """What green says of red and of blue, and red of blue, in 32nds; None where they say little."""
    signed = rgb.view(np.int8).astype(np.float32)
    signed -= signed.mean(axis=1, keepdims=True)
    (rr, rg, rb), (_, gg, gb), (_, _, bb) = (signed @ signed.T).tolist()
    if not gg or max(rg * rg / max(gg * rr, 1e-9), gb * gb / max(gg * bb, 1e-9)) < 0.25:
        return None
    to = lambda v: int(np.clip(round(32 * v), -128, 127)) & 255
    # of blue what green does not say
    rest = rb - gb / gg * rg
    return to(rg / gg), to(gb / gg), to(rest / rr) if abs(rest) > 0.25 * rr else 0


def _written(argb: np.ndarray, rgb: np.ndarray, bits: float, width: int, height: int, steps: list[tuple], coded_width: int) -> bytes:
    w = begin_picture(width, height)
    for kind, size, data in steps:
        w.many(np.array([1, kind]), np.array([1, 2]))
        if kind in (PREDICTOR, CROSS_COLOR):
            w.put(size - 2, 3)
            write_pixels(w, data.ravel(), data.shape[1], main=False)
        elif kind == PALETTE:
            w.put(len(data) - 1, 8)
            write_pixels(w, data, len(data), main=False)
    w.put(0, 1)
    write_pixels(w, argb, coded_width, _cache_bits(argb, rgb, bits), bits=bits)
    return w.bytes()


def encode_tile(argb: np.ndarray, width: int) -> bytes:
    """A VP8L chunk of pixels: with the transforms, colour cache and copies that make it smallest of those worth trying."""
    height = len(argb) // width
    tries: list[tuple] = []
    rgb = _colours(argb).astype(np.uint8)
    flat = rgb.T.ravel()
    plain = _entropy(np.bincount(flat, minlength=LITERALS))
    left = lambda step: _entropy(np.bincount(flat[step:] - flat[:-step], minlength=LITERALS))
    alike = left(3) < PAYS * plain or height > 1 and left(3 * width) < PAYS * plain
    less = _entropy(np.bincount(rgb[1], minlength=LITERALS)) + _entropy(np.bincount((rgb[::2] - rgb[1]).ravel(), minlength=LITERALS))
    if alike:
        step, rest = _predict(argb, width)
        tries.append(([step], rest, width))
    if less < PAYS * plain:
        green = _less_green(argb)
        tries.append(([(SUBTRACT_GREEN, 0, None)], green, width))
        if alike:
            step, rest = _predict(green, width)
            tries.append(([(SUBTRACT_GREEN, 0, None), step], rest, width))
    slopes = _slopes(rgb)
    if slopes is not None:
        to_red, to_blue, red_to_blue = slopes
        factors = np.array([[0xFF000000 | red_to_blue << 16 | to_blue << 8 | to_red]])
        rest = cross_colour(argb.reshape(height, width), 9, factors, -1).ravel()
        tries.append(([(CROSS_COLOR, 9, factors)], rest, width))
    palette = _palette(argb, width)
    if palette is not None:
        step, packed, wide = palette
        tries.append(([step], packed, wide))
    made = [_written(argb, rgb, plain, width, height, [], width)]
    for steps, pixels, coded in tries:
        of = _colours(pixels).astype(np.uint8)
        green, sides = np.bincount(of[1], minlength=LITERALS), np.bincount(of[::2].ravel(), minlength=LITERALS)
        bits = min(_entropy(green + sides), _entropy(green) + _entropy(sides) + OWN_CODE)
        if bits < PAYS * plain:
            made.append(_written(pixels, of, bits, width, height, steps, coded))
    return min(made, key=len)


# --- files -------------------------------------------------------------------------------------------


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + bytes(len(data) & 1)


def _three(n: int) -> bytes:
    return struct.pack("<I", n)[:3]


def encode(payload: bytes) -> bytes:
    """A WebP file of a payload whose length is a positive multiple of 3 * WIDTH."""
    rgb = np.frombuffer(payload, dtype=np.uint8).reshape(-1, 3).astype(np.int64)
    argb = 0xFF000000 | rgb[:, 0] << 16 | rgb[:, 1] << 8 | rgb[:, 2]
    tiles = [encode_tile(argb[a : a + TILE], WIDTH) for a in range(0, len(argb), TILE)]
    if len(tiles) == 1:
        body = _chunk(b"VP8L", tiles[0])
    else:
        height, rows = len(argb) // WIDTH, TILE // WIDTH
        body = _chunk(b"VP8X", b"\x02\0\0\0" + _three(WIDTH - 1) + _three(height - 1)) + _chunk(b"ANIM", bytes(6))
        for k, tile in enumerate(tiles):
            tall = min(rows, height - k * rows)
            # offsets count in twos; duration 0, no blending, the frame stays
            head = _three(0) + _three(k * rows // 2) + _three(WIDTH - 1) + _three(tall - 1) + _three(0) + b"\x02"
            body += _chunk(b"ANMF", head + _chunk(b"VP8L", tile))
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WEBP" + body


def _chunks(data: bytes, at: int):
    while at + 8 <= len(data):
        size = struct.unpack_from("<I", data, at + 4)[0]
        yield data[at : at + 4], data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)


def pictures(media: bytes) -> list[tuple[int, bytes]]:
    """(first row, VP8L chunk) of the pictures of a file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    out = []
    for name, data in _chunks(media, 12):
        if name == b"VP8L":
            out.append((0, data))
        elif name == b"ANMF":
            row = 2 * int.from_bytes(data[3:6], "little")
            out += [(row, inner) for kind, inner in _chunks(data, 16) if kind == b"VP8L"]
    return out


def decode(files: list[bytes]) -> list[np.ndarray]:
    """The RGB samples (rows, width, 3) of every file; all pictures of all files are decoded together."""
    found = [(i, row, Picture(data)) for i, media in enumerate(files) for row, data in pictures(media)]
    # pictures with a colour cache take more for each pixel, so that the others go without them
    pixels: list = [None] * len(found)
    for cached in (False, True):
        some = [k for k, (_, _, p) in enumerate(found) if (p.cache_bits > 0) == cached]
        if some:
            for k, argb in zip(some, decode_pixels([found[k][2] for k in some])[0], strict=True):
                pixels[k] = argb
    parts: list[list[tuple[int, np.ndarray]]] = [[] for _ in files]
    for (i, row, p), argb in zip(found, pixels, strict=True):
        rows = invert(p, argb) if p.transforms else argb.reshape(p.height, p.coded_width)
        parts[i].append((row, np.stack((rows >> 16 & 255, rows >> 8 & 255, rows & 255), axis=2).astype(np.uint8)))
    return [np.concatenate([x for _, x in sorted(p, key=lambda q: q[0])]) for p in parts]
