"""Lossless WebP (VP8L) as a media column: a decoder for the whole format, and a writer for grey images.

The decoder reads prefix codes, back-references, the colour cache and meta prefix codes and inverts
the predictor, cross-colour, subtract-green and palette transforms. The writer turns bytes into
8-bit grey pixels, 64 to a row or as many as keep the image within the format's 16384 rows: a palette with bundled pixels
for up to 16 distinct values, else subtract-green, with a predictor from the left or from above where that needs fewer bits; repeated lines
become back-references; the rest is prefix-coded. (A colour cache cannot make grey images smaller, whose other channels cost nothing.)
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._shared import bounded, small_batches, utf8

# Fixed values of the public VP8L bitstream specification.
_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
_CACHE_FACTOR = 0x1E35A7BD
#: Near distances: offsets (x, y) above and to the left of a pixel, nearest first.
_NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))

_PREDICTOR, _CROSS, _SUBTRACT_GREEN, _PALETTE = range(4)


class _Bits:
    """Bits of a byte string, least significant first."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def read(self, n: int) -> int:
        if not n:
            return 0
        first, last = self.at >> 3, (self.at + n + 7) >> 3
        if last > len(self.data):
            raise ValueError("the image ends early")
        value = int.from_bytes(self.data[first:last], "little") >> (self.at & 7)
        self.at += n
        return value & ((1 << n) - 1)

    def peek15(self) -> int:
        first = self.at >> 3
        return (int.from_bytes(self.data[first : first + 3], "little") >> (self.at & 7)) & 0x7FFF


#: Each 15-bit number with its bits in reverse.
_REVERSED = (np.arange(1 << 15)[:, None] >> np.arange(15) & 1) @ (1 << np.arange(14, -1, -1))


def _canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Used symbols by code, and how many of the 15-bit numbers each takes."""
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    return used, 1 << (15 - lengths[used])


def _reversed_codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes of the lengths, bits reversed as they stand in the stream."""
    used, span = _canonical(lengths)
    codes = np.zeros(len(lengths), np.int64)
    codes[used] = _REVERSED[np.cumsum(span) - span]
    return codes


class _Prefix:
    """A prefix code as a table over the next ``width`` bits: symbol * 16 + length."""

    def __init__(self, lengths: np.ndarray) -> None:
        used, span = _canonical(lengths)
        self.only = (int(used[0]) if len(used) else 0) if len(used) < 2 else None
        if self.only is not None:
            return
        if span.sum() != 1 << 15:
            raise ValueError("a prefix code is not complete")
        self.width = width = int(lengths[used[-1]])
        by_code = np.repeat((used * 16 + lengths[used]).astype(np.int32), span >> (15 - width))
        self.table = by_code[_REVERSED[: 1 << width] >> (15 - width)]
        self._list: list[int] | None = None

    def read(self, bits: _Bits) -> int:
        if self.only is not None:
            return self.only
        if self._list is None:
            self._list = self.table.tolist()
        entry = self._list[bits.peek15() & ((1 << self.width) - 1)]
        bits.at += entry & 15
        return entry >> 4


def _read_prefix(bits: _Bits, size: int) -> _Prefix:
    lengths = np.zeros(size, np.int64)
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        lengths[bits.read(8 if wide else 1)] = 1
        if two:
            lengths[bits.read(8)] = 1
        return _Prefix(lengths)
    own = np.zeros(19, np.int64)
    for i in range(bits.read(4) + 4):
        own[_LENGTH_ORDER[i]] = bits.read(3)
    code = _Prefix(own)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    i, last = 0, 8
    while i < size and left:
        left -= 1
        n = code.read(bits)
        if n < 16:
            lengths[i] = n
            i, last = i + 1, n or last
        else:
            value, extra, least = ((last, 2, 3), (0, 3, 3), (0, 7, 11))[n - 16]
            times = bits.read(extra) + least
            lengths[i : i + times] = value
            i += times
    return _Prefix(lengths)


def _extra(bits: _Bits, prefix: int) -> int:
    if prefix < 4:
        return prefix + 1
    n = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << n) + bits.read(n) + 1


def _distance(code: int, width: int) -> int:
    if code > 120:
        return code - 120
    x, y = _NEAR[code - 1]
    return max(1, x + y * width)


def _read_image(bits: _Bits, width: int, height: int, main: bool) -> np.ndarray:
    """Entropy-coded ARGB pixels, flat."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    groups_of, shift, n_groups = None, 0, 1
    if main and bits.read(1):
        shift = bits.read(3) + 2
        across = -(-width >> shift)
        groups_of = ((_read_image(bits, across, -(-height >> shift), False) >> 8) & 0xFFFF).tolist()
        n_groups = max(groups_of) + 1
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    groups = [[_read_prefix(bits, n) for n in sizes] for _ in range(n_groups)]
    green, red, blue, alpha, dist = groups[0]
    if groups_of is None and not cache_bits and green.only is None and None not in (red.only, blue.only, alpha.only):
        return _read_grey(bits, width, width * height, green, dist, (alpha.only << 24) | (red.only << 16) | blue.only)
    out, total, cache = [], width * height, [0] * (1 << cache_bits)
    cached = 0
    while (at := len(out)) < total:
        if groups_of is not None:
            green, red, blue, alpha, dist = groups[groups_of[(at // width >> shift) * across + (at % width >> shift)]]
        s = green.read(bits)
        if s < 256:
            r = red.read(bits)
            b = blue.read(bits)
            out.append((alpha.read(bits) << 24) | (r << 16) | (s << 8) | b)
        elif s < 280:
            n = _extra(bits, s - 256)
            d = _distance(_extra(bits, dist.read(bits)), width)
            if d > at or at + n > total:
                raise ValueError("a back-reference leaves the image")
            for i in range(at - d, at - d + n):
                out.append(out[i])
        else:
            for p in out[cached:]:
                cache[(_CACHE_FACTOR * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
            cached = at
            out.append(cache[s - 280])
    return np.array(out, np.uint32)


def _read_grey(bits: _Bits, width: int, total: int, green: _Prefix, dist: _Prefix, rest: int) -> np.ndarray:
    """Pixels that differ in green only: what the code would read at every bit is looked up at once, then followed."""
    out = np.empty(total, np.uint32)
    at, span = 0, 1 << 15
    while at < total:
        first = bits.at >> 3
        if first >= len(bits.data):
            raise ValueError("the image ends early")
        own = bits.data[first : first + span + 2]
        raw = np.frombuffer(own.ljust(min(span, len(bits.data) - first) + 2, b"\0"), np.uint8).astype(np.uint32)
        three = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
        entries = green.table[(three[:, None] >> np.arange(8, dtype=np.uint32) & ((1 << green.width) - 1)).ravel()]
        # A zero stops the walk: at a back-reference, and behind the last bit.
        steps = np.where(entries >= 256 * 16, 0, entries & 15).astype(np.uint8).tobytes() + bytes(16)
        p, end, seen = bits.at - first * 8, len(entries), []
        put = seen.append
        for _ in range(total - at):
            step = steps[p]
            if not step:
                break
            put(p)
            p += step
        out[at : at + len(seen)] = entries[seen] >> 4
        at += len(seen)
        bits.at = first * 8 + p
        if at < total and p < end:
            n = _extra(bits, green.read(bits) - 256)
            d = _distance(_extra(bits, dist.read(bits)), width)
            if d > at or at + n > total:
                raise ValueError("a back-reference leaves the image")
            while n:
                m = min(n, d)
                out[at : at + m] = out[at - d : at - d + m]
                at, n = at + m, n - m
    return (out << 8) | np.uint32(rest)


def _channels(argb: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(argb, "<u4").view(np.uint8).reshape(*argb.shape, 4)  # B, G, R, A


def _average(a: list[int], b: list[int]) -> list[int]:
    return [(x + y) >> 1 for x, y in zip(a, b, strict=True)]


def _select(left: list[int], top: list[int], corner: list[int]) -> list[int]:
    to_left = sum(abs(t - c) for t, c in zip(top, corner, strict=True))
    to_top = sum(abs(x - c) for x, c in zip(left, corner, strict=True))
    return left if to_left < to_top else top


def _clamp(x: int) -> int:
    return 0 if x < 0 else 255 if x > 255 else x


def _half(a: int, b: int) -> int:
    """Half of a difference, towards zero."""
    return (a - b) // 2 if a >= b else -((b - a) // 2)


_PREDICT = (
    lambda left, top, corner, right: [0, 0, 0, 255],
    lambda left, top, corner, right: left,
    lambda left, top, corner, right: top,
    lambda left, top, corner, right: right,
    lambda left, top, corner, right: corner,
    lambda left, top, corner, right: _average(_average(left, right), top),
    lambda left, top, corner, right: _average(left, corner),
    lambda left, top, corner, right: _average(left, top),
    lambda left, top, corner, right: _average(corner, top),
    lambda left, top, corner, right: _average(top, right),
    lambda left, top, corner, right: _average(_average(left, corner), _average(top, right)),
    lambda left, top, corner, right: _select(left, top, corner),
    lambda left, top, corner, right: [_clamp(x + y - z) for x, y, z in zip(left, top, corner, strict=True)],
    lambda left, top, corner, right: [_clamp(m + _half(m, z)) for m, z in zip(_average(left, top), corner, strict=True)],
)


def _undo_predictor(pixels: np.ndarray, width: int, shift: int, modes: np.ndarray) -> np.ndarray:
    kinds = np.unique((modes >> 8) & 15)
    if len(kinds) == 1 and kinds[0] in (1, 2):
        # Left or above everywhere: sums along rows or columns, from the first column or row on.
        c = _channels(pixels.reshape(-1, width)).copy()
        c[0, 0, 3] = (int(c[0, 0, 3]) + 255) & 255
        edge, axis = (c[:, 0], 1) if kinds[0] == 1 else (c[0], 0)
        np.cumsum(edge, axis=0, dtype=np.uint8, out=edge)
        return np.ascontiguousarray(np.cumsum(c, axis=axis, dtype=np.uint8)).view("<u4").ravel()
    rows = _channels(pixels.reshape(-1, width)).tolist()
    across = -(-width >> shift)
    mode = ((modes >> 8) & 15).tolist()
    for y, row in enumerate(rows):
        for x, p in enumerate(row):
            if y == 0:
                guess = row[x - 1] if x else [0, 0, 0, 255]
            elif x == 0:
                guess = rows[y - 1][0]
            else:
                above = rows[y - 1]
                guess = _PREDICT[mode[(y >> shift) * across + (x >> shift)] % 14](row[x - 1], above[x], above[x - 1], above[x + 1] if x + 1 < width else row[0])
            row[x] = [(a + b) & 255 for a, b in zip(p, guess, strict=True)]
    return np.array(rows, np.uint8).view("<u4").ravel()


def _undo_cross(pixels: np.ndarray, width: int, shift: int, elements: np.ndarray) -> np.ndarray:
    c = _channels(pixels.reshape(-1, width)).astype(np.int32)
    y, x = np.indices(c.shape[:2])
    e = _channels(elements)[(y >> shift) * -(-width >> shift) + (x >> shift)].astype(np.int8).astype(np.int32)
    signed = lambda v: (v & 255).astype(np.uint8).astype(np.int8).astype(np.int32)
    green = signed(c[..., 1])
    red = c[..., 2] + (e[..., 0] * green >> 5)
    c[..., 0] = c[..., 0] + (e[..., 1] * green >> 5) + (e[..., 2] * signed(red) >> 5)
    c[..., 2] = red
    return (c & 255).astype(np.uint8).view("<u4").ravel()


def _undo_palette(pixels: np.ndarray, width: int, height: int, bits: int, palette: np.ndarray) -> np.ndarray:
    index = (pixels >> 8) & 255
    if bits:
        each = 8 >> bits
        index = (index.reshape(height, -1, 1) >> (np.arange(1 << bits) * each).astype(np.uint32)) & ((1 << each) - 1)
        index = index.reshape(height, -1)[:, :width].ravel()
    return np.where(index < len(palette), palette[np.minimum(index, len(palette) - 1)], 0).astype(np.uint32)


def decode(data: bytes) -> np.ndarray:
    """A lossless WebP file -> array (height, width, 4) of red, green, blue, alpha."""
    if data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L":
        raise ValueError("not a lossless WebP file")
    bits = _Bits(data[20 : 20 + int.from_bytes(data[16:20], "little")])
    if bits.read(8) != 0x2F:
        raise ValueError("no VP8L signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    has_alpha = bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    steps, now = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (_PREDICTOR, _CROSS):
            shift = bits.read(3) + 2
            steps.append((kind, now, shift, _read_image(bits, -(-now >> shift), -(-height >> shift), False)))
        elif kind == _PALETTE:
            n = bits.read(8) + 1
            colours = np.cumsum(_channels(_read_image(bits, n, 1, False)), axis=0, dtype=np.uint8).view("<u4").ravel()
            bundle = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            steps.append((kind, now, bundle, colours))
            now = -(-now >> bundle)
        else:
            steps.append((kind, now, 0, None))
    pixels = _read_image(bits, now, height, True)
    for kind, own, n, extra in reversed(steps):
        if kind == _PREDICTOR:
            pixels = _undo_predictor(pixels, own, n, extra)
        elif kind == _CROSS:
            pixels = _undo_cross(pixels, own, n, extra)
        elif kind == _PALETTE:
            pixels = _undo_palette(pixels, own, height, n, extra)
        else:
            c = _channels(pixels).copy()
            c[:, 0] += c[:, 1]
            c[:, 2] += c[:, 1]
            pixels = c.view("<u4").ravel()
    out = _channels(pixels.reshape(height, width))[..., [2, 1, 0, 3]].copy()
    if not has_alpha:
        out[..., 3] = 255
    return out


# --- writer ---------------------------------------------------------------------------------------

#: Pixels of a row, and the most that the format allows along a side. Only payloads of more than its square, 256 MiB, are several files one after the other.
_ROW, _MOST = 64, 1 << 14
SEGMENT = _MOST * _MOST
_SHORTEST_COPY = 24


def _code_lengths(counts: np.ndarray, longest: int = 12) -> np.ndarray:
    """Lengths of a prefix code for the counts; counts are flattened until no code is too long."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts).tolist()
    weights = counts.copy()
    while True:
        if len(used) < 2:
            lengths[used] = 1
            return lengths
        nodes = weights[used].tolist()
        heap = [(n, i) for i, n in enumerate(nodes)]
        heapq.heapify(heap)
        parent = [0] * (2 * len(used) - 1)
        for new in range(len(used), 2 * len(used) - 1):
            n, a = heapq.heappop(heap)
            m, b = heap[0]
            parent[a] = parent[b] = new
            heapq.heapreplace(heap, (n + m, new))
        depth = [0] * len(parent)
        for i in range(len(parent) - 2, -1, -1):
            depth[i] = depth[parent[i]] + 1
        if max(depth) <= longest:
            lengths[used] = depth[: len(used)]
            return lengths
        weights = np.where(weights > 0, (weights >> 1) + 1, 0)


def _prefix_value(value: int) -> tuple[int, int, int]:
    """(prefix, extra bits, how many) of a length or distance."""
    if value <= 4:
        return value - 1, 0, 0
    value -= 1
    n = value.bit_length() - 2
    return 2 * (n + 1) + (value >> n & 1), value & ((1 << n) - 1), n


class _Writer:
    def __init__(self) -> None:
        self.values: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def put(self, *pairs: tuple[int, int]) -> None:
        self.array(np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64))

    def array(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values.append(values)
        self.sizes.append(sizes)

    def prefix(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Write a code's lengths; returns what its symbols are written as."""
        used = np.flatnonzero(lengths)
        if len(used) < 2 and (not len(used) or used[0] < 256):
            self.put((1, 1), (0, 1), (1, 1), (int(used[0]) if len(used) else 0, 8))
            return np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        tokens, i, end = [], 0, int(used[-1]) + 1
        plain = lengths.tolist()
        while i < end:
            n = 1
            while i + n < end and plain[i + n] == plain[i]:
                n += 1
            if plain[i] == 0 and n >= 3:
                n = min(n, 138)
                tokens.append((17, n - 3, 3) if n <= 10 else (18, n - 11, 7))
            else:
                n = 1
                tokens.append((plain[i], 0, 0))
            i += n
        own = _code_lengths(np.bincount([t[0] for t in tokens], minlength=19), 7)
        if (own > 0).sum() < 2:
            own[17 if own[17] == 0 else 18] = 1
        stored = [int(own[s]) for s in _LENGTH_ORDER]
        self.put((0, 1), (15, 4), *[(n, 3) for n in stored])
        n = len(tokens)
        wide = max(0, ((n - 2).bit_length() - 1) // 2)
        self.put((1, 1), (wide, 3), (n - 2, 2 + 2 * wide))
        codes = _reversed_codes(own)
        self.put(*[x for s, extra, m in tokens for x in ((int(codes[s]), int(own[s])), (extra, m))])
        return _reversed_codes(lengths), lengths

    def bytes(self) -> bytes:
        values, sizes = np.concatenate(self.values), np.concatenate(self.sizes)
        out, rest = [], np.zeros(0, np.uint8)
        for s in range(0, len(values), 1 << 16):
            v, n = values[s : s + (1 << 16)], sizes[s : s + (1 << 16)]
            place = np.arange(int(n.max()))
            bits = (v[:, None] >> place & 1).astype(np.uint8)[place < n[:, None]]
            if len(values) <= 1 << 16:
                return np.packbits(bits, bitorder="little").tobytes()
            bits = np.r_[rest, bits]
            whole = len(bits) & ~7
            out.append(np.packbits(bits[:whole], bitorder="little").tobytes())
            rest = bits[whole:]
        return b"".join(out) + np.packbits(rest, bitorder="little").tobytes()


def _copies(data: bytes) -> list[tuple[int, int, int]]:
    """(start, length, distance) of lines that stood earlier in ``data``."""
    if data.count(b"\n") < 2:
        return []
    out, seen, at = [], {}, 0
    for line in data.split(b"\n"):
        if len(line) >= _SHORTEST_COPY:
            if line in seen:
                out += [(at + i, min(4096, len(line) - i), at - seen[line]) for i in range(0, len(line), 4096)]
            seen[line] = at
        at += len(line) + 1
    return out


def _bits_needed(counts: np.ndarray) -> float:
    """Bits of symbols that occur so often, each by its share."""
    n = counts[counts > 0]
    return float(n.sum() * np.log2(n.sum()) - (n * np.log2(n)).sum())


def _residuals(grey: np.ndarray) -> dict[int, np.ndarray]:
    """What the predictor leaves with mode 1 (left; above in the first column) and mode 2 (above; left in the first row)."""
    left, above = grey.copy(), grey.copy()
    left[:, 1:] -= grey[:, :-1]
    left[1:, 0] -= grey[:-1, 0]
    above[1:] -= grey[:-1]
    above[0, 1:] -= grey[0, :-1]
    return {1: left, 2: above}


def encode_grey(samples: bytes, width: int = _ROW) -> bytes:
    """8-bit grey samples, a whole number of rows, as one lossless WebP file."""
    raw = np.frombuffer(samples, np.uint8)
    height = len(raw) // width
    out = _Writer()
    out.put((0x2F, 8), (width - 1, 14), (height - 1, 14), (0, 1), (0, 3))
    plain = np.bincount(raw, minlength=256)
    values = np.flatnonzero(plain)
    symbols, copies, opaque = raw, [], 255
    if len(values) <= 16:
        n = len(values)
        bundle = 3 if n <= 2 else 2 if n <= 4 else 1
        out.put((1, 1), (_PALETTE, 2), (n - 1, 8), (0, 1))
        colours = np.diff(values, prepend=0)
        lengths = _code_lengths(np.bincount(colours, minlength=280))
        codes = [out.prefix(lengths), out.prefix(lengths[:256]), out.prefix(lengths[:256])]
        alpha = np.r_[255, np.zeros(n - 1, np.int64)]
        codes += [out.prefix(_code_lengths(np.bincount(alpha, minlength=256)))]
        out.prefix(np.zeros(40, np.int64))
        for colour, a in zip(colours.tolist(), alpha.tolist(), strict=True):
            out.put(*[(int(c[0][s]), int(c[1][s])) for c, s in zip(codes, (colour, colour, colour, a), strict=True)])
        index = np.searchsorted(values, raw).reshape(-1, 1 << bundle)
        symbols = (index << (np.arange(1 << bundle) * (8 >> bundle))).sum(1)
    else:
        out.put((1, 1), (_SUBTRACT_GREEN, 2))
        whole = _bits_needed(plain)
        # Under six bits a sample, as in prose, neighbours say little; then it is not tried.
        guesses = _residuals(raw.reshape(height, width)) if whole > 6 * len(raw) else {}
        need = {mode: _bits_needed(np.bincount(x.ravel(), minlength=256)) for mode, x in guesses.items()}
        mode = min(need, key=need.get, default=0)
        if need and need[mode] < 0.95 * whole:
            # One mode for all blocks: an image of modes that takes no bits for its pixels.
            out.put((1, 1), (_PREDICTOR, 2), (7, 3), (0, 1))
            for always in (mode, 0, 0, 255, 0):
                out.put((1, 1), (0, 1), (1, 1), (always, 8))
            symbols, opaque = guesses[mode].ravel(), 0
        else:
            copies = _copies(samples)
    out.put((0, 1), (0, 1), (0, 1))
    parts, at, far = [], 0, []
    for start, length, distance in copies:
        parts.append(symbols[at:start])
        far.append((_prefix_value(length), _prefix_value(distance + 120)))
        at = start + length
    parts.append(symbols[at:])
    counts = np.bincount(np.concatenate(parts), minlength=280)
    for length, _ in far:
        counts[256 + length[0]] += 1
    code, size = out.prefix(_code_lengths(counts))
    for always in (0, 0, opaque):
        out.prefix(np.eye(1, 256, always, dtype=np.int64)[0])
    dist_code, dist_size = out.prefix(_code_lengths(np.bincount([d[0] for _, d in far], minlength=40)))
    for i, part in enumerate(parts):
        out.array(code[part], size[part])
        if i < len(far):
            length, d = far[i]
            out.put((int(code[256 + length[0]]), int(size[256 + length[0]])), length[1:], (int(dist_code[d[0]]), int(dist_size[d[0]])), d[1:])
    body = out.bytes()
    chunk = b"VP8L" + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk


def encode_payload(payload: bytes) -> bytes:
    """A payload (a positive multiple of 64 bytes) as one WebP file; beyond ``SEGMENT`` bytes several, one after the other.

    Rows have 64 pixels. Where that gives too many rows they are as many times longer as needed, and zeros fill the last one up.
    """
    out = []
    for i in range(0, len(payload), SEGMENT):
        part = payload[i : i + SEGMENT]
        rows = len(part) // _ROW
        width = _ROW * -(-rows // _MOST)
        out.append(encode_grey(part.ljust(-(-len(part) // width) * width, b"\0"), width))
    return b"".join(out)


def payload_size(n_bytes: int) -> int:
    """The length of the payload of so many bytes of text."""
    return max(64, -(-n_bytes // 64) * 64)


def decode_payload(media: bytes, size: int) -> bytes:
    """The first ``size`` samples of the files."""
    out, at = [], 0
    while at < len(media):
        end = at + 8 + int.from_bytes(media[at + 4 : at + 8], "little")
        out.append(decode(media[at:end])[..., 1].tobytes())
        at = end
    return b"".join(out)[:size]


def features(samples: bytes) -> str:
    """Mean, deviation, entropy and a 16-bin histogram (shares) of the samples."""
    counts = np.bincount(np.frombuffer(samples, np.uint8), minlength=256)
    share = counts / counts.sum()
    level = np.arange(256)
    mean = float(share @ level)
    deviation = float(np.sqrt(max(0.0, share @ (level - mean) ** 2)))
    entropy = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
    return ";".join([f"{mean:.4f}", f"{deviation:.4f}", f"{abs(entropy):.4f}", *[f"{x:.4f}" for x in share.reshape(16, 16).sum(1).tolist()]])


def store_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, media binary)``: each text's UTF-8 bytes, zero-padded to a positive multiple of 64, as lossless WebP.

    Null reads as empty (64 zero bytes). Equal texts give equal files. Row by row; no shuffle. Repeated rows stay repeated; other
    columns play no part.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col, 1 << 20):
            raw = utf8(batch.column(text_col))
            media = [encode_payload(b.ljust(payload_size(len(b)), b"\0")) for b in raw]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([len(b) for b in raw], pa.int64()), pa.array(media, pa.binary())], schema.names)

    return bounded(df).select(id_col, text_col).mapInArrow(run, schema)


def read_pixels(df: DataFrame, media_col: str = "media", id_col: str = "doc_id") -> DataFrame:
    """``(id, frame, height, width, pixels binary)`` of every WebP file in a column: rows of red, green, blue, alpha bytes.

    A null column gives no frame; a broken file raises. A text that :func:`store_texts` stored is the first samples of any colour.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("frame", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("pixels", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, media in enumerate(batch.column(media_col).to_pylist()):
                at = frame = 0
                while media and at < len(media):
                    end = at + 8 + int.from_bytes(media[at + 4 : at + 8], "little")
                    image = decode(media[at:end])
                    h, w = image.shape[:2]
                    yield pa.RecordBatch.from_arrays([batch.column(id_col).slice(row, 1), pa.array([frame], pa.int32()), pa.array([h], pa.int32()), pa.array([w], pa.int32()), pa.array([image.tobytes()], pa.binary())], schema.names)
                    at, frame = end, frame + 1

    return bounded(df).select(id_col, media_col).mapInArrow(run, schema)


def media_digests(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Read stored media back: ``(id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature)``."""
    schema = T.StructType(
        [df.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_sha256", T.StringType()), T.StructField("tail_crc32", T.LongType())]
        + [T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType()), T.StructField("feature", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, media_col, 1 << 20):
            media = batch.column(media_col).to_pylist()
            payload = [decode_payload(m, payload_size(n)) for m, n in zip(media, batch.column("n_bytes").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("n_bytes"), pa.array([len(p) for p in payload], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in payload])]
                + [pa.array([zlib.crc32(p[-64:]) for p in payload], pa.int64()), pa.array([len(m) for m in media], pa.int64()), pa.array([hashlib.sha256(m).hexdigest() for m in media]), pa.array([features(p) for p in payload])],
                schema.names,
            )

    return bounded(df).select(id_col, "n_bytes", media_col).mapInArrow(run, schema)


def op3_webp(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every document. ``feature`` is the mean, deviation, entropy and a histogram of 16 bins of the samples read back."""
    return media_digests(store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
