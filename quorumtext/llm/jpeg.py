"""Progressive JPEG in numpy: many images of one layout are coded and decoded in lockstep.

The decoder reads the scans in file order into coefficient arrays: DC and AC bands
(spectral selection), first passes and refinements (successive approximation), Huffman
tables as given, end-of-band runs, interleaved or single components, any restart interval
and sampling factors. Restart segments are independent, so the segments of all images in a
batch advance together, one symbol a step, with numpy over the segments. Then come an exact
integer inverse transform, chroma upsampling and RGB.

The encoder writes coefficients as they are (quantisers of 1), so a payload stored as
coefficients comes back bit for bit; scripts and layout are those of ordinary progressive
files with 4:2:0 sampling.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

# Fixed values of the file format: zigzag order, by its rule; marker codes.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
SOI, EOI, SOF2, DHT, DQT, DRI, SOS, COM = 0xD8, 0xD9, 0xC2, 0xC4, 0xDB, 0xDD, 0xDA, 0xFE

RESTART = 4
SAMPLING = ((2, 2), (1, 1), (1, 1))  # of Y, Cb, Cr: horizontal, vertical
MCU_BLOCKS = sum(h * v for h, v in SAMPLING)
#: Scans: components, first and last coefficient, Ah, Al.
SCRIPT = (((0, 1, 2), 0, 0, 0, 1), ((0,), 1, 5, 0, 1), ((1,), 1, 63, 0, 1), ((2,), 1, 63, 0, 1), ((0,), 6, 63, 0, 1), ((0, 1, 2), 0, 0, 1, 0), ((0,), 1, 63, 1, 0), ((1,), 1, 63, 1, 0), ((2,), 1, 63, 1, 0))

_COS = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(0.125) if u == 0 else 0.5) for x in range(8)] for u in range(8)])
_SCALE = 13
#: Sample y, x of a block from its coefficient u, v: whole numbers, so sums are exact in float64.
_IDCT = np.rint(np.einsum("uy,vx->uvyx", _COS, _COS).reshape(64, 64) * (1 << _SCALE))


# Huffman tables: 12 frequent symbols have 4 bits, all others 12, given by this rule.
_SHORT = (0, 1, 2, 3, 4, 5, 6, 7, 8, 0x11, 0x12, 0x13)


def _table(symbols: tuple[int, ...]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(DHT body without class, code by symbol, length by symbol)."""
    rest = [s for s in range(256) if s not in symbols]
    counts = [0] * 16
    counts[3], counts[11] = len(symbols), len(rest)
    code, length = np.zeros(256, np.int64), np.zeros(256, np.int64)
    code[list(symbols)], length[list(symbols)] = np.arange(len(symbols)), 4
    code[rest], length[rest] = (len(symbols) << 8) + np.arange(len(rest)), 12
    return bytes(counts) + bytes(symbols) + bytes(rest), code, length


_BODY, _CODE, _LEN = _table(_SHORT)


def _category(v: np.ndarray) -> np.ndarray:
    """Bits of |v|."""
    return np.frexp(np.abs(v).astype(np.float64))[1]


def _extra(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.where(v < 0, v + (1 << s) - 1, v)


class _Bits:
    """Bit strings in the order of ``key``, packed for each restart segment."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, key: np.ndarray, code: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((key, code, n))

    def pack(self, shift: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, first byte of each segment): key >> shift is the segment; ones fill the last byte."""
        key = np.concatenate([p[0] for p in self.parts])
        order = np.argsort(key, kind="stable")
        code = np.concatenate([p[1] for p in self.parts])[order].astype(np.uint64)
        n = np.concatenate([p[2] for p in self.parts])[order].astype(np.int64)
        seg = (key[order] >> shift).astype(np.int64)
        end = np.cumsum(n)
        total = np.bincount(seg, weights=n, minlength=segments).astype(np.int64)
        size = (total + 7) // 8
        first = np.concatenate([[0], np.cumsum(size)])
        at = end - n - np.repeat(np.cumsum(total) - total, np.bincount(seg, minlength=segments)) + 8 * first[seg]
        word = at >> 5
        wide = code << (64 - n - (at & 31)).astype(np.uint64)
        out = np.zeros(int(first[-1]) // 4 + 2, np.uint64)
        for w, v in ((word, wide >> np.uint64(32)), (word + 1, wide & np.uint64(0xFFFFFFFF))):
            if len(w):
                head = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                out[w[head]] += np.add.reduceat(v, head)
        data = out.astype(">u4").view(np.uint8)[: int(first[-1])].copy()
        fill = 8 * size - total
        last = first[1:][size > 0] - 1
        data[last] |= ((1 << fill[size > 0]) - 1).astype(np.uint8)
        return data, first


def _stuffed(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ff = np.flatnonzero(data == 0xFF)
    return np.insert(data, ff + 1, 0), first + np.searchsorted(ff, first)


@dataclass
class Layout:
    """Blocks of each component of many images, one image after another."""

    wide: np.ndarray  # MCUs a row, by image
    high: np.ndarray

    def blocks(self, c: int, sampling=SAMPLING) -> np.ndarray:
        return self.wide * self.high * sampling[c][0] * sampling[c][1]

    def mcu_blocks(self, c: int, image: np.ndarray, mcu: np.ndarray, base: np.ndarray, sampling=SAMPLING) -> np.ndarray:
        """Block numbers (mcu, block in mcu) of component c."""
        h, v = sampling[c]
        w = self.wide[image]
        y, x = mcu // w, mcu % w
        cols = [base[image] + (y * v + j) * (w * h) + x * h + i for j in range(v) for i in range(h)]
        return np.stack(cols, 1)


def shape_for(mcus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """MCUs a row and rows of an image that holds at least so many; at most 4095 either way."""
    wide = np.minimum(np.maximum(mcus, 1), np.maximum(32, -(-mcus // 4095)))
    return wide, np.maximum(1, -(-mcus // wide))


def _ranges(n: np.ndarray) -> np.ndarray:
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _scan_units(layout: Layout, comps: tuple[int, ...], restart: int, sampling=SAMPLING) -> tuple[np.ndarray, ...]:
    """For the segments of a scan: image, first unit, units; a unit is an MCU or, alone, a block."""
    per = layout.wide * layout.high if len(comps) > 1 else layout.blocks(comps[0], sampling)
    segs = -(-per // restart)
    image = np.repeat(np.arange(len(per)), segs)
    begin = _ranges(segs) * restart
    return image, begin, np.minimum(restart, per[image] - begin)


def encode(coefs: list[np.ndarray], layout: Layout, comments: list[bytes]) -> list[bytes]:
    """Progressive files of images given as zigzag coefficients (blocks, 64) of each component."""
    base = [np.concatenate([[0], np.cumsum(layout.blocks(c))]) for c in range(3)]
    head = bytes([0xFF, DQT, 0, 67, 0]) + bytes([1] * 64)
    tables = b"".join(bytes([0xFF, DHT]) + (3 + len(_BODY)).to_bytes(2, "big") + bytes([k]) + _BODY for k in (0x00, 0x10))
    dri = bytes([0xFF, DRI, 0, 4]) + RESTART.to_bytes(2, "big")
    sof = [bytes([0xFF, SOF2, 0, 17, 8]) + int(h * 16).to_bytes(2, "big") + int(w * 16).to_bytes(2, "big") + b"\x03" + b"".join(bytes([c + 1, SAMPLING[c][0] << 4 | SAMPLING[c][1], 0]) for c in range(3)) for w, h in zip(layout.wide, layout.high, strict=True)]
    files = [[b"\xff\xd8", bytes([0xFF, COM]) + (2 + len(m)).to_bytes(2, "big") + m, head, s, tables, dri] for m, s in zip(comments, sof, strict=True)]
    for comps, lo, hi, was, now in SCRIPT:
        image, begin, units = _scan_units(layout, comps, RESTART)
        seg = np.repeat(np.arange(len(image)), units)
        unit = np.repeat(begin, units) + _ranges(units)
        bits = _Bits()
        if lo == 0:
            blocks = [layout.mcu_blocks(c, image[seg], unit, base[c]) for c in comps]
            values = np.concatenate([coefs[c][b, 0] for c, b in zip(comps, blocks, strict=True)], 1).astype(np.int64)
            key = (seg[:, None] << 16) | (np.arange(len(seg)) - np.searchsorted(seg, seg, "left"))[:, None] << 8 | np.arange(values.shape[1])[None]
            if was:
                bits.add(key.ravel(), (values.ravel() >> now) & 1, np.ones(values.size, np.int64))
            else:
                values >>= now
                fresh = np.concatenate([[True], seg[1:] != seg[:-1]])
                k0 = 0
                for c in comps:
                    n = SAMPLING[c][0] * SAMPLING[c][1]
                    v = values[:, k0 : k0 + n]
                    prev = np.concatenate([np.where(fresh, 0, np.concatenate([[0], v[:-1, -1]]))[:, None], v[:, :-1]], 1)
                    d = (v - prev).ravel()
                    s = _category(d)
                    bits.add(key[:, k0 : k0 + n].ravel(), _CODE[s] << s | _extra(d, s), _LEN[s] + s)
                    k0 += n
            shift = 16
        else:
            c = comps[0]
            block = coefs[c][base[c][image[seg]] + unit, lo : hi + 1].astype(np.int64)
            local = np.arange(len(seg)) - np.searchsorted(seg, seg, "left")
            key0 = (seg << 16 | local << 13) if RESTART <= 8 else None
            shift = 16
            (_refine_items if was else _first_items)(bits, block, key0, now)
        data, first = bits.pack(shift, len(image))
        data, first = _stuffed(data, first)
        raw = data.tobytes()
        sos = bytes([0xFF, SOS, 0, 6 + 2 * len(comps), len(comps)]) + b"".join(bytes([c + 1, 0]) for c in comps) + bytes([lo, hi, was << 4 | now])
        cuts, at = first.tolist(), np.searchsorted(image, np.arange(len(files) + 1)).tolist()
        for i, f in enumerate(files):
            f.append(sos)
            for j in range(at[i], at[i + 1]):
                if j > at[i]:
                    f.append(bytes([0xFF, 0xD0 + (j - at[i] - 1) % 8]))
                f.append(raw[cuts[j] : cuts[j + 1]])
    return [b"".join([*f, b"\xff\xd9"]) for f in files]


def _first_items(bits: _Bits, block: np.ndarray, key0: np.ndarray, now: int) -> None:
    """First pass of an AC band: run and size symbols. Key: segment, block, 2 * coefficient."""
    v = np.sign(block) * (np.abs(block) >> now)
    b, k = np.nonzero(v)
    before = np.where(np.concatenate([[True], b[1:] != b[:-1]]), -1, np.concatenate([[0], k[:-1]])) if len(b) else k
    run = k - before - 1
    zrl = run >> 4
    x = v[b, k]
    s = _category(x)
    sym = (run & 15) << 4 | s
    if zrl.any():
        r = np.repeat(np.arange(len(b)), zrl)
        bits.add(key0[b[r]] | 2 * k[r], np.full(len(r), _CODE[0xF0]), np.full(len(r), _LEN[0xF0]))
    bits.add(key0[b] | (2 * k + 1), _CODE[sym] << s | _extra(x, s), _LEN[sym] + s)
    tail = np.flatnonzero(v[:, -1] == 0)
    bits.add(key0[tail] | 2 * 64, np.full(len(tail), _CODE[0]), np.full(len(tail), _LEN[0]))


def _refine_items(bits: _Bits, block: np.ndarray, key0: np.ndarray, now: int) -> None:
    """Refinement of an AC band. Key: segment, block, 64 * place of the symbol that the bits follow, order behind it."""
    mag = np.abs(block) >> now
    old, new, n = mag > 1, mag == 1, block.shape[1]
    last_new = np.where(new.any(1), n - 1 - np.argmax(new[:, ::-1], 1), -1)
    event = np.zeros(block.shape, bool)
    runs = np.zeros(block.shape, np.int64)
    run = np.zeros(len(block), np.int64)
    for k in range(n) if new.any() else ():  # zero runs, where a band gains coefficients
        runs[:, k] = run
        zero = ~old[:, k] & ~new[:, k]
        sixteen = zero & (run == 15) & (k < last_new)
        event[:, k] = new[:, k] | sixteen
        run = np.where(event[:, k], 0, run + zero)
    place = np.where(event, np.arange(n), n)
    place = np.minimum.accumulate(place[:, ::-1], 1)[:, ::-1]
    b, k = np.nonzero(event)
    if len(b):
        fresh = new[b, k]
        sym = np.where(fresh, runs[b, k] << 4 | 1, 0xF0)
        code = np.where(fresh, _CODE[sym] << 1 | (block[b, k] > 0), _CODE[sym])
        bits.add(key0[b] | k << 7, code, _LEN[sym] + fresh)
    rest = last_new < n - 1
    bits.add(key0[rest] | n << 7, np.full(rest.sum(), _CODE[0]), np.full(rest.sum(), _LEN[0]))
    plain = old.all(1)
    if plain.any():  # all coefficients are known: one run of correction bits in two words
        low = (mag[plain] & 1).astype(np.int64)
        for a, z in ((0, min(32, n)), (32, n)):
            if z > a:
                code = low[:, a:z] @ (1 << np.arange(z - a - 1, -1, -1))
                bits.add(key0[plain] | n << 7 | a + 1, code, np.full(len(code), z - a))
    b, k = np.nonzero(old & ~plain[:, None])
    bits.add(key0[b] | place[b, k] << 7 | (k + 1), mag[b, k] & 1, np.ones(len(b), np.int64))


@dataclass
class _Header:
    width: int = 0
    height: int = 0
    comps: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, h, v, quantiser
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    comments: list[bytes] = field(default_factory=list)
    scans: list[tuple] = field(default_factory=list)  # (key of equal scans, first and last byte)


def _lookup(body: bytes) -> np.ndarray:
    """For each 16-bit window: code length << 8 | symbol."""
    out, code, at = np.full(1 << 16, 16 << 8, np.int64), 0, 16
    for n in range(1, 17):
        for _ in range(body[n - 1]):
            out[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | body[at]
            code, at = code + 1, at + 1
        code <<= 1
    return out


def _parse(raw: bytes, base: int, markers: np.ndarray, places: np.ndarray) -> _Header:
    """Headers and scans of one file that begins at ``base`` of a batch; places: of all markers but restarts."""
    h, tables, restart, pos = _Header(), {}, 0, 2
    while pos + 4 <= len(raw):
        if raw[pos] != 0xFF:
            raise ValueError("not a JPEG marker")
        kind = raw[pos + 1]
        if kind == EOI:
            break
        size = int.from_bytes(raw[pos + 2 : pos + 4], "big")
        body = raw[pos + 4 : pos + 2 + size]
        pos += 2 + size
        if kind == SOF2:
            h.height, h.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            h.comps = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])]
        elif 0xC0 <= kind <= 0xCF and kind not in (DHT, 0xC8, 0xCC):
            raise ValueError("only progressive Huffman files are read")
        elif kind == DQT:
            while body:
                wide = body[0] >> 4
                h.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * (1 + wide)], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[1 + 64 * (1 + wide) :]
        elif kind == DHT:
            while body:
                n = 17 + sum(body[1:17])
                tables[body[0]], body = body[1:n], body[n:]
        elif kind == DRI:
            restart = int.from_bytes(body[:2], "big")
        elif kind == COM:
            h.comments.append(body)
        elif kind == SOS:
            n = body[0]
            ids = [c[0] for c in h.comps]
            comps = tuple(ids.index(body[1 + 2 * i]) for i in range(n))
            dc, ac = [tables.get(body[2 + 2 * i] >> 4) for i in range(n)], tables.get(0x10 | body[2] & 15)
            lo, hi, approx = body[1 + 2 * n : 4 + 2 * n]
            end = int(places[np.searchsorted(places, base + pos)]) - base
            h.scans.append(((comps, lo, hi, approx >> 4, approx & 15, tuple(dc) if lo == 0 else ac, restart), pos, end))
            pos = end
    return h


class _Reader:
    """Bit positions of many segments in one cleaned stream."""

    def __init__(self, stream: np.ndarray, at: np.ndarray):
        b = np.concatenate([stream, np.full(8, 255, np.uint8)]).astype(np.uint64)
        self.words = b[:-4] << np.uint64(32) | b[1:-3] << np.uint64(24) | b[2:-2] << np.uint64(16) | b[3:-1] << np.uint64(8) | b[4:]
        self.at = at

    def peek(self, i: np.ndarray, n) -> np.ndarray:
        """The next n <= 32 bits of segments i."""
        p = self.at[i]
        w = self.words[np.minimum(p >> 3, len(self.words) - 1)]
        return ((w >> (40 - (p & 7) - n).astype(np.uint64)) & ((1 << np.asarray(n)) - 1).astype(np.uint64)).astype(np.int64)

    def take(self, i: np.ndarray, n: np.ndarray) -> np.ndarray:
        v = self.peek(i, n)
        self.at[i] += n
        return v

    def symbol(self, i: np.ndarray, table: np.ndarray) -> np.ndarray:
        e = table[self.peek(i, np.full(len(i), 16))]
        self.at[i] += e >> 8
        return e & 255


def _extend(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.where((s > 0) & (v < (1 << np.maximum(s - 1, 0))), v - (1 << s) + 1, v)


def decode_coefficients(files: list[bytes]) -> tuple[list[np.ndarray], Layout, list[_Header], tuple[tuple[int, int], ...]]:
    """Coefficients (blocks, 64, zigzag order) of files with the same scans and sampling."""
    data = np.frombuffer(b"".join(files), np.uint8)
    base = np.concatenate([[0], np.cumsum([len(f) for f in files])]).astype(np.int64)
    ff = np.flatnonzero(data[:-1] == 0xFF)
    code = data[ff + 1]
    is_restart = (code >= 0xD0) & (code <= 0xD7)
    places = ff[(code != 0) & (code != 0xFF) & ~is_restart]
    restarts = ff[is_restart]
    heads = [_parse(f, int(b), code, places) for f, b in zip(files, base, strict=False)]
    stuffed = ff[code == 0] + 1
    keep = np.ones(len(data), bool)
    keep[stuffed] = False
    stream = data[keep]
    moved = lambda p: p - np.searchsorted(stuffed, p)
    sampling = tuple((c[1], c[2]) for c in heads[0].comps)
    hm, vm = max(h for h, _ in sampling), max(v for _, v in sampling)
    layout = Layout(np.array([-(-h.width // (8 * hm)) for h in heads]), np.array([-(-h.height // (8 * vm)) for h in heads]))
    starts = [np.concatenate([[0], np.cumsum(layout.blocks(c, sampling))]) for c in range(len(sampling))]
    coefs = [np.zeros((int(s[-1]), 64), np.int32) for s in starts]
    words = None
    for k, (key, _, _) in enumerate(heads[0].scans):
        if any(h.scans[k][0] != key for h in heads):
            raise ValueError("files of one batch must have the same scans")
        comps, lo, hi, was, now, table, restart = key
        image, unit, units = _scan_blocks(heads, layout, comps, restart, sampling)
        first, last = base[:-1] + [h.scans[k][1] for h in heads], base[:-1] + [h.scans[k][2] for h in heads]
        a, z = np.searchsorted(restarts, first), np.searchsorted(restarts, last)
        n = z - a
        begin = np.empty(len(image), np.int64)
        head = np.concatenate([[True], image[1:] != image[:-1]])
        begin[head] = first
        inner = np.repeat(a, n) + _ranges(n)
        begin[~head] = restarts[inner] + 2
        reader = _Reader(stream, 8 * moved(begin)) if words is None else _Reader.__new__(_Reader)
        if words is not None:
            reader.words, reader.at = words, 8 * moved(begin)
        words = reader.words
        if lo == 0:
            _dc_scan(reader, coefs, comps, image, unit, units, layout, starts, sampling, heads, was, now, table)
        else:
            c = comps[0]
            place = _single_blocks(heads, layout, c, sampling, starts[c])
            (_ac_refine if was else _ac_first)(reader, coefs[c], place, image, unit, units, lo, hi, now, _lookup(table))
    return coefs, layout, heads, sampling


def _own_size(h: _Header, layout: Layout, i: int, c: int, sampling) -> tuple[int, int]:
    """Blocks a row and rows of component c in a scan of its own."""
    hm, vm = max(x for x, _ in sampling), max(y for _, y in sampling)
    return -(-(-(-h.width * sampling[c][0] // hm)) // 8), -(-(-(-h.height * sampling[c][1] // vm)) // 8)


def _scan_blocks(heads, layout, comps, restart, sampling):
    if len(comps) > 1:
        per = layout.wide * layout.high
    else:
        per = np.array([np.prod(_own_size(h, layout, i, comps[0], sampling)) for i, h in enumerate(heads)])
    step = np.where(restart > 0, restart, np.maximum(per, 1))
    segs = -(-per // step)
    image = np.repeat(np.arange(len(per)), segs)
    begin = _ranges(segs) * step[image]
    return image, begin, np.minimum(step[image], per[image] - begin)


def _single_blocks(heads, layout, c, sampling, start):
    """Function: (image, unit of a single-component scan) -> block number."""
    own = np.array([_own_size(h, layout, i, c, sampling)[0] for i, h in enumerate(heads)])
    full = layout.wide * sampling[c][0]
    return lambda image, unit: start[image] + unit // own[image] * full[image] + unit % own[image]


def _dc_scan(reader, coefs, comps, image, unit, units, layout, starts, sampling, heads, was, now, tables) -> None:
    look = [None if t is None else _lookup(t) for t in tables]
    pred = np.zeros((len(image), len(comps)), np.int64)
    for step in range(int(units.max(initial=0))):
        i = np.flatnonzero(units > step)
        for j, c in enumerate(comps):
            if len(comps) > 1:
                blocks = layout.mcu_blocks(c, image[i], unit[i] + step, starts[c], sampling)
            else:
                blocks = _single_blocks(heads, layout, c, sampling, starts[c])(image[i], unit[i] + step)[:, None]
            for b in blocks.T:
                if was:
                    coefs[c][b, 0] |= reader.take(i, np.ones(len(i), np.int64)) << now
                else:
                    s = reader.symbol(i, look[j])
                    pred[i, j] += _extend(reader.take(i, s), s)
                    coefs[c][b, 0] = pred[i, j] << now


def _ac_first(reader, coef, place, image, unit, units, lo, hi, now, table) -> None:
    k, step, eob = np.full(len(image), lo), np.zeros(len(image), np.int64), np.zeros(len(image), np.int64)
    flat = coef.reshape(-1)
    i = np.flatnonzero(units > 0)
    block = np.zeros(len(image), np.int64)
    block[i] = place(image[i], unit[i])
    while len(i):
        e = reader.symbol(i, table)
        r, s = e >> 4, e & 15
        coded = s > 0
        at = k[i] + r
        v = _extend(reader.take(i, s), s)
        ok = coded & (at <= hi)
        flat[block[i[ok]] * 64 + at[ok]] = v[ok] << now if now == 0 else v[ok] * (1 << now)
        k[i] = np.where(coded, at + 1, np.where(r == 15, k[i] + 16, hi + 1))
        run = ~coded & (r < 15)
        if (run & (r > 0)).any():  # an end-of-band run covers this and following blocks
            x = i[run & (r > 0)]
            eob[x] = (1 << r[run & (r > 0)]) + reader.take(x, r[run & (r > 0)]) - 1
        done = k[i] > hi
        if done.any():
            x = i[done]
            step[x] += 1 + np.minimum(eob[x], units[x] - step[x] - 1)
            eob[x] = 0
            k[x] = lo
            more = step[x] < units[x]
            y = x[more]
            block[y] = place(image[y], unit[y] + step[y])
            if not more.all():
                i = i[step[i] < units[i]]


def _ac_refine(reader, coef, place, image, unit, units, lo, hi, now, table) -> None:
    k, step, eob = np.full(len(image), lo), np.zeros(len(image), np.int64), np.zeros(len(image), np.int64)
    i = np.flatnonzero(units > 0)
    cols = np.arange(lo, hi + 1)
    bit = 1 << now
    while len(i):
        in_run = eob[i] > 0
        r, s, value = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        x = np.flatnonzero(~in_run)
        if len(x):
            e = reader.symbol(i[x], table)
            r[x], s[x] = e >> 4, e & 15
            starts = x[(s[x] == 0) & (r[x] < 15)]
            eob[i[starts]] = (1 << r[starts]) + reader.take(i[starts], r[starts])
            fresh = x[s[x] > 0]
            value[fresh] = np.where(reader.take(i[fresh], np.ones(len(fresh), np.int64)) > 0, bit, -bit)
            in_run[starts] = True
        block = place(image[i], unit[i] + step[i])
        rows = coef[block, lo : hi + 1]
        known = rows != 0
        ahead = cols[None] >= k[i][:, None]
        zeros = np.cumsum(~known & ahead, 1)
        past = np.where(in_run, 99, r + 1)[:, None]
        stop = np.where(in_run, hi + 1, lo + np.minimum((zeros < past).sum(1), hi + 1 - lo))
        fix = known & ahead & (cols[None] < stop[:, None])
        count = fix.sum(1)
        a, b = np.nonzero(fix)
        if len(a):
            p = reader.at[i[a]] + _ranges(count)
            got = (reader.words[p >> 3] >> (39 - (p & 7)).astype(np.uint64)) & np.uint64(1)
            w = rows[a, b]
            rows[a, b] = w + np.where((got > 0) & (np.abs(w) & bit == 0), np.where(w > 0, bit, -bit), 0)
            reader.at[i] += count
        put = np.flatnonzero((s > 0) & (stop <= hi))
        rows[put, stop[put] - lo] = value[put]
        coef[block, lo : hi + 1] = rows
        k[i] = stop + 1
        done = in_run | (k[i] > hi)
        x = i[done]
        eob[i[in_run]] -= 1
        step[x] += 1
        k[x] = lo
        i = i[step[i] < units[i]]


def rgb_tensors(coefs: list[np.ndarray], layout: Layout, heads: list[_Header], sampling) -> list[np.ndarray]:
    """Full-resolution (height, width, 3) uint8 tensors: inverse transform, chroma upsampling, colours."""
    hm, vm = max(h for h, _ in sampling), max(v for _, v in sampling)
    planes: list[list[np.ndarray]] = []
    for c, (h, v) in enumerate(sampling):
        natural = np.zeros((len(coefs[c]), 64))
        q = heads[0].quant[heads[0].comps[c][3]]
        natural[:, ZIGZAG] = coefs[c] * q[None]
        pixels = np.clip(((natural @ _IDCT).astype(np.int64) + (128 << _SCALE) + (1 << (_SCALE - 1))) >> _SCALE, 0, 255).astype(np.int32)
        at, out = 0, []
        for w, t in zip((layout.wide * h).tolist(), (layout.high * v).tolist(), strict=True):
            own = pixels[at : at + w * t].reshape(t, w, 8, 8).transpose(0, 2, 1, 3).reshape(t * 8, w * 8)
            at += w * t
            if (h, v) != (hm, vm):
                own = own.repeat(vm // v, 0).repeat(hm // h, 1)
            out.append(own)
        planes.append(out)
    tensors = []
    for i, head in enumerate(heads):
        y = planes[0][i]
        if len(planes) == 1:
            rgb = np.stack([y, y, y], 2)
        else:  # fixed values: colour weights of the file format, in 65536ths
            cb, cr, half = planes[1][i] - 128, planes[2][i] - 128, 1 << 15
            rgb = np.stack([y + (91881 * cr + half >> 16), y - (22554 * cb + 46802 * cr + half >> 16), y + (116130 * cb + half >> 16)], 2)
        tensors.append(np.clip(rgb, 0, 255).astype(np.uint8)[: head.height, : head.width])
    return tensors
