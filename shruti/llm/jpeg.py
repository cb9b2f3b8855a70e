"""Progressive JPEG in numpy: scans accumulate into coefficient arrays, which become full-resolution RGB.

``decode`` reads any 8-bit progressive file with Huffman coding: spectral
selection, successive approximation, restart intervals, any sampling factors.
Scans whose codes have one length (what ``encode_payload`` writes), refinement
bits and end-of-band runs are decoded as arrays; other scans symbol by symbol.

``encode_payload`` stores bytes losslessly in the format's own unit, the
quantised coefficient: with all quantisation steps 1, each AC coefficient has
one byte (sign and seven low bits of a magnitude of 128 to 255), sent as a first
scan and a refinement scan; a comment segment has the number of bytes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np


def zigzag() -> list[int]:
    """Natural position of each coefficient in the order of the scans."""
    order = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda p: (s := p[0] + p[1], p[0] if s % 2 else -p[0]))
    return [y * 8 + x for y, x in order]


#: Fixed-point bits of the inverse transform; products stay exact in float64, so results don't depend on the machine.
SCALE = 18


def inverse_basis() -> np.ndarray:
    """(64 coefficients in scan order, 64 samples), times 2**SCALE."""
    c = np.array([[(math.sqrt(0.5) if u == 0 else 1.0) / 2 * math.cos((2 * x + 1) * u * math.pi / 16) for x in range(8)] for u in range(8)])
    natural = np.einsum("vy,ux->vuyx", c, c).reshape(64, 64)
    return np.rint(natural[zigzag()] * (1 << SCALE))


BASIS = inverse_basis()


@dataclass
class Component:
    ident: int
    h: int
    v: int
    quant: int
    width: int = 0  # in blocks, as a scan of this component alone has them
    height: int = 0
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros((0, 0, 64), np.int16))  # whole MCUs


@dataclass
class Table:
    """A Huffman table: symbol and length for each 16-bit prefix."""

    symbols: np.ndarray
    lengths: np.ndarray
    single: tuple[int, int] | None  # (symbol, length) if there is only one


def huffman(counts: bytes, values: bytes) -> Table:
    symbols, lengths = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)
    code = at = 0
    for n, k in enumerate(counts, 1):
        for v in values[at : at + k]:
            lo = code << (16 - n)
            symbols[lo : lo + (1 << (16 - n))] = v
            lengths[lo : lo + (1 << (16 - n))] = n
            code += 1
        at += k
        code <<= 1
    used = [n for n, k in enumerate(counts, 1) if k]
    return Table(symbols, lengths, (values[0], used[0]) if sum(counts) == 1 else None)


_TABLES: dict[bytes, Table] = {}


def cached_table(spec: bytes) -> Table:
    if spec not in _TABLES:
        if len(_TABLES) > 64:
            _TABLES.clear()
        _TABLES[spec] = huffman(spec[:16], spec[16:])
    return _TABLES[spec]


class Bits:
    """Bits of one entropy-coded segment."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.n = len(raw) * 8
        self.at = 0

    def peek16(self) -> int:
        i = self.at >> 3
        return int.from_bytes((self.raw[i : i + 3] + b"\xff\xff\xff")[:3], "big") >> (8 - (self.at & 7)) & 0xFFFF

    def symbol(self, t: Table) -> int:
        k = self.peek16()
        n = int(t.lengths[k])
        if not n or self.at >= self.n:
            raise ValueError("bad code in a JPEG scan")
        self.at += n
        return int(t.symbols[k])

    def take(self, n: int) -> int:
        if not n:
            return 0
        i, end = self.at >> 3, (self.at + n + 7) >> 3
        value = int.from_bytes(self.raw[i:end], "big") >> (end * 8 - self.at - n) & ((1 << n) - 1)
        self.at += n
        return value

    def array(self, n: int) -> np.ndarray:
        """The next ``n`` bits."""
        i, end = self.at >> 3, (self.at + n + 7) >> 3
        bits = np.unpackbits(np.frombuffer(self.raw[i:end], np.uint8))
        if len(bits) - (self.at & 7) < n:
            raise ValueError("a JPEG scan ends early")
        out = bits[self.at & 7 : (self.at & 7) + n]
        self.at += n
        return out


def extend(value: int, n: int) -> int:
    return value if n == 0 or value >> (n - 1) else value - (1 << n) + 1


class Decoder:
    def __init__(self, data: bytes):
        self.data = data
        self.quant: dict[int, np.ndarray] = {}
        self.dc: dict[int, Table] = {}
        self.ac: dict[int, Table] = {}
        self.components: list[Component] = []
        self.comment = b""
        self.restart = 0
        self.width = self.height = 0
        self.scans = 0
        self._read()

    def _read(self) -> None:
        data, at = self.data, 2
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        while at < len(data):
            if data[at] != 0xFF:
                raise ValueError("no marker where one is due")
            kind = data[at + 1]
            if kind == 0xFF:
                at += 1
                continue
            if kind == 0xD9:
                return
            size = int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if kind == 0xDB:
                self._quantisation(body)
            elif kind == 0xC4:
                while body:
                    n = 17 + sum(body[1:17])
                    (self.ac if body[0] >> 4 else self.dc)[body[0] & 15] = cached_table(body[1:n])
                    body = body[n:]
            elif kind == 0xC2:
                self._frame(body)
            elif kind in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xD0)):
                raise ValueError("not a progressive JPEG with Huffman coding")
            elif kind == 0xDD:
                self.restart = int.from_bytes(body[:2], "big")
            elif kind == 0xFE:
                self.comment = body
            elif kind == 0xDA:
                at = self._scan(body, at)
        raise ValueError("the JPEG file ends early")

    def _quantisation(self, body: bytes) -> None:
        while body:
            wide = body[0] >> 4
            n = 128 if wide else 64
            self.quant[body[0] & 15] = np.frombuffer(body[1 : n + 1], ">u2" if wide else np.uint8).astype(np.int64)
            body = body[n + 1 :]

    def _frame(self, body: bytes) -> None:
        if body[0] != 8:
            raise ValueError("only 8-bit samples")
        self.height, self.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
        self.components = [Component(c, s >> 4, s & 15, q) for c, s, q in zip(body[6::3], body[7::3], body[8::3])]
        self.h, self.v = max(c.h for c in self.components), max(c.v for c in self.components)
        self.columns, self.rows = -(-self.width // (8 * self.h)), -(-self.height // (8 * self.v))
        for c in self.components:
            c.width, c.height = -(-self.width * c.h // (8 * self.h)), -(-self.height * c.v // (8 * self.v))
            c.coefficients = np.zeros((self.rows * c.v, self.columns * c.h, 64), np.int16)

    def _segments(self, at: int) -> tuple[list[bytes], int]:
        """The scan's entropy-coded segments without stuffing, and where they end."""
        data, out, start = self.data, [], at
        while True:
            at = data.find(b"\xff", at)
            if at < 0 or at + 1 >= len(data):
                raise ValueError("a JPEG scan doesn't end")
            if data[at + 1] == 0:
                at += 2
            elif 0xD0 <= data[at + 1] <= 0xD7:
                out.append(data[start:at].replace(b"\xff\0", b"\xff"))
                start = at = at + 2
            else:
                out.append(data[start:at].replace(b"\xff\0", b"\xff"))
                return out, at

    def _scan(self, head: bytes, at: int) -> int:
        self.scans += 1
        n = head[0]
        chosen = [(next(c for c in self.components if c.ident == head[1 + 2 * i]), head[2 + 2 * i] >> 4, head[2 + 2 * i] & 15) for i in range(n)]
        first, last, high, low = head[1 + 2 * n], head[2 + 2 * n], head[3 + 2 * n] >> 4, head[3 + 2 * n] & 15
        segments, end = self._segments(at)
        if n == 1:
            c = chosen[0][0]
            grid = c.coefficients[: c.height, : c.width]
            views, units = [grid], c.height * c.width
        else:
            views, units = [c.coefficients for c, *_ in chosen], self.rows * self.columns
        step = self.restart or units
        done = 0
        if first == 0:
            order, owner = self._dc_order(chosen, n)
            per = len(order) // max(1, units)
            values = np.zeros(len(order), np.int64) if not high else np.concatenate([v.reshape(-1, 64)[:, 0] for v in views]).astype(np.int64)[order] if n > 1 else views[0][:, :, 0].ravel().astype(np.int64)
            for raw in segments:
                k = min(step, units - done)
                part = slice(done * per, (done + k) * per)
                if high:
                    values[part] |= Bits(raw).array(k * per).astype(np.int64) << low
                else:
                    values[part] = self._dc_first(Bits(raw), owner[part], [self.dc[t] for _, t, _ in chosen]) << low
                done += k
            flat = np.empty(len(order), np.int64)
            flat[order] = values
            where = 0
            for v in views:
                m = v.shape[0] * v.shape[1]
                v[:, :, 0] = flat[where : where + m].reshape(v.shape[:2])
                where += m
        else:
            table = self.ac[chosen[0][2]]
            band = np.ascontiguousarray(views[0][:, :, first : last + 1]).reshape(units, -1)
            for raw in segments:
                k = min(step, units - done)
                (self._ac_more if high else self._ac_first)(Bits(raw), band[done : done + k], table, low)
                done += k
            views[0][:, :, first : last + 1] = band.reshape(*views[0].shape[:2], -1)
        return end

    def _dc_order(self, chosen: list, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of the scan in coded order, as numbers in the components' arrays one after another; and whose each is."""
        if n == 1:
            c = chosen[0][0]
            m = c.height * c.width
            return np.arange(m), np.zeros(m, np.int64)
        parts, base = [], 0
        for c, *_ in chosen:
            h, w = c.coefficients.shape[:2]
            parts.append(base + np.arange(h * w).reshape(self.rows, c.v, self.columns, c.h).transpose(0, 2, 1, 3).reshape(self.rows * self.columns, -1))
            base += h * w
        owner = np.concatenate([np.full(p.shape[1], i) for i, p in enumerate(parts)])
        return np.concatenate(parts, 1).ravel(), np.tile(owner, self.rows * self.columns)

    @staticmethod
    def _dc_first(bits: Bits, owner: np.ndarray, tables: list[Table]) -> np.ndarray:
        if all(t.single and t.single[0] == 0 for t in tables):
            return np.zeros(len(owner), np.int64)
        last, out = [0] * len(tables), []
        for i in owner.tolist():
            n = bits.symbol(tables[i])
            last[i] += extend(bits.take(n), n)
            out.append(last[i])
        return np.array(out, np.int64)

    @staticmethod
    def _ac_first(bits: Bits, band: np.ndarray, table: Table, low: int) -> None:
        blocks, width = band.shape
        if table.single and 0 < table.single[0] < 16:  # every coefficient has a code of one length
            n, size = table.single[0], table.single[1]
            if size + n == 8 and bits.at == 0:
                raw = np.frombuffer(bits.raw, np.uint8, band.size).astype(np.int16)
            else:
                raw = bits.array(band.size * (size + n)).reshape(-1, size + n)[:, size:].astype(np.int16) @ (1 << np.arange(n - 1, -1, -1, dtype=np.int16))
            raw = np.where(raw >> (n - 1), raw, raw - ((1 << n) - 1))
            band[:] = (raw << low).reshape(band.shape)
            return
        run = 0
        for b in range(blocks):
            if run:
                run -= 1
                continue
            k = 0
            while k < width:
                r, s = divmod(bits.symbol(table), 16)
                if s:
                    k += r
                    band[b, k] = extend(bits.take(s), s) << low
                    k += 1
                elif r == 15:
                    k += 16
                else:
                    run = (1 << r) + bits.take(r) - 1
                    break

    @staticmethod
    def _ac_more(bits: Bits, band: np.ndarray, table: Table, low: int) -> None:
        blocks, width = band.shape
        one = 1 << low
        b = k = 0
        while b < blocks:
            row = band[b]
            while k < width:
                r, s = divmod(bits.symbol(table), 16)
                new = 0
                if s:
                    new = one if bits.take(1) else -one
                elif r < 15:  # the rest of this block and of more blocks: correction bits only
                    until = min(blocks, b + (1 << r) + bits.take(r))
                    rest = band.reshape(-1)[b * width + k : until * width]
                    at = np.flatnonzero(rest)
                    rest[at] += np.where(bits.array(len(at)) == 1, np.where(rest[at] > 0, one, -one), 0).astype(np.int16)
                    b, k = until - 1, width
                    break
                while k < width:
                    if row[k]:
                        if bits.take(1):
                            row[k] += one if row[k] > 0 else -one
                    elif r == 0:
                        if s:
                            row[k] = new
                        k += 1
                        break
                    else:
                        r -= 1
                    k += 1
            b, k = b + 1, 0

    def rgb(self) -> np.ndarray:
        """(height, width, 3) uint8; one component gives grey."""
        planes = [self._plane(c) for c in self.components]
        size = (self.rows * self.v * 8, self.columns * self.h * 8)

        def full(plane: np.ndarray) -> np.ndarray:  # by replication
            return plane.repeat(size[0] // plane.shape[0], 0).repeat(size[1] // plane.shape[1], 1)

        crop = (slice(self.height), slice(self.width))
        if len(planes) < 3:
            return np.repeat(full(planes[0])[crop][:, :, None], 3, 2)
        y, cb, cr = planes[:3]
        y = full(y)[crop].astype(np.int16)
        out = np.empty((self.height, self.width, 3), np.uint8)
        for i, chroma in enumerate((RED[cr], GREEN_B[cb] + GREEN_R[cr] if cb.shape == cr.shape else full(GREEN_B[cb]) + full(GREEN_R[cr]), BLUE[cb])):
            out[:, :, i] = np.clip(y + full(chroma)[crop], 0, 255)
        return out

    def _plane(self, c: Component) -> np.ndarray:
        h, w = c.coefficients.shape[:2]
        blocks = c.coefficients.reshape(-1, 64)
        out = np.empty((h * w, 64), np.uint8)
        basis = BASIS * self.quant[c.quant][:, None]
        for a in range(0, h * w, 1 << 14):
            x = blocks[a : a + (1 << 14)].astype(np.float64) @ basis
            x += (1 << (SCALE - 1)) + (128 << SCALE)
            x *= 1.0 / (1 << SCALE)
            out[a : a + (1 << 14)] = np.clip(np.floor(x, out=x), 0, 255, out=x)
        return out.reshape(h, w, 8, 8).transpose(0, 2, 1, 3).reshape(h * 8, w * 8)


def _chroma(factor: float) -> np.ndarray:
    return np.floor(factor * (np.arange(256) - 128) + 0.5).astype(np.int16)


RED, BLUE, GREEN_B, GREEN_R = _chroma(1.402), _chroma(1.772), _chroma(-0.344136), _chroma(-0.714136)

# Bytes in coefficients


def _byte_tables() -> tuple[bytes, np.ndarray, np.ndarray]:
    """First-scan code of each byte (one 0 bit, then seven bits); magnitude by byte; byte by coefficient + 255."""
    value = [(128 + (b & 127)) * (1 if b < 128 else -1) for b in range(256)]
    first = bytes(abs(v) >> 1 if v > 0 else (abs(v) >> 1) ^ 127 for v in value)
    back = np.zeros(511, np.uint8)
    for b, v in enumerate(value):
        back[v + 255] = b
    return first, np.array(value, np.int16), back


FIRST, VALUE, BACK = _byte_tables()
PER_MCU, BLOCK_AC = 6 * 63, 63


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _packed(bits: np.ndarray) -> bytes:
    fill = np.ones(-len(bits) % 8, np.uint8)
    return np.packbits(np.concatenate([bits, fill])).tobytes().replace(b"\xff", b"\xff\0")


def _run_header(n: int) -> np.ndarray:
    """Bits of the end-of-band run code for ``n`` blocks: four bits for the size, then the size's bits."""
    size = n.bit_length() - 1
    return np.array([size >> i & 1 for i in (3, 2, 1, 0)] + [n >> i & 1 for i in range(size - 1, -1, -1)], np.uint8)


def _scan_head(parts: list[tuple[int, int]], first: int, last: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(parts), *(x for p in parts for x in p), first, last, high << 4 | low]))


#: Tables: DC 0 has the code 0 for "no difference", AC 0 the code 0 for "size 7, no run", AC 1 four bits for each run size.
_TABLE_SEGMENTS = _segment(0xDB, b"\0" + b"\1" * 64) + _segment(0xC4, b"\x00" + b"\1" + b"\0" * 16 + b"\x10" + b"\1" + b"\0" * 15 + b"\7" + b"\x11" + b"\0\0\0\x0f" + b"\0" * 12 + bytes(r << 4 for r in range(15)))


def encode_payload(payload: bytes) -> bytes:
    """A 4:2:0 progressive JPEG file that has the payload in its AC coefficients."""
    mcus = max(1, -(-len(payload) // PER_MCU))
    columns = min(4095, math.isqrt(mcus - 1) + 1)
    rows = -(-mcus // columns)
    if rows > 4095:
        raise ValueError("the payload is too large for one image")
    mcus = rows * columns
    data = np.frombuffer(payload.ljust(mcus * PER_MCU, b"\0"), np.uint8)
    codes = np.frombuffer(data.tobytes().translate(FIRST), np.uint8)
    luma = 4 * mcus * BLOCK_AC
    cuts = (slice(0, luma), slice(luma, luma + mcus * BLOCK_AC), slice(luma + mcus * BLOCK_AC, None))
    odd = data & 1
    parity = [np.bitwise_xor.reduce(odd[c].reshape(-1, BLOCK_AC), 1) for c in cuts]
    order = np.concatenate([parity[0].reshape(rows, 2, columns, 2).transpose(0, 2, 1, 3).reshape(mcus, 4), parity[1][:, None], parity[2][:, None]], 1)
    three = [(1, 0), (2, 0), (3, 0)]
    out = [
        b"\xff\xd8", _segment(0xFE, len(payload).to_bytes(8, "big")), _TABLE_SEGMENTS,
        _segment(0xC2, bytes([8, *(rows * 16).to_bytes(2, "big"), *(columns * 16).to_bytes(2, "big"), 3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])),
        _scan_head(three, 0, 0, 0, 1), _packed(np.zeros(6 * mcus, np.uint8)),
    ]
    y = codes[cuts[0]].reshape(-1, BLOCK_AC)
    out += [_scan_head([(1, 0)], 1, 5, 0, 1), y[:, :5].tobytes(), _scan_head([(1, 0)], 6, 63, 0, 1), y[:, 5:].tobytes()]
    out += [x for i in (1, 2) for x in (_scan_head([(i + 1, 0)], 1, 63, 0, 1), codes[cuts[i]].tobytes())]
    out += [_scan_head(three, 0, 0, 1, 0), _packed(order.ravel())]
    for i, c in enumerate(cuts):
        bits, rest = [], odd[c]
        while len(rest):
            run = min(len(rest) // BLOCK_AC, 0x7FFF)
            bits += [_run_header(run), rest[: run * BLOCK_AC]]
            rest = rest[run * BLOCK_AC :]
        out += [_scan_head([(i + 1, 1)], 1, 63, 1, 0), _packed(np.concatenate(bits))]
    return b"".join([*out, b"\xff\xd9"])


def payload_of(image: Decoder) -> bytes:
    """The bytes that ``encode_payload`` has put into the image; the DC bits confirm each block."""
    parts = []
    for c in image.components:
        blocks = c.coefficients.reshape(-1, 64)
        data = BACK[blocks[:, 1:] + 255]
        if (np.bitwise_xor.reduce(data & 1, 1) != (blocks[:, 0] & 1)).any():
            raise ValueError("a block's parity is wrong")
        parts.append(data.tobytes())
    return b"".join(parts)[: int.from_bytes(image.comment, "big")]
