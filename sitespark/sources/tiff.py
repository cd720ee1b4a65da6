"""TIFF in plain Python: tags, strips and tiles, compression and predictors. Nothing here knows of Spark."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np

#: Tag numbers and field sizes of the TIFF 6.0 and GeoTIFF 1.1 specifications: fixed values.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES, SAMPLE_FORMAT = 322, 323, 324, 325, 339
PIXEL_SCALE, TIEPOINT, TRANSFORM, GEO_KEYS, GDAL_NODATA = 33550, 33922, 34264, 34735, 42113
FIELDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE, ZSTD = 1, 5, 8, 32773, 32946, 50000
CODECS = {"none": NONE, "lzw": LZW, "deflate": DEFLATE}
KINDS = {1: "u", 2: "i", 3: "f"}


def lzw_decode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant first, each width left one code early; 256 clears, 257 ends."""
    out, table = [], []
    base = [bytes([i]) for i in range(256)] + [b"", b""]
    bits = held = 0
    width, before = 9, b""
    for byte in data:
        held = (held << 8 | byte) & 0xFFFFFF
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & ((1 << width) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, before = list(base), 9, b""
            continue
        if not table:
            table = list(base)
        if not before:
            entry = table[code]
        else:
            entry = table[code] if code < len(table) else before + before[:1]
            table.append(before + entry[:1])
        out.append(entry)
        before = entry
        if len(table) >= (1 << width) - 1 and width < 12:
            width += 1
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    out, held, bits = bytearray(), 0, 0
    table: dict[bytes, int] = {}

    def put(code: int, width: int) -> None:
        nonlocal held, bits
        held = held << width | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
        held &= (1 << bits) - 1

    def fresh() -> dict[bytes, int]:
        return {bytes([i]): i for i in range(256)}

    put(256, 9)
    table, following, width, word = fresh(), 258, 9, b""
    for k in range(len(data)):
        longer = word + data[k : k + 1]
        if longer in table:
            word = longer
            continue
        put(table[word], width)
        table[longer] = following
        following += 1
        if following == 1 << width:
            width += 1
        if following == 4095:
            put(256, 12)
            table, following, width = fresh(), 258, 9
        word = data[k : k + 1]
    if word:
        put(table[word], width)
        following += 1
        if following == 1 << width and width < 12:
            width += 1
    put(257, width)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def packbits_decode(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        elif n > 128:
            out += data[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out)


def decompressed(data: bytes, compression: int) -> bytes:
    if compression == NONE:
        return data
    if compression == LZW:
        return lzw_decode(data)
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(data)
    if compression == PACKBITS:
        return packbits_decode(data)
    if compression == ZSTD:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(data)
    raise ValueError(f"TIFF compression {compression} is not known")


class Tiff:
    """The first image of a TIFF file: its layout, and its blocks (strips or tiles) decoded one by one.

    read(offset, length) gives bytes of the file; only headers are read here.
    """

    def __init__(self, read: Callable[[int, int], bytes]):
        head = read(0, 16)
        if head[:2] not in (b"II", b"MM"):
            raise ValueError("not a TIFF file")
        self.order = "<" if head[:2] == b"II" else ">"
        big = struct.unpack(self.order + "H", head[2:4])[0] == 43
        at = struct.unpack(self.order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
        counted, entry, inline = ("Q", 20, 8) if big else ("H", 12, 4)
        n = struct.unpack(self.order + counted, read(at, struct.calcsize(counted)))[0]
        table = read(at + struct.calcsize(counted), n * entry)
        self.tags: dict[int, tuple] = {}
        for i in range(n):
            tag, kind = struct.unpack_from(self.order + "HH", table, i * entry)
            count = struct.unpack_from(self.order + ("Q" if big else "I"), table, i * entry + 4)[0]
            if kind not in FIELDS:
                continue
            size = struct.calcsize("<" + FIELDS[kind]) * count
            where = i * entry + (12 if big else 8)
            raw = table[where : where + inline] if size <= inline else read(struct.unpack_from(self.order + ("Q" if big else "I"), table, where)[0], size)
            self.tags[tag] = (raw[:size],) if kind == 2 else struct.unpack(f"{self.order}{count * len(FIELDS[kind])}{FIELDS[kind][0]}", raw[:size])
        one = lambda tag, default=None: self.tags.get(tag, (default,))[0]
        self.width, self.height = one(WIDTH), one(HEIGHT)
        self.samples, self.compression, self.predictor, self.planar = one(SAMPLES, 1), one(COMPRESSION, 1), one(PREDICTOR, 1), one(PLANAR, 1)
        bits, kind = one(BITS, 1), one(SAMPLE_FORMAT, 1)
        if bits % 8 or kind not in KINDS:
            raise ValueError(f"TIFF samples of {bits} bits, format {kind}, are not known")
        self.dtype = np.dtype(f"{self.order}{KINDS[kind]}{bits // 8}")
        self.tiled = TILE_WIDTH in self.tags
        self.block_width, self.block_height = (one(TILE_WIDTH), one(TILE_HEIGHT)) if self.tiled else (self.width, min(one(ROWS_PER_STRIP, self.height), self.height))
        self.offsets, self.bytes = self.tags[TILE_OFFSETS if self.tiled else STRIP_OFFSETS], self.tags[TILE_BYTES if self.tiled else STRIP_BYTES]
        self.across = -(-self.width // self.block_width)
        nodata = one(GDAL_NODATA)
        self.nodata = float(nodata.split(b"\0")[0]) if nodata else None
        keys = self.tags.get(GEO_KEYS, ())
        self.epsg = next((keys[i + 3] for i in range(4, len(keys), 4) if keys[i] in (2048, 3072) and keys[i + 1] == 0 and keys[i + 3] != 32767), None)
        self.transform = self._transform()

    def _transform(self) -> tuple[float, float, float, float]:
        """(x of the west edge, y of the north edge, pixel width, pixel height downwards)."""
        if PIXEL_SCALE in self.tags and TIEPOINT in self.tags:
            (sx, sy), (i, j, _, x, y) = self.tags[PIXEL_SCALE][:2], self.tags[TIEPOINT][:5]
            return x - i * sx, y + j * sy, sx, sy
        if TRANSFORM in self.tags:
            m = self.tags[TRANSFORM]
            if m[1] or m[4]:
                raise ValueError("rotated rasters are not known")
            return m[3], m[7], m[0], -m[5]
        return 0.0, float(self.height), 1.0, 1.0

    def blocks(self, rows: tuple[int, int], cols: tuple[int, int], band: int = 0) -> list[tuple[int, int, int, int]]:
        """(first row, first column, offset, length) of the blocks that meet rows [from, to) and columns [from, to)."""
        base = band * self.across * -(-self.height // self.block_height) if self.planar == 2 else 0
        r0, r1, c0, c1 = max(0, rows[0]), min(self.height, rows[1]), max(0, cols[0]), min(self.width, cols[1])
        if r0 >= r1 or c0 >= c1:
            return []
        found = []
        for i in range(r0 // self.block_height, (r1 - 1) // self.block_height + 1):
            for j in range(c0 // self.block_width, (c1 - 1) // self.block_width + 1):
                k = base + i * self.across + j
                found.append((i * self.block_height, j * self.block_width, self.offsets[k], self.bytes[k]))
        return found

    def decode(self, data: bytes, row: int, col: int, band: int = 0) -> np.ndarray:
        """The pixels of the block at (row, col), without what a tile has beyond the image. An absent block is no data."""
        samples = 1 if self.planar == 2 else self.samples
        high, wide = (self.block_height if self.tiled else min(self.block_height, self.height - row)), self.block_width
        if not data:
            a = np.full((high, wide, samples), self.nodata or 0, self.dtype)
        else:
            raw = decompressed(data, self.compression)[: high * wide * samples * self.dtype.itemsize]
            if self.predictor == 3:
                a = self._float_rows(np.frombuffer(raw, np.uint8).reshape(high, wide * samples * self.dtype.itemsize), wide, samples)
            else:
                a = np.frombuffer(raw, self.dtype).reshape(high, wide, samples)
                if self.predictor == 2:
                    a = np.cumsum(a, axis=1, dtype=a.dtype.newbyteorder("="))
        return a[: self.height - row, : self.width - col, 0 if self.planar == 2 else band]

    def _float_rows(self, rows: np.ndarray, wide: int, samples: int) -> np.ndarray:
        """Predictor 3: bytes of a row by significance, each the difference from the byte `samples` before."""
        size = self.dtype.itemsize
        summed = np.cumsum(rows.reshape(len(rows), -1, samples), axis=1, dtype=np.uint8).reshape(len(rows), size, wide * samples)
        return np.ascontiguousarray(summed.transpose(0, 2, 1)).view(f">f{size}").reshape(len(rows), wide, samples)


def encode(pixels: np.ndarray, transform: tuple[float, float, float, float], epsg: int | None, nodata: float | None, compress: str = "deflate", predictor: int = 1, tile: int = 256) -> bytes:
    """A little-endian tiled GeoTIFF of one band."""
    high, wide = pixels.shape
    dtype = pixels.dtype.newbyteorder("<")
    pixels = pixels.astype(dtype, copy=False)
    blocks = []
    for r in range(0, high, tile):
        for c in range(0, wide, tile):
            block = np.full((tile, tile), nodata if nodata is not None else 0, dtype)
            part = pixels[r : r + tile, c : c + tile]
            block[: part.shape[0], : part.shape[1]] = part
            if predictor == 2:
                block = np.diff(block, axis=1, prepend=np.zeros((tile, 1), dtype))
            raw = block.tobytes()
            blocks.append({"none": bytes, "lzw": lzw_encode, "deflate": zlib.compress}[compress](raw))
    west, north, sx, sy = transform
    geographic = epsg is not None and 4000 <= epsg < 5000
    keys = [1, 1, 0, 2 + (epsg is not None), 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1] + ([2048 if geographic else 3072, 0, 1, epsg] if epsg is not None else [])
    tags = [(WIDTH, 4, [wide]), (HEIGHT, 4, [high]), (BITS, 3, [dtype.itemsize * 8]), (COMPRESSION, 3, [CODECS[compress]]), (PHOTOMETRIC, 3, [1]), (SAMPLES, 3, [1]), (PREDICTOR, 3, [predictor]), (TILE_WIDTH, 4, [tile]), (TILE_HEIGHT, 4, [tile]), (TILE_OFFSETS, 4, [0] * len(blocks)), (TILE_BYTES, 4, [len(b) for b in blocks]), (SAMPLE_FORMAT, 3, [{"u": 1, "i": 2, "f": 3}[dtype.kind]]), (PIXEL_SCALE, 12, [sx, sy, 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, west, north, 0.0]), (GEO_KEYS, 3, keys)]
    if nodata is not None:
        text = f"{nodata:g}".encode() + b"\0"
        tags.append((GDAL_NODATA, 2, text))
    size = lambda kind, values: struct.calcsize("<" + FIELDS[kind][0]) * len(values)
    behind = 8 + 2 + 12 * len(tags) + 4
    data_at = behind + sum(s + s % 2 for _, k, v in tags if (s := size(k, v)) > 4)
    offsets = [data_at + sum(len(b) for b in blocks[:i]) for i in range(len(blocks))]
    head, extra = struct.pack("<2sHIH", b"II", 42, 8, len(tags)), b""
    for tag, kind, values in tags:
        values = offsets if tag == TILE_OFFSETS else values
        raw = bytes(values) if kind == 2 else struct.pack(f"<{len(values)}{FIELDS[kind][0]}", *values)
        if len(raw) > 4:
            where = struct.pack("<I", behind + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            where = raw.ljust(4, b"\0")
        head += struct.pack("<HHI", tag, kind, len(values)) + where
    return head + b"\0\0\0\0" + extra + b"".join(blocks)
