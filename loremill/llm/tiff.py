"""TIFF images as columns: one row per page, decoded to samples.

The reader walks the chain of image directories of a file (either byte order), takes strips or tiles,
undoes PackBits, LZW or deflate and then the horizontal predictor, and puts the samples of a page in
row order. The writer stores bytes as 8-bit grey pages in the same forms.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import texts

# Fixed values of the TIFF 6.0 format: tags, field sizes, compression schemes.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES = 317, 322, 323, 324, 325
FIELD_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
SCHEMES = {"none": NONE, "lzw": LZW, "deflate": DEFLATE, "packbits": PACKBITS}
LZW_CLEAR, LZW_END, LZW_FIRST = 256, 257, 258


class TiffError(ValueError):
    """The file is not one that this reader can take."""


# ---- compression schemes ------------------------------------------------------------------------


def unpack_bits(data: bytes) -> bytes:
    """Runs: a count byte n below 128 stands before n + 1 bytes, one above 128 before a byte that is repeated 257 - n times."""
    out, at = [], 0
    while at < len(data):
        n = data[at]
        at += 1
        if n < 128:
            out.append(data[at : at + n + 1])
            at += n + 1
        elif n > 128:
            out.append(data[at : at + 1] * (257 - n))
            at += 1
    return b"".join(out)


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more equal bytes as repeats of up to 128, what lies between as plain stretches of up to 128."""
    out, raw = bytearray(), np.frombuffer(data, np.uint8)

    def plain(begin: int, end: int) -> None:
        for k in range(begin, end, 128):
            part = data[k : min(k + 128, end)]
            out.append(len(part) - 1)
            out.extend(part)

    first = np.flatnonzero(np.concatenate([[True] * (len(raw) > 0), raw[1:] != raw[:-1]]))
    last = np.append(first[1:], len(raw))
    long, at = last - first >= 3, 0
    for begin, end in zip(first[long].tolist(), last[long].tolist()):
        plain(at, begin)
        for k in range(begin, end, 128):
            n = min(128, end - k)
            out.extend((257 - n, data[k]) if n > 1 else (0, data[k]))
        at = end
    plain(at, len(data))
    return bytes(out)


def un_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first; the width grows one code before the table needs it."""
    base = [bytes([k]) for k in range(256)] + [b"", b""]
    table, width, last, out = list(base), 9, b"", []
    held, bits = 0, 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == LZW_CLEAR:
            table, width, last = list(base), 9, b""
            continue
        if code == LZW_END:
            break
        if not last:
            if code >= LZW_CLEAR:
                raise TiffError("LZW data begins with a code that is not in the table")
            last = table[code]
        else:
            if code < len(table):
                entry = table[code]
            elif code == len(table):
                entry = last + last[:1]
            else:
                raise TiffError("LZW code beyond the table")
            table.append(last + entry[:1])
            last = entry
            width = min(12, max(9, (len(table) + 1).bit_length()))
        out.append(last)
    return b"".join(out)


def lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits; the table is cleared when it is full. A code and a byte after it are one number."""
    codes, sizes = [LZW_CLEAR], [9]
    table: dict[int, int] = {}
    width, following, grows = 9, LZW_FIRST, 511
    current = data[0] if data else -1
    for byte in memoryview(data)[1:]:
        known = table.get(current << 8 | byte)
        if known is not None:
            current = known
            continue
        codes.append(current)
        sizes.append(width)
        table[current << 8 | byte] = following
        following += 1
        if following > grows:
            if following == 4094:
                codes.append(LZW_CLEAR)
                sizes.append(12)
                table, width, following, grows = {}, 9, LZW_FIRST, 511
            else:
                width += 1
                grows = (1 << width) - 1 if width < 12 else 4093
        current = byte
    if current >= 0:
        codes.append(current)
        sizes.append(width)
        width = min(12, max(9, (following + 1).bit_length()))
    codes.append(LZW_END)
    sizes.append(width)
    return _bits(np.array(codes, np.uint16), np.array(sizes))


def _bits(codes: np.ndarray, sizes: np.ndarray) -> bytes:
    """Codes of the given numbers of bits, most significant bit first, one after another."""
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.packbits((np.repeat(codes, sizes) >> (np.repeat(sizes, sizes) - 1 - place).astype(np.uint16)) & 1).tobytes()


def _inflate(data: bytes) -> bytes:
    try:
        return zlib.decompress(data)
    except zlib.error as e:
        raise TiffError(f"deflate: {e}") from e


UNPACK = {NONE: bytes, LZW: un_lzw, DEFLATE: _inflate, OLD_DEFLATE: _inflate, PACKBITS: unpack_bits}
PACK = {NONE: bytes, LZW: lzw, DEFLATE: lambda data: zlib.compress(data, 1), PACKBITS: pack_bits}


# ---- reader ---------------------------------------------------------------------------------------


def directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple[int, ...]]]]:
    """Byte order and the integer fields of each image directory, in the order of the chain."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise TiffError("no TIFF header")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at:
        if at in seen:
            raise TiffError("the chain of directories comes back to itself")
        seen.add(at)
        try:
            fields = {}
            n = struct.unpack_from(order + "H", data, at)[0]
            for k in range(n):
                tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
                size = FIELD_SIZE.get(kind, 0) * count
                where = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
                if code := {1: "B", 3: "H", 4: "I"}.get(kind):
                    fields[tag] = struct.unpack_from(f"{order}{count}{code}", data, where)
            at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]
        except struct.error as e:
            raise TiffError(f"directory: {e}") from e
        yield order, fields


def read_page(data: bytes, order: str, fields: dict[int, tuple[int, ...]]) -> np.ndarray:
    """The samples of a page as an array of rows, columns and channels (8 or 16 bits)."""
    one = lambda tag, default: fields.get(tag, (default,))[0]
    width, height, channels, bits = one(WIDTH, 0), one(HEIGHT, 0), one(SAMPLES, 1), one(BITS, 1)
    scheme, predictor, planar = one(COMPRESSION, NONE), one(PREDICTOR, 1), one(PLANAR, 1)
    if bits not in (8, 16) or scheme not in UNPACK or predictor not in (1, 2) or planar not in (1, 2):
        raise TiffError(f"bits {bits}, compression {scheme}, predictor {predictor}, planes {planar}: not supported")
    kind = np.dtype("u1" if bits == 8 else f"{order}u2")
    tiled = TILE_OFFSETS in fields
    if tiled:
        across, down, offsets, sizes = one(TILE_WIDTH, 0), one(TILE_HEIGHT, 0), fields[TILE_OFFSETS], fields.get(TILE_BYTES, ())
    else:
        across, down, offsets, sizes = width, min(one(ROWS_PER_STRIP, height), height), fields.get(STRIP_OFFSETS, ()), fields.get(STRIP_BYTES, ())
    if not (width and height and across and down) or len(offsets) != len(sizes):
        raise TiffError("page without samples")
    planes, deep = (channels, 1) if planar == 2 else (1, channels)
    columns, rows = -(-width // across), -(-height // down)
    if len(offsets) < planes * columns * rows:
        raise TiffError("strips or tiles are missing")
    page = np.empty((height, width, channels), dtype=kind)
    for k in range(planes * columns * rows):
        plane, row, column = k // (columns * rows), k // columns % rows * down, k % columns * across
        tall = down if tiled else min(down, height - row)
        raw = UNPACK[scheme](data[offsets[k] : offsets[k] + sizes[k]])
        if len(raw) < tall * across * deep * kind.itemsize:
            raise TiffError("strip or tile is too short")
        block = np.frombuffer(raw, kind, tall * across * deep).reshape(tall, across, deep)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=kind.newbyteorder("="))
        block = block[: height - row, : width - column]
        into = page[row : row + block.shape[0], column : column + block.shape[1]]
        if planar == 2:
            into[:, :, plane] = block[:, :, 0]
        else:
            into[:] = block
    return page


def read_pages(data: bytes) -> Iterator[np.ndarray]:
    for order, fields in directories(data):
        yield read_page(data, order, fields)


# ---- writer ---------------------------------------------------------------------------------------


def write_tiff(samples: bytes, width: int, rows_per_page: int, scheme: str = "deflate", predictor: bool = True, rows_per_strip: int = 16, tile: int = 0, order: str = "<") -> bytes:
    """A file of 8-bit grey pages of ``width`` columns; the last page may have fewer rows. ``tile``: edge of square tiles, a multiple of 16, instead of strips."""
    if not samples or len(samples) % width:
        raise TiffError("samples must fill a positive number of rows")
    image = np.frombuffer(samples, np.uint8).reshape(-1, width)
    out = bytearray({"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HI", 42, 8))
    code, link = SCHEMES[scheme], 4
    for top in range(0, len(image), rows_per_page):
        page = image[top : top + rows_per_page]
        height = len(page)
        if tile:
            down, across = -(-height // tile), -(-width // tile)
            full = np.zeros((down * tile, across * tile), dtype=np.uint8)
            full[:height, :width] = page
            blocks = [full[r : r + tile, c : c + tile] for r in range(0, down * tile, tile) for c in range(0, across * tile, tile)]
        else:
            blocks = [page[r : r + rows_per_strip] for r in range(0, height, rows_per_strip)]
        if predictor:
            blocks = [np.diff(b, axis=1, prepend=np.uint8(0)) for b in blocks]
        packed = [PACK[code](b.tobytes()) for b in blocks]
        fields = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [8]), (COMPRESSION, 3, [code]), (PHOTOMETRIC, 3, [1]), (SAMPLES, 3, [1])]
        fields += [(PREDICTOR, 3, [2])] * predictor
        offsets, at = [], len(out)
        for p in packed:
            offsets.append(at)
            at += len(p)
        if tile:
            fields += [(TILE_WIDTH, 4, [tile]), (TILE_HEIGHT, 4, [tile]), (TILE_OFFSETS, 4, offsets), (TILE_BYTES, 4, [*map(len, packed)])]
        else:
            fields += [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [rows_per_strip]), (STRIP_BYTES, 4, [*map(len, packed)])]
        out += b"".join(packed)
        out += b"\0" * (len(out) % 2)
        directory, extra = len(out), bytearray()
        after = directory + 2 + 12 * len(fields) + 4
        struct.pack_into(order + "I", out, link, directory)
        entries = bytearray(struct.pack(order + "H", len(fields)))
        for tag, kind, values in sorted(fields):
            raw = struct.pack(f"{order}{len(values)}{'H' if kind == 3 else 'I'}", *values)
            if len(raw) > 4:
                where, raw = struct.pack(order + "I", after + len(extra)), raw
                extra += raw
                raw = where
            entries += struct.pack(order + "HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
        link = directory + len(entries)
        out += entries + struct.pack(order + "I", 0) + extra
    return bytes(out)


# ---- columns --------------------------------------------------------------------------------------

PAGE_SCHEMA = "page int, width int, height int, channels int, bits int, samples binary, error string"


def tiff_pages(files: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """``id_col`` with one row per page: ``page, width, height, channels, bits, samples, error``.

    ``samples`` has the rows one after another (16-bit samples in little-endian order). A file that is
    null, empty or broken gives one row, with page null and what is wrong in ``error``, after the rows of
    the pages before the break. Repeated rows give repeated pages; other columns are ignored.
    """
    source = files.select(id_col, media_col)
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "page", "width", "height", "channels", "bits", "samples", "error"]
        types = [None, *(pa.int32(),) * 5, pa.binary(), pa.string()]
        for b in batches:
            for k in range(len(b)):
                data, rows = b.column(1)[k].as_py() or b"", []
                try:
                    for n, page in enumerate(read_pages(data)):
                        rows.append((n, page.shape[1], page.shape[0], page.shape[2], 8 * page.itemsize, page.astype(page.dtype.newbyteorder("<")).tobytes(), None))
                except (TiffError, MemoryError) as e:
                    rows.append((None, None, None, None, None, None, str(e)))
                own = b.column(0).take(pa.array([k] * len(rows), pa.int32()))
                yield pa.RecordBatch.from_arrays([own, *(pa.array(x, t) for x, t in zip(zip(*rows), types[1:]))], names)

    return source.mapInArrow(run, f"id {kind}, {PAGE_SCHEMA}").withColumnRenamed("id", id_col)


ROW, ROWS_PER_PAGE, TILE = 576, 64, 64
#: How payloads are stored; a payload's checksum deals it one of these, so each carries texts of every size.
FORMS = ({"scheme": "deflate", "predictor": True, "tile": TILE}, {"scheme": "lzw", "predictor": False, "rows_per_strip": 8}, {"scheme": "packbits", "predictor": False, "rows_per_strip": 16})


def store_text(payload: bytes) -> bytes:
    """A payload of whole rows as TIFF of 64 rows to a page, in the form that its checksum deals it."""
    return write_tiff(payload, ROW, ROWS_PER_PAGE, **FORMS[zlib.crc32(payload) % len(FORMS)])


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each whole text as TIFF, reads the stored pages back and describes them.

    ``id_col, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature``.
    Null is the empty text, which is a row of padding. Equal texts have equal values.
    """
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in texts(b.column(1)):
                raw = text.encode()
                media = store_text(raw + b"\xff" * (-len(raw) % ROW or (0 if raw else ROW)))
                digest, tail, n, pages, total, edges, low, high = hashlib.sha256(), b"", 0, 0, 0, 0, 255, 0
                for page in read_pages(media):
                    grey = page[:, :, 0]
                    own = grey.tobytes()
                    digest.update(own)
                    tail, n, pages = (tail + own)[-32:], n + len(own), pages + 1
                    total += int(grey.sum(dtype=np.int64))
                    edges += int((grey[:, 1:] != grey[:, :-1]).sum())
                    low, high = min(low, int(grey.min())), max(high, int(grey.max()))
                feature = f"pages={pages};rows={n // ROW};mean={total // n};low={low};high={high};edges={edges}"
                rows.append((len(raw), n, digest.hexdigest(), zlib.crc32(tail), len(media), hashlib.sha256(media).hexdigest(), feature))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    out = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return source.mapInArrow(run, f"id {kind}, {out}").withColumnRenamed("id", id_col)
