"""Media columns: texts kept losslessly as coefficients of progressive JPEG files, and read back.

``encode_media`` pads a text's UTF-8 with spaces to a positive multiple of 192 bytes and
writes byte b as the quantised coefficient b - 128, 64 bytes a block, six blocks a 4:2:0
unit; the file's comment holds the lengths. ``decode_media`` reads stored files scan by scan
into coefficient arrays (from which the payload comes back bit for bit), inverse-transforms
them, upsamples chroma and returns full-resolution RGB tensors.

Both are maps: rows never meet, so nothing shuffles and hot texts cost what others cost.
Work goes through slices of bounded bytes; a very long text is a slice of its own.

Edge cases: a null text counts as empty, and an empty text is 192 spaces; a null medium
gives nulls; extra columns are dropped unless named in ``keep``; files that are not
progressive JPEGs raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm import jpeg
from quorumtext.llm.textbatch import slices, unlike

UNIT = 192
_SLICE = 1 << 20


def payload_of(data: bytes) -> bytes:
    """The bytes, padded with spaces to a positive multiple of ``UNIT``."""
    return data + b" " * (max(UNIT, -(-len(data) // UNIT) * UNIT) - len(data))


def to_files(texts: list[bytes]) -> list[bytes]:
    """One progressive file for each text."""
    loads = [payload_of(t) for t in texts]
    blocks = np.array([len(x) // 64 for x in loads])
    wide, high = jpeg.shape_for(-(-blocks // jpeg.MCU_BLOCKS))
    layout = jpeg.Layout(wide, high)
    mcus = wide * high
    cells = np.zeros((int(mcus.sum()) * jpeg.MCU_BLOCKS, 64), np.int32)
    at = np.repeat((np.cumsum(mcus) - mcus) * jpeg.MCU_BLOCKS, blocks) + jpeg._ranges(blocks)
    cells[at] = np.frombuffer(b"".join(loads), np.uint8).reshape(-1, 64).astype(np.int32) - 128
    coefs = _spread(cells, layout)
    notes = [f"{len(t)} {len(x)}".encode() for t, x in zip(texts, loads, strict=True)]
    return jpeg.encode(coefs, layout, notes)


def _places(layout: jpeg.Layout) -> list[np.ndarray]:
    """Block numbers of each unit's blocks, by component."""
    mcus = layout.wide * layout.high
    image = np.repeat(np.arange(len(mcus)), mcus)
    unit = jpeg._ranges(mcus)
    base = [np.concatenate([[0], np.cumsum(layout.blocks(c))]) for c in range(3)]
    return [layout.mcu_blocks(c, image, unit, base[c]) for c in range(3)]


def _spread(cells: np.ndarray, layout: jpeg.Layout) -> list[np.ndarray]:
    units = cells.reshape(-1, jpeg.MCU_BLOCKS, 64)
    out, k = [], 0
    for place in _places(layout):
        n = place.shape[1]
        c = np.zeros((place.size, 64), np.int32)
        c[place.ravel()] = units[:, k : k + n].reshape(-1, 64)
        out.append(c)
        k += n
    return out


def from_files(files: list[bytes]) -> list[tuple[int, bytes, np.ndarray]]:
    """(unpadded length, payload, RGB tensor) of each stored file."""
    coefs, layout, heads, sampling = jpeg.decode_coefficients(files)
    cells = np.concatenate([c[p].reshape(len(p), -1) for c, p in zip(coefs, _places(layout), strict=True)], 1)
    raw = (cells.reshape(-1, 64) + 128).astype(np.uint8).tobytes()
    first = np.concatenate([[0], np.cumsum(layout.wide * layout.high)]) * jpeg.MCU_BLOCKS * 64
    notes = [tuple(map(int, h.comments[0].split())) for h in heads]
    tensors = jpeg.rgb_tensors(coefs, layout, heads, sampling)
    return [(n, raw[a : a + m], t) for (n, m), a, t in zip(notes, first.tolist(), tensors, strict=False)]


def encode_media(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``media``; ``keep`` may not hold a ``media``."""
    unlike(keep, ("media",))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo = 0
            for s in slices(b.column(len(keep)), _SLICE):
                raw, cut = s.data.tobytes(), s.bounds.tolist()
                files = to_files([raw[p:q] for p, q in zip(cut, cut[1:], strict=False)])
                own = b.slice(lo, len(files))
                lo += len(files)
                yield pa.record_batch([*own.columns[: len(keep)], pa.array(files, pa.binary())], names=[*keep, "media"])

    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    return docs.select(*own, F.col(text).alias("text")).mapInArrow(each, f"{kinds}, media binary")


def _pieces(media: pa.Array) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, x in enumerate(media):
        n = len(x.as_buffer()) if x.is_valid else 0
        if i > lo and size + n > _SLICE:
            yield lo, i
            lo, size = i, 0
        size += n
    if len(media) > lo:
        yield lo, len(media)


def feature(tensor: np.ndarray) -> str:
    """Width, height, whole sums of the colours and of their squares, and an 8 x 8 sign pattern of brightness."""
    t = tensor.astype(np.int64)
    h, w, _ = t.shape
    light = t.sum(2)
    rows, cols = np.arange(h) * 8 // h, np.arange(w) * 8 // w
    grid = np.zeros((8, 8), np.int64)
    np.add.at(grid, rows, np.stack([np.bincount(cols, weights=x, minlength=8).astype(np.int64) for x in light]))
    bright = np.packbits((grid * 64 > grid.sum()).ravel()).tobytes().hex()
    return f"{w}x{h}:{','.join(map(str, t.sum((0, 1)).tolist()))}:{','.join(map(str, (t * t).sum((0, 1)).tolist()))}:{bright}"


def decode_media(stored: DataFrame, media: str = "media", keep: tuple[str, ...] = ("doc_id",), tensor: bool = True) -> DataFrame:
    """Columns ``keep``, n_bytes, payload, height, width, feature and, with ``tensor``, the RGB bytes by rows; ``keep`` may hold none of these names."""
    unlike(keep, ("n_bytes", "payload", "height", "width", "feature", *(["rgb"] if tensor else [])))
    kinds = ", ".join(f"`{c}` {stored.schema[c].dataType.simpleString()}" for c in keep)
    kinds += ", n_bytes long, payload binary, height int, width int, feature string" + ", rgb binary" * tensor

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(len(keep))
            for lo, hi in _pieces(col):
                files = [x.as_py() for x in col.slice(lo, hi - lo)]
                there = [f for f in files if f is not None]
                got = iter(from_files(there) if there else ())
                rows = [None if f is None else next(got) for f in files]
                cols = [pa.array([r and r[0] for r in rows], pa.int64()), pa.array([r and r[1] for r in rows], pa.binary()), pa.array([r and r[2].shape[0] for r in rows], pa.int32()), pa.array([r and r[2].shape[1] for r in rows], pa.int32()), pa.array([r and feature(r[2]) for r in rows], pa.string())]
                if tensor:
                    cols.append(pa.array([r and r[2].tobytes() for r in rows], pa.binary()))
                names = [*keep, "n_bytes", "payload", "height", "width", "feature", "rgb"]
                yield pa.record_batch([*b.slice(lo, hi - lo).columns[: len(keep)], *cols], names=names[: len(keep) + len(cols)])

    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    return stored.select(*own, F.col(media).alias("media")).mapInArrow(each, kinds)


def op5_media(spark, sf_dir: str) -> DataFrame:
    """Digests of what ``decode_media`` reads back from ``encode_media``'s files, for all documents."""
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    stored = encode_media(table(spark, sf_dir, "documents"))
    stored = stored.withColumns({"media_bytes": F.octet_length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    back = decode_media(stored, keep=("doc_id", "media_bytes", "media_sha256"), tensor=False)
    return back.select("doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -16)")).alias("tail_crc32"), "media_bytes", "media_sha256", "feature")
