"""SHA-256 of a group's strings, sorted and joined, without ever holding the group."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 16


def joined_sha256(rows: DataFrame, key: str, item: str) -> DataFrame:
    """(key, n, sha256) of each key's items, sorted as strings and comma-joined; rows: a string key, a string item, each pair once.

    Ranges of (key, item) are sorted and packed into strings of about ``PIECE`` characters, so a key
    with very many items is spread; its pieces, few, are then hashed in order as they pass.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, items, size = None, [], 0
        for b in batches:
            out = []
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != own or size > PIECE:
                    if items:
                        out.append((own, items[0], len(items), ",".join(items)))
                    own, items, size = k, [], 0
                items.append(x)
                size += len(x) + 1
            yield batch(out)
        if items:
            yield batch([(own, items[0], len(items), ",".join(items))])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))], names=["key", "first", "n", "items"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n, digest = None, 0, None
        result = lambda rows: pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=[key, "n", "sha256"])
        for b in batches:
            out = []
            for k, _, m, items in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if k != own:
                    if digest is not None:
                        out.append((own, n, digest.hexdigest()))
                    own, n, digest = k, m, hashlib.sha256(items.encode())
                else:
                    n += m
                    digest.update(b"," + items.encode())
            yield result(out)
        if digest is not None:
            yield result([(own, n, digest.hexdigest())])

    pieces = rows.select(F.col(key).alias("key"), F.col(item).alias("item")).repartitionByRange("key", "item").sortWithinPartitions("key", "item")
    pieces = pieces.mapInArrow(packed, "key string, first string, n long, items string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, f"`{key}` string, n long, sha256 string")
