"""The archive as a data source: ``spark.read.format("transcripts")`` and ``readStream``.

Files are listed once, dealt to partitions by size (a file is never cut), and read where Spark
runs the partition, through Arrow's file systems, so ``path`` may be a local path or a uri of a
store that Arrow reaches. Filters on show, layer and ep are applied to the listing, so
only matching files are opened (with ``spark.sql.python.filterPushdown.enabled``). A stream's offset is the (time,
path) of the last file it has taken; files with a later one are new, so a file must keep
the time it was written at, or get a later one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from quorumtext.runtime import ship_package
from quorumtext.sources.archive import EPISODE_DIR, INTERVIEW_TURN, NAV_CLOSE, NAV_OPEN, RAW_TURN, parse_header

SCHEMA = "show string, ep int, video_id string, layer string, seq int, line int, start_sec int, speaker string, text string, n_paragraphs int, n_words long"
PARTITION_BYTES = 4 << 20
_WORD = re.compile("[^ \t\n\r\f\x0b]+")


def turns_of(text: str, layer: str) -> Iterator[tuple[int, int, int | None, str, str, int]]:
    """(seq, line, start_sec, speaker, text, n_paragraphs) of a layer file, as the batch reader tells them."""
    rules = opened = closed = seq = 0
    turn: list | None = None
    for n, value in enumerate(text.split("\n"), 1):
        rules += value.rstrip(" ") == "---"
        opened += value.strip(" ") == NAV_OPEN
        closed += value.strip(" ") == NAV_CLOSE
        if rules < 2 or value.rstrip(" ") == "---" or opened != closed or value.strip(" ") in ("", NAV_CLOSE) or value.startswith("# "):
            continue
        raw = re.match(RAW_TURN, value) if layer == "raw" else None
        talk = re.match(INTERVIEW_TURN, value)
        if raw or talk:
            if turn:
                yield _closed(turn)
            seq += 1
            start = None
            if raw:
                *h, m, s = (int(x) for x in raw[1].split(":"))
                start = (h[0] * 3600 if h else 0) + m * 60 + s
            turn = [seq, n, start, raw[2] if raw else talk[1], [raw[3] if raw else talk[2]]]
        elif turn:
            turn[4].append(value)
    if turn:
        yield _closed(turn)


def _closed(turn: list) -> tuple:
    return (*turn[:4], "\n\n".join(turn[4]), len(turn[4]))


@dataclass(order=True)
class LayerFile:
    mtime: int
    path: str
    size: int = field(compare=False)


def listed(path: str) -> list[LayerFile]:
    """All layer files under ``path``, oldest first."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted(LayerFile(f.mtime_ns or 0, f.path, f.size) for f in found if f.is_file and re.search(EPISODE_DIR, "/" + f.path.lstrip("/")))


def place(path: str) -> dict[str, object]:
    show, _, ep, _, layer = re.search(EPISODE_DIR, "/" + path.lstrip("/")).groups()
    return {"show": show, "ep": int(ep), "layer": layer}


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


def dealt(files: list[LayerFile], most: int) -> list[Files]:
    """Files in partitions of at most ``most`` bytes, or one file."""
    out, size = [], 0
    for f in files:
        if not out or size + f.size > most:
            out.append([])
            size = 0
        out[-1].append(f.path)
        size += f.size
    return [Files(p) for p in out]


def read_files(path: str, paths: list[str]) -> Iterator[pa.RecordBatch]:
    """A batch of turns per file."""
    from pyarrow import fs

    store = fs.FileSystem.from_uri(path)[0] if "://" in path else fs.LocalFileSystem()
    kinds = {"ep": pa.int32(), "seq": pa.int32(), "line": pa.int32(), "start_sec": pa.int32(), "n_paragraphs": pa.int32(), "n_words": pa.int64()}
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
    for p in paths:
        with store.open_input_stream(p) as f:
            text = f.read().decode("utf-8", "replace")
        at, vid = place(p), parse_header(text).get("video_id")
        rows = [(at["show"], at["ep"], vid if isinstance(vid, str) else None, at["layer"], *t, len(_WORD.findall(t[4]))) for t in turns_of(text, at["layer"])]
        yield pa.record_batch([pa.array([r[i] for r in rows], kinds.get(n, pa.string())) for i, n in enumerate(names)], names=names)


class TurnReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.most = options["path"], int(options.get("partitionbytes", PARTITION_BYTES))
        self.wanted: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in ("show", "layer", "ep"):
                self.wanted.append((f.attribute[0], tuple(f.value) if isinstance(f, In) else (f.value,)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        return dealt([f for f in listed(self.path) if all(place(f.path)[c] in values for c, values in self.wanted)], self.most)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # an empty archive has no partition
            yield from read_files(self.path, partition.paths)


class TurnStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.most = options["path"], int(options.get("partitionbytes", PARTITION_BYTES))

    def initialOffset(self) -> dict:
        return {"mtime": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = listed(self.path)
        return {"mtime": files[-1].mtime, "path": files[-1].path} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        key = lambda o: (o["mtime"], o["path"])
        return dealt([f for f in listed(self.path) if key(start) < (f.mtime, f.path) <= key(end)], self.most)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        yield from read_files(self.path, partition.paths)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class TranscriptSource(DataSource):
    """Turns of all layer files under the option ``path``; ``partitionBytes`` bounds a partition."""

    @classmethod
    def name(cls) -> str:
        return "transcripts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TurnReader:
        return TurnReader(self.options)

    def streamReader(self, schema) -> TurnStream:
        return TurnStream(self.options)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("transcripts")`` known, and let filters reach it."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TranscriptSource)
