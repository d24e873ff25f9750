"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

The vocabulary of a SentencePiece BPE model is read on the driver and broadcast (its size is
the model's, not the corpus's). A text gets a leading space; spaces become the model's mark.
No piece holds a mark behind another character or a line feed, so merges never cross the
start of a run of spaces, and a text is encoded chunk by chunk.

Each chunk's agenda holds adjacent pairs whose concatenation is a piece, best score first,
leftmost on ties. A popped pair that still stands is *skipped* if a keyed hash of (seed,
document, number of the chunk in its text, place, rank) falls under ``dropout``; skipped
pairs are gone until a neighbour's merge makes a new pair there. Every occurrence of a word
so draws for itself. Without dropout this is plain BPE.

1. The plain derivation of each distinct chunk of a slice is run once and its merges noted.
2. An occurrence whose hashes skip none of these merges has the plain tokens, as its agenda
   would pop the same pairs in the same order. The others run agendas of their own.
3. Agendas run in lockstep, one merge a step in each; a chunk of ``LONG`` characters or more
   has a heap of its own.

Symbols without a piece become byte pieces; a mark that stands in the text itself does too.
So decoding gives every text back, whatever was skipped.

Edge cases: a null text gives null tokens and back; an empty text has none; texts of any
length are encoded whole (an agenda is as long as its chunk); rows with one id and one text
come out equal; null ids are one key; unknown token ids raise an error; columns not named in
``keep`` are dropped.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.textbatch import mix, slices, span_hashes, unlike

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED = 17
DROPOUT = 0.1
MARK = "▁"
LONG = 48
SLICE = 1 << 20  # bytes of text whose chunks are held at once
NONE = 1 << 30
_PLACE, _RANK, _CHUNK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Vocabulary:
    """rank: pieces by dense rank of score, 0 the best; ids of pieces and of bytes; bytes of each id (None: not text)."""

    rank: dict[str, int]
    ids: dict[str, int]
    byte_ids: list[int]
    raw: list[bytes | None]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, byte_ids, raw, score = {}, [0] * 256, [], {}
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(None)
            else:
                if "\n" in piece or " " in piece or MARK in piece.lstrip(MARK):
                    raise ValueError("pieces must hold marks at their start only, no space and no line feed")
                ids[piece], score[piece] = i, sp.get_score(i)
                raw.append(piece.replace(MARK, " ").encode())
        place = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        return cls({p: place[s] for p, s in score.items()}, ids, byte_ids, raw)


class PairTable:
    """(left, right) -> (rank, merged) of all pairs of symbols that make a piece, as hash tables in arrays.

    A symbol is a piece's id, or the vocabulary's size plus the code point of a character
    without a piece (such never merge). A space is the mark; a mark of the text has no piece.
    """

    def __init__(self, v: Vocabulary):
        size = len(v.raw)
        self.symbol = np.arange(0x110000, dtype=np.int32) + size
        for p, i in v.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.symbol[32], self.symbol[ord(MARK)] = self.symbol[ord(MARK)], size + ord(MARK)
        each = ((v.ids[p[:k]] << 21 | v.ids[p[k:]], v.rank[p], i) for p, i in v.ids.items() for k in range(1, len(p)) if p[:k] in v.ids and p[k:] in v.ids)
        pairs = np.fromiter(each, [("key", np.int64), ("rank", np.int32), ("merged", np.int32)])  # a list of them would stay with the worker
        key, rank, merged = (np.ascontiguousarray(pairs[c]) for c in ("key", "rank", "merged"))
        self.tables = []
        while len(key):  # what finds its place taken goes to a further table
            level, bits = len(self.tables), len(key).bit_length() + 2
            slots = np.full(1 << bits, -1, np.int32)
            at = self.slot(key, bits, level)
            slots[at[::-1]] = np.arange(len(key))[::-1]
            here = slots[at] == np.arange(len(key))
            slots[at[here]] = np.arange(here.sum())
            self.tables.append((bits, slots, np.append(key[here], -1), rank[here], merged[here]))  # an empty place leads to the last key
            key, rank, merged = key[~here], rank[~here], merged[~here]

    @staticmethod
    def slot(key: np.ndarray, bits: int, level: int) -> np.ndarray:
        times = np.uint64(pow(0x9E3779B97F4A7C15, 2 * level + 1, 1 << 64))
        return (key.view(np.uint64) * times >> np.uint64(64 - bits)).view(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE where there is no such piece) and merged symbol."""
        key = left.astype(np.int64) << 21 | right
        rank, merged = np.full(len(key), NONE, np.int32), np.zeros(len(key), np.int32)
        rest = None
        for level, (bits, slots, keys, ranks, pieces) in enumerate(self.tables):
            own = key if rest is None else key[rest]
            at = slots[self.slot(own, bits, level)]
            found = keys[at]
            hit = np.flatnonzero(found == own)
            to = hit if rest is None else rest[hit]
            rank[to], merged[to] = ranks[at[hit]], pieces[at[hit]]
            on = np.flatnonzero((found != own) & (found >= 0))  # an empty place: no table has the key
            rest = on if rest is None else rest[on]
            if not len(rest):
                break
        return rank, merged


def chunk_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each chunk and its row; data: rows with their leading space.

    A chunk is a run of spaces with the run of other characters behind it, or of line feeds.
    """
    kind = np.where(data == 32, 1, np.where(data == 10, 2, 0)).astype(np.int8)
    before = np.empty_like(kind)
    before[1:], before[:1] = kind[:-1], 3
    before[bounds[:-1][np.diff(bounds) > 0]] = 3
    start = np.flatnonzero((kind != before) & ((kind > 0) | (before >= 2)))
    return start, np.searchsorted(bounds, start, side="right") - 1


def _ranges(n: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n in turn."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


class Encoder:
    """Encodes texts with one vocabulary, seed and dropout."""

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED, dropout: float = DROPOUT):
        self.v, self.turn = vocabulary, np.uint64(seed * int(_RANK) & (1 << 64) - 1)
        self.limit = np.uint64(int(dropout * (1 << 32)))
        self.pairs = PairTable(vocabulary)
        self.bytes = np.array(vocabulary.byte_ids, np.int32)

    def keys(self, document: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The key of each document's chunk with that number."""
        return mix(mix(document.astype(np.uint64) + self.turn) + number.astype(np.uint64) * _CHUNK)

    def skipped(self, key: np.ndarray, place: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Whether the keyed hash skips the pair of that rank at that place."""
        x = key ^ (place.astype(np.uint64) * _PLACE + rank.astype(np.uint64) * _RANK)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
        return x >> np.uint64(32) < self.limit

    def encode(self, text: str, document: int = 0) -> list[int]:
        """Token ids of one text."""
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, _ = self.encode_slice(raw, np.array([0, len(raw)]), np.array([document], np.int64))
        return ids.tolist()

    def encode_slice(self, data: np.ndarray, bounds: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows of a slice, and where each row's begin (one more than rows)."""
        full = np.diff(bounds) > 0
        data = np.insert(data, bounds[:-1][full], 32)
        bounds = bounds + np.concatenate([[0], np.cumsum(full)])
        if len(full) > 1 or len(data) <= 2 * SLICE:
            return self._encoded(data, bounds, document, 0)
        start, _ = chunk_spans(data, bounds)  # a very long text goes through in pieces of whole chunks
        head = np.unique(np.searchsorted(start, np.arange(0, len(data), SLICE)))
        head = head[head < len(start)].tolist()
        ends = [*start[head[1:]].tolist(), len(data)]
        parts = [self._encoded(data[start[a] : z], np.array([0, z - start[a]]), document, a)[0] for a, z in zip(head, ends, strict=True)]
        ids = np.concatenate(parts)
        return ids, np.array([0, len(ids)])

    def _encoded(self, data: np.ndarray, bounds: np.ndarray, document: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_slice``, of rows with their leading space; their first chunk has the number ``before``."""
        start, row = chunk_spans(data, bounds)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        end = np.append(start[1:], len(data))
        number = before + np.arange(len(start)) - np.searchsorted(row, row)
        key = self.keys(document[row], number)
        one = self._distinct(data, start, end)  # of each chunk, the first that is equal
        chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        first, size = at[start], at[end] - at[start]
        sym = self.pairs.symbol[chars]
        own = np.flatnonzero(one == np.arange(len(one)))
        seat = np.empty(len(start), np.int64)
        seat[own] = np.arange(len(own))
        seat = seat[one]
        short = size[own] < LONG
        plain, ends, (m_seat, m_place, m_rank) = self._agendas(sym, first[own[short]], size[own[short]], None)
        place_of = np.full(len(own), -1, np.int64)
        place_of[short] = np.arange(int(short.sum()))
        seat = place_of[seat]  # -1: long
        again = np.flatnonzero(seat >= 0)[:0]
        if self.limit and len(m_seat):
            order = np.argsort(m_seat, kind="stable")
            m_place, m_rank = m_place[order], m_rank[order]
            begin = np.searchsorted(m_seat[order], np.arange(len(ends)))
            n_merges = np.diff(np.append(begin, len(order)))
            had = np.flatnonzero(seat >= 0)
            n = n_merges[seat[had]]
            which = np.repeat(begin[seat[had]], n) + _ranges(n)
            skip = self.skipped(np.repeat(key[had], n), m_place[which], m_rank[which])
            again = np.unique(np.repeat(had, n)[skip])
        drawn, drawn_ends, _ = self._agendas(sym, first[again], size[again], key[again])
        long = np.flatnonzero(seat < 0)
        heaps = [self.segment(sym[first[c] : first[c] + size[c]].tolist(), key[c]) for c in long.tolist()]
        flat = np.concatenate([plain, drawn, np.array([x for h in heaps for x in h], np.int32)])
        finish = np.concatenate([ends, len(plain) + drawn_ends, len(plain) + len(drawn) + np.cumsum([len(h) for h in heaps], dtype=np.int64)]).astype(np.int64)
        begin = np.concatenate([[0], finish[:-1]]).astype(np.int64)
        seat[again] = len(ends) + np.arange(len(again))
        seat[long] = len(ends) + len(again) + np.arange(len(long))
        n = finish[seat] - begin[seat]
        out = flat[np.repeat(begin[seat], n) + _ranges(n)]
        per = np.bincount(row, weights=n, minlength=len(bounds) - 1).astype(np.int64)
        return self._with_bytes(out, np.concatenate([[0], np.cumsum(per)]))

    @staticmethod
    def _distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each chunk the first equal one; equal hashes are compared byte by byte."""
        h = span_hashes(data, start, end)
        _, first, back = np.unique(h, return_index=True, return_inverse=True)
        one = first[back]
        n = end - start
        same = (end[one] - start[one]) == n
        look = np.flatnonzero(same & (one != np.arange(len(one))))
        m = n[look]
        step = _ranges(m)
        differ = data[np.repeat(start[look], m) + step] != data[np.repeat(start[one[look]], m) + step]
        same[np.repeat(look, m)[differ]] = False
        return np.where(same, one, np.arange(len(one)))

    def _with_bytes(self, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without a piece as the pieces of their bytes."""
        size = len(self.v.raw)
        foreign = np.flatnonzero(ids >= size)
        if not len(foreign):
            return ids, begin
        raw = [chr(c).encode() for c in (ids[foreign] - size).tolist()]
        n = np.ones(len(ids), np.int64)
        n[foreign] = [len(x) for x in raw]
        to = np.concatenate([[0], np.cumsum(n)])
        out = np.repeat(ids, n)
        at = np.repeat(to[foreign], n[foreign]) + _ranges(n[foreign])
        out[at] = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        return out, to[begin]

    def _agendas(self, sym: np.ndarray, first: np.ndarray, size: np.ndarray, key: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """Symbols of chunks after their agendas have run, where each ends, and the merges (chunk, place, rank) of plain ones."""
        wide = -(-size // 6) * 6
        got, count, merges = [], np.zeros(len(size), np.int64), []
        order = []
        for width in np.unique(wide).tolist():
            which = np.flatnonzero(wide == width)
            for lo in range(0, len(which), 8192):
                own = which[lo : lo + 8192]
                flat, n, noted = self._lockstep(sym, first[own], size[own], int(width), None if key is None else key[own])
                got.append(flat)
                count[own] = n
                order.append(own)
                merges += [(own[r], p, k) for r, p, k in noted]
        ends = np.cumsum(count)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for own, flat in zip(order, got, strict=True):
            n = count[own]
            out[np.repeat(ends[own] - n, n) + _ranges(n)] = flat
        parts = [np.concatenate([m[k] for m in merges]) if merges else np.zeros(0, np.int64) for k in range(3)]
        return out, ends, tuple(parts)

    def _lockstep(self, symbols: np.ndarray, first: np.ndarray, size: np.ndarray, width: int, key: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, list]:
        n, size = len(size), size.astype(np.int32)
        col = np.arange(width, dtype=np.int32)
        inside = col[None] < size[:, None]
        sym = np.where(inside, symbols[np.minimum(first[:, None] + col[None], len(symbols) - 1)], -1).astype(np.int32)
        place = np.tile(col, (n, 1))
        rank, piece = np.full((n, width), NONE, np.int32), np.zeros((n, width), np.int32)

        def look(i: np.ndarray, p: np.ndarray) -> None:
            """Put the pair at place p of rows i on the agenda, unless its hash says to skip it."""
            r, m = self.pairs.find(sym[i, p], sym[i, p + 1])
            if key is not None:
                there = np.flatnonzero(r < NONE)
                r[there[self.skipped(key[i[there]], place[i[there], p[there]], r[there])]] = NONE
            rank[i, p], piece[i, p] = r, m

        look(*np.nonzero(inside[:, 1:]))
        done_sym, done_size = np.empty_like(sym), np.zeros(n, np.int32)
        row = np.arange(n)  # of each row that is still held
        noted = []
        while len(row):
            best = rank.argmin(1).astype(np.int32)
            least = rank[np.arange(len(row)), best]
            at = np.flatnonzero(least < NONE)
            if 4 * len(at) < 3 * len(row):  # let finished rows go, now and then
                gone = np.ones(len(row), bool)
                gone[at] = False
                done_sym[row[gone]], done_size[row[gone]] = sym[gone], size[gone]
                row, sym, place, rank, piece, size, best, least = (x[at] for x in (row, sym, place, rank, piece, size, best, least))
                key = None if key is None else key[at]
                at = np.arange(len(row))
            if not len(at):
                continue
            here = best[at]
            if key is None:
                noted.append((row[at], place[at, here], least[at]))
            sym[at, here] = piece[at, here]
            flat = (at * width)[:, None] + np.minimum(col[None] + (col[None] > here[:, None]), width - 1)
            for x in (sym, place, rank, piece):
                x[at] = x.ravel()[flat]
            rank[at, width - 1] = rank[at, here] = NONE
            size[at] -= 1
            after = here + 1 < size[at]
            look(at[after], here[after])
            before = here > 0
            look(at[before], here[before] - 1)
        return done_sym[col[None] < done_size[:, None]], done_size.astype(np.int64), noted

    def segment(self, symbols: list[int], key: int | np.uint64 = 0) -> list[int]:
        """Symbols of one chunk after its agenda has run, popped from a heap."""
        n = len(symbols)
        syms: list[int] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int, int]] = []
        key = np.array([key], np.uint64)

        def look(pairs: list[tuple[int, int]]) -> None:
            left, right = (np.array([syms[p[k]] for p in pairs], np.int32) for k in (0, 1))
            ranks, merged = self.pairs.find(left, right)
            for (i, j), r, m, a, b in zip(pairs, ranks.tolist(), merged.tolist(), left.tolist(), right.tolist(), strict=True):
                if r < NONE:
                    heapq.heappush(agenda, (r, i, m, a, b))

        look([(i, i + 1) for i in range(n - 1)])
        while agenda:
            r, i, m, a, b = heapq.heappop(agenda)
            j = after[i]
            if syms[i] != a or j >= n or syms[j] != b:
                continue
            if self.limit and self.skipped(key, np.array([i]), np.array([r]))[0]:
                continue
            syms[i], syms[j] = m, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            look([p for p in ((i, k), (before[i], i)) if 0 <= p[0] and p[1] < n])
        return [s for s in syms if s >= 0]


def decode_ids(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text that was encoded."""
    raw = b"".join([vocabulary.raw[i] for i in ids])
    return raw[1:].decode("utf-8")


def encode(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), key: str = "doc_id", model: str = MODEL, seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """Columns ``keep`` and ``tokens``, an array of ids; ``key`` names the document whose merges are drawn. ``keep`` may not hold a ``tokens``."""
    unlike(keep, ("tokens",))
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(sent.value, seed, dropout)
        for b in batches:
            document, there = b.column(len(keep)).to_numpy(), b.column(len(keep) + 1).is_valid()
            for s in slices(b.column(len(keep) + 1), SLICE):
                ids, begin = coder.encode_slice(s.data, s.bounds, document[s.lo : s.hi])
                valid = there.slice(s.lo, s.hi - s.lo)
                tokens = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids, pa.int32()), mask=pa.compute.invert(valid))
                yield pa.record_batch([*b.slice(s.lo, s.hi - s.lo).columns[: len(keep)], tokens], names=[*keep, "tokens"])

    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    return docs.select(*own, F.xxhash64(key).alias("key"), F.col(text).alias("text")).mapInArrow(each, f"{kinds}, tokens array<int>")


def decode(tokens: DataFrame, keep: tuple[str, ...] = ("doc_id",), column: str = "tokens", model: str = MODEL) -> DataFrame:
    """Columns ``keep`` and ``text``; ``keep`` may not hold a ``text``."""
    unlike(keep, ("text",))
    sent = tokens.sparkSession.sparkContext.broadcast(Vocabulary.load(model).raw)
    kinds = ", ".join(f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in keep)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = np.array([x if x is not None else b"" for x in sent.value], object)
        bad = np.array([x is None for x in sent.value])
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                own = b.slice(lo, 256)
                out: list[str | None] = []
                for t in own.column(len(keep)):
                    if not t.is_valid:
                        out.append(None)
                        continue
                    ids = t.values.to_numpy()
                    if bad[ids].any():
                        raise ValueError("an id that stands for no text")
                    out.append(b"".join(raw[ids])[1:].decode("utf-8"))
                yield pa.record_batch([*own.columns[: len(keep)], pa.array(out, pa.string())], names=[*keep, "text"])

    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    return tokens.select(*own, F.col(column).alias("tokens")).mapInArrow(each, f"{kinds}, text string")


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Digests of all documents' tokens and of the texts decoded from them."""
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("text_sha256", F.sha2("text", 256)).withColumn("n_bytes", F.octet_length("text"))
    coded = encode(docs, keep=("doc_id", "text_sha256", "n_bytes"))
    back = decode(coded.withColumns({"n_tokens": F.size("tokens"), "tokens_hash": F.xxhash64("tokens")}), keep=("doc_id", "text_sha256", "n_bytes", "n_tokens", "tokens_hash"))
    return back.select("doc_id", "n_bytes", "n_tokens", "tokens_hash", F.sha2("text", 256).eqNullSafe(F.col("text_sha256")).alias("lossless"))
