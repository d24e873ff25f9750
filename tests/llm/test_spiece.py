"""Merge-dropout against agendas popped one by one from the definition, plain BPE, exact round trips."""

import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from quorumtext.llm import spiece as P
from quorumtext.runtime import ship_package

TEXTS = ["", " ", "a", " a  b\n\nc", "Éçan “x” ’", "<s> <0x0A> ▁▁x", "你好 \U0001f600", "in the the the " * 50, "x" * 3000, "tab\there", "end \n", "   ", "\n a", "Straßenverkehrsordnung " * 3]


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary.load(P.MODEL)


def slow_encode(coder, text, document):
    """Chunks by a pattern, then the best pair that stands and is not skipped, again and again."""
    v, out = coder.v, []
    for number, chunk in enumerate(re.findall("[ ]*[^ \n]+|[ ]+|\n+", " " + text) if text else []):
        key = coder.keys(np.array([document]), np.array([number]))
        parts = [(i, "\0" if c == P.MARK else c.replace(" ", P.MARK)) for i, c in enumerate(chunk)]
        skipped = set()
        while True:
            pairs = [(v.rank[a + b], i, k) for k, ((i, a), (_, b)) in enumerate(zip(parts, parts[1:])) if a + b in v.rank and (i, a, b) not in skipped]
            if not pairs:
                break
            r, i, k = min(pairs)
            if coder.limit and coder.skipped(key, np.array([i]), np.array([r]))[0]:
                skipped.add((i, parts[k][1], parts[k + 1][1]))
                continue
            parts[k : k + 2] = [(i, parts[k][1] + parts[k + 1][1])]
        for _, p in parts:
            out += [v.ids[p]] if p in v.ids else [v.byte_ids[x] for x in p.replace("\0", P.MARK).encode()]
    return out


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
def test_slices_equal_single_agendas(vocabulary, dropout):
    coder = P.Encoder(vocabulary, dropout=dropout)
    texts = [t if len(t) < 1000 else t[:60] for t in TEXTS] + ["of the international measurement co-operation " * 4, "ab" * 23 + " " + "ab" * 24, "ab" * 30]
    raw = [t.encode() for t in texts]
    ids, begin = coder.encode_slice(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), np.arange(len(raw)))
    for i, t in enumerate(texts):
        want = slow_encode(coder, t, i)
        assert ids[begin[i] : begin[i + 1]].tolist() == want == coder.encode(t, i), t
        assert P.decode_ids(want, vocabulary) == t


def test_without_dropout_it_is_plain_bpe(vocabulary):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    coder = P.Encoder(vocabulary, dropout=0.0)
    for t in TEXTS:
        if P.MARK not in t:
            assert coder.encode(t) == sp.encode(t), t


def test_every_occurrence_draws_for_itself(vocabulary):
    text = " international" * 4000
    ids = P.Encoder(vocabulary, dropout=0.3).encode(text, 5)
    words = re.findall("[ ][^ ]+", " " + text)
    pieces = [vocabulary.raw[i] for i in ids]
    cuts, word, left = set(), [], 0
    for p in pieces[1:]:
        word.append(p)
        left += len(p)
        if left == len(" international"):
            cuts.add(tuple(word))
            word, left = [], 0
    assert len(cuts) > 100 and len(words) > 3000
    assert len({tuple(P.Encoder(vocabulary).encode(text[:500], d)) for d in range(20)}) == 20
    assert P.Encoder(vocabulary, seed=1).encode(text, 5) != P.Encoder(vocabulary, seed=2).encode(text, 5)


def test_very_long_texts_go_in_pieces(vocabulary, monkeypatch):
    coder = P.Encoder(vocabulary)
    text = "measure  of\n\nthings, \u00e9t\u00e9 " * 300 + "x" * 900 + " end"
    whole = coder.encode(text, 3)
    monkeypatch.setattr(P, "SLICE", 700)
    assert coder.encode(text, 3) == whole and P.decode_ids(whole, vocabulary) == text


def test_share_of_skipped_merges(vocabulary):
    coder = P.Encoder(vocabulary, dropout=0.1)
    keys = coder.keys(np.zeros(50_000, np.int64), np.arange(50_000))
    assert 0.095 < coder.skipped(keys, np.full(50_000, 2), np.full(50_000, 77)).mean() < 0.105
    assert P.Encoder(vocabulary, dropout=1.0).encode("the")[:3] == [vocabulary.ids[x] for x in (P.MARK, "t", "h")]


def test_frames(spark):
    ship_package(spark)
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(99, None, "y", 2), (None, "a b", "z", 3), (2, "a", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, tokens string, _text int")
    back = P.decode(P.encode(docs, keep=("doc_id", "_text"))).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in back) == sorted((str(i), str(t)) for i, t, _, _ in rows)
    assert [r.text for r in back if r.doc_id == 99] == [None]
    assert P.decode(P.encode(docs.where(F.lit(False)))).count() == 0
