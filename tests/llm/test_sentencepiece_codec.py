import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from loomwick.llm import sentencepiece_codec as op


@pytest.fixture(scope="module")
def model():
    sp = SentencePieceProcessor(model_file=op.default_model())
    pieces = {}
    for i in range(sp.get_piece_size()):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[sp.id_to_piece(i).replace("▁", " ")] = (sp.get_score(i), i)
    return sp, pieces


def brute(text, model):
    """Best score of the text and one best path, over characters, without an automaton."""
    sp, pieces = model
    low = min(s for s, _ in pieces.values()) - op.UNSPELLED
    text = " " + text
    best = [(0.0, [])]
    for t in range(1, len(text) + 1):
        ways = []
        for size in range(min(t, 60), 0, -1):
            if (p := text[t - size : t]) in pieces:
                score, i = pieces[p]
                ways.append((best[t - size][0] + score, size, best[t - size][1] + [i]))
        c = text[t - 1]
        if c not in pieces:
            ways.append((best[t - 1][0] + low, 0, best[t - 1][1] + [sp.piece_to_id(f"<0x{b:02X}>") for b in c.encode()]))
        top = max(ways, key=lambda w: w[:2])
        best.append((top[0], top[2]))
    return best[-1][1]


def texts():
    rnd = random.Random(2)
    bits = ["the", "of ", " ", "  ", "ing", "Été", "ß", "\n", "\t", "日", "本語", "🙂", "▁", "xq", "12", ".", "straße", "\x00", "é"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 25))) for _ in range(150)] + ["a" * 300, " ", "   x", "x   ", "▁▁"]


def test_equals_brute_force_and_round_trips(model):
    codec = op.Codec(op.default_model())
    got = [np.frombuffer(x, np.int32).tolist() for x in codec.encode(texts())]
    for text, ids in zip(texts(), got, strict=True):
        assert ids == brute(text, model)
        assert codec.decode(ids) == text


def test_long_parts_alone(monkeypatch):
    """Parts of any length give the same ids by the pass for long ones; a long text without spaces is one part."""
    want = op.Codec(op.default_model()).encode(texts())
    monkeypatch.setattr(op, "LONG_PART", 0)
    codec = op.Codec(op.default_model())
    assert codec.encode(texts()) == want and not codec.cache
    monkeypatch.undo()
    long = "本語theÉté▁xq12" * 30_000
    (ids,) = codec.encode([long])
    assert not codec.cache and codec.decode_many([ids]) == [long]


def test_generations_of_memory(monkeypatch):
    want = op.Codec(op.default_model()).encode(texts())
    monkeypatch.setattr(op, "CACHE_PARTS", 10)
    codec = op.Codec(op.default_model())
    assert [codec.encode([t])[0] for t in texts()] == want


def test_frames(spark):
    rows = [(1, None), (2, ""), (3, "hello world"), (3, "hello world"), (None, "x " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as decoded")
    out = op.decode(op.encode(df, op.default_model()), op.default_model()).collect()
    assert sorted(((r.doc_id, r.decoded) for r in out), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert op.encode(df.filter("false"), op.default_model()).collect() == []
