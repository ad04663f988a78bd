"""Encoding against the sentencepiece library, as it is and read as a unigram model."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as format_of

import __spark_entry__ as entry
from shelfcast.llm import piece_automaton as pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def variant(kind, byte_fallback=True):
    """The public file with another kind of model, or without its byte pieces."""
    model = format_of.ModelProto()
    model.ParseFromString(pieces.read_model(PATH))
    model.trainer_spec.model_type = kind
    if not byte_fallback:
        model.trainer_spec.byte_fallback = False
        kept = [p for p in model.pieces if p.type != pieces.BYTE]
        del model.pieces[:]
        model.pieces.extend(kept)
    return model.SerializeToString()


TEXTS = [
    "", " ", "  ", "     x", "a  b\n\tc  ", "Hello, world!", "naïve café ÀÉ", "東京タワー 東京", "🙂 🙃🙂a",
    "<s> </s> <unk> <0x0A>", "aaaa" * 200, "ababab" * 90, " " * 33, "\x00\x01é", "ѫ梦ң" * 3,
    "x" + " " * 7 + "y", "don't can't 1234567890", "  ", "ﬁ ﬂ ½",
]


def random_texts(n):
    rng = random.Random(11)
    alphabet = "aaeeiinnoorrssttth  ..,éñ梦🙂ѫ\n"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("kind", [pieces.BPE, pieces.UNIGRAM])
@pytest.mark.parametrize("byte_fallback", [True, False])
def test_ids_are_those_of_the_library(kind, byte_fallback):
    content = variant(kind, byte_fallback)
    library = sentencepiece.SentencePieceProcessor(model_proto=content)
    model = pieces.PieceModel(content)
    for text in TEXTS + random_texts(400):
        got = np.frombuffer(model.encode(text), "<i4").tolist()
        want = library.encode(text)
        if kind == pieces.UNIGRAM and got != want:  # another path of the same score
            score = lambda ids: sum(library.get_score(i) for i in ids)
            assert score(got) == score(want), text
            continue
        assert got == want, text
        assert model.decode(got) == library.decode(want), text
        if byte_fallback:
            assert model.decode(got) == text


@pytest.mark.parametrize("kind", [pieces.BPE, pieces.UNIGRAM])
def test_long_texts_without_spaces(kind):
    content = variant(kind)
    library = sentencepiece.SentencePieceProcessor(model_proto=content)
    model = pieces.PieceModel(content)
    rng = random.Random(5)
    runs = [[chr(rng.randrange(low, high)) for _ in range(10_000)] for low, high in ((0x4E00, 0x9FFF), (0x1F300, 0x1F5FF))]
    for text in ["".join(r) for r in runs] + ["".join(rng.choice(c) for c in zip(*runs, "word" * 2500))]:
        got = np.frombuffer(model.encode(text), "<i4").tolist()
        assert kind == pieces.UNIGRAM or got == library.encode(text)
        assert model.decode(got) == text
        assert all(len(w) <= pieces.LONGEST_REMEMBERED for w in [*model.known, *model.known.old])


def test_odd_rows(spark, docs_frame):
    content = pieces.read_model(PATH)
    pairs = [*enumerate(TEXTS), (None, None), (5, TEXTS[5])]
    rows = pieces.decode(pieces.encode(docs_frame(pairs), content), content).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        assert r.decoded == r.text and (r.ids is None) == (r.text is None)
    assert pieces.encode(docs_frame([]), content).count() == 0


def test_op4_against_the_library(spark, sf):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: r for r in entry.queries()["op4_piece_automaton"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<i4").tobytes()))
        assert r.round_trip and r.n_bytes == len(d.text.encode())
