"""Piece encoding and decoding against the sentencepiece library."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lendscope import llm
from lendscope.llm.piece_bpe import Pieces, piece_decode, piece_encode

from corpus import empty, odd_rows, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "   ", "\n", "\t", "a", "e", "in", "the", "▁", "é", "日本", "🙂", "\x00", "ing", "er", "S", "'", "1", "00", "…",
         "̀", "ł", "²", "벨", "ж", ".", "==", "--", "    ", "ll", "abcab", "aaa", "\r\n", "𝒳"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def held():
    return Pieces(MODEL)


def numbers(packed):
    return np.frombuffer(packed, "<i4").tolist()


def test_random_texts(library, held):
    rnd = random.Random(1)
    for _ in range(4000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40)))
        want = library.encode(text)
        assert numbers(held.encode(text)) == want
        assert held.decode(np.array(want, "<i4")) == library.decode(want)


def test_random_ids_decode(library, held):
    rnd = random.Random(2)
    for _ in range(4000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(3, 259), rnd.choice([0, 1, 2, 259, 260, 28705])])
               for _ in range(rnd.randint(0, 12))]
        assert held.decode(np.array(ids, "<i4")) == library.decode(ids)
    with pytest.raises(ValueError):
        held.decode(np.array([32000], "<i4"))


def test_long_runs(library, held):
    for text in ("x" * 5000, "日本" * 4000, " " * 3001, "\n" * 3000, "ab" * 3000 + " " + "é" * 2000):
        assert numbers(held.encode(text)) == library.encode(text)


def test_compatibility_is_that_of_the_library(library, held):
    """Pairs of pieces: compatible exactly if their joint text is encoded as the two."""
    rnd = random.Random(3)
    plain = sorted(i for i in held.plain if "▁" not in held.text[i])
    for _ in range(3000):
        a, b = rnd.choice(plain[:2000]), rnd.choice(plain[:4000])
        alone = numbers(held._listed(held.text[a] + held.text[b])) == [a, b]
        assert held.fits[a, b] == alone
        want = library.encode_as_pieces("," + held.text[a] + held.text[b])
        if held.fits[a, b] and want[:2] == ["▁", ","]:
            assert want[2:] == [held.text[a], held.text[b]]


def test_without_the_cut_at_blanks(library):
    """Whole texts through the table, as for a model whose pieces hold blanks inside."""
    whole = Pieces(MODEL)
    whole.by_parts = False
    rnd = random.Random(4)
    for _ in range(300):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60)))
        assert numbers(whole.encode(text)) == library.encode(text)


def test_odd_rows(spark, library):
    docs = table(spark, [*odd_rows(), (None, "no id"), (7, "again"), (7, "again")])
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], list(r["ids"]), r["decoded"])
                 for r in piece_encode(docs, MODEL, decoded=True).collect())
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "")
        want.append((r["doc_id"] is None, r["doc_id"] or 0, len(ids), ids, library.decode(ids)))
    assert got == sorted(want)
    assert piece_encode(empty(spark), MODEL).count() == 0


def test_decoding_of_a_table(spark, library):
    rows = [(1, [259, 259, 278], "x"), (2, None, "x"), (3, [], "x"), (4, [0, 278, 2, 5, 200, 300], "x"), (4, [222, 1, 192], "x")]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>, decoded string")
    got = piece_decode(frame, MODEL)
    assert got.columns == ["doc_id", "ids", "decoded"]
    found = sorted((r["doc_id"], r["ids"] or [], r["decoded"]) for r in got.collect())
    assert found == sorted((i, ids or [], None if ids is None else library.decode(ids)) for i, ids, _ in rows)


def test_query(spark, library):
    from lendscope.sources.tables import read_table
    from conftest import SF_SMALL
    got = {r["doc_id"]: tuple(r)[1:] for r in llm.queries()["op13_pieces"](spark, SF_SMALL).collect()}
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "")
        assert got[doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                               hashlib.sha256(library.decode(ids).encode()).hexdigest())
