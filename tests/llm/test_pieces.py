import random

import public_tokenizers
import sentencepiece
from millrace.llm.pieces import Pieces, decode_pieces, encode_pieces

from . import cases

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_same_as_the_library():
    ours, lib, rng = Pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH), random.Random(5)
    texts = [r[1] or "" for r in cases.ODD] + [" ", "  ", "   x   ", "▁▁ x", "<0x41>", "</s>", "a" * 500, " " * 90 + "b", "x\x00y", "漢字かな交じり文 🙂🙂"]
    texts += ["".join(rng.choice("   abehtinor▁<0x>\né漢🙂.,-") for _ in range(rng.randrange(60))) for _ in range(300)]
    got, want = [i.tolist() for i in ours.encode(texts)], lib.encode(texts)
    assert got == want
    assert [ours.decode(i) for i in got] == [lib.decode(i) for i in want]


def test_edges_are_all_occurrences():
    p = Pieces(PATH)
    text = "▁the▁then▁and" * 3
    start, end, piece = p.edges(p.char_rank[[ord(c) for c in text]])
    got = sorted(zip(start.tolist(), end.tolist(), piece.tolist()))
    whole = {int(i) for i in p.whole_ids}
    want = sorted((a, a + n, p.ids[text[a : a + n]]) for a in range(len(text)) for n in range(1, 17) if a + n <= len(text) and p.ids.get(text[a : a + n], -1) in whole)
    assert got == want


def check(docs):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = encode_pieces(docs, PATH).collect()
    assert sorted((str(r.doc_id), r.n_ids, r.ids) for r in rows) == sorted((str(r.doc_id), len(i := lib.encode(r.text or "")), i) for r in docs.collect())
    assert all(r.round_trip for r in rows)


def test_odd_rows(spark):
    check(cases.odd(spark))


def test_documents_and_back(spark, sf):
    docs = cases.documents(spark, sf)
    check(docs)
    back = decode_pieces(encode_pieces(docs, PATH), PATH).join(docs, "doc_id")
    assert back.where("decoded <> text").isEmpty()


def test_empty(spark):
    assert encode_pieces(cases.empty(spark), PATH).count() == 0


def test_words_longer_than_a_part(monkeypatch):
    """Text without spaces, in stretches: the library's ids, also where pieces reach over the ends of stretches."""
    from millrace.llm import pieces

    rng = random.Random(5)
    text = "".join(rng.choice(["the", "ing", "ation", "日本", "é", "0", "==", "x", "\u1234", "🙂"]) for _ in range(9000))
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for part in (500, 777, 100_000):
        monkeypatch.setattr(pieces, "PART", part)
        p = pieces.Pieces(PATH)
        got = p.encode([text, "a b " + text + " c", text[:part], text[: part - 1]])
        assert [g.tolist() for g in got] == [lib.encode(t) for t in (text, "a b " + text + " c", text[:part], text[: part - 1])]
