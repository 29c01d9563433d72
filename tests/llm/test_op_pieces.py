"""SentencePiece by an agenda of pairs, against the library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tidemark.llm import pieces
from tidemark.llm.pieces import PairAgenda, encode_pieces, model_path, op11_sentencepiece, slices

LETTERS = "ab e\n\t ▁é日本<0x>s/\x00​😀.,-“”Жд аaatheing  "


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


@pytest.fixture(scope="module")
def agenda(model):
    return PairAgenda(model)


def ids_of(agenda, text):
    return np.frombuffer(agenda.encode(text), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])) | st.text(st.sampled_from(LETTERS)))
def test_same_ids_as_the_library(model, agenda, text):
    assert ids_of(agenda, text) == model.encode(text, add_bos=True, add_eos=True)


def test_stretches_lose_no_letter(agenda):
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choices(LETTERS, k=rng.randint(0, 80)))
        assert "".join(agenda.stretches.findall(agenda.normalize(text))) == agenda.normalize(text)


def test_one_agenda_for_a_whole_text_gives_the_same(model, agenda):
    text = "It was, as they say, the best of times; 12 days… «voilà» the end.\n\n  Fin"
    whole = agenda.ids_of(agenda.merged(agenda.normalize(text)))
    assert [model.bos_id(), *whole, model.eos_id()] == ids_of(agenda, text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("▁abthein g,é"), min_size=2, max_size=40))
def test_both_agendas_merge_alike(agenda, text):
    short = agenda.merged(text)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pieces, "MAX_LENGTH", 0)
        assert agenda.merged(text) == short


def test_a_letter_without_end_and_forgotten_stretches(model, agenda, monkeypatch):
    long = "a" * 200_000 + "é" * 50_000
    assert ids_of(agenda, long) == model.encode(long, add_bos=True, add_eos=True)
    monkeypatch.setattr(pieces, "MAX_KEPT", 3)
    text = " ".join(map(chr, range(97, 123))) * 3
    assert ids_of(agenda, text) == model.encode(text, add_bos=True, add_eos=True)


def test_equal_scores_go_left_first():
    class Tied:
        names = ["<unk>", "a", "aa", "aaa"]

        def __getattr__(self, name):
            return {"unk_id": lambda: 0, "bos_id": lambda: -1, "eos_id": lambda: -1, "normalize": str}[name]

        get_piece_size = lambda self: 4
        id_to_piece = lambda self, i: self.names[i]
        get_score = lambda self, i: 0.0
        is_unused = is_control = is_byte = lambda self, i: False
        is_unknown = lambda self, i: i == 0

    tied = PairAgenda(Tied())
    assert ids_of(tied, "aaaa") == [3, 1]
    # Without bytes, neighbouring unknowns are one.
    assert ids_of(tied, "bbab") == [0, 1, 0]


def test_odd_rows(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (None, "one two", "x"), (4, "one two", "x"), (4, "one two", "x"), (5, " \n ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(encode_pieces(docs).collect(), key=str)
    assert len(got) == 6 and all(r.agrees for r in got)
    for r in got:
        text = next(t for d, t, _ in rows if d == r.doc_id) or ""
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == model.decode(ids)
    assert encode_pieces(docs.limit(0)).count() == 0
    broken = docs.limit(1).selectExpr("1L doc_id", "cast(X'61FF62' AS string) text")
    assert encode_pieces(broken).first().decoded == "a�b"


def test_slices_hold_every_text():
    texts = ["x" * n for n in (3, 5, 0, 20, 1, 1)]
    parts = list(slices(texts, 8))
    assert [t for p in parts for t in texts[p]] == texts
    assert max(sum(map(len, texts[p])) for p in parts if p.stop - p.start > 1) <= 8
    assert list(slices([])) == []


def test_query_on_the_given_table(spark, model):
    folder = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = model.encode(r.text or "", add_bos=True, add_eos=True)
        digests = np.array(ids, "<u4").tobytes(), model.decode(ids).encode()
        want[r.doc_id] = (len(ids), *(hashlib.sha256(d).hexdigest() for d in digests))
    got = op11_sentencepiece(spark, folder).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert len(got) == len(want) and all(r.agrees for r in got)
