from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from allotment.llm.bpe import Vocabulary, encode_decode

from . import frames

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    with open(PATH, "rb") as file:
        return Vocabulary(file.read()), Tokenizer.from_file(PATH)


def agree(both, text: str) -> None:
    mine, theirs = both
    ids = np.frombuffer(mine.encode(text), dtype="<u4")
    assert ids.tolist() == theirs.encode(text, add_special_tokens=False).ids
    assert mine.decode(ids).decode("utf-8", "replace") == theirs.decode(ids.tolist(), skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(both, text):
    agree(both, text)


def test_pieces_white_space_and_special_tokens(both):
    random.seed(5)
    pool = ["a", "the", "'s", "'ll", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "é", "日本", "🙂", "1", "²", "<|endoftext|>", "<|", "...", "\x00"]
    for _ in range(3000):
        agree(both, "".join(random.choices(pool, k=random.randint(0, 14))))
    for text in ("a" * 3000, " " * 3000, "ab" * 2000 + " x", "".join(random.choices("abcdefghij", k=4000))):
        agree(both, text)


def test_steps_back_are_exact(both):
    random.seed(6)
    for _ in range(300):
        agree(both, "".join(random.choices("aabnrest", k=random.randint(1, 40))))


def test_long_texts_are_cut_at_seams(both, monkeypatch):
    monkeypatch.setattr("allotment.llm.bpe.STRETCH", 50)
    agree(both, frames.LONG[:20000] + "  \n x" * 40)


def test_invalid_bytes_are_replaced(both):
    mine, theirs = both
    ids = np.array([mine.tokens.index(b"\xe2"), mine.tokens.index(b"("), 50256], dtype="<u4")
    assert mine.decode(ids) == b"\xe2(<|endoftext|>"
    assert mine.decode(ids).decode("utf-8", "replace") == theirs.decode(ids.tolist(), skip_special_tokens=False)


def test_full_memories_change_nothing(both, monkeypatch):
    """Runs, pieces and pairs in two generations of three entries each."""
    monkeypatch.setattr("allotment.llm.bpe.REMEMBERED", 3)
    with open(PATH, "rb") as file:
        small = Vocabulary(file.read())
    for _, text, *_ in frames.EDGES:
        assert small.encode((text or "")[:3000]) == both[0].encode((text or "")[:3000])
    agree((small, both[1]), "the cat, the dog; the cat, éèê the  dog " * 20)
    assert max(len(small.memory), len(small.memory.old), len(small.pieces), len(small.pairs)) <= 3


def test_rows(spark, both):
    rows = encode_decode(frames.docs(spark, frames.EDGES), PATH).collect()
    assert len(rows) == len(frames.EDGES)
    for r, (i, text, _, _) in zip(rows, frames.EDGES):
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert (r.doc_id, r.decoded, r.n_tokens) == (i, text or "", len(ids))
        assert ids == both[1].encode(text or "", add_special_tokens=False).ids
    assert encode_decode(frames.docs(spark, []), PATH, decoded=False).count() == 0


@pytest.mark.parametrize("few, slots", [(0, 19), (0, 4), (3, 19)])
def test_side_by_side_is_exact(both, monkeypatch, few, slots):
    """Many pieces at once, with a large and a small pair table: as alone and as the library."""
    monkeypatch.setattr("allotment.llm.bpe.FEW", few)
    monkeypatch.setattr("allotment.llm.bpe.SLOTS", slots)
    with open(PATH, "rb") as file:
        words = Vocabulary(file.read())
    random.seed(8)
    syllables = ["th", "on", "ti", "nd", "er", "ing", "ß", "é", "ü", "日本", "🙂", "ÿ", "×", "'ll", "...", "%%%", "7", "²"]
    texts = [" ".join("".join(random.choices(syllables, k=random.randint(1, 7))) for _ in range(60)) for _ in range(60)]
    texts += ["", " ", "a" * 200 + " " + "thonti" * 60, "<|endoftext|>x<|endoftext|>", "\xff\udfff".encode("utf-8", "ignore").decode()]
    ids = [np.frombuffer(x, dtype="<u4").tolist() for x in words.encode_all(texts)]
    assert ids == [both[1].encode(t, add_special_tokens=False).ids for t in texts]
    pieces = [p for p in {"".join(random.choices(syllables[:10], k=k)) for k in range(1, 12) for _ in range(20)}]
    packed, until = words.sequences("".join(p + "\udcff" for p in pieces).encode("utf-8", "surrogateescape"))
    alone = [words.piece(p.encode().decode("latin-1")) for p in pieces]
    assert np.frombuffer(packed, dtype="<u4").tolist() == sum(alone, []) and until.tolist() == np.cumsum([*map(len, alone)]).tolist()


def test_pairs_of_all_kinds_are_compatible_or_not(both):
    rng = np.random.default_rng(9)
    left, right = rng.integers(0, 3000, (2, 20000))
    assert both[0].all_compatible(left, right).tolist() == [both[0].compatible(*p) for p in zip(left.tolist(), right.tolist())]
    for _ in range(2):
        assert both[0].fits(left, right).tolist() == both[0].all_compatible(left, right).tolist()


def test_a_task_forgets_its_words(both):
    with open(PATH, "rb") as file:
        words = Vocabulary(file.read())
    before = words.encode(frames.LONG[:5000])
    words.forget()
    assert not any(len(m) or len(m.old) for m in (words.memory, words.pieces, words.pairs))
    assert words.encode(frames.LONG[:5000]) == before


def test_new_words_are_worked_out_side_by_side(both):
    """Of 5,000 new words fewer than 500 are left to be worked out alone."""
    with open(PATH, "rb") as file:
        words = Vocabulary(file.read())
    alone = []
    words.pieces.work = lambda word: alone.append(word) or words.piece_ids(word)
    random.seed(10)
    texts = [" ".join("".join(random.choices(["th", "on", "ti", "nd", "er", "ing"], k=6)) for _ in range(50)) for _ in range(100)]
    words.encode_all(texts)
    assert len(alone) < 500
