from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from allotment.llm import alignment
from allotment.llm.alignment import Tokenizers, align, aligned

from . import frames

FIRST, SECOND = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """The alignment by its definition, token by token."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
        self.a.encode_special_tokens = True

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        if not text:
            return []
        whole, out = " " + text, []
        a = self.a.encode(whole, add_special_tokens=False).ids
        b = self.b.encode(text)
        letters = alignment.byte_letters()
        a_bytes = [bytes(letters[c] for c in self.a.id_to_token(i)) for i in a]
        pieces = [self.b.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if b"".join(a_bytes) != whole.encode() or b"".join(b_bytes) != whole.encode():
            return []
        x, y, group = 0, 0, ([], [])
        a, b = list(zip(a, a_bytes)), list(zip(b, b_bytes))
        while a or b:
            if x <= y:
                i, t = a.pop(0)
                group[0].append(i)
                x += len(t)
            else:
                i, t = b.pop(0)
                group[1].append(i)
                y += len(t)
            if x == y:
                out.append(group)
                group = ([], [])
        return out

    def rows(self, texts: list[tuple]) -> list[tuple]:
        links, count = [], Counter()
        for _, text in texts:
            groups = self.groups(text)
            links.append((groups, Counter((i, j) for a, b in groups for i in a for j in b)))
            count.update(links[-1][1].keys())
        best = defaultdict(int)
        for (i, _), n in count.items():
            best[i] = max(best[i], n)
        out = []
        for (id, _), (groups, pairs) in zip(texts, links):
            line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            out.append((
                id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(pairs.values()),
                sum(n for (i, j), n in pairs.items() if count[i, j] == best[i]), sum(count[p] * n for p, n in pairs.items()),
                hashlib.sha256(line.encode()).hexdigest() if groups else "",
            ))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def words():
    return Tokenizers(*(open(p, "rb").read() for p in (FIRST, SECOND)))


def told(frame) -> list[tuple]:
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_texts(plain, words, texts):
    digests, linked = align(*words.encode(texts), words, [(" " + t).encode() if t else b"" for t in texts])
    for k, (_, *expected) in enumerate(plain.rows([(None, t) for t in texts])):
        assert [digests[c][k].as_py() for c in ("n_a", "n_b", "n_groups", "n_links")] == expected[:4]
        assert digests["groups_sha256"][k].as_py() == expected[-1]
    assert linked.column_names == ["document", "pair", "links"]


POOL = ["the", " quick", "naïve", " 日本語", "🙂", " <|endoftext|>", "</s>", "<0x41>", "  ", "\n", "\t", "a" * 50, "▁", "ﬁ", "é", "́", " 12.5", "##", "\x00", "ing"]


@pytest.mark.parametrize("frequent", [0, 5, 1 << 17])
def test_rows_against_the_definition(spark, plain, monkeypatch, frequent):
    random.seed(4)
    texts = [(i % 37, "".join(random.choices(POOL, k=random.randint(0, 60)))) for i in range(120)] + [(None, None), (None, "the ing"), (1, "")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, row string, pair int")
    assert told(aligned(frame, FIRST, SECOND, frequent=frequent)) == sorted(plain.rows(texts), key=str)


def test_small_parts_change_nothing(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "TOGETHER", 300)
    monkeypatch.setattr(alignment, "HELD", 50)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    texts = [(r.doc_id, r.text) for r in rows.collect()]
    assert told(aligned(rows, FIRST, SECOND)) == sorted(plain.rows(texts), key=str)


def test_edges(spark, plain):
    texts = [(i, t) for i, t, *_ in frames.EDGES]
    out = told(aligned(frames.docs(spark, frames.EDGES), FIRST, SECOND))
    assert out == sorted(plain.rows(texts), key=str)
    assert {r[0]: r[1:] for r in out}[3] == (0, 0, 0, 0, 0, 0, "")
    assert told(aligned(frames.docs(spark, []), FIRST, SECOND)) == []


def test_a_group_of_repeated_tokens(words):
    """One group of many tokens, whose ends never meet but at the end, is counted and not written out."""
    a_one, a_two, b_two = words.a.encode_single_token("a"), words.a.encode_single_token("aa"), words.b.piece_to_id("aa")
    n = 60000
    a, b = (pa.array([x], pa.list_(pa.int64())) for x in ([a_one] + [a_two] * (n - 1) + [a_one], [b_two] * n))
    digests, linked = align(a, b, words, [b"aa" * n])
    assert digests["n_groups"][0].as_py() == 1 and digests["n_links"][0].as_py() == n * (n + 1)
    pairs = dict(zip(linked["pair"].to_pylist(), linked["links"].to_pylist()))
    assert pairs == {a_one << alignment.BITS | b_two: 2 * n, a_two << alignment.BITS | b_two: (n - 1) * n}
