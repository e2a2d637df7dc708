"""Byte-level BPE: exact encoding by backtracking over longest matches, decoding by offsets."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Unicode white space, and the published split pattern of this kind of vocabulary.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
# Runs that no piece crosses: a word with the space before it, or white space.
RUNS = rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
# A run that is one piece, as most are: Latin letters.
WORD = r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+"

#: Runs, pieces and pairs of tokens in each generation that a task remembers, and the longest run worth remembering.
REMEMBERED, REMEMBERED_CHARS = 1 << 15, 64
#: Characters split at once, rows that a task holds at once.
STRETCH, ROWS = 1 << 20, 512
#: Pieces of so many bytes at most are worked out side by side, until so few are left.
SIDE_BY_SIDE, FEW = 64, 32
#: Ends a piece: the byte 255, which UTF-8 has not, taken as the number 256.
SEAM, SEAM_BYTE, LETTERS = "\udcff", 256, 257
#: Slots of the pair table as a power of two, the factor that spreads pairs over them, and pairs compared at once.
SLOTS, SPREAD, PAIRS = 19, np.uint64(0x9E3779B97F4A7C15), 1 << 14
#: The rank of what never merges.
NEVER = np.iinfo(np.int32).max


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file, by its rule.

    Printable Latin-1 bytes stand for themselves, the others take the code points
    from 256 on in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary file of the tokenizers library, with its added tokens.

    Encoding: an Aho-Corasick automaton over the tokens gives the longest token at a
    position of a piece. The encoder takes it and goes on if the pair with the token
    before is compatible; else it tries the longest token that is a prefix of it, and
    steps back where none is left. A sequence whose neighbours are all compatible is
    the one the merges produce, and a position that failed once is never tried again,
    so the time is linear. The new pieces of many texts take these steps side by side,
    in arrays over their joined bytes, and find longest tokens by walking down the tree
    of tokens; long pieces and the last few take them alone.
    The pair table is filled as pairs are met.
    """

    def __init__(self, source: bytes | str):
        spec = json.loads(source)
        letters, ids = byte_letters(), spec["model"]["vocab"]
        size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])], default=-1) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, id in ids.items():
            self.tokens[id] = bytes(letters[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, id in self.added.items():
            self.tokens[id] = content.encode()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.halves = {ids[a + b]: (ids[a], ids[b]) for a, b in pairs}
        if len(self.halves) < len(self.rank):
            raise ValueError("two merges make the same token; the pair table needs one")
        self.automaton = ahocorasick.Automaton()
        text = {id: self.tokens[id].decode("latin-1") for id in ids.values()}
        for id, word in text.items():
            self.automaton.add_word(word, id)
        self.automaton.make_automaton()
        of_text = {word: id for id, word in text.items()}
        self.shorter = [-1] * (size + 1)
        for id, word in text.items():
            self.shorter[id] = next((of_text[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in of_text), -1)
        # Entry -1 of both: no token.
        self.prefix = np.array(self.shorter, dtype=np.int32)
        self.sizes = np.array([*map(len, self.tokens), 0], dtype=np.int32)
        steps: dict[int, int] = {}
        nodes = {0: -1}
        for id in ids.values():
            node = 0
            for byte in self.tokens[id]:
                node = steps.setdefault(node * LETTERS + byte, len(steps) + 1)
            nodes[node] = id
        down = sorted(steps.items())
        self.steps, self.below = (np.array([x[k] for x in down] + [last], dtype=np.int64) for k, last in ((0, np.iinfo(np.int64).max), (1, 0)))
        self.token_at = np.array([nodes.get(node, -1) for node in range(len(steps) + 1)], dtype=np.int32)
        self.packed = [id.to_bytes(4, "little") for id in range(size)]
        self.right, self.left = (lru_cache(maxsize=None)(lambda id, side=side: self._edge(id, side)) for side in (1, 0))
        self.memory, self.pieces = (_Generations(work, REMEMBERED_CHARS) for work in (self.run_ids, self.piece_ids))
        self.pairs = _Generations(lambda pair: self.compatible(*pair))
        merged = sorted((a * size + b, rank) for (a, b), rank in self.rank.items())
        self.merged, self.ranks = (np.array([x[k] for x in merged] + [last], dtype=np.int64) for k, last in ((0, np.iinfo(np.int64).max), (1, NEVER)))
        self.edges = [self._edges(side) for side in (1, 0)]
        self.table = np.full(1 << SLOTS, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes[:-1], dtype=np.int64)])
        self.blob = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.specials = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.runs, self.split, self.word = re.compile(RUNS), regex.compile(SPLIT), re.compile(WORD)
        self.seam = re.compile(rf"(?<=[^{WHITE}]) (?=[^{WHITE}])")

    def _edge(self, id: int, side: int) -> list[tuple[int, float]]:
        """The token and its parts along one side, each with the rank of the merge that uses it up."""
        parts, until = [(id, float("inf"))], None
        while id in self.halves:
            until = self.rank[self.halves[id]]
            id = self.halves[id][side]
            parts.append((id, until))
        return parts

    def _edges(self, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_edge`` of all tokens: the parts, their ranks, and where each token's parts begin."""
        all_parts = [self._edge(id, side) for id in range(len(self.tokens))]
        parts, until = (np.array([min(p[k], NEVER) for parts in all_parts for p in parts], dtype=np.int64) for k in (0, 1))
        return parts, until, np.concatenate([[0], np.cumsum([len(parts) for parts in all_parts], dtype=np.int64)])

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges keep the boundary between two tokens.

        They don't if a part at the end of the left one and a part at the start of the
        right one merge before either is used up. Merges of one rank go from the left:
        on a tie the left part has been used up, the right one has not.
        """
        for x, x_until in self.right(left):
            for y, y_until in self.left(right):
                rank = self.rank.get((x, y))
                if rank is not None and rank < x_until and rank <= y_until:
                    return False
        return True

    def all_compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` of many pairs: every part of one side with every part of the other."""
        (x, x_until, x_from), (y, y_until, y_from) = self.edges
        n_x, n_y = x_from[left + 1] - x_from[left], y_from[right + 1] - y_from[right]
        count = n_x * n_y
        first = np.cumsum(count) - count
        nth = np.arange(count.sum()) - np.repeat(first, count)
        n_y = np.repeat(n_y, count)
        i, j = np.repeat(x_from[left], count) + nth // n_y, np.repeat(y_from[right], count) + nth % n_y
        merge = x[i] * len(self.tokens) + y[j]
        place = np.searchsorted(self.merged, merge)
        rank = np.where(self.merged[place] == merge, self.ranks[place], NEVER)
        return ~np.logical_or.reduceat((rank < x_until[i]) & (rank <= y_until[j]), first)

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``all_compatible``, remembered in a table of fixed size where a new pair takes the slot of an older one."""
        size = np.uint64(len(self.tokens))
        slot = lambda pair: (pair * SPREAD) >> np.uint64(64 - SLOTS)
        pair = left.astype(np.uint64) * size + right.astype(np.uint64)
        held = self.table[slot(pair)]
        fit, unknown = (held & np.uint64(1)).astype(bool), held >> np.uint64(1) != pair
        if unknown.any():
            new, back = np.unique(pair[unknown], return_inverse=True)
            some = [new[k : k + PAIRS] for k in range(0, len(new), PAIRS)]
            found = np.concatenate([self.all_compatible((p // size).astype(np.int64), (p % size).astype(np.int64)) for p in some])
            fit[unknown] = found[back]
            self.table[slot(new)] = new * np.uint64(2) + found
        return fit

    def longest(self, letters: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The longest token at each place."""
        best = np.full(len(at), -1, dtype=np.int32)
        nth, node = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
        while len(nth):
            step = node * LETTERS + letters[at]
            place = np.searchsorted(self.steps, step)
            there = self.steps[place] == step
            nth, node, at = nth[there], self.below[place[there]], at[there] + 1
            id = self.token_at[node]
            best[nth[id >= 0]] = id[id >= 0]
        return best

    def sequences(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The packed tokens of many pieces, each followed by the byte of ``SEAM``, and how many there are up to each one's end.

        All pieces take a step of ``piece`` at once: a token is taken, made shorter or
        given back. ``ending`` holds for each place the token taken last that ends there.
        """
        sizes, prefix = self.sizes, self.prefix
        letters = np.frombuffer(text, dtype=np.uint8).astype(np.int64)
        stops = np.flatnonzero(letters == 0xFF)
        letters[stops] = SEAM_BYTE
        length = np.diff(stops, prepend=-1) - 1
        ending = np.full(len(text), -1, dtype=np.int32)
        failed, marked = (np.zeros(len(text), dtype=bool) for _ in range(2))
        nth = np.flatnonzero(length <= SIDE_BY_SIDE)
        at, stop = (stops - length)[nth], stops[nth]
        id = self.longest(letters, at)
        while len(nth) > FEW:
            last, reach = ending[at], at + sizes[id]
            none = id < 0
            free = ~(none | failed[reach])
            asked = np.flatnonzero(free & (last >= 0))
            free[asked] = self.fits(last[asked], id[asked])
            failed[at[none]] = True
            ending[reach[free]] = id[free]
            id = prefix[np.where(none, last, id)]
            at = np.where(free, reach, np.where(none, at - sizes[last], at))
            more = at < stop
            nth, at, stop, id, free = (x[more] for x in (nth, at, stop, id, free))
            id[free] = self.longest(letters, at[free])
        alone = np.zeros(len(stops), dtype=bool)
        alone[nth] = alone[length > SIDE_BY_SIDE] = True
        for k in np.flatnonzero(alone):
            start = stops[k] - length[k]
            taken = np.frombuffer(self.pieces[text[start : stops[k]].decode("latin-1")], dtype="<u4")
            places = start + np.cumsum(sizes[taken])
            ending[places], marked[places] = taken, True
        at, start = stops[~alone], (stops - length)[~alone]
        while len(at):
            marked[at] = True
            at = at - sizes[ending[at]]
            more = at > start
            at, start = at[more], start[more]
        return ending[marked].astype("<u4").tobytes(), np.cumsum(marked)[stops]

    def piece(self, word: str) -> list[int]:
        """The tokens of one piece, given as the Latin-1 letters of its bytes."""
        pairs, longest = self.pairs, self.automaton.iter_long
        taken = [id for _, id in longest(word)]
        for k in range(1, len(taken)):
            if not pairs[taken[k - 1], taken[k]]:
                break
        else:
            return taken
        # From the first pair that does not fit on, with shorter tokens and steps back.
        size = self.tokens
        at = sum(len(size[id]) for id in taken[:k])
        id, taken, failed = self.shorter[taken[k]], taken[:k], set()
        while True:
            while id >= 0 and (at + len(size[id]) in failed or (taken and not pairs[taken[-1], id])):
                id = self.shorter[id]
            if id < 0:
                failed.add(at)
                last = taken.pop()
                at -= len(size[last])
                id = self.shorter[last]
                continue
            taken.append(id)
            at += len(size[id])
            if at == len(word):
                return taken
            id = next(longest(word, at))[1]

    def run_ids(self, runs: list[str]) -> list[bytes]:
        """The packed tokens of each run."""
        word, split = self.word.fullmatch, self.split.findall
        cut = [[run] if word(run) else split(run) for run in runs]
        joined = "".join([SEAM.join(pieces) + SEAM for pieces in cut])
        packed, until = self.sequences(joined.encode("utf-8", "surrogateescape"))
        stops = (4 * until[np.cumsum([len(pieces) for pieces in cut]) - 1]).tolist()
        return [packed[start:stop] for start, stop in zip([0, *stops], stops)]

    def piece_ids(self, word: str) -> bytes:
        packed = self.packed
        return b"".join([packed[id] for id in self.piece(word)])

    def _stretches(self, text: str) -> Iterator[str]:
        """The text in parts that end where pieces end, so that a long text needs little memory."""
        start = 0
        while len(text) - start > STRETCH:
            seam = self.seam.search(text, start + STRETCH)
            if seam is None:
                break
            yield text[start : seam.start()]
            start = seam.start()
        yield text[start:]

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers. Added tokens are found in the text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` of each text. Stretches are worked out together until they hold ``STRETCH`` characters."""
        out: list[list] = [[] for _ in texts]
        waiting, chars = [], 0
        for parts, text in zip(out, texts):
            for part in self._parts(text):
                if isinstance(part, str):
                    waiting.append((parts, len(parts), part))
                    chars += len(part)
                parts.append(part)
                if chars >= STRETCH:
                    self._put(waiting)
                    waiting, chars = [], 0
        self._put(waiting)
        return [b"".join(parts) for parts in out]

    def _parts(self, text: str) -> Iterator[str | bytes]:
        """The text's added tokens, packed, and the stretches between them."""
        start = 0
        for mark in self.specials.finditer(text) if self.specials else ():
            yield from self._stretches(text[start : mark.start()])
            yield self.added[mark[0]].to_bytes(4, "little")
            start = mark.end()
        yield from self._stretches(text[start:])

    def _put(self, waiting: list[tuple[list, int, str]]) -> None:
        """The packed tokens of each stretch, in its place among the parts of its text."""
        runs = [self.runs.findall(part) for *_, part in waiting]
        known = self.memory.all(set().union(*runs))
        for (parts, k, _), of_part in zip(waiting, runs):
            parts[k] = b"".join(map(known.__getitem__, of_part))

    def forget(self) -> None:
        """Drop all that was remembered but the pair table, and give unused memory back."""
        for memory in (self.memory, self.pieces, self.pairs):
            memory.forget()
        pa.default_memory_pool().release_unused()

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids: slices of one table of all tokens, by its offsets."""
        parts = []
        for start in range(0, len(ids), STRETCH):
            some = ids[start : start + STRETCH]
            first, length = self.offsets[some], self.offsets[some + 1] - self.offsets[some]
            before = np.cumsum(length) - length
            parts.append(self.blob[np.repeat(first - before, length) + np.arange(length.sum())].tobytes())
        return b"".join(parts)


class _Generations(dict):
    """Worked-out values in two generations of bounded size.

    When the young one is full it becomes the old one. A value that is still asked for
    moves to the new young one, so frequent keys are never worked out again.
    """

    def __init__(self, work: Callable, longest: float = float("inf")):
        super().__init__()
        self.work, self.longest, self.old = work, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.work(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = value

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def all(self, keys: set) -> dict:
        """The values of all keys; ``work`` gets the list of the new ones."""
        found, new = {}, []
        for key in keys:
            value = self.get(key)
            if value is None:
                value = self.old.get(key)
                if value is None:
                    new.append(key)
                    continue
                self.keep(key, value)
            found[key] = value
        for key, value in zip(new, self.work(new) if new else ()):
            found[key] = value
            self.keep(key, value)
        return found


@lru_cache(maxsize=1)
def _loaded(source: bytes) -> Vocabulary:
    """One vocabulary per worker process; ``forget`` ends a task, so that idle workers hold little else."""
    return Vocabulary(source)


def encode_decode(
    docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", *, decoded: bool = True
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and, if ``decoded``, ``decoded`` of every row of ``docs``.

    ``vocabulary`` is the path of a byte-level BPE file of the tokenizers library;
    the driver reads it and broadcasts its bytes, a fixed size. ``ids`` are packed
    little-endian unsigned 32-bit numbers, the same as the library gives without
    added special tokens; an added token's string inside a text becomes that token.
    ``decoded`` is the text of the ids, special tokens included; bytes that are not
    UTF-8 become U+FFFD. A NULL text counts as empty: no ids, an empty text. Rows
    keep their id, also NULL or repeated; other columns are not read.
    """
    with open(vocabulary, "rb") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = "doc_id long, n_tokens long, ids binary" + ", decoded string" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for batch in batches:
            words = words or _loaded(source.value)
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = words.encode_all([t or "" for t in part["text"].to_pylist()])
                columns = [part["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                names = ["doc_id", "n_tokens", "ids"]
                if decoded:
                    texts = [words.decode(np.frombuffer(x, dtype="<u4")).decode("utf-8", "replace") for x in ids]
                    columns, names = [*columns, pa.array(texts, pa.string())], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)
        if words:
            words.forget()

    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, schema)
