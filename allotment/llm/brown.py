"""Language-model scores by class-based bigrams over Brown classes.

Classes are found in three steps, each over all training texts: the most frequent words by
exchange, one after another, over the matrix of their bigrams; the other frequent words
by exchange moves that all take place at once; all remaining words, down to those seen once,
by one such move each. So every training word has a class that its own neighbours
gave it, and what is gathered grows with the texts. Only the second step's words are broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Scratch

END = ""  # no word is empty, so this stands for the end token


@dataclass(frozen=True)
class Sizes:
    """Bounds of what lies on the driver or is broadcast; none bounds which words get a class.

    ``own``: words exchanged one after another. ``frequent``: words that are broadcast, with
    count and class (65,535 at most, as their places are kept in two bytes); all others are
    joined by word. ``classes`` (250 at most), ``rounds``: of the exchange. ``moves``: rounds
    of moves at once for the frequent words beyond ``own``. ``passes``: the same for all other
    words. ``inertia``: pseudo-count of the smoothed transitions. ``held``: entries that a task gathers before it passes them on.
    """

    own: int = 1024
    frequent: int = 65535
    classes: int = 64
    rounds: int = 8
    moves: int = 2
    passes: int = 3
    inertia: float = 2.0
    held: int = 400_000

    @property
    def end(self) -> int:
        """The class of the end token."""
        return self.classes

    @property
    def open(self) -> int:
        """Stands for the class of a word that has none yet."""
        return self.classes + 1

    @property
    def contexts(self) -> int:
        return self.classes + 2


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def is_held_out(id: Column) -> Column:
    return F.crc32(F.coalesce(id.cast("string"), F.lit(""))) % 7 == 2


def word_counts(texts: DataFrame, text: str = "text", held: int = Sizes.held) -> DataFrame:
    """``word`` and ``n`` over all rows, the end token included. Counted within a task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for value in batch["text"]:
                seen.update(words_of(value.as_py()))
                seen[END.encode()] += 1
                if len(seen) > held:
                    yield told()
                    seen.clear()
        yield told()

    counted = texts.select(F.col(text).cast("binary").alias("text")).mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _texts(frame: DataFrame, text: str, *more: Column) -> DataFrame:
    return frame.select(*more, F.col(text).cast("binary").alias("text"))


def coded(texts: DataFrame, frequent: list[bytes], text: str = "text") -> DataFrame:
    """``codes`` of each text: the places of its words among the frequent ones, two bytes each, others one past the last."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, other = {w: k for k, w in enumerate(shared.value)}.get, len(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                lines = [
                    np.array([place(w, other) for w in words_of(value.as_py())], dtype="<u2").tobytes()
                    for value in batch["text"].slice(start, 256)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["codes"])

    return _texts(texts, text).mapInArrow(run, "codes binary")


def _joined(values: pa.Array, symbols: Callable[[bytes], np.ndarray], end: int) -> np.ndarray:
    """The symbols of all texts of a batch in one line, with the end before, between and after them."""
    lines = values.to_pylist()
    line = symbols(b"".join(lines))
    per_byte = len(line) / max(sum(map(len, lines)), 1)
    stops = (np.cumsum([0, *map(len, lines)]) * per_byte).round().astype(np.int64)
    return np.insert(line, stops, end)


def _matrix(rows: DataFrame, column: str, symbols: Callable[[bytes], np.ndarray], size: int) -> np.ndarray:
    """How often one symbol follows another, as a matrix of fixed size; texts start and stop with the last symbol.

    Symbols beyond the last one break the chain: pairs with them are left out.
    """
    end = size - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                line = _joined(batch[column].slice(start, 1024), symbols, end)
                first, second = line[:-1], line[1:]
                both = (first <= end) & (second <= end)
                total += np.bincount(first[both] * size + second[both], minlength=size * size)
        pairs = np.flatnonzero(total)
        for start in range(0, len(pairs), 1 << 16):
            some = pairs[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    counted = rows.select(column).mapInArrow(count, "pair long, n long")
    found = counted.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # at most size ** 2 rows
    matrix = np.zeros(size * size, dtype=np.float64)
    matrix[found["pair"].to_numpy()] = found["n"].to_numpy()
    return matrix.reshape(size, size)


def symbol_bigrams(codes: DataFrame, sizes: Sizes, member: np.ndarray | None = None) -> np.ndarray:
    """Bigrams of the ``own`` most frequent words and the end.

    With ``member``, the classes of the frequent words, there is a symbol a class between them: its words beyond ``own``.
    """
    own, between = sizes.own, 0 if member is None else sizes.classes

    def symbols(value: bytes) -> np.ndarray:
        line = np.frombuffer(value, "<u2").astype(np.int64)
        if member is None:
            return np.where(line < own, line, own + 1)
        of = member[line].astype(np.int64)
        return np.where(line < own, line, own + of)

    return _matrix(codes, "codes", symbols, own + between + 1)


def class_bigrams(codes: DataFrame, member: np.ndarray, sizes: Sizes) -> np.ndarray:
    """Bigrams of classes, over neighbours that both have one. ``member`` ends with the entry of all other words."""

    def symbols(value: bytes) -> np.ndarray:
        return member[np.frombuffer(value, "<u2")].astype(np.int64)

    return _matrix(codes, "codes", symbols, sizes.classes + 1)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(bigrams: np.ndarray, classes: int, rounds: int, start: np.ndarray | None = None) -> np.ndarray:
    """Brown classes by exchange: each symbol in turn moves to the class that raises the likelihood most.

    The likelihood of class bigrams is, but for a constant, the sum of n log n over
    class pairs less that over the classes as first and as second. The last symbol is
    the end, a class of its own (number ``classes``). Starts from the frequency order, or from
    ``start``, the classes of the first symbols; the symbols between these and the end then are the
    classes' other members, taken together, and stay. Stops when a round moves nothing.
    Ties go to the lower class.
    """
    size = len(bigrams)
    order = np.argsort(-bigrams.sum(axis=0)[:-1], kind="stable")
    member = np.zeros(size, dtype=np.int64)
    member[order] = np.arange(size - 1) % classes
    member[-1] = classes
    if start is not None:
        order = order[order < len(start)]
        member[: len(start)], member[len(start) : -1] = start, np.arange(classes)
    joined = np.zeros((size, classes + 1))
    joined[np.arange(size), member] = 1
    after, before = bigrams @ joined, joined.T @ bigrams  # symbol then class, class then symbol
    pairs = joined.T @ after
    for _ in range(rounds):
        moved = 0
        for s in order:
            old, self_pairs = member[s], bigrams[s, s]
            after[:, old] -= bigrams[:, s]
            before[old] -= bigrams[s]
            out, into = after[s].copy(), before[:, s].copy()
            pairs[old] -= out
            pairs[:, old] -= into
            pairs[old, old] -= self_pairs
            if out.any() or into.any() or self_pairs:
                now = _xlogx(pairs)
                rows, columns = _xlogx(pairs + out) - now, _xlogx(pairs + into[:, None]) - now
                own = np.diag(pairs)
                gain = rows.sum(axis=1) - np.diag(rows) + columns.sum(axis=0) - np.diag(columns)
                gain += _xlogx(own + out + into + self_pairs) - np.diag(now)
                for totals, more in ((pairs.sum(axis=1), out.sum() + self_pairs), (pairs.sum(axis=0), into.sum() + self_pairs)):
                    gain -= _xlogx(totals + more) - _xlogx(totals)
                new = int(np.argmax(gain[:classes]))
                new = new if gain[new] > gain[old] + 1e-6 else int(old)
            else:
                new = int(old)
            moved += new != old
            member[s] = new
            after[:, new] += bigrams[:, s]
            before[new] += bigrams[s]
            pairs[new] += out
            pairs[:, new] += into
            pairs[new, new] += self_pairs
        if not moved:
            break
    return member


def smoothed(pairs: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of a class after a class, and of each class."""
    share = (pairs.sum(axis=0) + 1) / (pairs.sum() + len(pairs))
    return (pairs + sizes.inertia * share) / (pairs.sum(axis=1, keepdims=True) + sizes.inertia), share


def context_weights(pairs: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """What one neighbour says for each class: by the class before the word, and by the class after it.

    The log-likelihood of a word's tokens in a class is, but for what is the same in all
    classes, the sum of log p(class | before) / p(class) and log p(after | class) / p(after).
    Neighbours without a class say nothing.
    """
    p, share = smoothed(pairs, sizes)
    before, after = np.zeros((2, sizes.contexts, sizes.classes))
    before[: sizes.classes + 1] = np.log(p / share)[:, : sizes.classes]
    after[: sizes.classes + 1] = np.log(p / share).T[:, : sizes.classes]
    return before, after


def _gathered(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(keys), return_counts=True)


def code_contexts(codes: DataFrame, member: np.ndarray, sizes: Sizes) -> DataFrame:
    """``word`` (place), ``slot``, ``n``: the classes before (slots from 0) and after each frequent word beyond ``own``.

    Of the neighbours without a class only those before are listed; they weigh nothing.
    """
    own, size, words = sizes.own, sizes.contexts, len(member) - 1
    classes = np.r_[member.astype(np.int64), sizes.end]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held = [], 0

        def told() -> pa.RecordBatch:
            found, n = _gathered(keys)
            return pa.RecordBatch.from_arrays(
                [pa.array(found // (2 * size)), pa.array((found % (2 * size)).astype(np.int32)), pa.array(n.astype(np.int64))], ["word", "slot", "n"]
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                line = _joined(batch["codes"].slice(start, 1024), lambda value: np.frombuffer(value, "<u2").astype(np.int64), words + 1)
                of = classes[line]
                moving = (line[1:-1] >= own) & (line[1:-1] < words)
                for shift, near in ((0, of[:-2]), (size, of[2:])):
                    told_by = moving & ((near != sizes.open) | (shift == 0))  # every word has a row, so every word gets a class
                    keys.append(line[1:-1][told_by] * (2 * size) + shift + near[told_by])
                    held += len(keys[-1])
                if held > 10 * sizes.held:
                    yield told()
                    keys, held = [], 0
        if held:
            yield told()

    return codes.mapInArrow(run, "word long, slot int, n long")


def context_lists(contexts: DataFrame) -> DataFrame:
    """``word``, ``n`` (sum over its slots), ``slots`` and ``times``. A word has no more entries than there are slots."""
    summed = contexts.repartition("word").groupBy("word", "slot").agg(F.sum("n").alias("n"))
    lists = summed.groupBy("word").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("slot", "n"))).alias("near"))
    return lists.select("word", "n", F.col("near.slot").alias("slots"), F.col("near.n").alias("times"))


def _best(part: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each word of ``context_lists``, and all slots and times of the words, one after another."""
    slots, times = part["slots"].flatten().to_numpy(), part["times"].flatten().to_numpy()
    starts = np.r_[0, np.cumsum(part["slots"].value_lengths().to_numpy())[:-1]]  # no list is empty
    return np.add.reduceat(weights[slots] * times[:, None], starts, axis=0).argmax(axis=1), slots, times


def placed(lists: DataFrame, weights: np.ndarray) -> DataFrame:
    """``word``, ``n``, ``class``: the class for which the word's contexts say most.

    Ties go to the lower one, as do words whose neighbours have no class either.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                best = _best(part, weights)[0].astype(np.int32)
                yield pa.RecordBatch.from_arrays([part["word"], part["n"], pa.array(best)], ["word", "n", "class"])

    return lists.mapInArrow(run, f"word {dict(lists.dtypes)['word']}, n long, class int")


def pairs_when_placed(lists: DataFrame, pairs: np.ndarray, weights: np.ndarray, sizes: Sizes) -> np.ndarray:
    """``pairs`` with the bigrams that the words add in the classes they are placed in; slots are pairs of neighbours' classes."""
    size, slots_in_all = sizes.contexts, len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sizes.classes * slots_in_all, dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                best, slots, times = _best(part, weights)
                of = np.repeat(best, part["slots"].value_lengths().to_numpy())
                np.add.at(total, of * slots_in_all + slots, times)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["place", "n"])

    summed = lists.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    rows = summed.toArrow()  # at most classes times slots
    place, n = rows["place"].to_numpy(), rows["n"].to_numpy()
    of, before, after = place // slots_in_all, place % slots_in_all // size, place % size
    grown = np.zeros((size, size))
    grown[: len(pairs), : len(pairs)] = pairs
    np.add.at(grown, (before, of), n)
    np.add.at(grown, (of, after), n)
    return grown[: len(pairs), : len(pairs)]


@dataclass
class Classes:
    """The frequent words with their counts and classes, and the table of all counts."""

    sizes: Sizes
    frequent: list[bytes]
    frequent_counts: np.ndarray
    member: np.ndarray  # class of each frequent word, then ``open`` for all others
    pairs: np.ndarray  # class bigrams of the frequent words and the end
    tokens: int
    types: int
    documents: int
    counts: DataFrame = field(repr=False)


def cluster(texts: DataFrame, text: str = "text", sizes: Sizes = Sizes()) -> Classes:
    """Count all words; find the classes of the frequent ones."""
    scratch = Scratch(texts.sparkSession)
    counts = scratch.write(word_counts(texts, text, sizes.held), "counts")
    tokens, types, documents = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.length("word") == 0, F.col("n"))), F.lit(0))
    ).first()
    top = counts.where(F.length("word") > 0).orderBy(F.desc("n"), "word").limit(sizes.frequent).toArrow()
    frequent = top["word"].to_pylist()
    codes = scratch.write(coded(texts, frequent, text), "codes")
    member = np.full(len(frequent) + 1, sizes.open, dtype=np.uint8)
    first = min(sizes.own, len(frequent))
    member[:first] = exchange(symbol_bigrams(codes, sizes), sizes.classes, sizes.rounds)[:first]
    pairs = class_bigrams(codes, member, sizes)
    for _ in range(sizes.moves if len(frequent) > first else 0):
        moved = placed(context_lists(code_contexts(codes, member, sizes)), np.concatenate(context_weights(pairs, sizes)))
        moved = moved.select("word", "class").toArrow()  # one row a frequent word
        member = member.copy()
        member[moved["word"].to_numpy()] = moved["class"].to_numpy()
        member[:first] = exchange(symbol_bigrams(codes, sizes, member), sizes.classes, sizes.rounds, member[:first])[:first]
        pairs = class_bigrams(codes, member, sizes)
    scratch.drop("codes")
    return Classes(sizes, frequent, top["n"].to_numpy(), member, pairs, tokens, types, documents, counts)


def marked(docs: DataFrame, known: Classes, *more: Column, text: str = "text") -> DataFrame:
    """Per row, after ``more`` columns: what the frequent words say, and the other words by name.

    ``classes``: a byte a word, ``open`` for other words; ``other``: which of ``names`` each of those
    is, four bytes each; ``known`` and ``logs``: number of frequent words and sum of the log10 of
    their counts plus one.
    """
    shared = docs.sparkSession.sparkContext.broadcast((known.frequent, np.log10(np.r_[known.frequent_counts, 0] + 1.0), known.member))
    kept = _texts(docs, text, *more)
    names = [c for c in kept.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, logs, member = shared.value
        place = {w: k for k, w in enumerate(frequent)}.get
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lines = []
                for value in part["text"]:
                    words = words_of(value.as_py())
                    codes = np.array([place(w, -1) for w in words], dtype=np.int64)
                    seen: dict[bytes, int] = {}
                    other = np.array([seen.setdefault(words[k], len(seen)) for k in np.flatnonzero(codes < 0)], dtype="<i4")
                    lines.append((member[codes].tobytes(), other.tobytes(), list(seen), int((codes >= 0).sum()), float(logs[codes].sum())))
                kinds = (pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.int64(), pa.float64())
                columns = [pa.array(c, t) for c, t in zip(zip(*lines), kinds)]
                yield pa.RecordBatch.from_arrays([*(part[n] for n in names), *columns], [*names, "classes", "other", "names", "known", "logs"])

    schema = ", ".join([f"`{n}` {t}" for n, t in kept.dtypes if n != "text"])
    return kept.mapInArrow(run, f"{schema}, classes binary, other binary, names array<binary>, known long, logs double")


def name_contexts(rows: DataFrame, sizes: Sizes) -> DataFrame:
    """``word``, ``slot`` (class before times ``contexts`` plus class after), ``n`` of all words that are not frequent."""
    size = sizes.contexts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, classes, other in zip(batch["names"], batch["classes"], batch["other"]):
                if not len(names):
                    continue
                of = np.r_[sizes.end, np.frombuffer(classes.as_py(), np.uint8), sizes.end].astype(np.int64)
                at = np.flatnonzero(of[1:-1] == sizes.open)
                which = np.frombuffer(other.as_py(), "<i4").astype(np.int64)
                found, n = _gathered([which * size * size + of[at] * size + of[at + 2]])
                words = names.values.take(pa.array(found // (size * size)))
                yield pa.RecordBatch.from_arrays([words, pa.array((found % (size * size)).astype(np.int32)), pa.array(n)], ["word", "slot", "n"])

    return rows.select("names", "classes", "other").mapInArrow(run, "word binary, slot int, n long")


def other_words(rows: DataFrame, known: Classes, scratch: Scratch) -> DataFrame:
    """``word``, ``n``, ``class`` of all training words that are not frequent, from ``marked`` training rows.

    The words are placed ``passes`` times; what they add to the bigrams when they are placed counts in the next pass.
    """
    sizes, pairs = known.sizes, known.pairs
    lists = scratch.write(context_lists(name_contexts(rows, sizes)), "lists")

    def weights(pairs: np.ndarray) -> np.ndarray:
        before, after = context_weights(pairs, sizes)
        return (before[:, None] + after[None]).reshape(-1, sizes.classes)

    for _ in range(sizes.passes - 1):
        pairs = pairs_when_placed(lists, known.pairs, weights(pairs), sizes)
    others = scratch.write(placed(lists, weights(pairs)), "others")
    scratch.drop("lists")
    return others


def class_mass(known: Classes, others: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens plus words of each class, and its words seen once."""
    mass, once = np.zeros((2, known.sizes.classes))
    of = known.member[:-1].astype(np.int64)
    np.add.at(mass, of, known.frequent_counts + 1)
    np.add.at(once, of, known.frequent_counts == 1)
    for row in others.groupBy("class").agg(F.sum(F.col("n") + 1).alias("n"), F.count_if(F.col("n") == 1).alias("once")).collect():  # one row a class
        mass[row["class"]] += row["n"]
        once[row["class"]] += row["once"]
    return mass, once


def resolved(rows: DataFrame, others: DataFrame, sizes: Sizes, more: list[str]) -> DataFrame:
    """``marked`` rows with the classes of all words: ``more`` columns, ``classes``, ``known``, ``logs``.

    Words that no training text has stay ``open``. ``rows`` has a column ``key``, one value a row.
    """
    found = rows.select("key", F.posexplode("names").alias("at", "word")).join(others, "word")
    found = found.groupBy("key").agg(F.collect_list(F.struct("at", "n", "class")).alias("found"))
    slim = rows.withColumn("kinds", F.size("names")).drop("names").join(found, "key", "left")
    slim = slim.select(*more, "classes", "other", "kinds", "known", "logs", F.col("found.at").alias("at"), F.col("found.n").alias("n"), F.col("found.class").alias("of"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lines = []
                for classes, other, kinds, count, logs, at, n, of in zip(*(part[c] for c in ("classes", "other", "kinds", "known", "logs", "at", "n", "of"))):
                    line = np.frombuffer(classes.as_py(), np.uint8).copy()
                    which = np.frombuffer(other.as_py(), "<i4")
                    member, times = np.full(kinds.as_py(), sizes.open, dtype=np.uint8), np.zeros(kinds.as_py())
                    if at.is_valid:
                        place = at.values.to_numpy()
                        member[place], times[place] = of.values.to_numpy(), n.values.to_numpy()
                    line[line == sizes.open] = member[which]
                    lines.append((line.tobytes(), count.as_py() + int((times[which] > 0).sum()), logs.as_py() + float(np.log10(times[which] + 1).sum())))
                columns = [pa.array(c, t) for c, t in zip(zip(*lines), (pa.binary(), pa.int64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in more), *columns], [*more, "classes", "known", "logs"])

    schema = ", ".join(f"`{n}` {t}" for n, t in slim.select(*more).dtypes)
    return slim.mapInArrow(run, f"{schema}, classes binary, known long, logs double")


@dataclass
class Model:
    """The words and their classes, and the smoothed probabilities over classes."""

    known: Classes
    others: DataFrame = field(repr=False)  # word, n, class of the words that are not frequent
    unseen: np.ndarray  # class of an unseen word, by the class before it
    transitions: np.ndarray  # log10 p(class | class before)
    emission_base: np.ndarray  # log10 of what a class's counts are divided by
    unseen_logs: np.ndarray  # log10 of what the unseen words of a class count


def _model(known: Classes, others: DataFrame, train_rows: DataFrame) -> Model:
    sizes, (mass, once) = known.sizes, class_mass(known, others)
    pairs = _matrix(train_rows, "classes", lambda value: np.frombuffer(value, np.uint8).astype(np.int64), sizes.classes + 1)
    transitions, emission_base = np.log10(smoothed(pairs, sizes)[0]), np.log10(mass + once + 1)
    unseen_logs = np.log10(once + 1)
    unseen = (transitions[:, : sizes.classes] + unseen_logs - emission_base).argmax(axis=1).astype(np.uint8)
    return Model(known, others, unseen, transitions, emission_base, unseen_logs)


def _learn(rows: DataFrame, train_rows: DataFrame, known: Classes, scratch: Scratch, more: list[str]) -> tuple[DataFrame, DataFrame]:
    """Classes of the other words from ``train_rows``, and all ``rows`` resolved."""
    others = other_words(train_rows, known, scratch)
    return others, scratch.write(resolved(rows, others, known.sizes, more), "resolved")


def train(texts: DataFrame, text: str = "text", sizes: Sizes = Sizes()) -> Model:
    """Count all words, find all classes, and estimate the class bigrams."""
    scratch = Scratch(texts.sparkSession)
    known = cluster(texts, text, sizes)
    rows = scratch.write(marked(texts, known, F.monotonically_increasing_id().alias("key"), text=text), "marked")
    others, lines = _learn(rows, rows, known, scratch, ["key"])
    model = _model(known, others, lines)
    scratch.drop("marked", "resolved")
    return model


def _scored(rows: DataFrame, model: Model, more: list[str]) -> DataFrame:
    """Scores of resolved rows."""
    known, sizes = model.known, model.known.sizes
    transitions, emission_base, unseen, unseen_logs = model.transitions, model.emission_base, model.unseen, model.unseen_logs
    end_log, end_known = float(np.log10(known.documents + 1)), int(known.documents > 0)
    floor = float(np.log10(known.tokens + known.types + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for classes, count, logs in zip(batch["classes"], batch["known"], batch["logs"]):
                of = np.frombuffer(classes.as_py(), np.uint8).copy()
                new = np.flatnonzero(of == sizes.open)
                for k in new:
                    of[k] = unseen[of[k - 1] if k else sizes.end]
                base = logs.as_py() + end_log - (len(of) + 1) * floor
                moves = transitions[np.r_[sizes.end, of], np.r_[of, sizes.end]].sum()
                lines.append((len(of) + 1, count.as_py() + end_known, base, logs.as_py() + moves - emission_base[of].sum() + unseen_logs[of[new]].sum()))
            columns = [pa.array(c, t) for c, t in zip(zip(*lines), (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
            if lines:
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in more), *columns], [*more, "n_tokens", "n_known", "base_score", "score"])

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.select(*more).dtypes)
    return rows.select(*more, "classes", "known", "logs").mapInArrow(run, f"{schema}, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``n_known``, ``base_score``, ``score``.

    ``base_score`` is the add-one unigram log10 probability, ``score`` that of the class
    bigrams: transitions of classes times the word's share of its class, add-one. Unseen words
    together count as many tokens in a class as it has words seen once, and one more. After a given
    class an unseen word is put in the class where it is likeliest, and in no other, so the
    probabilities of what may follow add up to one at most. Counts and classes of frequent words are at hand in the tasks; all other
    words are few of a kind, and are joined by word.
    """
    scratch = Scratch(docs.sparkSession)
    key = F.monotonically_increasing_id().alias("key")
    rows = scratch.write(marked(docs, model.known, F.col(id).cast("long").alias("doc_id"), key, text=text), "marked")
    lines = resolved(rows, model.others, model.known.sizes, ["doc_id"])
    return _scored(lines, model, ["doc_id"])


def score_held_out(docs: DataFrame, id: str = "doc_id", text: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """Train on the rows whose id is not held out (``is_held_out``) and score all rows.

    Adds ``held_out`` and ``train_tokens`` to the columns of ``score``. A NULL text counts
    as empty: one end token. A NULL id counts as the empty string. Without training
    rows every word is unknown. Repeated rows are scored each and trained on each. Training
    rows and others are marked and resolved together, so each text is joined with the words once.
    """
    scratch = Scratch(docs.sparkSession)
    known = cluster(docs.where(~is_held_out(F.col(id))), text, sizes)
    more = ["doc_id", "held_out"]
    rows = scratch.write(marked(
        docs, known, F.col(id).cast("long").alias("doc_id"), is_held_out(F.col(id)).alias("held_out"),
        F.monotonically_increasing_id().alias("key"), text=text,
    ), "marked")
    others, lines = _learn(rows, rows.where("NOT held_out"), known, scratch, more)
    scratch.drop("marked")
    model = _model(known, others, lines.where("NOT held_out"))
    return _scored(lines, model, more).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(known.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
