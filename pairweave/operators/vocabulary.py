"""Word counts, vocabularies and subword training on distinct words."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairweave.functions.arrays import SPECIAL_TOKENS, UNK
from pairweave.functions.text import byte_level_lines, normalize_text
from pairweave.session import remove, rewrite

VOCAB_SCHEMA = "token string, id int"
MERGE_SCHEMA = "rank int, left string, right string"


class Bpe(NamedTuple):
    """A trained subword model: ``vocab(token, id)`` and ``merges(rank, left, right)``."""

    vocab: DataFrame
    merges: DataFrame


def word_counts(df: DataFrame, words: Column) -> DataFrame:
    """Occurrences per word of an array column. Counts are combined before the shuffle, so frequent words are cheap."""
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def unit_counts(df: DataFrame, text: str) -> DataFrame:
    """Occurrences per byte-level unit of normalised text, the input of subword training."""
    lines = df.select(byte_level_lines(normalize_text(F.col(text))).alias("lines"))
    # An empty text has one empty line. Filtering the texts instead would spell each of them twice.
    return word_counts(lines, F.split("lines", "\n")).filter(F.col("word") != "")


def _pairs_in(word: Column) -> Column:
    """Adjacent two-character strings of a word."""
    starts = F.when(F.char_length(word) > 1, F.sequence(F.lit(1), F.char_length(word) - 1))
    pairs = F.transform(starts, lambda i: F.substring(word, i, F.lit(2)))
    return F.coalesce(pairs, F.array().cast("array<string>"))


def pair_counts(words: DataFrame, word: str = "word", weight: str = "cnt") -> DataFrame:
    """Adjacent character pairs over distinct words, weighted by how often each word occurs."""
    exploded = words.select(F.explode(_pairs_in(F.col(word))).alias("pair"), weight)
    return exploded.groupBy("pair").agg(F.sum(weight).cast("bigint").alias("cnt"))


def word_vocabulary(counts: DataFrame, vocab_size: int) -> DataFrame:
    """Special tokens, then the most frequent words, ties in word order. ``vocab_size`` bounds the ranked rows."""
    top = counts.orderBy(F.desc("cnt"), "word").limit(vocab_size - len(SPECIAL_TOKENS))
    # Sorted by (count desc, word): at most vocab_size entries in one array.
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("cnt")).alias("c"), "word")))
    tokens = F.concat(F.array(*map(F.lit, SPECIAL_TOKENS)), ordered["word"])
    return top.agg(tokens.alias("t")).select(F.posexplode("t").alias("id", "token")).select("token", "id")


def train_bpe(
    words: DataFrame,
    vocab_size: int = 16_384,
    min_frequency: int = 4,
    num_merges: int | None = None,
    tracked_pairs: int = 50_000,
    most_steps: int = 1024,
    foreseen_words: int = 50_000,
) -> Bpe:
    """Learn merges over distinct byte-level words ``(word, cnt)``.

    The words stay distributed (``SpelledWords``). The driver holds the counts of the most frequent
    pairs, four times ``tracked_pairs`` at most. A round takes the pairs that are next, and one job cuts all words down to the stretches that
    these pairs link, equal ones counted together, ``foreseen_words`` at most: what is merged before any other pair is next is merged inside
    them, so trying it there gives the next merges, also of symbols that the round makes itself (``Foresight``). A second job applies
    them to all words; it returns, merge by merge, how pair counts change. The driver then takes merges
    as counting anew after each would choose them, for as long as the choice is among the predicted ones and what the job
    says of it holds: predicted merges that meet in no word may change places, others may not (``_dependencies``).
    Where the pairs link more stretches than that, fewer pairs are taken; if it is a single pair, the most frequent stretches
    are a guess. A wrong prediction costs a round, never a result.

    A pair outside the table can only become rarer, so the table stays exact until it is used up and counted anew; a merge
    that spells a token already there is the exception, and is followed by a new count.
    Training ends at ``vocab_size`` tokens, after ``num_merges`` merges if given, or when no pair occurs
    ``min_frequency`` times.
    """
    spark = words.sparkSession
    words, table = rewrite(words, "words")
    letters = words.select(F.explode(F.split("word", "")).alias("c")).filter(F.col("c") != "").distinct()
    alphabet = sorted(r.c for r in letters.collect())  # byte-level spelling: at most 256 characters
    tokens = [*SPECIAL_TOKENS, *alphabet]
    ids = {token: i for i, token in enumerate(tokens)}
    merges: list[tuple[int, str, str]] = []
    most = float("inf") if num_merges is None else num_merges

    spelled = SpelledWords.of_words(words, alphabet, len(SPECIAL_TOKENS))
    remove(spark, table)
    known = PairCounts(*spelled.frequent_pairs(min_frequency, tracked_pairs))
    width = 64
    while (room := int(min(vocab_size - len(tokens), most - len(merges), most_steps))) > 0:
        if not known:
            if known.floor < min_frequency:
                break
            spelled = spelled.rewritten()
            known = PairCounts(*spelled.frequent_pairs(min_frequency, tracked_pairs))
            continue
        while True:
            pairs = known.next(min(width, 2 * room))
            stretches = spelled.stretches(pairs, foreseen_words + 1)
            if len(stretches) <= foreseen_words or len(pairs) == 1:
                break
            width = len(pairs) // 2
        if len(stretches) <= foreseen_words // 2:
            width = max(width, 2 * len(pairs))
        steps = Foresight(stretches[:foreseen_words]).predicted(pairs, known, tokens, ids, room)
        changes = spelled.count_changes(steps, known.floor)
        needs, place = _dependencies(steps, changes), {pair: i for i, (pair, _) in enumerate(steps)}
        symbols: dict[int, int] = {}  # predicted ones as they are numbered now
        foreseen: dict[int, int] = {}  # and the other way round
        taken: dict[int, tuple[int, int]] = {}
        repeats = False
        while known and not repeats:
            pair = known.first()
            step = place.get(_renumbered(pair, foreseen))
            if step is None or not needs[step] <= taken.keys():
                break
            predicted = steps[step][1]
            left, right = tokens[pair >> 32], tokens[pair & _LOW]
            merges.append((len(merges), left, right))
            repeats = left + right in ids
            symbol = symbols[predicted] = ids.setdefault(left + right, len(tokens))
            foreseen[symbol] = predicted
            if not repeats:
                tokens.append(left + right)
            taken[step] = (pair, symbol)
            known.update([(_renumbered(p, symbols), n) for p, n in changes.get(step, ())], symbol)
        spelled.accept(list(taken.values()))
        if repeats:
            known = PairCounts({}, max(min_frequency, known.floor))  # a known token became more frequent: count anew
        known.trim(tracked_pairs)
        if spelled.replayed > spelled.rows:
            spelled = spelled.rewritten()
    spelled.drop()
    vocab = spark.createDataFrame(list(zip(tokens, range(len(tokens)))), VOCAB_SCHEMA)
    return Bpe(vocab, spark.createDataFrame(merges, MERGE_SCHEMA))


_LOW = 0xFFFFFFFF


def _renumbered(pair: int, symbols: dict[int, int]) -> int:
    """A pair with other numbers for some symbols."""
    left, right = pair >> 32, pair & _LOW
    return symbols.get(left, left) << 32 | symbols.get(right, right)


def _merged(word: list[int], pair: int, symbol: int) -> list[int]:
    """A word after one merge, from left to right."""
    left, right, out, i = pair >> 32, pair & _LOW, [], 0
    while i < len(word):
        if word[i] == left and i + 1 < len(word) and word[i + 1] == right:
            out.append(symbol)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return out


class Foresight:
    """Stretches of words, a bounded number of them, on which the driver tries which merges come next.

    What it says is only a guess at which merges a job should apply to all words: counts, choices and results come from there.
    """

    def __init__(self, words: list[tuple[list[int], int]]):
        self.words, self.counts = [w for w, _ in words], [n for _, n in words]
        self.held: dict[int, set[int]] = {}  # words that hold a pair, or held it once
        for i, word in enumerate(self.words):
            for a, b in zip(word, word[1:]):
                self.held.setdefault(a << 32 | b, set()).add(i)

    def _merge(self, pair: int, symbol: int) -> dict[int, int]:
        """Merge a pair in all words; returns how counts change."""
        changes: dict[int, int] = {}
        for i in self.held.get(pair, ()):
            word, cnt = self.words[i], self.counts[i]
            out = _merged(word, pair, symbol)
            if len(out) == len(word):
                continue
            for a, b in zip(word, word[1:]):
                changes[a << 32 | b] = changes.get(a << 32 | b, 0) - cnt
            for a, b in zip(out, out[1:]):
                p = a << 32 | b
                changes[p] = changes.get(p, 0) + cnt
                if p != pair and symbol in (a, b):
                    self.held.setdefault(p, set()).add(i)
            self.words[i] = out
        return changes

    def predicted(self, pairs: list[int], known: PairCounts, tokens: list[str], ids: dict[str, int], room: int) -> list[tuple[int, int]]:
        """At most ``room`` of ``(pair, symbol it becomes)`` in turn, up to and with the first that spells a known token.

        ``pairs`` are those that are next, in turn. A pair that a merge makes has its places where one of the pairs before was, so it
        is no more frequent than that one: as long as it comes before the last of ``pairs``, all its places are in the stretches of ``pairs``.
        If they are all pairs above the floor, that holds down to the floor.
        Where stretches were left out, changes seen in the others are scaled up by the share that they hold of the merged pair.
        """
        made: dict[str, int] = {}
        spelling: dict[int, str] = {}
        steps: list[tuple[int, int]] = []
        guessed = {pair: known.counts[pair] for pair in pairs}
        first, all_known = set(pairs), len(pairs) == len(known.counts)
        least = known.floor + 1 if all_known else guessed[pairs[-1]]
        order = [(-guessed[pair], pair) for pair in pairs]
        while order and len(steps) < room:
            count, pair = heapq.heappop(order)
            if guessed[pair] != -count:
                continue
            if -count == least and pair not in first and not all_known:
                break
            left, right = pair >> 32, pair & _LOW
            merged = (spelling.get(left) or tokens[left]) + (spelling.get(right) or tokens[right])
            if merged in made:
                break
            if merged in ids:
                steps.append((pair, ids[merged]))
                break
            symbol = made[merged] = len(tokens) + len(steps)
            spelling[symbol] = merged
            steps.append((pair, symbol))
            changes = self._merge(pair, symbol)
            share = -count / max(1, -changes.pop(pair, 0))
            guessed[pair] = 0
            for p, n in changes.items():
                if n:
                    guess = guessed[p] = guessed.get(p, known.counts.get(p, 0)) + round(n * share)
                    if guess >= least:
                        heapq.heappush(order, (-guess, p))
        return steps


def _dependencies(steps: list[tuple[int, int]], changes: dict[int, list[tuple[int, int]]]) -> list[set[int]]:
    """For each step the earlier ones without which its changes would be others.

    A pair becomes more frequent only by the step that makes the later of its symbols. So an earlier step matters to a later one only where
    it takes away or makes an occurrence of the later one's pair, which is among the earlier one's changes, or where it makes the symbol next
    to such an occurrence, which then is in a pair among the later one's changes. (Steps whose pair is made no more often than the floor are
    never taken.)
    """
    place = {pair: i for i, (pair, _) in enumerate(steps)}
    made = {symbol: i for i, (_, symbol) in enumerate(steps)}
    needs: list[set[int]] = [set() for _ in steps]
    for step, rows in changes.items():
        for pair, _ in rows:
            if place.get(pair, -1) > step:
                needs[place[pair]].add(step)
            for symbol in (pair >> 32, pair & _LOW):
                if made.get(symbol, step) < step:
                    needs[step].add(made[symbol])
    return needs


class PairCounts:
    """Counts of the pairs that occur more often than ``floor``, in the order training takes them: by count, then by symbols."""

    def __init__(self, counts: dict[int, int], floor: int):
        self.counts, self.floor = counts, floor
        self.order = [(-n, pair) for pair, n in counts.items()]
        heapq.heapify(self.order)

    def __bool__(self) -> bool:
        return bool(self.counts)

    def first(self) -> int | None:
        """The pair that is next."""
        while self.order and self.counts.get(self.order[0][1]) != -self.order[0][0]:
            heapq.heappop(self.order)
        return self.order[0][1] if self.order else None

    def next(self, n: int) -> list[int]:
        """The ``n`` pairs that are next, by the counts of now."""
        return [pair for _, pair in heapq.nsmallest(n, ((-n, pair) for pair, n in self.counts.items()))]

    def update(self, changes: list[tuple[int, int]], made: int) -> None:
        """Counts after a merge. Only pairs with the symbol it made may join; those at or below the floor leave."""
        for pair, change in changes:
            if pair in self.counts or made in (pair >> 32, pair & _LOW):
                count = self.counts.get(pair, 0) + change
                if count > self.floor:
                    self.counts[pair] = count
                    heapq.heappush(self.order, (-count, pair))
                else:
                    self.counts.pop(pair, None)

    def trim(self, tracked: int) -> None:
        """Raise the floor once the table has grown to four times the tracked pairs."""
        if len(self.counts) > 4 * tracked:
            self.floor = heapq.nlargest(tracked + 1, self.counts.values())[-1]
            self.__init__({p: n for p, n in self.counts.items() if n > self.floor}, self.floor)


class Replay:
    """Merges in turn, applied to many words by the same array steps.

    Each merge goes over a word once, so a pair that a later merge brings about again is left alone, as in training.
    """

    def __init__(self, merges: list[tuple[int, int]]):
        pairs = np.array([pair for pair, _ in merges], np.int64)
        self.symbols = np.array([symbol for _, symbol in merges], np.int64)
        self.ranks = np.argsort(pairs)
        self.pairs, self.none = pairs[self.ranks], len(merges)

    def _ranks(self, pairs: np.ndarray) -> np.ndarray:
        """Which merge takes each pair? ``none`` if no one does."""
        if not self.none:
            return np.zeros(len(pairs), np.int64)
        at = np.minimum(np.searchsorted(self.pairs, pairs), self.none - 1)
        return np.where(self.pairs[at] == pairs, self.ranks[at], self.none)

    def run(self, words: Words, counted_from: int | None = None) -> tuple[Words, int, list[tuple[np.ndarray, ...]]]:
        """The words after all merges, in another order; how many were merged at all; and what merges from ``counted_from`` on
        change, as arrays of merge, pair and change."""
        counted_from = self.none if counted_from is None else counted_from
        changes, done, replayed = [], [], None
        last = np.full(len(words.sizes), -1)
        while len(words.sizes):
            pairs, starts = words.pairs()
            owner = np.repeat(np.arange(len(words.sizes)), words.sizes)
            ranks = self._ranks(pairs)
            ranks[ranks <= last[owner]] = self.none
            least = np.minimum.reduceat(ranks, starts)
            active = least < self.none
            done.append(words.filter(~active))
            replayed = int(active.sum()) if replayed is None else replayed
            own = active[owner]
            words, last, pairs, ranks, merge = words.filter(active), least[active], pairs[own], ranks[own], least[owner][own]
            # Of places side by side, as in a run of one symbol, every other is merged, from the left.
            places = np.flatnonzero(ranks == merge)
            opens = np.diff(places, prepend=-2) != 1
            run_start = np.maximum.accumulate(np.where(opens, places, 0))
            places = places[(places - run_start) % 2 == 0]
            counts = np.repeat(words.counts, words.sizes)
            before = self._touched(places, len(pairs), (-1, 0, 1), pairs)
            counted = before[merge[before] >= counted_from]
            changes.append((merge[counted], pairs[counted], -counts[counted]))
            kept = np.ones(len(pairs), bool)
            kept[places + 1] = False
            symbols = words.symbols.copy()
            symbols[places] = self.symbols[merge[places]]
            owner = np.repeat(np.arange(len(words.sizes)), words.sizes)
            words = Words(symbols[kept], np.bincount(owner[kept], minlength=len(words.sizes)), words.counts)
            merge, counts, places = merge[kept], counts[kept], places - np.arange(len(places))
            pairs, _ = words.pairs()
            after = self._touched(places, len(pairs), (-1, 0), pairs)
            counted = after[merge[after] >= counted_from]
            changes.append((merge[counted], pairs[counted], counts[counted]))
        return Words.all_of(done), replayed or 0, changes

    @staticmethod
    def _touched(places: np.ndarray, size: int, beside: tuple[int, ...], pairs: np.ndarray) -> np.ndarray:
        """Places at or beside the given ones where a pair is."""
        near = np.zeros(size, bool)
        for by in beside:
            at = places + by
            near[at[(at >= 0) & (at < size)]] = True
        return np.flatnonzero(near & (pairs >= 0))


class Words(NamedTuple):
    """Words as one array of symbols, with the size and the count of each; none is empty."""

    symbols: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray

    @classmethod
    def of_batch(cls, batch: pa.RecordBatch) -> Words:
        """Stored words."""
        words = batch.column(0)
        starts = words.offsets.to_numpy()
        symbols = words.values.to_numpy()[starts[0] : starts[-1]].astype(np.int64)
        return cls(symbols, np.diff(starts).astype(np.int64), batch.column(1).to_numpy())

    @classmethod
    def all_of(cls, parts: list[Words]) -> Words:
        """Several after one another."""
        return cls(*map(np.concatenate, zip(*parts))) if parts else cls(*(np.zeros(0, np.int64) for _ in range(3)))

    def filter(self, chosen: np.ndarray) -> Words:
        """Some of the words."""
        return Words(self.symbols[np.repeat(chosen, self.sizes)], self.sizes[chosen], self.counts[chosen])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All adjacent symbols, the place after a word's last as -1; and where each word starts."""
        ends = np.cumsum(self.sizes)
        pairs = self.symbols << 32 | np.append(self.symbols[1:], 0)[: len(self.symbols)]
        pairs[ends - 1] = -1
        return pairs, ends - self.sizes

    def to_batch(self) -> pa.RecordBatch:
        """Words as they are stored."""
        offsets = np.append(0, np.cumsum(self.sizes)).astype(np.int32)
        words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.symbols.astype(np.int32)))
        return pa.RecordBatch.from_pydict({"word": words, "cnt": pa.array(self.counts)})

    def linked_by(self, wanted: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The longest stretches in which every two neighbours are one of the sorted pairs, as bytes, and the count of each one's word."""
        pairs, _ = self.pairs()
        links = wanted[np.minimum(np.searchsorted(wanted, pairs), len(wanted) - 1)] == pairs
        follows = np.append(False, links)[: len(links)]
        inside = links | follows
        starts = np.append(np.flatnonzero((links & ~follows)[inside]), inside.sum())
        data = pa.py_buffer(self.symbols[inside].astype("<i4"))
        found = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((starts * 4).astype(np.int32)), data])
        return found, np.repeat(self.counts, self.sizes)[links & ~follows]


class SpelledWords:
    """Distinct words as symbol ids, spread over the cores.

    Words are stored as they were when they were last written. Merges accepted since then are pending, and every job applies them
    first. Once jobs have merged as many words as there are, all words are written anew.
    """

    SCHEMA = "word array<int>, cnt bigint"

    def __init__(self, spark: SparkSession, words: DataFrame, path: str):
        self.spark, self.words, self.path = spark, words, path
        self.pending: list[tuple[int, int]] = []
        self.replayed = 0
        self.rows = words.count()

    @classmethod
    def of_words(cls, words: DataFrame, alphabet: list[str], first: int) -> SpelledWords:
        """Spelled words ``(word, cnt)``; letter ``i`` of the alphabet is symbol ``first + i``."""
        of = {c: first + i for i, c in enumerate(alphabet)}

        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                spelled = [[of[c] for c in w] for w in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_pydict({"word": pa.array(spelled, pa.list_(pa.int32())), "cnt": batch.column(1)})

        spark = words.sparkSession
        # Merging costs far more per byte than reading: one share per core, however small the table.
        longer = words.filter(F.char_length("word") > 1).select("word", F.col("cnt").cast("bigint")).repartition(spark.sparkContext.defaultParallelism)
        return cls(spark, *rewrite(longer.mapInArrow(spell, cls.SCHEMA), "words"))

    def stretches(self, pairs: list[int], most: int) -> list[tuple[list[int], int]]:
        """The distinct stretches of words that some pairs link, and how often each occurs; the ``most`` most frequent ones."""
        replay, wanted = Replay(self.pending), np.array(sorted(pairs), np.int64)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, _, _ = replay.run(Words.of_batch(batch)) if len(batch) else (Words.all_of([]), 0, [])
                found, counts = words.linked_by(wanted)
                own = pa.table({"stretch": found, "n": counts}).group_by("stretch").aggregate([("n", "sum")])
                yield from own.rename_columns({"n_sum": "n"}).select(["stretch", "n"]).combine_chunks().to_batches()

        counted = self.words.mapInArrow(cut, "stretch binary, n bigint").groupBy("stretch").agg(F.sum("n").alias("n"))
        table = counted.orderBy(F.desc("n"), "stretch").limit(most).toArrow()
        return [(np.frombuffer(s, "<i4").tolist(), n) for s, n in zip(*(c.to_pylist() for c in table.columns))]

    def frequent_pairs(self, least: int, tracked: int) -> tuple[dict[int, int], int]:
        """The most frequent pairs, and a count that no other pair exceeds. No merge may be pending."""
        counted = self.words.mapInArrow(_pairs_of_batches, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("cnt")).filter(F.col("cnt") >= least)
        rows = counted.orderBy(F.desc("cnt"), "pair").limit(tracked + 1).collect()
        floor = least - 1 if len(rows) <= tracked else rows[-1].cnt
        above = {r.pair: r.cnt for r in rows if r.cnt > floor}
        if rows and not above:  # all are equally frequent: as many as there are
            floor -= 1
            above = {r.pair: r.cnt for r in counted.filter(F.col("cnt") > floor).collect()}
        return above, floor

    def count_changes(self, steps: list[tuple[int, int]], floor: int) -> dict[int, list[tuple[int, int]]]:
        """By step, ``(pair, change of its count)``. New pairs that occur no more often than the floor are left out."""
        replay, start = Replay([*self.pending, *steps]), len(self.pending)

        def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                _, replayed, found = replay.run(Words.of_batch(batch), start)
                ranks, pairs, counts = map(np.concatenate, zip(*found, (np.array([start - 1]), np.array([0]), np.array([replayed]))))
                rows = pa.table({"step": (ranks - start).astype(np.int32), "pair": pairs, "n": counts})
                summed = rows.group_by(["step", "pair"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
                yield from summed.filter(pc.not_equal(summed["n"], 0)).select(["step", "pair", "n"]).combine_chunks().to_batches()

        summed = self.words.mapInArrow(changes, "step int, pair bigint, n bigint").groupBy("step", "pair").agg(F.sum("n").alias("n"))
        table = summed.filter(f"step < 0 or n < 0 or n > {floor}").toArrow()
        out: dict[int, list[tuple[int, int]]] = {}
        for step, pair, n in zip(*(c.to_pylist() for c in table.columns)):
            out.setdefault(step, []).append((pair, n))
        self.replayed += sum(n for _, n in out.pop(-1, ()))
        return out

    def accept(self, steps: list[tuple[int, int]]) -> None:
        """Merges that all later jobs replay."""
        self.pending += steps

    def rewritten(self) -> SpelledWords:
        """The words after the pending merges."""
        merges, replay = self.pending, Replay(self.pending)

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    after, _, _ = replay.run(Words.of_batch(batch))
                    yield after.filter(after.sizes > 1).to_batch()

        words, path = rewrite(self.words.mapInArrow(apply, self.SCHEMA), "words")
        self.drop()
        return SpelledWords(self.spark, words, path)

    def drop(self) -> None:
        """Remove what is stored."""
        remove(self.spark, self.path)


def _pairs_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with their counts, one row for each batch that holds the pair."""
    for batch in batches:
        if not len(batch):
            continue
        words = Words.of_batch(batch)
        pairs, _ = words.pairs()
        inside = pairs >= 0
        distinct, which = np.unique(pairs[inside], return_inverse=True)
        counts = np.zeros(len(distinct), np.int64)
        np.add.at(counts, which, np.repeat(words.counts, words.sizes)[inside])
        yield pa.RecordBatch.from_pydict({"pair": pa.array(distinct), "n": pa.array(counts)})


def _among(column: str, values: list[int], ranges: int = 16) -> str:
    """A filter for some sorted values, stated also as at most so many ranges around them.

    A scan skips pages by ranges; of a long list of values alone it only knows the least and the greatest.
    """
    if not values:
        return "false"
    gaps = sorted(range(1, len(values)), key=lambda i: values[i - 1] - values[i])[: ranges - 1]
    cuts = [0, *sorted(gaps), len(values)]
    spans = " OR ".join(f"{column} BETWEEN {values[a]} AND {values[b - 1]}" for a, b in zip(cuts, cuts[1:]))
    return f"({spans}) AND {column} IN ({', '.join(map(str, values))})"


def id_lookup(vocab: DataFrame, unknown: int = UNK):
    """An Arrow UDF from a token array to its ids; tokens outside the vocabulary become ``unknown``.

    The vocabulary is bounded by the ``vocab_size`` it was made with, and travels with the tasks, so the tokens stay in their row.
    Tokens are looked up as one Arrow array per batch, never as Python strings. A filter on ids does not make Spark evaluate it
    twice, because it is not declared deterministic.
    """
    ids = {r.token: r.id for r in vocab.select("token", "id").collect()}
    shared = vocab.sparkSession.sparkContext.broadcast((pa.array(list(ids), pa.string()), pa.array([*ids.values(), unknown], pa.int32())))

    @F.arrow_udf("array<int>")
    def look_up(rows: pa.Array) -> pa.Array:
        known, numbers = shared.value
        places = pc.fill_null(pc.index_in(rows.flatten(), value_set=known), len(known))
        sizes = pc.fill_null(pc.list_value_length(rows), 0)
        ends = pc.cumulative_sum(sizes)
        offsets = pa.concat_arrays([pa.array([0], ends.type), ends]).cast(pa.int32())
        return pa.ListArray.from_arrays(offsets, numbers.take(places), mask=rows.is_null() if rows.null_count else None)

    return look_up.asNondeterministic()


def lookup_ids(df: DataFrame, key: str, tokens: str, vocab: DataFrame, unknown: int = UNK) -> DataFrame:
    """Ids of an array of tokens, ``(key, ids)``. Rows without tokens keep an empty array."""
    return df.select(key, id_lookup(vocab, unknown)(F.coalesce(tokens, F.array().cast("array<string>"))).alias("ids"))


def vocab_check(left: DataFrame, right: DataFrame) -> DataFrame:
    """Special token by special token, do two vocabularies agree in id, and do they agree in size?"""
    special = F.col("token").isin(*SPECIAL_TOKENS)
    ids = left.filter(special).select("token", F.col("id").alias("left_id")).join(
        right.filter(special).select("token", F.col("id").alias("right_id")), "token", "full_outer"
    )
    sizes = left.agg(F.count(F.lit(1)).alias("left_size"), F.lit(1).alias("_k")).join(
        right.agg(F.count(F.lit(1)).alias("right_size"), F.lit(1).alias("_k")), "_k"
    )
    same = F.coalesce((F.col("left_id") == F.col("right_id")) & (F.col("left_size") == F.col("right_size")), F.lit(False))
    return ids.withColumn("_k", F.lit(1)).join(F.broadcast(sizes), "_k").drop("_k").withColumn("compatible", same)


def require_compatible(left: DataFrame, right: DataFrame) -> None:
    """Raise ``ValueError`` unless two vocabularies share special ids and size."""
    bad = vocab_check(left, right).filter(~F.col("compatible")).select("token").collect()
    if bad:
        raise ValueError(f"vocabularies differ at {sorted(r.token for r in bad)}")


def read_only_vocab(spark: SparkSession, tokens: list[str]) -> DataFrame:
    """A vocabulary frame from an ordered token list."""
    return spark.createDataFrame(list(zip(tokens, range(len(tokens)))), VOCAB_SCHEMA)
