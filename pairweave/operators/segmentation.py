"""Cutting unspaced script into dictionary words.

Words of a run come from a best path over a dictionary; stretches of characters that no word covers are decoded as hidden
states (begin, middle, end of a word, or a word of one character) of a model counted on the same dictionary. Scores are
logarithms in whole millionths, so sums are exact and equal totals are ties on every machine.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from pairweave.operators.numbering import range_slice
from pairweave.session import rewrite, scratch_path

#: A run of Han characters; other text is left as it is.
HAN_RUN = r"\p{IsHan}+"
#: Most words in one automaton, which travels with the tasks: about 100 MB. Larger dictionaries are cut in parts.
PART_WORDS = 1_000_000

_NO_WORD = np.iinfo(np.int32).min  # scores are far above it: the logarithm of the least double is -745 millions
_CHARACTER_BITS = 21
#: Words that are Python objects at a time.
_JOINED = 10_000
#: What may follow each state. Of equal paths the one that ends words sooner is taken, in this order.
_FOLLOWING = {"B": "EM", "M": "EM", "E": "SB", "S": "SB"}


def millionths(probability: Column | float) -> Column | int:
    """A logarithm in whole millionths, rounded down."""
    if isinstance(probability, Column):
        return F.floor(1_000_000 * F.log(probability)).cast("bigint")
    return math.floor(1_000_000 * math.log(probability))


class Automaton(NamedTuple):
    """A prefix tree as two arrays: node ``i + 1`` is reached by edge ``i``, whose number is parent and character.

    Nodes are numbered level by level, so edges are sorted, and a step from any number of nodes at once is one binary search.
    """

    edges: np.ndarray
    scores: np.ndarray

    @classmethod
    def of_words(cls, words: list[str] | pa.Array, scores: list[int] | np.ndarray) -> Automaton:
        """The tree of distinct words."""
        words = pa.array(words, pa.string())
        order = pc.sort_indices(words)
        words, values = words.take(order), np.asarray(scores, np.int32)[order.to_numpy()]
        text = np.concatenate([np.zeros(0, np.uint32), *(_codes("".join(words[i : i + _JOINED].to_pylist())) for i in range(0, len(words), _JOINED))])
        sizes = pc.utf8_length(words).to_numpy()
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        at, node, edges, ends, depth = np.flatnonzero(sizes > 0), np.zeros(len(words), np.int64), [], [np.array([_NO_WORD], np.int32)], 0
        made = 1
        while len(at):
            wanted = node[at] << _CHARACTER_BITS | text[starts[at] + depth]  # in order, as the words are
            other = np.concatenate([[True], wanted[1:] != wanted[:-1]])
            new, which = wanted[other], np.cumsum(other) - 1
            node[at] = made + which
            edges.append(new)
            level = np.full(len(new), _NO_WORD, np.int32)
            over = sizes[at] == depth + 1
            level[which[over]] = values[at[over]]
            ends.append(level)
            made, depth, at = made + len(new), depth + 1, at[~over]
        return cls(np.concatenate([*edges, np.zeros(0, np.int64)]), np.concatenate(ends))

    def words_at(self, codes: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length from one on: the places among ``at`` where a word of that length begins, and its scores."""
        node, size = np.zeros(len(at), np.int64), 0
        while len(at) and len(self.edges):
            wanted = node << _CHARACTER_BITS | codes[at + size]
            edge = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
            alive = self.edges[edge] == wanted
            at, node, size = at[alive], edge[alive] + 1, size + 1
            scores = self.scores[node]
            word = scores != _NO_WORD
            yield size, at[word], scores[word]
            inside = at + size < len(codes)
            at, node = at[inside], node[inside]

    def matches(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(place, length, score)`` of every word in a text, by place and length."""
        codes = _codes(text)
        found = [(at, np.full(len(at), size), scores) for size, at, scores in self.words_at(codes, np.arange(len(codes)))]
        places, lengths, scores = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in range(3))
        order = np.lexsort((lengths, places))
        return places[order], lengths[order], scores[order]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class HiddenStates(NamedTuple):
    """Scores of the states that characters may be in: of a first state, of one after another, and of a character in a state."""

    first: dict[str, int]
    after: dict[tuple[str, str], int]
    shown: dict[str, dict[str, int]]
    unseen: dict[str, int]

    @classmethod
    def of_counts(cls, shown: dict[tuple[str, str], int]) -> HiddenStates:
        """The model of ``(state, character)`` counts, each count and each following state one up."""
        total = {s: sum(n for (t, _), n in shown.items() if t == s) for s in "BMES"}
        characters = len({c for _, c in shown} - {""}) + 1
        inner = total["M"]
        longer = shown.get(("B", ""), 0)  # words of three characters and more, counted beside the characters
        multi, single = total["B"] - longer, total["S"]
        open_, stay = millionths((multi + 1) / (multi + single + 2)), millionths((single + 1) / (multi + single + 2))
        after = {("B", "E"): millionths((multi - longer + 1) / (multi + 2)), ("B", "M"): millionths((longer + 1) / (multi + 2))}
        after |= {("M", "E"): millionths((longer + 1) / (inner + 2)), ("M", "M"): millionths((inner - longer + 1) / (inner + 2))}
        after |= {(s, t): v for s in "ES" for t, v in (("B", open_), ("S", stay))}
        total["B"] = multi
        scores: dict[str, dict[str, int]] = {s: {} for s in "BMES"}
        for (s, c), n in shown.items():
            if c:
                scores[s][c] = millionths((n + 1) / (total[s] + characters))
        return cls({"B": open_, "S": stay}, after, scores, {s: millionths(1 / (total[s] + characters)) for s in "BMES"})

    def cut(self, text: str) -> list[str]:
        """A stretch of characters as the words of its best states."""
        later: list[dict[str, int]] = [{"E": 0, "S": 0}]  # a stretch ends with a word
        for i in range(len(text) - 1, 0, -1):
            said = {s: self.shown[s].get(text[i], self.unseen[s]) for s in "BMES"}
            reach = {s: said[s] + later[-1][s] for s in later[-1]}
            later.append({s: max(self.after[s, t] + reach[t] for t in _FOLLOWING[s] if t in reach) for s in "BMES" if any(t in reach for t in _FOLLOWING[s])})
        words, state = [], ""
        for c in text:
            left = later.pop()
            options = [t for t in (_FOLLOWING[state] if state else "SB") if t in left]
            score = {t: (self.after[state, t] if state else self.first[t]) + self.shown[t].get(c, self.unseen[t]) + left[t] for t in options}
            state = max(options, key=lambda t: (score[t], -options.index(t)))
            if state in "SB":
                words.append(c)
            else:
                words[-1] += c
        return words


#: Of each length the places and scores of the words found, in any number of arrays.
Found = dict[int, list[tuple[np.ndarray, np.ndarray]]]


def best_path(run: str, matches: list[tuple[int, int, int]], unknown: int, states: HiddenStates | None = None) -> list[str]:
    """The segmentation of ``run`` with the highest total score; on equal totals the longer first word wins.

    ``matches`` are ``(place, length, score)`` by place and length. A character that is no word scores ``unknown``; two or more of
    them on end are cut anew by their hidden states.
    """
    found: Found = defaultdict(list)
    for place, size, score in matches:
        found[size].append((np.array([place]), np.array([score])))
    at = np.flatnonzero(_word_starts(run, np.array([0]), np.array([len(run)]), found, unknown, states)).tolist()
    return [run[i:j] for i, j in zip(at, [*at[1:], len(run)])]


def _word_starts(text: str, starts: np.ndarray, ends: np.ndarray, found: Found, unknown: int, states: HiddenStates | None) -> np.ndarray:
    """Where words begin on the best paths of many runs of a text; ``found`` is used up. No word goes on after the end of its run.

    Places are ranked by how far from the end of its run each is, then by run, so one array step scores all places of the same distance.
    """
    sizes = ends - starts
    by_size = np.argsort(-sizes, kind="stable")
    starts, ends, sizes = starts[by_size], ends[by_size], sizes[by_size]
    runs, most = len(sizes), int(sizes.max(initial=0))
    first_rank = np.concatenate([[0], np.cumsum(runs - np.searchsorted(sizes[::-1], np.arange(most + 1)))])
    ranks = int(first_rank[-1])
    rank_of, place_of = np.zeros(len(text) + 1, np.int32), np.zeros(ranks, np.int32)
    run = np.repeat(np.arange(runs), sizes + 1)
    left = np.repeat(np.cumsum(sizes + 1), sizes + 1) - np.arange(len(run)) - 1
    places = ends[run] - left
    rank_of[places] = first_rank[left] + run
    place_of[rank_of[places]] = places
    del run, left, places

    alone = np.ones(ranks, bool)
    alone[:runs] = False  # the ends
    for at, _ in found.get(1, ()):
        alone[rank_of[at]] = False
    lone = np.flatnonzero(alone)
    found.setdefault(1, []).append((place_of[lone], np.full(len(lone), unknown, np.int32)))
    options = np.zeros(ranks + 1, np.int64)
    for of_size in found.values():
        for at, _ in of_size:
            options[rank_of[at] + 1] += 1
    first = np.cumsum(options)
    fill, scores, to = first.copy(), np.zeros(first[-1], np.int32), np.zeros(first[-1], np.int32)
    for size in sorted(found):
        for at, score in found.pop(size):
            rank = rank_of[at]
            scores[fill[rank]], to[fill[rank]] = score, rank_of[at + size]
            fill[rank] += 1
    del fill

    total = np.zeros(ranks, np.int64)
    for low, high in zip(first_rank[1:].tolist(), first_rank[2:].tolist()):
        here = slice(first[low], first[high])
        total[low:high] = np.maximum.reduceat(scores[here] + total[to[here]], first[low:high] - first[low])
    step, lone_word = np.ones(len(text) + 1, np.int32), np.zeros(len(text) + 1, bool)
    low = runs
    while low < ranks:
        high = max(low + 1, int(np.searchsorted(first, first[low] + _OPTIONS_TOGETHER, "right")) - 1)
        here, count = slice(first[low], first[high]), np.diff(first[low : high + 1])
        best = np.flatnonzero(scores[here] + total[to[here]] == np.repeat(total[low:high], count))
        chosen = np.zeros(high - low, np.int64)
        chosen[np.repeat(np.arange(high - low), count)[best]] = best  # of equal ones the last, so the longest
        at = place_of[low:high]
        step[at] = place_of[to[here][chosen]] - at
        lone_word[at] = alone[low:high] & (step[at] == 1)
        low = high

    begins = np.zeros(len(text) + 1, bool)
    at = starts[sizes > 0]
    last = ends[sizes > 0]
    while len(at):
        begins[at] = True
        at = at + step[at]
        inside = at < last
        at, last = at[inside], last[inside]
    if states is not None:
        begins[ends] = False
        lone_at = np.flatnonzero(begins & lone_word)
        ended = np.zeros(len(text) + 1, bool)
        ended[ends] = True
        # A stretch goes on where the place before is one of an unknown character of the same run.
        new = np.concatenate([[True], (np.diff(lone_at) != 1) | ended[lone_at[1:]]]) if len(lone_at) else np.zeros(0, bool)
        of_stretch = np.flatnonzero(new)
        cuts: dict[str, list[int]] = {}
        for i, n in zip(lone_at[of_stretch].tolist(), np.diff([*of_stretch.tolist(), len(lone_at)]).tolist()):
            if n > 1:
                piece = text[i : i + n]
                if piece not in cuts:
                    cuts[piece] = np.cumsum([0, *map(len, states.cut(piece))]).tolist()[:-1]
                begins[i : i + n] = False
                for k in cuts[piece]:
                    begins[i + k] = True
    return begins[: len(text)]


def _state_counts(words: DataFrame) -> dict[tuple[str, str], int]:
    """How often each character begins, continues, ends or is a word. The driver gets four rows per character of the script at most."""
    size = F.char_length("word")
    inner = F.when(size > 2, F.split(F.expr("substring(word, 2, char_length(word) - 2)"), "")).otherwise(F.array().cast("array<string>"))
    many = F.array(F.struct(F.lit("B").alias("s"), F.substring("word", 1, 1).alias("c")), F.struct(F.lit("E").alias("s"), F.expr("right(word, 1)").alias("c")))
    longer = F.when(size > 2, F.array(F.struct(F.lit("B").alias("s"), F.lit("").alias("c")))).otherwise(F.array().cast("array<struct<s:string,c:string>>"))
    middle = F.transform(F.filter(inner, lambda c: c != ""), lambda c: F.struct(F.lit("M").alias("s"), c.alias("c")))
    each = F.when(size == 1, F.array(F.struct(F.lit("S").alias("s"), F.col("word").alias("c")))).otherwise(F.concat(many, middle, longer))
    counted = words.select(F.explode(each).alias("e"), "cnt").groupBy("e.s", "e.c").agg(F.sum("cnt").alias("n"))
    return {(r.s, r.c): r.n for r in counted.collect()}


class _Part(NamedTuple):
    """An automaton over a range of the sorted dictionary, shared with the tasks, and the least and greatest first character of its words."""

    tree: Broadcast
    low: int
    high: int

    def words_at(self, codes: np.ndarray, by_code: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """As that of the automaton. ``by_code`` are places by their characters."""
        low, high = np.searchsorted(codes, np.array([self.low, self.high + 1], np.uint32), sorter=by_code)
        if low < high:
            yield from self.tree.value.words_at(codes, by_code[low:high])

    def let_go(self) -> None:
        """Free the automaton in a task, which reads it from its disk when it is next wanted."""
        if "_path" in vars(self.tree):  # not so where Spark encrypts what it shares
            vars(self.tree).pop("_value", None)


def _automata(words: DataFrame, part_words: int) -> list[_Part]:
    """Shared automata over ranges of the sorted dictionary; tasks build them side by side, and the driver holds one at a time."""
    sliced, _ = rewrite(range_slice(words, "word", "part", part_words), "dictionary")

    def build(rows: pa.Table) -> pa.Table:
        if rows["score"].null_count:
            raise ValueError("a word of the dictionary has no count above zero")
        tree = Automaton.of_words(rows["word"].combine_chunks(), rows["score"].to_numpy())
        return pa.table({"part": rows["part"][:1], "edges": [tree.edges.tobytes()], "scores": [tree.scores.tobytes()]})

    # A file each, so whoever reads one holds no other.
    spark, path, kind = words.sparkSession, scratch_path(words.sparkSession, "automata"), "edges binary, scores binary"
    sliced.groupBy("part").applyInArrow(build, f"part int, {kind}").write.partitionBy("part").parquet(path)
    parts = []
    for (part,) in sliced.select("part").distinct().orderBy("part").collect():
        row = spark.read.schema(kind).parquet(f"{path}/part={part}").first()
        tree = Automaton(np.frombuffer(row.edges, np.int64), np.frombuffer(row.scores, np.int32))
        firsts = tree.edges[: np.searchsorted(tree.edges, 1 << _CHARACTER_BITS)]
        parts.append(_Part(spark.sparkContext.broadcast(tree), int(firsts[0]), int(firsts[-1])))
    return parts


def segment_runs(df: DataFrame, text: str, dictionary: DataFrame, out: str, run: str = HAN_RUN, part_words: int = PART_WORDS) -> DataFrame:
    """Add ``out``: ``text`` with a space between the words of each run, by best path over ``dictionary(word, cnt)``.

    Words are distinct; null and empty ones and those with a line break are not used. The dictionary is written once and becomes automata of up to ``part_words``
    words each, by the order of words, which travel with the tasks. Texts are cut where they lie: a task takes many at a time through one automaton after
    the other and holds one of them. With an empty dictionary every character is a word.
    """
    words, _ = rewrite(dictionary.select("word", F.col("cnt").cast("bigint").alias("cnt")).filter(r"word <> '' AND NOT contains(word, '\n')"), "words")
    total = max(words.agg(F.sum("cnt")).first()[0] or 0, 1)
    scored = words.select("word", millionths(F.col("cnt") / F.lit(float(total))).alias("score"))
    states = df.sparkSession.sparkContext.broadcast(HiddenStates.of_counts(_state_counts(words)))
    unknown = millionths(1 / total)
    parts = _automata(scored, part_words)

    @F.arrow_udf("array<string>")
    def split_runs(lists: pa.Array) -> pa.Array:
        return _split(lists, parts, unknown, states.value)

    runs = F.regexp_extract_all(F.col(text), F.lit(run), F.lit(0))
    cut = df.withColumn("_runs", split_runs(runs))
    return cut.withColumn(out, _rejoin(F.col(text), F.col("_runs"), run)).drop("_runs")


#: Characters that are cut by the same array steps, which take about 60 times as many bytes, and options of places that are compared at a time.
_CUT_TOGETHER, _OPTIONS_TOGETHER = 500_000, 500_000


def _split(lists: pa.Array, parts: list[_Part], unknown: int, states: HiddenStates) -> pa.Array:
    """Each run of each list with spaces between its words."""
    flat = lists.flatten()
    sizes = pc.utf8_length(flat).to_numpy(zero_copy_only=False)
    upto, cut, start = np.cumsum(sizes + 1), [], 0
    while start < len(flat):
        end = max(start + 1, int(np.searchsorted(upto, _CUT_TOGETHER + (upto[start - 1] if start else 0), "right")))
        cut.append(_cut(flat[start:end].to_pylist(), parts, unknown, states))
        start = end
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays(cut or [pa.array([], pa.string())]), mask=lists.is_null())


def _cut(runs: list[str], parts: list[_Part], unknown: int, states: HiddenStates) -> pa.Array:
    """Each run with spaces between its words. All are searched and cut as one text, in which a character that no word holds sets them apart."""
    text = "\n".join(runs)
    codes = _codes(text)
    sizes = np.array([len(r) for r in runs], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    found: Found = defaultdict(list)
    by_code = np.argsort(codes.astype(np.uint16) if codes.max(initial=0) < 1 << 16 else codes, kind="stable").astype(np.int32)
    for part in parts:
        for size, at, scores in part.words_at(codes, by_code):
            found[size].append((at, scores))
        if len(parts) > 1:
            part.let_go()
    begins = _word_starts(text, starts, starts + sizes, found, unknown, states)
    begins[starts[sizes > 0]] = False
    before = np.cumsum(begins)
    spaced = np.full(len(codes) + int(before[-1] if len(before) else 0), ord(" "), np.uint32)
    spaced[np.arange(len(codes)) + before] = codes
    joined = spaced.tobytes().decode("utf-32-le")
    before = np.concatenate([[0], before])
    return pa.array([joined[i:j] for i, j in zip((starts + before[starts]).tolist(), (starts + sizes + before[starts + sizes]).tolist())], pa.string())


#: Characters whose matches are found by the same array steps.
_MATCHED_TOGETHER = 200_000


def _found(tree: Automaton | None, rows: list[list[str] | None]) -> Iterator[list[tuple[int, int, int]]]:
    """For each list of runs its matches; places count from its first run on, and a character that no word holds sets runs apart.

    Many lists are matched at once, as one text: the array steps of a short one cost as much as those of a thousand. These are
    Python objects, to look at or to test against; ``_split`` keeps what it finds in arrays.
    """
    start = 0
    while start < len(rows):
        texts, size = [], 0
        while start + len(texts) < len(rows) and (not texts or size < _MATCHED_TOGETHER):
            of = rows[start + len(texts)]
            texts.append("\n".join(of) if of is not None else "")
            size += len(texts[-1]) + 1
        start += len(texts)
        if tree is None:
            yield from ([] for _ in texts)
            continue
        places, lengths, scores = tree.matches("\n".join(texts))
        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        ends = np.searchsorted(places, firsts)
        for first, low, high in zip(firsts.tolist(), ends.tolist(), ends[1:].tolist()):
            yield list(zip((places[low:high] - first).tolist(), lengths[low:high].tolist(), scores[low:high].tolist()))


def _rejoin(text: Column, runs: Column, run: str) -> Column:
    """Put segmented runs back into the text, set off by a space where the text has none; the rest stays as it was."""
    edge = ""
    around = F.split(text, run, -1)
    woven = F.zip_with(around, runs, lambda a, r: F.concat(a, F.coalesce(F.concat(F.lit(edge), r, F.lit(edge)), F.lit(""))))
    no_space = F.regexp_replace(F.array_join(woven, ""), rf"(?<=^|\s){edge}|{edge}(?=\s|$)", "")
    return F.replace(no_space, F.lit(edge), F.lit(" "))
