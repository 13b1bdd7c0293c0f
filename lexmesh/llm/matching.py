"""Matching entities across sources without keys (problem 7).

Records are sorted by several composite keys and compared within a sliding window.
How much a field's agreement says is learned from the candidate pairs themselves by
a two-class mixture over their agreement patterns; pairs get a confidence, and a
one-to-one assignment of greatest total confidence is kept.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmesh.functions.keys import strip_key
from lexmesh.llm.groups import group_pairs
from lexmesh.llm.lookalike import meet_marks, plain_form
from lexmesh.operators.ranks import with_rank
from lexmesh.storage import materialize

#: Words in more than this share of records describe, rarer ones name.
COMMON_SHARE = 0.004
#: Records compared on either side of a record in each sort order.
WINDOW = 8
#: Rows of a sort order compared in one task.
TASK_ROWS = 10_000
#: Pairs of one group of rivals that a task assigns (about 500 MB); larger groups are auctioned across tasks.
GROUP_PAIRS = 5_000_000

#: Items of two lists, all against all, that a task holds at once; a pair with more is compared item by item.
CROSSED = 1 << 20

_WORD = re.compile(r"[^\W_]+")
_RECORD = "id string, source string, terms array<string>, numbers array<string>, names array<string>, said array<int>, called array<int>"


def words(text: str | None) -> list[str]:
    return _WORD.findall(plain_form(text).lower())


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, replacements and swaps of neighbours between a and b; most + 1 if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, prev = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        before, prev = prev, row
    return prev[-1]


@lru_cache(1 << 16)
def _near_words(x: str, y: str, few: int) -> bool:
    """Whether two words are at most ``few`` edits (1 or 2) apart; what both share at their beginnings and ends is cut off first."""
    n, m = len(x), len(y)
    i, most = 0, min(n, m)
    while i < most and x[i] == y[i]:
        i += 1
    j = 0
    while j < most - i and x[-1 - j] == y[-1 - j]:
        j += 1
    # what lies between the shared ends spans at most the edits and the letters between them
    if i + j < max(n, m) - (2 if few == 1 else 7):
        return False
    return _within(x[i : n - j], y[i : m - j], few)


def _within(x: str, y: str, few: int) -> bool:
    """Whether ``edits`` of two words that differ in their first letter, or of which one is empty, is at most ``few``."""
    n, m = len(x), len(y)
    if not n or not m:
        return max(n, m) <= few
    if few == 0 or not -few <= n - m <= few:
        return False
    ways = [(1, 1)] if n == m else [(1, 1), (1, 0), (0, 1)]
    if few > 1 and n == m:
        ways += [(1, 0), (0, 1)]
    if n > 1 and m > 1 and x[0] == y[1] and x[1] == y[0]:
        ways.append((2, 2))
    for a, b in ways:
        while a < n and b < m and x[a] == y[b]:
            a, b = a + 1, b + 1
        if _within(x[a:], y[b:], few - 1):
            return True
    return False


def nearness(a: list[str], b: list[str], most: int, own: frozenset[str] | None = None) -> int:
    """0: one side says nothing, 1: equal, 2: one edit apart (up to ``most`` in words of nine or more letters), 3: different.

    ``own`` are the words of ``b`` as a set, if at hand.
    """
    if not a or not b:
        return 0
    if not (frozenset(b) if own is None else own).isdisjoint(a):
        return 1
    for x in a:
        n, first, last = len(x), x[0], x[-1]
        if n < 4:
            continue
        for y in b:
            # near words are equal at one end at least
            if (y[0] != first and y[-1] != last) or len(y) < 4 or not -most <= n - len(y) <= most:
                continue
            if _near_words(x, y, most if min(n, len(y)) >= 9 else 1):
                return 2
    return 3


def source_records(resources: DataFrame, labels: DataFrame, schemes: list[str]) -> DataFrame:
    """(id, source, said, called): the distinct definitions' and labels' words of each record.

    Repeated rows count once. A record without labels or definition has empty lists. A
    record in several schemes belongs to the smallest.
    """
    own = resources.select(strip_key("id").alias("id"), strip_key("scheme").alias("source"), "definition").filter(F.col("source").isin(schemes) & F.col("id").isNotNull())
    own = own.groupBy("id").agg(F.min("source").alias("source"), F.max("definition").alias("definition"))
    named = labels.select(strip_key("resource").alias("id"), "value").filter("value IS NOT NULL").join(own.select("id"), "id", "left_semi")
    # words, not label copies, are gathered: a record's distinct words are bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("value").to_pylist()
            meet_marks(texts)
            out = [sorted(set(words(v))) for v in texts]
            yield pa.record_batch([batch.column("id"), pa.array(out, pa.list_(pa.string()))], names=["id", "w"])

    called = named.distinct().mapInArrow(run, "id string, w array<string>").select("id", F.explode("w").alias("w")).groupBy("id").agg(F.array_sort(F.collect_set("w")).alias("called"))

    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("definition").to_pylist()
            meet_marks(texts)
            out = [sorted(set(words(v))) for v in texts]
            yield pa.record_batch([batch.column("id"), batch.column("source"), pa.array(out, pa.list_(pa.string()))], names=["id", "source", "said"])

    none = F.array().cast("array<string>")
    both = own.mapInArrow(said, "id string, source string, said array<string>").join(called, "id", "left")
    return both.select("id", "source", "said", F.coalesce("called", none).alias("called"))


def common_words(records: DataFrame, field: str, n: int) -> dict[str, int]:
    """Words of a field in more than COMMON_SHARE of records, with their number; at most words-per-record / COMMON_SHARE."""
    least = max(20, n * COMMON_SHARE)
    counts = records.select(F.explode(field).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    return {r["w"]: r["n"] for r in counts.collect()}


def _descriptive(said: dict[str, int]) -> list[str]:
    """The common words of definitions that are no numbers; numbers are compared as they are, however common."""
    return sorted(w for w in said if not _numeric(w))


def _numeric(word: str) -> bool:
    return any(x.isdigit() for x in word)


class _Words:
    """A column of lists of words as arrays: each word's code and list, where lists start, and the different words by code."""

    def __init__(self, words: list[str], codes: np.ndarray, size: np.ndarray) -> None:
        self.words, self.codes, self.size = words, codes, size
        self.start = np.cumsum(size) - size
        self.list = np.repeat(np.arange(len(size)), size)

    @classmethod
    def of(cls, column: pa.ListArray) -> _Words:
        found = column.flatten().dictionary_encode()
        return cls(found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False).astype(np.int64), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))

    def where(self, keep: np.ndarray) -> _Words:
        return _Words(self.words, self.codes[keep], np.bincount(self.list[keep], minlength=len(self.size)))

    def kept(self, keep: np.ndarray, values: np.ndarray | None = None) -> pa.ListArray:
        """The lists of the words to keep, or of their ``values``."""
        ends = np.r_[0, np.cumsum(np.bincount(self.list[keep], minlength=len(self.size)))].astype(np.int32)
        items = pa.array(self.words, pa.string()).take(pa.array(self.codes[keep])) if values is None else pa.array(values[keep], pa.int32())
        return pa.ListArray.from_arrays(pa.array(ends), items)

    def meet(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether lists i and j, taken in pairs, share a word."""
        width = max(len(self.words), 1)
        held = np.unique(self.list * width + self.codes)
        pair, at = _spread(self.start[i], self.size[i])
        sought = j[pair] * width + self.codes[at]
        place = np.searchsorted(held, sought)
        return np.bincount(pair[held[np.minimum(place, len(held) - 1)] == sought], minlength=len(i)) > 0 if len(sought) and len(held) else np.zeros(len(i), dtype=bool)

    def nearness(self, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
        """``nearness`` of lists i and j, taken in pairs."""
        out = np.where((self.size[i] == 0) | (self.size[j] == 0), SILENT, np.where(self.meet(i, j), EQUAL, DIFFERENT))
        open_ = np.flatnonzero(out == DIFFERENT)
        if not len(open_):
            return out
        length = np.array([len(w) for w in self.words])
        letters = np.frombuffer("".join(self.words).encode("utf-32-le"), dtype=np.uint32)
        first = np.cumsum(length) - length
        head, tail = letters[first], letters[first + length - 1]
        # an edit takes at most one letter from a word's set of letters and brings one in
        marks = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (letters & 63).astype(np.uint64)), first)
        long = self.where(length[self.codes] >= 4)
        for part, pair, a, b in _crossed(long, i[open_], long, j[open_]):
            if a is None:
                for p in part.tolist():
                    x, y = ([self.words[c] for c in self.codes[self.start[k] : self.start[k] + self.size[k]]] for k in (i[open_[p]], j[open_[p]]))
                    out[open_[p]] = nearness(x, y, most)
                continue
            x, y = long.codes[a], long.codes[b]
            likely = ((head[x] == head[y]) | (tail[x] == tail[y])) & (np.abs(length[x] - length[y]) <= most)
            pair, x, y = pair[likely], x[likely], y[likely]
            few = np.where(np.minimum(length[x], length[y]) >= 9, most, 1)
            likely = np.bitwise_count(marks[x] ^ marks[y]) <= 2 * few
            pair, both = pair[likely], x[likely] * len(self.words) + y[likely]
            few = few[likely]
            kinds, at, back = np.unique(both, return_index=True, return_inverse=True)
            near = np.array([_near_words(self.words[k // len(self.words)], self.words[k % len(self.words)], f) for k, f in zip(kinds.tolist(), few[at].tolist(), strict=True)], dtype=bool)
            out[open_[pair[near[back]]]] = NEAR
        return out


def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``size`` places from ``start``: the run and the place of each."""
    run = np.repeat(np.arange(len(size)), size)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def _crossed(x, i: np.ndarray, y, j: np.ndarray) -> Iterator[tuple]:
    """All items of the lists i of ``x`` against all of the lists j of ``y``, taken in pairs: (None, pair, place in x,
    place in y) in the order of pairs and places, at most CROSSED at once; (pairs, None, None, None) for pairs with more."""
    n = x.size[i] * y.size[j]
    large = n > CROSSED
    if large.any():
        yield np.flatnonzero(large), None, None, None
    held = np.flatnonzero((n > 0) & ~large)
    if not len(held):
        return
    at = 0
    total = np.cumsum(n[held])
    while at < len(held):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CROSSED, side="right")))
        p = held[at:end]
        a_of, a = _spread(x.start[i[p]], x.size[i[p]])
        of, b = _spread(y.start[j[p]][a_of], y.size[j[p]][a_of])
        yield None, p[a_of[of]], a[of], b
        at = end


def _split(said: dict[str, int], called: dict[str, int]):
    """Words to fields: rare words and numbers of the definition, rare words of labels, codes of the common words."""
    code_said = {w: i for i, w in enumerate(_descriptive(said))}
    code_called = {w: i for i, w in enumerate(sorted(called))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, c = _Words.of(batch.column("said")), _Words.of(batch.column("called"))
            common_s, common_c = (np.array([d.get(w, -1) for w in x.words], dtype=np.int32)[x.codes] for x, d in ((s, code_said), (c, code_called)))
            number = np.array([_numeric(w) for w in s.words], dtype=bool)[s.codes]
            cols = [s.kept(~number & (common_s < 0)), s.kept(number), c.kept(common_c < 0), s.kept(common_s >= 0, common_s), c.kept(common_c >= 0, common_c)]
            yield pa.record_batch([batch.column("id"), batch.column("source"), *cols], names=["id", "source", "terms", "numbers", "names", "said", "called"])

    return run


def sort_rows(records: DataFrame) -> DataFrame:
    """Records once per order and value, with a composite key: rare word of the definition and the same read
    backwards, name and the same backwards, each with what else is known; and all that is known at once.

    The last order has every record with a word, so none stays without neighbours.
    """
    rest = F.concat_ws(" ", F.array_join("numbers", " "), F.array_join("names", " "), F.array_join("terms", " "))
    codes = lambda c: F.array_join(F.transform(c, lambda x: F.lpad(x.cast("string"), 6, "0")), " ")
    part = records.withColumn("_rest", rest)
    orders = []
    for order, (field, back) in enumerate([("terms", False), ("terms", True), ("names", False), ("names", True)]):
        rows = part.select(F.lit(order).alias("order"), F.explode(field).alias("_w"), "*")
        orders.append(rows.withColumn("key", F.concat_ws("\x01", F.reverse("_w") if back else F.col("_w"), "_rest")).drop("_w", "_rest"))
    whole = part.select(F.lit(len(orders)).alias("order"), "*").withColumn("key", F.concat_ws("\x01", codes("said"), codes("called"), "_rest")).drop("_rest")
    out = orders[0]
    for rows in [*orders[1:], whole.filter(F.size("said") + F.size("called") + F.size("numbers") + F.size("names") + F.size("terms") > 0)]:
        out = out.unionByName(rows)
    return out


#: Values of the compared fields: nothing said on a side, equal, nearly equal, different; numbers are equal or different.
SILENT, EQUAL, NEAR, DIFFERENT = range(4)
_CODED = "source_1 string, source_2 string, terms int, numbers int, names int"


_WORDS_OF = ["said_1", "said_2", "called_1", "called_2"]
_ROW = ["order", "id", "source", "terms", "numbers", "names", "said", "called"]
_NO_WORDS = (None,) * 4
_PAIR = ["id_1", "id_2", "source_1", "source_2", "terms", "numbers", "names", *_WORDS_OF, "heard", "read", "n"]
#: Every agreement in terms, numbers and names, and whether both sides have common words of the definition and of labels.
_PATTERNS = list(product(range(4), range(4), range(4), (False, True), (False, True)))


def _compared(r: tuple, row: tuple, sets: tuple[frozenset, frozenset, frozenset]) -> tuple[tuple, bool]:
    """The pattern of two rows of _ROW, and whether they are near in a rare word or a name; ``sets`` are terms, numbers and names of ``row``."""
    term, name = nearness(r[3], row[3], 1, sets[0]), nearness(r[5], row[5], 2, sets[2])
    number = SILENT if not row[4] or not r[4] else (DIFFERENT if sets[1].isdisjoint(r[4]) else EQUAL)
    return (term, number, name, bool(row[6] and r[6]), bool(row[7] and r[7])), EQUAL <= term <= NEAR or EQUAL <= name <= NEAR


def _pair(r: tuple, row: tuple, pattern: tuple, close: bool) -> tuple:
    a, b = (r, row) if r[1] < row[1] else (row, r)
    return (a[1], b[1], a[2], b[2], *pattern[:3], *((a[6], b[6], a[7], b[7]) if close else _NO_WORDS), *pattern[3:], 1)


def _pair_batches(rows: DataFrame):
    """The schema of compared pairs, and what makes a batch of them."""
    kind = rows.schema["id"].dataType.simpleString()
    arrow = pa.int64() if kind == "bigint" else pa.string()
    result = f"id_1 {kind}, id_2 {kind}, {_CODED}, " + ", ".join(f"{c} array<int>" for c in _WORDS_OF) + ", heard boolean, read boolean, n long"
    kinds = [arrow, arrow, pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), *[pa.list_(pa.int32())] * 4, pa.bool_(), pa.bool_(), pa.int64()]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 14, kinds, strict=True)], names=_PAIR)

    return result, batch_of


def _silent_rows(rows: DataFrame, window: int) -> DataFrame:
    """Compared pairs, unreduced, that share a rare word of the definition while a side says no number, however far apart they stand.

    Rows of a word are ordered by numbers, so where a word is on many records those
    without number stand apart from their like. Words on at most ``window`` + 1 records
    lie within a window and are left to it.
    """
    own = rows.filter("order = 0").withColumn("_w", F.substring_index("key", "\x01", 1))
    many = own.groupBy("_w").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.size("numbers") == 0).alias("_s")).filter((F.col("_n") > window + 1) & (F.col("_s") > 0))
    result, batch_of = _pair_batches(rows)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, silent, out = None, [], []
        for batch in batches:
            for *row, own_word in zip(*[batch.column(c).to_pylist() for c in [*_ROW, "_w"]], strict=True):
                if own_word != word:
                    word, silent = own_word, []
                sets = frozenset(row[3]), frozenset(row[4]), frozenset(row[5])
                for r in silent:
                    if r[2] != row[2] and r[1] != row[1]:
                        out.append(_pair(r, row, *_compared(r, row, sets)))
                if not row[4]:
                    silent.append(row)
                if len(out) > TASK_ROWS:
                    yield batch_of(out)
                    out = []
        yield batch_of(out)

    # rows without number come first, so each word holds these only
    held = own.join(many.select("_w"), "_w", "left_semi").select(*_ROW, "_w")
    return held.repartition("_w").sortWithinPartitions("_w", F.size("numbers") > 0, "id").mapInArrow(compare, result)


def _placed(rows: DataFrame) -> DataFrame:
    """Rows of all orders with their exact rank."""
    return with_rank(rows.select(*_ROW, "key"), ["order", "key", "id"], "rank").drop("key")


def _window_rows(placed: DataFrame, window: int, task_rows: int, kept: set[tuple[int, ...]] | None) -> DataFrame:
    """Compared pairs, unreduced, of rows as from ``_placed``: with ids those near or equal in a field or of a pattern in ``kept`` (None: all);
    the others as counts (n) by pattern and task. A pattern tells too which common words either side lacks."""
    total = placed.count()
    result, batch_of = _pair_batches(placed)
    block = F.floor(F.col("rank") / task_rows)
    again = F.when((F.col("rank") % task_rows < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    placed = placed.withColumn("block", F.explode(again))
    names = [*_ROW, "rank", "block"]
    asked = np.array([kept is None or tuple(p) in kept for p in _PATTERNS])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = None
        apart = np.zeros(len(_PATTERNS), dtype=np.int64)

        for batch in batches:
            if not batch.num_rows:
                continue
            old = 0 if recent is None else recent.num_rows
            batch = batch if recent is None else pa.Table.from_batches([recent, batch]).combine_chunks().to_batches()[0]
            recent = batch.slice(max(0, batch.num_rows - window))
            order, rank, own = (batch.column(c).to_numpy() for c in ("order", "rank", "block"))
            ident, source = (batch.column(c).dictionary_encode().indices.to_numpy().astype(np.int64) for c in ("id", "source"))
            i = np.repeat(np.arange(old, batch.num_rows), window)
            j = i - np.tile(np.arange(window, 0, -1), batch.num_rows - old)
            i, j = i[j >= 0], j[j >= 0]
            # a pair belongs to the block of its earlier row
            meet = (own[i] == own[j]) & (order[i] == order[j]) & (source[i] != source[j]) & (ident[i] != ident[j]) & (rank[i] - rank[j] <= window) & (rank[j] < (own[j] + 1) * task_rows)
            i, j = i[meet], j[meet]
            terms, numbers, called = (_Words.of(batch.column(c)) for c in ("terms", "numbers", "names"))
            term, name = terms.nearness(j, i, 1), called.nearness(j, i, 2)
            number = np.where((numbers.size[i] == 0) | (numbers.size[j] == 0), SILENT, np.where(numbers.meet(j, i), EQUAL, DIFFERENT))
            heard, read = (((n[i] > 0) & (n[j] > 0)).astype(np.int64) for n in (pc.list_value_length(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("said", "called")))
            close = ((EQUAL <= term) & (term <= NEAR)) | ((EQUAL <= name) & (name <= NEAR))
            pattern = (((term * 4 + number) * 4 + name) * 2 + heard) * 2 + read
            out = close | (number == EQUAL) | asked[pattern]
            apart += np.bincount(pattern[~out], minlength=len(_PATTERNS))
            # once a batch
            pairs = np.flatnonzero(out)
            pairs = pairs[np.unique(np.minimum(ident[i], ident[j])[pairs] * batch.num_rows + np.maximum(ident[i], ident[j])[pairs], return_index=True)[1]]
            i, j, close = i[pairs], j[pairs], close[pairs]
            ids = batch.column("id")
            less = pc.less(ids.take(pa.array(j)), ids.take(pa.array(i))).to_numpy(zero_copy_only=False)
            ends = [np.where(less, j, i), np.where(less, i, j)]
            columns = [batch.column(c).take(pa.array(e)) for c in ("id", "source") for e in ends]
            columns += [pa.array(v[pairs], pa.int32()) for v in (term, number, name)]
            columns += [batch.column(c).take(pa.array(e, mask=~close)).cast(pa.list_(pa.int32())) for c in ("said", "called") for e in ends]
            columns += [pa.array(v[pairs] > 0) for v in (heard, read)]
            yield pa.record_batch([*columns, pa.array(np.ones(len(pairs), dtype=np.int64))], names=_PAIR)
        yield batch_of([(None, None, None, None, *p[:3], *_NO_WORDS, *p[3:], n) for p, n in zip(_PATTERNS, apart.tolist(), strict=True) if n])

    blocks = max(1, -(-total // task_rows))
    return placed.select(*names).repartitionByRange(min(blocks, 20_000), "block").sortWithinPartitions("block", "rank").mapInArrow(compare, result)


def window_pairs(rows: DataFrame, window: int = WINDOW, task_rows: int = TASK_ROWS) -> DataFrame:
    """All pairs of different sources within ``window`` places of an order, with their fields compared.

    Pairs that are near in a rare word or a name carry their common words (said_1,
    said_2, called_1, called_2); the others have nulls there. Rows get their exact rank
    over all partitions; blocks of ``task_rows`` ranks with the next ``window`` ranks
    repeated are compared apart, so no pair is lost between tasks and no task holds a
    whole order.
    """
    return _window_rows(_placed(rows), window, task_rows, None).dropDuplicates(["id_1", "id_2"]).filter("id_1 IS NOT NULL").drop("heard", "read", "n")


class _Codes:
    """A column of lists of codes as arrays."""

    def __init__(self, column: pa.ListArray) -> None:
        self.codes = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size

    def at(self, k: int) -> np.ndarray:
        return self.codes[self.start[k] : self.start[k] + self.size[k]]


def _together(pairs: DataFrame, a: str, b: str, size: int) -> np.ndarray:
    """How often common word i of one side meets common word j of the other; size x size, the vocabulary's bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((size, size + 1), dtype=np.int64)
        for batch in batches:
            x, y = _Codes(batch.column(a)), _Codes(batch.column(b))
            every = np.arange(batch.num_rows)
            for part, _, p, q in _crossed(x, every, y, every):
                for one, other in ([(x.codes[p], y.codes[q])] if part is None else [(np.repeat(x.at(k), y.size[k]), np.tile(y.at(k), x.size[k])) for k in part.tolist()]):
                    keys, n = np.unique(one * size + other, return_counts=True)
                    i, j = np.divmod(keys, size)
                    counts[i, j] += n
                    counts[j, i] += n
            for side in (x, y):
                counts[:, size] += np.bincount(side.codes, minlength=size)
        i, j = np.nonzero(counts)
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(np.where(j == size, -1, j), pa.int32()), pa.array(counts[i, j], pa.int64())], names=["i", "j", "n"])

    rows = pairs.select(a, b).mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((size, size + 1))
    for r in rows:
        out[r["i"], r["j"]] = r["n"]
    return out


def associations(met: np.ndarray, base: np.ndarray) -> np.ndarray:
    """How much likelier than by chance word j stands on the other side of a match if word i stands on this one; 0..1."""
    given = met[:, :-1] / np.maximum(met[:, -1:], 1.0)
    return np.clip((given - base) / np.maximum(1 - base, 1e-6), 0, 1)


def agreement(x: list[int], y: list[int], link: list[list[float]], weight: list[float]) -> float:
    """How far the common words of two sides stand for each other, weighed by rarity; -1 if one side has none."""
    if not x or not y:
        return -1.0
    forth = back = wide = deep = 0.0
    for i in x:
        row, w = link[i], weight[i]
        forth += w * max([row[j] for j in y])
        wide += w
    for j in y:
        row, w = link[j], weight[j]
        back += w * max([row[i] for i in x])
        deep += w
    return max(forth / wide, back / deep)


def agreements(x: _Codes, y: _Codes, link: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``agreement`` of the lists of two columns, row by row; sums run in its order, so values are the same to the last bit."""
    every = np.arange(len(x.size))
    out = np.full(len(every), -1.0)
    large: list[int] = []
    shares = []
    for side, other in ((x, y), (y, x)):
        best = np.zeros(len(side.codes))
        for part, _, p, q in _crossed(side, every, other, every):
            if part is not None:
                large = part.tolist()
                continue
            runs = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            best[p[runs]] = np.maximum.reduceat(link[side.codes[p], other.codes[q]], runs)
        row, w = np.repeat(every, side.size), weight[side.codes]
        with np.errstate(invalid="ignore"):
            shares.append(np.bincount(row, weights=w * best, minlength=len(every)) / np.bincount(row, weights=w, minlength=len(every)))
    both = (x.size > 0) & (y.size > 0)
    out[both] = np.maximum(*shares)[both]
    for k in large:
        out[k] = agreement(x.at(k).tolist(), y.at(k).tolist(), link, weight)
    return out


_BINS = np.array([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])


def _bin(v: np.ndarray) -> np.ndarray:
    return np.where(v < 0, 0, np.searchsorted(_BINS, v, side="right"))


#: The compared fields, with the number of values each can have; 0 is always "nothing said".
FIELDS = {"terms": 4, "numbers": 4, "names": 4, "said": len(_BINS) + 1, "called": len(_BINS) + 1}
#: Log-odds from which learning starts, and which stand where too few pairs were seen to learn from.
START = {
    "terms": (0.0, 6.0, 1.5, -5.0), "numbers": (0.0, 4.0, 0.0, -6.0), "names": (0.0, 2.0, 1.2, -2.5),
    "said": (0.0, *np.linspace(-3, 3, len(_BINS))), "called": (0.0, *np.linspace(-1.2, 1.2, len(_BINS))),
}
#: Log-odds of a candidate pair before anything is compared, to start from.
PRIOR = -0.5
#: Candidate pairs from which weights are learned at all.
LEARN_FROM = 400


def rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest sequence that never falls, by pooling neighbours out of order."""
    pools: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist(), strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            (a, x, m), (b, y, n) = pools[-2:]
            pools[-2:] = [[(a * x + b * y) / (x + y), x + y, m + n]]
    return np.repeat([v for v, _, _ in pools], [int(n) for *_, n in pools])


def learn_weights(patterns: dict[tuple[int, ...], float], tolerance: float = 1e-6, most: int = 1000) -> tuple[float, dict[str, list[float]]]:
    """(prior, log-odds by field and value) of a mixture of matches and others over agreement patterns.

    Expectation and maximisation in turn from START until the likelihood stands still
    (an error after ``most`` rounds): fields agree independently within either class,
    and a field on which a side is silent says nothing. More agreement never counts
    less: values out of order share their weight. Patterns number at most the product
    of FIELDS.
    """
    keys = np.array(sorted(patterns), dtype=int).reshape(-1, len(FIELDS))
    n = np.array([patterns[tuple(k)] for k in keys.tolist()], dtype=float)
    weights = {f: np.array(v, dtype=float) for f, v in START.items()}
    prior, last = PRIOR, -np.inf
    if n.sum() < LEARN_FROM:
        return prior, {f: w.tolist() for f, w in weights.items()}
    for _ in range(most):
        score = prior + sum(weights[f][keys[:, i]] for i, f in enumerate(FIELDS))
        match = 1 / (1 + np.exp(-score))
        yes, no = n * match, n * (1 - match)
        prior = math.log((yes.sum() + 1) / (no.sum() + 1))
        gain = 0.0
        for i, (f, size) in enumerate(FIELDS.items()):
            p, q = (np.bincount(keys[:, i], weights=w, minlength=size)[1:] for w in (yes, no))
            shared = (p + q + 1) / (p + q + 1).sum()
            p, q = p / max(p.sum(), 1) + 2 * shared / max(p.sum(), 1), q / max(q.sum(), 1) + 2 * shared / max(q.sum(), 1)
            both = p + q
            # the three kinds count down from equal to different, grades count up
            p = (rising(p / both, both) if size > 4 else rising((p / both)[::-1], both[::-1])[::-1]) * both
            q = both - p
            p, q = p / p.sum(), q / q.sum()
            weights[f] = np.r_[0.0, np.log(p / q)]
            seen = keys[:, i] > 0
            at = keys[seen, i] - 1
            gain += float((yes[seen] * np.log(p[at])).sum() + (no[seen] * np.log(q[at])).sum())
        if abs(gain - last) <= tolerance * abs(gain):
            break
        last = gain
    else:
        raise RuntimeError(f"the weights of matching still move after {most} rounds")
    return prior, {f: w.tolist() for f, w in weights.items()}


def score_pairs(rows: DataFrame, records: DataFrame, said: dict[str, int], called: dict[str, int], n: int, least: float = 0.75, window: int = WINDOW) -> DataFrame:
    """(id_1, id_2, source_1, source_2, confidence) of all pairs within a window, or sharing a rare word while a side says no number, that can reach ``least``.

    Pairs near in a rare word and equal in a number are sure enough to learn which
    common words stand for each other. Weights are learned from all pairs; common words
    count as silent there unless a rare word or name is near, and pairs that agree in
    no field are only counted, once an order. Of the pairs without a near word, those
    are compared in full whose fields, with the best agreement of common words there
    is, could still reach ``least``; if pairs that agree in no field are among them,
    the windows are read again for these.
    """
    # pairs that are silent on rare words and numbers, not on the rest, are kept at once: they may well reach it
    open_ = {(SILENT, SILENT, name, True, read) for name in (SILENT, DIFFERENT) for read in (True, False)}
    placed = _placed(rows)
    found = materialize(_window_rows(placed, window, TASK_ROWS, open_).unionByName(_silent_rows(rows, window)))
    # a pair's rows are equal in all columns, and whole rows are told apart without a sort
    pairs = materialize(found.filter("id_1 IS NOT NULL").distinct())
    near, far = pairs.filter("said_1 IS NOT NULL"), pairs.filter("said_1 IS NULL")
    sure = near.filter(F.col("terms").isin(EQUAL, NEAR) & (F.col("numbers") == EQUAL))
    vocab = [_descriptive(said), sorted(called)]
    counts = [np.array([d[w] for w in v], dtype=float) if v else np.zeros(0) for d, v in ((said, vocab[0]), (called, vocab[1]))]
    weights = [np.log(np.maximum(n / np.maximum(c, 1), 1.0001)) for c in counts]
    sides = (("said_1", "said_2"), ("called_1", "called_2"))
    links = []
    for (a, b), c in zip(sides, counts, strict=True):
        met = _together(sure, a, b, len(c)) if len(c) else np.zeros((0, 1))
        link = associations(met, c / max(n, 1))
        links.append(link if met.sum() > 200 else np.eye(len(c)))
    kept = ["id_1", "id_2", "source_1", "source_2", "terms", "numbers", "names"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [pa.array(_bin(agreements(_Codes(batch.column(a)), _Codes(batch.column(b)), link, w)).astype(np.int32)) for (a, b), link, w in zip(sides, links, weights, strict=True)]
            yield pa.record_batch([*[batch.column(c) for c in kept], *bins], names=[*kept, "said", "called"])

    kind = pairs.schema["id_1"].dataType.simpleString()
    schema = f"id_1 {kind}, id_2 {kind}, {_CODED}, said int, called int"
    binned = materialize(near.mapInArrow(run, schema))
    # each at most the product of FIELDS
    patterns = Counter({tuple(r[f] for f in FIELDS): r["n"] for r in binned.groupBy(*FIELDS).agg(F.count(F.lit(1)).alias("n")).collect()})
    apart = found.filter("id_1 IS NULL").groupBy("terms", "numbers", "names", "heard", "read").agg(F.sum("n").alias("n")).collect()
    for r in [*far.groupBy("terms", "numbers", "names").agg(F.count(F.lit(1)).alias("n")).collect(), *apart]:
        patterns[r["terms"], r["numbers"], r["names"], 0, 0] += r["n"]
    prior, odds = learn_weights(patterns)
    logit = math.log(least / (1 - least)) if 0 < least < 1 else -math.inf
    most = {f: max(odds[f]) for f in ("said", "called")}
    missed = {
        (r["terms"], r["numbers"], r["names"], r["heard"], r["read"]) for r in apart
        if prior + odds["terms"][r["terms"]] + odds["numbers"][r["numbers"]] + odds["names"][r["names"]] + most["said"] * r["heard"] + most["called"] * r["read"] >= logit
    }
    if missed:
        again = _window_rows(placed, window, TASK_ROWS, missed).filter("id_1 IS NOT NULL AND said_1 IS NULL AND numbers <> 1")
        far = far.unionByName(materialize(again.distinct()))
    base = F.lit(prior) + sum((_column(F.col(f), odds[f]) for f in ("terms", "numbers", "names")), F.lit(0.0))
    best = F.col("heard").cast("double") * most["said"] + F.col("read").cast("double") * most["called"]
    chance = far.filter(base + best >= logit).select(*kept)
    own = lambda i: records.select(F.col("id").alias(f"id_{i}"), F.col("said").alias(f"said_{i}"), F.col("called").alias(f"called_{i}"))
    others = chance.join(own(1), "id_1").join(own(2), "id_2").select(*kept, "said_1", "said_2", "called_1", "called_2").mapInArrow(run, schema)
    score = base + _column(F.col("said"), odds["said"]) + _column(F.col("called"), odds["called"])
    return binned.unionByName(others).select("id_1", "id_2", "source_1", "source_2", (1 / (1 + F.exp(-score))).alias("confidence"))


def _column(c, values):
    out = F.lit(0.0)
    for i, v in enumerate(values):
        out = F.when(c == i, float(v)).otherwise(out)
    return out


def assign_edges(left: np.ndarray, right: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which edges form the one-to-one assignment of greatest total weight; ends are numbered from 0.

    Left ends are placed one after the other along cheapest paths over the edges, with
    prices on both ends that certify the optimum; an end whose price falls to 0 stays
    alone. Weights count to nine decimals, as integers, so ties are exact.
    """
    gain = np.rint(np.asarray(weight, dtype=float) * 1e9).astype(np.int64)
    order = np.lexsort((-gain, left))
    lf, rt, w = np.asarray(left)[order], np.asarray(right)[order], gain[order]
    n, m = (int(lf.max()) + 1, int(rt.max()) + 1) if len(lf) else (0, 0)
    start = np.searchsorted(lf, np.arange(n + 1))
    up, vp = [0] * n, [0] * m
    mate_l, mate_r = [-1] * n, [-1] * m
    rows = [None] * n

    def row(i: int) -> list[tuple[int, int, int]]:
        if rows[i] is None:
            rows[i] = [(e, r, g) for e, r, g in zip(range(int(start[i]), int(start[i + 1])), rt[start[i] : start[i + 1]].tolist(), w[start[i] : start[i + 1]].tolist(), strict=True) if g > 0]
        return rows[i]

    for i in range(n):
        up[i] = max((g - vp[r] for _, r, g in row(i)), default=0)
        if up[i] <= 0:
            up[i] = 0
            continue
        far_l, far_r, back = {i: 0}, {}, {}
        stop, lone, free = up[i], i, -1
        # free ends first among equally near ones
        heap = [(up[i] + vp[r] - g, mate_r[r] >= 0, r, e) for e, r, g in row(i) if up[i] + vp[r] - g < stop]
        heapq.heapify(heap)
        while heap:
            d, taken, r, e = heapq.heappop(heap)
            if d >= stop:
                break
            if r in far_r:
                continue
            far_r[r], back[r] = d, e
            if not taken:
                stop, free = d, r
                break
            k = int(lf[mate_r[r]])
            far_l[k] = d
            if d + up[k] < stop:
                stop, lone = d + up[k], k
            for e2, r2, g in row(k):
                d2 = d + up[k] + vp[r2] - g
                if d2 < stop and r2 not in far_r:
                    heapq.heappush(heap, (d2, mate_r[r2] >= 0, r2, e2))
        for k, d in far_l.items():
            up[k] -= max(0, stop - d)
        for r, d in far_r.items():
            vp[r] += max(0, stop - d)
        if free < 0:
            if lone == i:
                continue
            free = int(rt[mate_l[lone]])
            mate_l[lone] = -1
        r = free
        while True:
            e = back[r]
            k = int(lf[e])
            before, mate_l[k], mate_r[r] = mate_l[k], e, e
            if k == i:
                break
            r = int(rt[before])
    chosen = np.zeros(len(lf), dtype=bool)
    chosen[order[[e for e in mate_l if e >= 0]]] = True
    return chosen


def best_assignment(weight: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of a one-to-one assignment with the greatest total weight; zero weights pair nothing."""
    left, right = np.nonzero(weight > 0)
    chosen = assign_edges(left, right, weight[left, right])
    return list(zip(left[chosen].tolist(), right[chosen].tolist(), strict=True))


def auction(edges: DataFrame, step: float = 1e-3, max_rounds: int = 500) -> DataFrame:
    """One-to-one edges (l, r, w) within ``step`` a pair of the greatest total weight, across tasks.

    Each round every free left end bids for its best right end by the margin to its
    second best; a right end goes to its highest bidder. Equal gains are told apart by
    a hash of both ends, so tied ends bid for different ones. Only ends with positive
    profit bid. If bids are left after ``max_rounds``, that is an error: what is owned
    by then is no assignment of the kind promised.
    """
    edges = materialize(edges)
    price = edges.select("r").distinct().withColumn("p", F.lit(0.0)).withColumn("owner", F.lit(None).cast("string"))
    price = materialize(price)
    for _ in range(max_rounds):
        taken = price.filter("owner IS NOT NULL").select(F.col("owner").alias("l"))
        free = edges.join(taken, "l", "left_anti").join(price.select("r", "p"), "r").withColumn("gain", F.round(F.col("w") - F.col("p"), 9)).filter("gain > 0")
        top = free.groupBy("l").agg(F.max(F.struct("gain", F.xxhash64("l", "r").alias("h"), "r")).alias("best"))
        second = free.join(top.select("l", F.col("best.r").alias("r")), ["l", "r"], "left_anti").groupBy("l").agg(F.max("gain").alias("second"))
        bids = top.join(second, "l", "left").select(F.col("best.r").alias("r"), "l", (F.col("best.gain") - F.coalesce("second", F.lit(0.0)) + step).alias("up"))
        won = materialize(bids.groupBy("r").agg(F.max(F.struct("up", F.xxhash64("l").alias("h"), "l")).alias("b")).select("r", F.col("b.up").alias("up"), F.col("b.l").alias("new")))
        if won.isEmpty():
            break
        price = materialize(price.join(won, "r", "left").select("r", (F.col("p") + F.coalesce("up", F.lit(0.0))).alias("p"), F.coalesce("new", "owner").alias("owner")))
    else:
        raise RuntimeError(f"bids are left after {max_rounds} rounds of the auction")
    return edges.join(price.filter("owner IS NOT NULL").select("r", F.col("owner").alias("l")), ["l", "r"])


def assign(scored: DataFrame, least: float = 0.75, group_pairs_most: int = GROUP_PAIRS) -> DataFrame:
    """The pairs of a one-to-one assignment between any two sources with the greatest total confidence.

    Only pairs of at least ``least`` confidence count. Rivals are grouped; a group of up
    to ``group_pairs_most`` pairs is solved exactly in one task, a larger one is
    auctioned, within the auction's step a pair of the greatest total.
    """
    kept = materialize(scored.filter(F.col("confidence") >= least))
    first = F.col("source_1") < F.col("source_2")
    # the smaller id is not always of the same source, so sides are told by source
    sides = F.concat_ws("\x01", F.least("source_1", "source_2"), F.greatest("source_1", "source_2"))
    end = lambda c: F.concat_ws("\x01", sides, c.cast("string"))
    ends = kept.select("id_1", "id_2", "confidence", end(F.when(first, F.col("id_1")).otherwise(F.col("id_2"))).alias("l"), end(F.when(first, F.col("id_2")).otherwise(F.col("id_1"))).alias("r"))
    degree = ends.select(F.explode(F.array("l", "r")).alias("node")).groupBy("node").count()
    alone = materialize(degree.filter("count = 1").select("node"))
    lone = ends.join(alone.withColumnRenamed("node", "l"), "l", "left_semi").join(alone.withColumnRenamed("node", "r"), "r", "left_semi")
    rivals = materialize(ends.join(lone.select("l", "r"), ["l", "r"], "left_anti").select("l", "r", "id_1", "id_2", "confidence"))
    lone = lone.select("id_1", "id_2", "confidence")
    if rivals.isEmpty():
        return lone
    groups = group_pairs(rivals, "l", "r")
    tied = materialize(rivals.join(groups.select(F.col("node").alias("l"), "root"), "l"))
    large = materialize(tied.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_pairs_most).select("root"))

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by([("l", "ascending"), ("r", "ascending")])
        l, r = (table.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("l", "r"))
        return table.filter(pa.array(assign_edges(l, r, table.column("confidence").to_numpy()))).select(["id_1", "id_2", "confidence"])

    kind = kept.schema["id_1"].dataType.simpleString()
    exact = tied.join(large, "root", "left_anti").groupBy("root").applyInArrow(solve, f"id_1 {kind}, id_2 {kind}, confidence double")
    out = lone.unionByName(exact)
    if not large.isEmpty():
        apart = materialize(tied.join(large, "root", "left_semi"))
        won = auction(apart.select("l", "r", F.col("confidence").alias("w")))
        out = out.unionByName(apart.join(won.select("l", "r"), ["l", "r"], "left_semi").select("id_1", "id_2", "confidence"))
    return out


def match_entities(resources: DataFrame, labels: DataFrame, schemes: list[str], least: float = 0.75, window: int = WINDOW) -> DataFrame:
    """(id_1, id_2, confidence): records of two different schemes that describe the same thing, id_1 < id_2 as text.

    A record matches at most one record of each other scheme. Records without words in
    definition and labels match nothing; an empty table gives an empty result.
    """
    texts = materialize(source_records(resources, labels, schemes))
    n = texts.count()
    said, called = common_words(texts, "said", n), common_words(texts, "called", n)
    # numbers in the order of ids stand for them until the end
    ranked = with_rank(materialize(texts.mapInArrow(_split(said, called), _RECORD)), ["id"], "_n")
    names = materialize(ranked.select(F.col("_n").alias("n"), "id"))
    records = materialize(ranked.drop("id").withColumnRenamed("_n", "id"))
    scored = score_pairs(materialize(sort_rows(records)), records, said, called, n, least, window)
    chosen = assign(scored, least)
    own = lambda i: names.select(F.col("n").alias(f"n_{i}"), F.col("id").alias(f"id_{i}"))
    numbered = chosen.select(F.col("id_1").alias("n_1"), F.col("id_2").alias("n_2"), "confidence")
    return numbered.join(own(1), "n_1").join(own(2), "n_2").select("id_1", "id_2", "confidence")
