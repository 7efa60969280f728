"""Periodic runs of words by maximal pairs in an LCP-interval tree.

A run with period q is a maximal pair of suffixes q words apart: they share all words up to
the run's end, and the words left of them differ. Suffixes of a batch of documents are sorted by
doubling; a suffix takes part only if an equal stretch stands close enough by for some power of
two, and suffixes are kept apart by region, so the rest costs no more than the sort. The tree of
LCP intervals is then walked bottom-up. Every node keeps its places by the word to their left; when
two children join, each place of the smaller one looks in the other's lists of other left words for
places within a third of the node's depth. Each such pair is a run as it stands: it cannot be
extended. Only multiples of a run's smallest period, which make the same stretch, are dropped.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import blank_words, slices, utf8

TIMES, LEAST = 4, 6  # a run has at least TIMES periods and LEAST words
SHALLOW = 5  # words that the two suffixes of any run share at least: max(LEAST - q, 3 q) over all q
BATCH_WORDS = 150_000  # words sorted together; a longer document is a batch of its own


def _close(shared: int) -> int:
    """The largest period of a run whose two suffixes share up to `shared` words."""
    return shared // (TIMES - 1)


class Suffixes:
    """Suffixes of several documents in word order, by doubling; no order spans two documents."""

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        n = len(words)
        docs = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        self.end = ends[docs]
        self.order = np.argsort(docs * (int(words.max()) + 1) + words, kind="stable")
        key = (docs * (int(words.max()) + 1) + words)[self.order]
        self.levels: list[np.ndarray] = []  # ranks by the first 1, 2, 4, ... words
        self.links = np.zeros(n + 1, np.int64)  # +1 where a close pair begins, -1 where it ends
        self.near = np.zeros(n, bool)
        slots, rank = np.arange(n), np.zeros(n, np.int64)
        step = 1
        while True:
            new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
            firsts = slots[new]
            rank[self.order[slots]] = np.repeat(firsts, np.diff(np.flatnonzero(new), append=len(key)))
            self.levels.append(rank.copy())
            alone = new & np.append(new[1:], True)
            slots = slots[~alone]
            if not len(slots):
                return
            self._mark(slots, rank, step)
            at = self.order[slots]
            further = at + step
            inside = further < self.end[at]
            second = np.where(inside, rank[np.where(inside, further, 0)] + 1, 0)
            key = rank[at] * (n + 1) + second
            sort = np.argsort(key, kind="stable")
            self.order[slots] = at[sort]
            key = key[sort]
            step *= 2

    def _mark(self, slots: np.ndarray, rank: np.ndarray, step: int) -> None:
        """Mark places whose first `step` words stand again close by; equal ones lie in order of place."""
        if 2 * step <= SHALLOW - 1:
            return
        at = self.order[slots]
        gap = at[1:] - at[:-1]
        pair = (rank[at[1:]] == rank[at[:-1]]) & (gap <= _close(2 * step - 1))
        here, there = at[:-1][pair], at[1:][pair]
        self.near[here] = True
        self.near[there] = True
        np.add.at(self.links, here, 1)
        np.add.at(self.links, there, -1)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at two places (different ones) of one document share."""
        shared = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + shared, b + shared
            inside = (x < self.end[a]) & (y < self.end[b])
            x, y = np.where(inside, x, 0), np.where(inside, y, 0)
            shared += np.where(inside & (self.levels[k][x] == self.levels[k][y]), 1 << k, 0)
        return shared


class Node:
    """Places of an LCP interval: all in order, and by the word to their left."""

    __slots__ = ("places", "lists")

    def __init__(self, place: int, left: int):
        self.places = [place]
        self.lists = {left: [place]}


def join(a: Node, b: Node, depth: int, left: list[int], found: dict) -> Node:
    """The union of two children of a node of this depth; their maximal pairs go to `found`."""
    small, large = (a, b) if len(a.places) < len(b.places) else (b, a)
    reach, places, lists = _close(depth), large.places, large.lists
    for own, mine in small.lists.items():
        for place in mine:
            low = bisect_left(places, place - reach)
            high = bisect_right(places, place + reach)
            if low == high:
                continue
            # Close occurrences of so long a stretch stand one period apart. Behind all but the first
            # stands the same word, so there are at most two left words to look up.
            for other in {left[places[low]], left[places[high - 1]]}:
                if other == own:
                    continue
                listed = lists[other]
                for partner in listed[bisect_left(listed, place - reach) : bisect_right(listed, place + reach)]:
                    period = abs(place - partner)
                    length = depth + period
                    if length >= LEAST:
                        key = (min(place, partner), length)
                        if period < found.get(key, length):
                            found[key] = period
    if len(small.places) * 8 < len(places):
        for place in small.places:
            insort(places, place)
    else:
        places += small.places
        places.sort()
    for own, mine in small.lists.items():
        listed = lists.get(own)
        if listed is None:
            lists[own] = mine
        elif len(mine) * 8 < len(listed):
            for place in mine:
                insort(listed, place)
        else:
            listed += mine
            listed.sort()
    return large


def _walk(order: list[int], common: list[int], left: list[int], found: dict) -> None:
    """All maximal pairs of the tree over suffixes in order, bottom-up; `common[i]` belongs to i - 1 and i."""
    open_nodes: list[tuple[int, Node]] = []
    node = Node(order[0], left[order[0]])
    for i in range(1, len(order) + 1):
        depth = common[i] if i < len(order) else 0
        while open_nodes and open_nodes[-1][0] > depth:
            below, other = open_nodes.pop()
            node = join(other, node, below, left, found)
        if depth >= SHALLOW:
            if open_nodes and open_nodes[-1][0] == depth:
                node = join(open_nodes.pop()[1], node, depth, left, found)
            open_nodes.append((depth, node))
        if i < len(order):
            node = Node(order[i], left[order[i]])


def runs_of(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs, by start and period; places count over all documents.

    `words` are the word numbers of the documents one after the other, `ends` where each ends.
    """
    if not len(words):
        return np.zeros((0, 3), np.int64)
    suffixes = Suffixes(words, ends)
    if not suffixes.near.any():
        return np.zeros((0, 3), np.int64)
    order = suffixes.order[suffixes.near[suffixes.order]]
    region = np.cumsum(np.cumsum(suffixes.links[:-1]) == 0)  # the same from a place to one linked over it
    # a region ends with the last place that is linked to: that place itself has no link onward
    region = np.concatenate([[0], region[:-1]])[order]
    order = order[np.argsort(region, kind="stable")]
    region = np.sort(region, kind="stable")
    common = np.zeros(len(order), np.int64)
    common[1:] = np.where(region[1:] == region[:-1], suffixes.common(order[:-1], order[1:]), 0)
    left = np.concatenate([[-1], words[:-1]])
    starts = np.concatenate([[0], ends[:-1]])
    left[starts[starts < len(words)]] = -1
    found: dict[tuple[int, int], int] = {}
    _walk(order.tolist(), common.tolist(), left.tolist(), found)
    runs = np.array([(s, n, q) for (s, n), q in found.items()], np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one blank, of every run only its first period."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    return b" ".join(w for w, g in zip(words, gone.tolist()) if not g)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _documents(texts: list[list[bytes]]):
    """(runs, collapsed text) of documents sorted together."""
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for words in texts for w in words]
    ends = np.cumsum([len(words) for words in texts], dtype=np.int64)
    runs = runs_of(np.array(ids, np.int64), ends)
    cuts = np.searchsorted(runs[:, 0], ends, "left")
    first = start = 0
    for words, end, cut in zip(texts, ends.tolist(), cuts.tolist()):
        own = runs[first:cut] - np.array([start, 0, 0])
        yield own, collapsed(words, own)
        first, start = cut, end


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with n_words, `runs` (array of start, length, period) and `collapsed` (text) instead of the text.

    Words are runs of anything but blank and the control characters 9 to 13, counted from 0. A run
    is a longest stretch of at least 6 words and at least 4 of its smallest periods; runs go by
    start and period. `collapsed` keeps of every run its first period only, joined by one blank.
    Null and empty texts have no words, no runs and an empty `collapsed`. Every row counts for itself,
    so repeated rows and keys do not matter; an empty table gives no rows; columns of the
    three new names are replaced. A task sorts about 150,000 words at a time, or one longer document.
    """
    made = ("n_words", "runs", "collapsed")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in made]
    rows = docs.select(*kept, F.col(f"`{text}`").cast("string").alias("_text"))
    types = ("long", "array<struct<start:long,length:long,period:long>>", "string")
    schema = docs.select(*kept, *[F.lit(None).cast(t).alias(n) for n, t in zip(made, types)]).schema
    names = [f.name for f in schema]

    def run(batches):
        for batch in slices(batches, 500):
            texts = [blank_words(t) for t in utf8(batch.column(batch.num_columns - 1))]
            first, held = 0, 0
            for i, words in enumerate(texts):
                held += len(words)
                if held >= BATCH_WORDS or i == len(texts) - 1:
                    part = texts[first : i + 1]
                    runs, kept_texts = zip(*_documents(part))
                    flat = np.concatenate(runs)
                    offsets = np.cumsum([0, *map(len, runs)], dtype=np.int32)
                    structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *batch.slice(first, len(part)).columns[:-1],
                            pa.array([len(w) for w in part], pa.int64()),
                            pa.ListArray.from_arrays(pa.array(offsets), structs),
                            pa.array(kept_texts, pa.binary()).cast(pa.string()),
                        ],
                        names=names,
                    )
                    first, held = i + 1, 0

    return rows.mapInArrow(run, schema)


def run_digests(rows: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256).

    start, length and period are those of the longest run (ties: smallest start, then period), null
    without runs.
    """
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    top = rows.select(F.col(doc).cast("long").alias("doc_id"), "runs", "collapsed", best.alias("best"))
    period = -F.col("best.p")
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
