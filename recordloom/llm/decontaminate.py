"""Benchmark passages in documents, by suffix arrays over the documents.

Each batch of documents is a shard: its words that can be part of a match are put into a
suffix array, and every suffix of the benchmark items is binary-searched there. The
benchmark is broadcast in blocks of bounded size; a worker has one of them in memory at a time.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import letter_words, utf8

WINDOW = 10
BLOCK_BYTES = 4_000_000  # benchmark text that is collected and broadcast at once
_PAIR_BITS = 20
_GAP = -1


class ItemIndex:
    """The words, suffixes and windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        words, self.starts, self.lengths, self.owners, self.rest = [], [], [], [], []
        self.ids = []
        for n, (item, text) in enumerate(items):
            own = [number.setdefault(w, len(number)) for w in letter_words(text)]
            need = min(window, len(own))
            self.ids.append(item)
            for i in range(len(own)):  # every suffix; `lengths` 0 where no window starts
                self.starts.append(len(words) + i)
                self.lengths.append(need if i + need <= len(own) else 0)
                self.owners.append(n)
                self.rest.append(len(own) - i)
            words += [*own, _GAP]
        self.shortest = min((n for n in self.lengths if n), default=0)
        self.longest = max(self.rest, default=0)
        as_array = lambda x: np.array(x, dtype=np.int64)
        self.starts, self.lengths = as_array(self.starts), as_array(self.lengths)
        self.owners, self.rest = as_array(self.owners), as_array(self.rest)
        self.words = np.concatenate([as_array(words), np.full(self.longest + 1, _GAP)])
        self.pairs = np.zeros(1 << _PAIR_BITS, dtype=bool)
        a, b = self.words[:-1], self.words[1:]
        self.pairs[_pair(a, b)[(a >= 0) & (b >= 0)]] = True


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * 1_000_003 + b) & ((1 << _PAIR_BITS) - 1)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first `depth` words, by prefix doubling."""
    rank, step = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    while step < depth and rank.max() + 1 < len(words):
        after = np.concatenate([rank[step:] + 1, np.zeros(min(step, len(rank)), np.int64)])[: len(rank)]
        rank = np.unique(rank * (len(words) + 1) + after, return_inverse=True)[1]
        step *= 2
    return np.argsort(rank, kind="stable")


def _common(a, ai, b, bi, most: int) -> np.ndarray:
    """Words that suffixes a[ai:] and b[bi:] share at the start, at most `most`; gaps never match."""
    length = np.zeros(len(ai), dtype=np.int64)
    live = np.arange(len(ai))
    for step in range(most):
        x = a[ai[live] + step]
        live = live[(x == b[bi[live] + step]) & (x >= 0)]
        if not len(live):
            break
        length[live] += 1
    return length


def _insertion(text, order, words, starts, depth: int) -> np.ndarray:
    """Where each suffix words[starts:] belongs in the suffix array (first place)."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(order))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        here, there = starts[open_], order[middle]
        same = _common(words, here, text, there, depth)
        less = text[there + same] < words[here + same]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]


def find_windows(index: ItemIndex, documents: list[list[bytes]]) -> list[tuple]:
    """Per document: (hit intervals, positions in index.ids, longest match, its start, its item)."""
    nothing = ([], [], 0, None, None)
    found = [nothing] * len(documents)
    if not index.shortest:
        return found
    get = index.vocabulary.get
    sizes = np.array([len(d) + 1 for d in documents])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.fromiter(
        (x for d in documents for x in (*map(get, d, repeat(_GAP)), _GAP)), np.int64, begins[-1]
    )
    # runs of words whose neighbours also meet in some item: nothing else can match
    linked = np.zeros(len(ids), dtype=bool)
    linked[1:] = (ids[:-1] >= 0) & (ids[1:] >= 0) & index.pairs[_pair(ids[:-1], ids[1:])]
    run = np.cumsum(~linked)
    lengths = np.bincount(run)
    keep = (ids >= 0) & (lengths[run] >= index.shortest)
    at = np.flatnonzero(keep)
    if not len(at):
        return found
    ends = np.concatenate([run[at][1:] != run[at][:-1], [True]])
    place = np.repeat(np.arange(len(at)), 1 + ends)  # a gap after each run
    gap = np.concatenate([[False], place[1:] == place[:-1]])
    text = np.where(gap, _GAP, ids[at][place])
    where = at[place]
    order = suffix_array(text, index.longest)
    text = np.concatenate([text, np.full(index.longest + 1, _GAP - 1)])
    tests = np.flatnonzero((index.lengths > 0) & np.isin(index.words[index.starts], text))
    if not len(tests):
        return found
    starts, need = index.starts[tests], index.lengths[tests]
    first = _insertion(text, order, index.words, starts, index.longest)
    near = np.concatenate([[0], _common(text, order[:-1], text, order[1:], int(need.max()))])
    # the windows that occur: a suffix beside the insertion point shares the whole window
    beside = np.minimum(first, len(order) - 1)
    before = np.maximum(first - 1, 0)
    hits_after = _common(index.words, starts, text, order[beside], int(need.max())) >= need
    hits_before = _common(index.words, starts, text, order[before], int(need.max())) >= need
    pieces = []
    for depth in np.unique(need[hits_after | hits_before]):
        node = np.cumsum(near < depth)  # suffixes that share `depth` words stand together
        mine = np.flatnonzero((need == depth) & (hits_after | hits_before))
        wanted = node[np.where(hits_after[mine], beside[mine], before[mine])]
        left = np.searchsorted(node, wanted, "left")
        count = np.searchsorted(node, wanted, "right") - left
        test = np.repeat(tests[mine], count)
        slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(left, count)
        pieces.append((test, order[slot]))
    if not pieces:
        return found
    test, place = (np.concatenate(x) for x in zip(*pieces))
    verbatim = np.minimum(
        _common(index.words, index.starts[test], text, place, index.longest), index.rest[test]
    )
    start = where[place]
    owner = np.searchsorted(begins, start, "right") - 1
    by_doc = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.diff(owner[by_doc])) + 1
    for part in np.split(by_doc, cuts):
        d = int(owner[part[0]])
        begin = start[part] - begins[d]
        spans = merged(list(zip(begin.tolist(), (begin + index.lengths[test[part]]).tolist())))
        best = part[np.lexsort((index.owners[test[part]], begin, -verbatim[part]))[0]]
        items = np.unique(index.owners[test[part]]).tolist()
        found[d] = (spans, items, int(verbatim[best]), int(start[best] - begins[d]), int(index.owners[test[best]]))
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint intervals that cover the given ones, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPAN = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
# names that documents are not expected to have
FOUND = T.StructType(
    [
        T.StructField("__bm_words", T.LongType()),
        T.StructField("__bm_spans", T.ArrayType(_SPAN)),
        T.StructField("__bm_items", T.ArrayType(T.StringType())),
        T.StructField("__bm_longest", T.LongType()),
        T.StructField("__bm_start", T.LongType()),
        T.StructField("__bm_item", T.StringType()),
    ]
)
_ARROW = [
    pa.int64(),
    pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])),
    pa.list_(pa.string()),
    pa.int64(),
    pa.int64(),
    pa.string(),
]
SHARD_WORDS = 2_000_000  # words of documents in one suffix array


def _scan(blocks: list, text: str, names: list[str]):
    """One pass over batches that adds what all blocks of items find.

    A shard of documents goes past one block after the other. With several blocks each is
    read from the executor's disk when its turn comes and given up after it.
    """

    def scan(batches):
        for batch in batches:
            out = {n: [] for n in FOUND.names}
            for documents in _shards(utf8(batch.column(names.index(text)))):
                spans, items = [[] for _ in documents], [set() for _ in documents]
                best = [(0, None, None)] * len(documents)
                for block in blocks:
                    index = block.value
                    for d, (hits, owners, length, start, owner) in enumerate(find_windows(index, documents)):
                        if not owners:
                            continue
                        spans[d] = merged(spans[d] + hits)
                        items[d].update(index.ids[i] for i in owners)
                        if length > best[d][0]:
                            best[d] = (length, start, index.ids[owner])
                    if len(blocks) > 1:
                        del index
                        vars(block).pop("_value", None)  # the value that `block.value` would keep
                out["__bm_words"] += [len(words) for words in documents]
                out["__bm_spans"] += [[{"first": a, "end": b} for a, b in s] for s in spans]
                out["__bm_items"] += [sorted(i) for i in items]
                for name, column in zip(("__bm_longest", "__bm_start", "__bm_item"), zip(*best)):
                    out[name] += column
            made = [pa.array(out[n], kind) for n, kind in zip(FOUND.names, _ARROW)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*names, *FOUND.names])

    return scan


def _shards(texts):
    """Word lists of a batch, in shards of bounded size."""
    shard, words = [], 0
    for text in texts:
        shard.append(letter_words(text))
        words += len(shard[-1])
        if words >= SHARD_WORDS:
            yield shard
            shard, words = [], 0
    if shard:
        yield shard


def mark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`docs` with the columns of `FOUND` behind its own, ids in the type of the benchmark's.

    Words, hit intervals (first word, end), ids of items with occurring windows, and the
    longest verbatim match with its first word and item. Items are collected and broadcast in
    blocks of about `block_bytes` of text; the documents are read once for all of them, and a
    worker holds one block at a time. Null text and null items have no words; items without an
    id are ignored; items that repeat an id count once; an empty benchmark marks nothing. Rows
    that repeat are marked one by one.
    """
    items = benchmark.select(F.col(item).alias("id"), F.col(item_text).alias("words"))
    items = items.filter("id is not null and words is not null")
    total = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n_blocks = 1 + total // block_bytes
    spark, names = docs.sparkSession, list(docs.columns)
    block = F.pmod(F.xxhash64("id", "words"), F.lit(n_blocks))
    blocks = []
    for b in range(n_blocks):
        rows = items.filter(block == b).select("id", F.col("id").cast("string").alias("name"), "words").collect()
        texts = [(name, words.encode()) for _, words, name in sorted((r["id"], r["words"], r["name"]) for r in rows)]
        blocks.append(spark.sparkContext.broadcast(ItemIndex(texts, window)))
    schema = T.StructType([*docs.schema.fields, *FOUND.fields])
    found = docs.mapInArrow(_scan(blocks, text, names), schema)
    kind = benchmark.schema[item].dataType.simpleString()
    return found.select(
        *[F.col(f"`{c}`") for c in names],
        "__bm_words",
        "__bm_spans",
        F.col("__bm_items").cast(f"array<{kind}>").alias("__bm_items"),
        "__bm_longest",
        "__bm_start",
        F.col("__bm_item").cast(kind).alias("__bm_item"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match, ...) per row."""
    own = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    found = mark_matches(own, benchmark, **options)
    hit = F.aggregate(
        "__bm_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"]
    )
    ids = F.array_sort(F.transform("__bm_items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        F.col("__bm_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__bm_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("__bm_spans") > 0).alias("contaminated"),
        F.col("__bm_longest").alias("longest_match"),
        F.col("__bm_start").alias("match_start"),
        F.col("__bm_item").alias("match_item"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` without any benchmark window, with their own columns."""
    found = mark_matches(docs, benchmark, **options)
    return found.filter(F.size("__bm_spans") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
