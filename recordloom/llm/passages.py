"""Word passages that repeat across documents, by suffix trees over partitions of suffixes.

Only suffixes at anchors are kept: of every window of 50 words the 8-word prefix with the
smallest hash. Equal windows have equal anchors, so anchors that share their prefix with no
other document are done. The others are partitioned by prefix into groups that fit memory;
each bundle of groups gets a suffix tree to the right and one (reversed) to the left of the
anchors, and a window is a pair of nodes, one in each. Prefixes of too many anchors are
lengthened to whole windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import materialize
from .words import WordHash, blank_words, slices, utf8

WINDOW, PREFIX = 50, 8
REACH = WINDOW - PREFIX  # places an anchor can stand behind the start of its window
GROUP_ROWS = 20_000  # anchors of one prefix that one tree takes; more are split by whole windows
BUNDLE_ROWS = 5_000  # anchors of several prefixes that go into one tree


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, prefix hashes) of the anchors of all windows of a document's word hashes."""
    if len(hashes) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.zeros(len(hashes) - PREFIX + 1, np.uint64)
    for j in range(PREFIX):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + len(grams)]
    grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    least, place, width = grams, np.arange(len(grams)), 1
    while width < REACH + 1:  # least over `width` prefixes in a row, the leftmost of equals
        step = min(width, REACH + 1 - width)
        right = least[step:] < least[:-step]
        place = np.where(right, place[step:], place[:-step])
        least = np.where(right, least[step:], least[:-step])
        width += step
    chosen = place[np.concatenate([[True], place[1:] != place[:-1]])]
    return chosen, grams[chosen].view(np.int64)


def _by_prefix(place: np.ndarray, gram: np.ndarray) -> list[dict]:
    """One entry per prefix of a document, with all its places."""
    order = np.argsort(gram, kind="stable")
    h, place = gram[order], place[order]
    cuts = np.flatnonzero(h[1:] != h[:-1]) + 1
    firsts = np.concatenate([[0], cuts]) if len(h) else cuts
    return [{"h": int(h[i]), "at": part.tolist()} for i, part in zip(firsts, np.split(place, cuts))]


def _first_pass(batches):
    number = WordHash()
    for batch in slices(batches):
        out = {"n": [], "sha": [], "places": []}
        for text in utf8(batch.column(1)):
            words = blank_words(text)
            place, gram = anchors(np.array([number[w] for w in words], dtype=np.uint64))
            out["n"].append(len(words))
            out["sha"].append(hashlib.sha256(b" ".join(words)).hexdigest())
            out["places"].append(_by_prefix(place, gram))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(out["n"], pa.int64()),
                pa.array(out["sha"], pa.string()),
                pa.array(out["places"], pa.list_(pa.struct([("h", pa.int64()), ("at", pa.list_(pa.int64()))]))),
            ],
            names=["doc_id", "n_words", "sha", "places"],
        )


_CONTEXT = "h long, doc_id long, pos long, before long, context binary, hot boolean"


def distinct_contexts(words: list[bytes], hits: list[dict]) -> dict[tuple, list[int]]:
    """(prefix hash, hot, words before, context) -> places of a document with that context.

    A context is the words around an anchor that windows with it can hold. Text that goes
    on repeating has few different ones.
    """
    found: dict[tuple, list[int]] = {}
    for hit in hits:
        for at in hit["at"]:
            first = max(0, at - REACH)
            context = b" ".join(words[first : at + WINDOW])
            found.setdefault((hit["h"], hit["hot"], at - first, context), []).append(at)
    return found


def _contexts(batches):
    """One row per distinct context of a document, at its first place."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    names = ["h", "doc_id", "pos", "before", "context", "hot"]
    for batch in slices(batches, 64):
        rows = []
        for doc, text, sha, hits in zip(
            batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        ):
            words = blank_words(text)
            if hashlib.sha256(b" ".join(words)).hexdigest() != sha:
                continue  # another row with this id
            for (h, hot, before, context), places in distinct_contexts(words, hits).items():
                rows.append((h, doc, places[0], before, context, hot))
        for at in range(0, len(rows), 2000):
            columns = zip(*rows[at : at + 2000])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


class Tree:
    """Suffix tree of rows of word numbers, as sorted rows and their common prefix lengths."""

    def __init__(self, rows: np.ndarray):
        as_text = np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()
        self.order = np.argsort(as_text, kind="stable")
        near = rows[self.order]
        same = near[1:] == near[:-1]
        self.common = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))

    def node(self, depth: int) -> np.ndarray:
        """For each row the node that holds all rows with the same first `depth` words."""
        out = np.zeros(len(self.order), np.int64)
        out[self.order[1:]] = np.cumsum(self.common < depth)
        return out


def repeated_windows(docs: np.ndarray, before: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """Per anchor a bit mask: bit o is set if the window that starts o words before the anchor
    also stands in a document with a smaller id."""
    number: dict[bytes, int] = {}
    right = np.zeros((len(contexts), WINDOW), np.uint32)
    left = np.zeros((len(contexts), REACH), np.uint32)
    after = np.zeros(len(contexts), np.int64)
    for i, context in enumerate(contexts):
        ids = [number.setdefault(w, len(number) + 1) for w in context.split()]
        b = before[i]
        after[i] = len(ids) - b
        right[i, : after[i]] = ids[b:]
        left[i, :b] = ids[:b][::-1]
    by_doc = np.argsort(docs, kind="stable")
    tree_right, tree_left = Tree(right), Tree(left)
    masks = np.zeros(len(contexts), np.int64)
    for o in range(REACH + 1):
        valid = by_doc[(before[by_doc] >= o) & (after[by_doc] >= WINDOW - o)]
        if len(valid) < 2:
            continue
        node = tree_right.node(WINDOW - o)[valid] * (len(contexts) + 1) + tree_left.node(o)[valid]
        _, first, which = np.unique(node, return_index=True, return_inverse=True)
        later = docs[valid] > docs[valid][first[which]]
        masks[valid[later]] |= np.int64(1) << np.int64(o)
    return masks


def _trees(batches):
    """Masks of anchors that arrive in order of their prefix, one bundle of whole prefixes at a time."""

    def bundle(table):
        docs = table.column("doc_id").to_numpy()
        masks = repeated_windows(docs, table.column("before").to_numpy(), table.column("context").to_pylist())
        hit = np.flatnonzero(masks)
        return pa.RecordBatch.from_arrays(
            [pa.array(docs[hit]), pa.array(table.column("pos").to_numpy()[hit]), pa.array(masks[hit])],
            names=["doc_id", "pos", "mask"],
        )

    held: list[pa.RecordBatch] = []
    n = 0
    for batch in slices(batches, 1000):
        held.append(batch)
        n += batch.num_rows
        if n >= BUNDLE_ROWS:
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1], "left"))  # the last prefix may go on
            if cut:
                yield bundle(table.slice(0, cut))
                held, n = table.slice(cut).combine_chunks().to_batches(), len(h) - cut
    if n:
        yield bundle(pa.Table.from_batches(held))


def _windows(batches):
    """One row per window of an anchor whose prefix is too frequent: its words' digest."""
    for batch in slices(batches, 500):
        rows = {"window": [], "doc_id": [], "pos": [], "o": []}
        for doc, at, before, context in zip(
            *(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("doc_id", "pos", "before", "context"))
        ):
            words = context.split()
            for o in range(min(before, REACH) + 1):
                if len(words) - before >= WINDOW - o:
                    start = before - o
                    rows["window"].append(hashlib.md5(b" ".join(words[start : start + WINDOW])).digest())
                    rows["doc_id"].append(doc)
                    rows["pos"].append(at)
                    rows["o"].append(o)
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))


def _covered(places: np.ndarray, masks: np.ndarray, n: int) -> np.ndarray:
    """True for the words inside a repeated window."""
    edge = np.zeros(n + 1, np.int64)
    for o in range(REACH + 1):
        starts = places[(masks >> o) & 1 == 1] - o
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _remove(batches):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = ["edited", "edited_sha", "removed", "kept", "kept_text"]
    for batch in slices(batches):
        out = []
        for doc, text, sha, hits, masks in zip(
            batch.column(0).to_pylist(), utf8(batch.column(1)), *(batch.column(i).to_pylist() for i in (2, 3, 4))
        ):
            words = blank_words(text)
            if hashlib.sha256(b" ".join(words)).hexdigest() != sha:
                continue
            found: dict[int, int] = {}
            for m in masks:
                found[m["pos"]] = found.get(m["pos"], 0) | m["mask"]
            same = [(p, found[at[0]]) for at in distinct_contexts(words, hits).values() if at[0] in found for p in at]
            gone = _covered(*np.array(same, dtype=np.int64).T, len(words))
            kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
            out.append((doc, sha, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def remove_repeats(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", group_rows: int = GROUP_ROWS, with_text: bool = False
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per input row; optionally `kept_text`.

    A word goes if a window of 50 words around it also starts in a document with a smaller
    id; windows are judged on the input. `kept_text` is the kept words joined by one blank, null
    where nothing was removed. Whole copies of an earlier document are settled by their digest.
    Null text has no words. A row with a null id neither loses words nor takes any; rows that
    share an id never take words from each other. Other columns are ignored; an empty table
    gives no rows.
    """
    own = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(
        own.mapInArrow(_first_pass, "doc_id long, n_words long, sha string, places array<struct<h:long,at:array<long>>>"), "passages"
    )
    named = rows.filter("doc_id is not null")
    first = named.groupBy("sha").agg(F.min("doc_id").alias("first"))
    # one document per word sequence goes on: the one with the smallest id
    originals = named.filter(F.size("places") > 0).groupBy("sha").agg(
        F.min("doc_id").alias("doc_id"), F.min_by("places", "doc_id").alias("places")
    )
    suffixes = materialize(originals.select("doc_id", "sha", F.inline("places")), "anchors")
    shared = suffixes.groupBy("h").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum(F.size("at")).alias("n")
    )
    # written, so that adaptive execution can split the join below at a frequent prefix
    shared = materialize(shared.filter("low < high").select("h", (F.col("n") > group_rows).alias("hot")), "shared")
    hits = (
        suffixes.join(shared, "h")
        .groupBy("doc_id", "sha")
        .agg(F.collect_list(F.struct("h", "at", "hot")).alias("hits"))  # a part of one document's words
    )
    touched = materialize(own.join(hits, "doc_id").select("doc_id", "text", "sha", "hits"), "touched")
    contexts = touched.mapInArrow(_contexts, _CONTEXT)
    bundles = contexts.filter("not hot").repartition("h").sortWithinPartitions("h")
    masks = bundles.mapInArrow(_trees, "doc_id long, pos long, mask long")
    if not touched.filter(F.exists("hits", lambda x: x["hot"])).isEmpty():
        windows = contexts.filter("hot").mapInArrow(_windows, "window binary, doc_id long, pos long, o long")
        least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
        later = windows.join(least, "window").filter("doc_id > least").select(
            "doc_id", "pos", F.expr("shiftleft(1L, int(o))").alias("mask")
        )
        masks = masks.unionByName(later)
    by_doc = masks.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "mask")).alias("masks"))
    edited = touched.join(by_doc, "doc_id").select("doc_id", "text", "sha", "hits", "masks").mapInArrow(
        _remove, "edited long, edited_sha string, removed long, kept string, kept_text string"
    )
    if not with_text:
        edited = edited.drop("kept_text")
    nothing = hashlib.sha256(b"").hexdigest()
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= WINDOW)
    same = (F.col("doc_id") == F.col("edited")) & (F.col("sha") == F.col("edited_sha"))
    joined = rows.drop("places").join(first, "sha", "left").join(edited, same, "left")
    columns = [
        F.col("doc_id"),
        F.col("n_words"),
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))
    return joined.select(*columns)
