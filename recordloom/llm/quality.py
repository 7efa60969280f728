"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints.

The trees are trained here on a bounded sample of labelled documents, flattened into
arrays of nodes, and score whole batches at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import blank_words, slices, utf8

SAMPLE_ROWS = 20_000  # labelled documents the trees are trained on, at most
FOLDS = 5  # parts of the sample, each scored by trees of the others to find the cut
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# statistics the trees see, and the direction in which each may move the score (0: either)
FEATURES = {
    "words_log": 0,
    "mean_word": 0,
    "symbols": -1,
    "dup_lines": -1,
    "repeat_words": -1,
    "distinct_words": 1,
    "upper": 0,
    "digits": 0,
    "marks": -1,
    "top_word": 0,
    "words_per_line": 0,
    "non_ascii": 0,
}
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?*#$%&|<>~^=_@"


def repeated_words(ids: np.ndarray, k: int = REPEAT_WINDOW) -> int:
    """Words inside k-word windows (k a power of 2) that occur twice or more, the first included."""
    if len(ids) <= k:
        return 0
    rank, width = ids, 1
    while width < k:  # ranks of windows twice as long, from pairs of ranks
        pair = rank[:-width] * np.int64(len(ids) + 1) + rank[width:]
        rank, width = np.unique(pair, return_inverse=True)[1], width * 2
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:-k][twice] += 1
    edge[k:][twice] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: bytes | None) -> tuple[list[int], list[float]]:
    """(the base columns, the features) of one text; null has no words."""
    text = text or b""
    words = blank_words(text)
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    blanks = len(text) - sum(map(len, words))
    chars = len(text.decode()) - blanks
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.split()]
    dups = len(lines) - len(set(lines))
    repeats = repeated_words(ids)
    size, count = max(1, len(text)), max(1, n)
    share = lambda drop: (len(text) - len(text.translate(None, drop))) / size
    features = [
        float(np.log1p(n)),
        chars / count,
        symbols / count,
        dups / max(1, len(lines)),
        repeats / count,
        len(number) / count,
        share(_UPPER),
        share(_DIGITS),
        share(_MARKS) * size / count,
        float(np.bincount(ids).max()) / count if n else 0.0,
        n / max(1, len(lines)),
        1 - len(text.decode("ascii", "ignore")) / size,
    ]
    return [n, chars, symbols, dups, repeats], features


@dataclass
class Trees:
    """Flattened trees: node i asks feature[i] <= threshold[i]; leaves lead to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int
    keep_at: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality, for all rows and trees at once."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


def _middles(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Thresholds half way between the values on both sides of each edge."""
    distinct = np.unique(values)
    after = np.searchsorted(distinct, edges, "right")
    return (distinct[np.maximum(after - 1, 0)] + distinct[np.minimum(after, len(distinct) - 1)]) / 2


def train(
    x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2,
    bins: int = 64, min_rows: int = 20, penalty: float = 1.0,
) -> Trees:
    """Boosted trees for a 0/1 label under log loss.

    A split on a constrained feature is taken only if its two sides are ordered the right
    way, and the values below either side stay on their side of the middle, so the score is
    monotonic in each constrained feature.
    """
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    middles = [_middles(x[:, f], e) for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    score = np.full(len(y), np.log(prior / (1 - prior)))
    base = float(score[0])
    nodes: list[list[float]] = []  # feature, threshold, left, right, value

    def leaf_value(g, h, low, high):
        return float(np.clip(-g / (h + penalty), low, high))

    def grow(rows, g, h, level, low, high) -> int:
        me = len(nodes)
        nodes.append([0, np.inf, me, me, 0.0])
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * min_rows:
            for f, cut in enumerate(edges):
                if not len(cut):
                    continue
                b = binned[rows, f]
                n = np.cumsum(np.bincount(b, minlength=len(cut) + 1))[:-1]
                gl = np.cumsum(np.bincount(b, g[rows], len(cut) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], len(cut) + 1))[:-1]
                gr, hr = total_g - gl, total_h - hl
                vl = np.clip(-gl / (hl + penalty), low, high)
                vr = np.clip(-gr / (hr + penalty), low, high)
                loss = lambda gs, hs, v: -(gs * v + 0.5 * (hs + penalty) * v * v)
                gain = loss(gl, hl, vl) + loss(gr, hr, vr) - loss(total_g, total_h, leaf_value(total_g, total_h, low, high))
                ok = (n >= min_rows) & (len(rows) - n >= min_rows) & (directions[f] * (vr - vl) >= 0)
                gain = np.where(ok, gain, -np.inf)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, vl[k], vr[k]))
        if best[1] is None:
            nodes[me][4] = rate * leaf_value(total_g, total_h, low, high)
            score[rows] += nodes[me][4]
            return me
        f, k, vl, vr = best[1]
        goes = binned[rows, f] <= k
        bounds = [(low, high), (low, high)]
        if directions[f]:
            middle = (vl + vr) / 2
            bounds = [(low, middle), (middle, high)] if directions[f] > 0 else [(middle, high), (low, middle)]
        nodes[me][0], nodes[me][1] = f, middles[f][k]
        nodes[me][2] = grow(rows[goes], g, h, level + 1, *bounds[0])
        nodes[me][3] = grow(rows[~goes], g, h, level + 1, *bounds[1])
        return me

    roots = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -4.0, 4.0))
    table = np.array(nodes)
    integers = table[:, [0, 2, 3]].astype(np.int64)
    return Trees(
        integers[:, 0], table[:, 1], integers[:, 1], integers[:, 2], table[:, 4], np.array(roots), base, depth
    )


def held_out_scores(x: np.ndarray, y: np.ndarray, directions: list[int], folds: int = FOLDS) -> np.ndarray:
    """The score of every row by trees that did not see it, nor any row with equal statistics."""
    fold = np.unique(x, axis=0, return_inverse=True)[1].ravel() % folds
    scores = np.zeros(len(y))
    for k in np.unique(fold):
        mine = fold == k
        rest = ~mine if not mine.all() else mine  # all rows equal: nothing to hold out
        scores[mine] = train(x[rest], y[rest], directions).score(x[mine])
    return scores


def fit_quality(
    docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, spare_good: float = 0.001,
) -> Trees | None:
    """Trees fitted on at most `sample_rows` labelled documents, or None without both classes.

    The sample is the documents with the smallest hash of their id, so it does not depend on
    the partitioning. Labels of one id are averaged, null labels ignored. Documents that fail
    the base rules are left out. A document is rejected below even odds, or below a lower cut
    if that would reject more than `spare_good` of the good sample, by scores of trees that
    did not see the rows they score.
    """
    own = labels.filter(F.col(label).isNotNull() & F.col(doc).isNotNull())
    own = own.groupBy(F.col(doc).alias("__label_id")).agg((F.avg(label) >= 0.5).cast("double").alias("__label"))
    sample = own.orderBy(F.xxhash64("__label_id"), "__label_id").limit(sample_rows)
    # at most sample_rows rows of two numbers
    rows = docs.select(F.col(doc), F.col(text)).join(F.broadcast(sample), F.col(doc) == F.col("__label_id"))
    found = rows.select("__label", F.col(text).alias("text")).mapInArrow(
        _measure, "label double, failed boolean, x array<double>"
    )
    # several rows with one id could exceed the bound
    found = found.filter("not failed").limit(sample_rows).collect()
    y = np.array([r["label"] for r in found])
    if not len(y) or y.min() == y.max():
        return None
    order = sorted(range(len(found)), key=lambda i: (found[i]["x"], y[i]))  # whatever the order of rows
    x, y = np.array([found[i]["x"] for i in order]), y[order]
    directions = list(FEATURES.values())
    trees = train(x, y, directions)
    unseen = held_out_scores(x, y, directions)
    trees.keep_at = float(min(0.0, np.quantile(unseen[y == 1], spare_good, method="lower")))
    return trees


def _failed(base: list[int]) -> bool:
    return base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEAT_PERCENT * base[0]


def _measure(batches):
    for batch in slices(batches):
        both = [statistics(t) for t in utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([_failed(b) for b, _ in both]),
                pa.array([x for _, x in both], pa.list_(pa.float64())),
            ],
            names=["label", "failed", "x"],
        )


def _judge(texts, trees: Trees | None):
    """(base columns, base_failed, score, kept) of a list of texts."""
    both = [statistics(t) for t in texts]
    base = [b for b, _ in both]
    failed = np.array([_failed(b) for b in base], dtype=bool)
    if trees is None:
        return base, failed, np.zeros(len(base)), ~failed
    score = trees.score(np.array([x for _, x in both]).reshape(len(both), len(FEATURES)))
    return base, failed, score, ~failed & (score >= trees.keep_at)


def judge_quality(docs: DataFrame, trees: Trees | None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base columns, base_failed, kept, score), one row per input row.

    `score` is the log odds of good quality. Without trees only the base rules decide. Null
    text has no words and fails; rows that repeat are judged one by one; a null id is carried
    along; other columns are ignored; an empty table gives no rows.
    """

    def scan(batches):
        for batch in slices(batches):
            base, failed, score, kept = _judge(utf8(batch.column(1)), trees)
            columns = [pa.array([b[i] for b in base], pa.int64()) for i in range(len(BASE))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(failed), pa.array(kept), pa.array(score)],
                names=["doc_id", *BASE, "base_failed", "kept", "score"],
            )

    own = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    longs = ", ".join(f"{n} long" for n in BASE)
    return own.mapInArrow(scan, f"doc_id long, {longs}, base_failed boolean, kept boolean, score double")


def good_documents(docs: DataFrame, trees: Trees | None, text: str = "text") -> DataFrame:
    """The rows of `docs` that are kept, with the same columns."""
    place = docs.columns.index(text)

    def scan(batches):
        for batch in slices(batches):
            kept = _judge(utf8(batch.column(place)), trees)[3]
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(scan, T.StructType(docs.schema.fields))
