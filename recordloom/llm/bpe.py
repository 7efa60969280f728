"""Byte-pair encoding and decoding with a fixed public vocabulary file.

A word is a doubly linked list of symbols; a priority queue holds the rank of every mergeable
pair of neighbours. The best pair is merged, the two new pairs are queued, and entries whose
pair no longer stands there are skipped when they come up, so a word of n symbols costs
n log n steps however long it is. Text is cut at white space first, which the vocabulary's
own split drops, and each distinct piece is encoded once per worker.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import slices

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
# The characters the vocabulary's library takes as white space.
_BLANK = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_CHUNK = re.compile(f"[^{_BLANK}]+")
_NOT_BLANK = re.compile("[\x1c-\x1f]")  # blank to str.split, not to the library
LONG_TEXT = 1 << 20  # longer texts are cut lazily
REMEMBERED = 200_000  # words a worker remembers, as many chunks, and as many of each from before


def byte_symbols() -> list[str]:
    """One visible character per byte: itself if printable Latin-1, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def read_vocabulary(path: str = VOCABULARY) -> dict:
    """The parts of a vocabulary file that encoding needs, checked against what is supported here."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = spec["normalizer"]["normalizers"]
    split, to_bytes = spec["pre_tokenizer"]["pretokenizers"]
    model = spec["model"]
    known = (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True)
        and (to_bytes["type"], to_bytes["add_prefix_space"], to_bytes["use_regex"]) == ("ByteLevel", False, False)
        and model["type"] == "BPE"
        and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and spec["decoder"] is None
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )
    if not known:
        raise ValueError(f"{path} asks for steps that are not supported")
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {
        "vocab": model["vocab"] | added,
        "merges": [tuple(m) for m in model["merges"]],
        "added": added,
        "pattern": split["pattern"]["Regex"],
        "end": model["end_of_word_suffix"] or "",
    }


def _pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def _older(text: str) -> str:
    """The text with characters newer than Python's tables, unknown to the library's split, as symbols."""
    if text.isascii():
        return text
    return "".join("\ufffd" if unicodedata.category(c) == "Cn" else c for c in text)


class Remembering(dict):
    """Results of a costly function by its text. What is not asked for again is forgotten first: when
    `most` results are held, those not used since the last time this happened go."""

    def __init__(self, function, most: int, longest: int = 64):
        super().__init__()
        self.function, self.most, self.longest, self.older = function, most, longest, {}

    def __missing__(self, text):
        found = self.older.get(text)
        if found is None:
            found = self.function(text)
            if len(text) > self.longest:
                return found
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[text] = found
        return found


class Encoder:
    """Token ids of texts; chunks (text without white space) and words are remembered, as packed 32-bit ids."""

    def __init__(self, vocabulary: dict, most: int = REMEMBERED):
        import regex

        vocab, end = vocabulary["vocab"], vocabulary["end"]
        self.pieces = regex.compile(vocabulary["pattern"])
        self.added = vocabulary["added"]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        shown = byte_symbols()
        self.inner = [vocab.get(s) for s in shown]
        self.last = [vocab.get(s + end) for s in shown]
        # by left id: right id -> rank; and the ids of the merged symbols by rank
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(vocab.values()) + 1)]
        for rank, (left, right) in enumerate(vocabulary["merges"]):
            self.ranks[vocab[left]][vocab[right]] = rank
        self.made = [vocab[left + right] for left, right in vocabulary["merges"]]
        self.words = Remembering(self.merge, most)
        self.chunks = Remembering(self.encode_chunk, most)

    def encode_chunk(self, chunk: str) -> bytes:
        if chunk.isalpha() and chunk.isascii():
            return self.words[chunk.lower()]
        parts = self.special.split(chunk) if self.special else [chunk]
        packed = b""
        for i, part in enumerate(parts):
            if i % 2:  # the split keeps special strings at odd places
                packed += _pack([self.added[part]])
            elif part.isascii():
                for word in self.pieces.findall(part.lower()):
                    packed += self.words[word]
            else:
                # character by character: the one rule of str.lower that looks around is for capital sigma
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                if plain.isalpha():
                    packed += self.words[plain]
                    continue
                for found in self.pieces.finditer(_older(plain)):
                    packed += self.words[plain[found.start() : found.end()]]
        return packed

    def merge(self, text: str) -> bytes:
        """Ids of one word: its bytes as symbols, merged by rank, leftmost first among equals."""
        word = text.encode()
        inner, ranks, made = self.inner, self.ranks, self.made
        ids = [inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        if None in ids:  # a byte the vocabulary does not know
            ids = [i for i in ids if i is not None]
        n = len(ids)
        low = max(14, n.bit_length())  # an entry is a rank and, in the low bits, the place of the left symbol
        queue = [
            rank << low | at
            for at, (left, right) in enumerate(zip(ids, ids[1:]))
            if (rank := ranks[left].get(right)) is not None
        ]
        if not queue:
            return _pack(ids)
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        mask = (1 << low) - 1
        while queue:
            entry = pop(queue)
            at, rank = entry & mask, entry >> low
            right, left_id = after[at], ids[at]
            if left_id < 0 or right >= n or ranks[left_id].get(ids[right]) != rank:
                continue  # stale: the pair no longer stands here
            ids[at] = merged = made[rank]
            ids[right] = -1
            after[at] = beyond = after[right]
            if beyond < n:
                before[beyond] = at
                rank = ranks[merged].get(ids[beyond])
                if rank is not None:
                    push(queue, rank << low | at)
            ahead = before[at]
            if ahead >= 0:
                rank = ranks[ids[ahead]].get(merged)
                if rank is not None:
                    push(queue, rank << low | ahead)
        return _pack([i for i in ids if i >= 0])

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if len(text) > LONG_TEXT or _NOT_BLANK.search(text):
            chunks = (m.group() for m in _CHUNK.finditer(text))
        else:
            chunks = text.split()
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, chunks)), np.int32)


class Decoder:
    """Texts of id lists: the vocabulary strings, joined by one blank as the library does without a decoder."""

    def __init__(self, vocabulary: dict):
        size = max(vocabulary["vocab"].values()) + 1
        strings: list[str | None] = [None] * size
        for text, i in vocabulary["vocab"].items():
            strings[i] = text
        self.strings, self.size = pa.array(strings, pa.large_string()), size

    def decode(self, ids: pa.Array) -> pa.Array:
        """Ids that are null or not in the vocabulary are left out; a null list gives a null text."""
        values = ids.values.slice(ids.offsets[0].as_py(), ids.offsets[-1].as_py() - ids.offsets[0].as_py())
        known = pc.fill_null(pc.and_(pc.greater_equal(values, 0), pc.less(values, self.size)), False)
        words = self.strings.take(pc.if_else(known, values, None))
        starts = np.asarray(ids.offsets) - ids.offsets[0].as_py()
        if words.null_count:
            there = np.asarray(words.is_valid())
            starts = np.concatenate([[0], np.cumsum(there)])[starts]
            words = words.drop_null()
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words)
        joined = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
        return pc.if_else(ids.is_valid(), joined, None)


def share_vocabulary(spark: SparkSession, path: str = VOCABULARY):
    """The vocabulary as a broadcast; the driver reads the file, a fixed one of under two megabytes."""
    return spark.sparkContext.broadcast(read_vocabulary(path))


def _others(df: DataFrame, made: str) -> list:
    return [F.col(f"`{c}`") for c in df.columns if c.lower() != made.lower()]


def _encoded(batches, vocabulary, names: list[str]):
    """Batches whose last column, the text, is replaced by its token ids, 64 rows at a time."""
    shared = vocabulary.value  # one object for all tasks of a worker, which so share what is remembered
    encoder = shared.get("encoder") or shared.setdefault("encoder", Encoder(shared))
    for batch in slices(batches, 64):
        found = [encoder.encode(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=names)


def _decoded(batches, vocabulary, names: list[str], keep: bool):
    """Batches with the text of their last column, token ids, after it or in its place."""
    decoder = Decoder(vocabulary.value)
    for batch in slices(batches, 64):
        lists = batch.column(batch.num_columns - 1)
        kept = batch.columns if keep else batch.columns[:-1]
        yield pa.RecordBatch.from_arrays([*kept, decoder.decode(lists)], names=names)


def _schema(rows: DataFrame, kept: list, **made: str):
    return rows.select(*kept, *[F.lit(None).cast(kind).alias(name) for name, kind in made.items()]).schema


def encode_texts(docs: DataFrame, vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with a column of token ids (array<int>) in place of any column of that name.

    White space is dropped and text is lower-cased, as the vocabulary asks; strings of special
    tokens become their ids. Null and empty texts have no ids. Every row is encoded on its
    own, so repeated rows stay, keys are not looked at, and an empty table gives no rows. A
    text may be of any length; a worker holds 64 texts at a time. Only characters assigned after
    Unicode 15.1, which Python's tables do not know, may get other ids than the library's.
    """
    kept = _others(docs, ids)
    schema = _schema(docs, kept, **{ids: "array<int>"})
    rows = docs.select(*kept, F.col(f"`{text}`").cast("string").alias("_text"))
    names = [f.name for f in schema]
    return rows.mapInArrow(lambda batches: _encoded(batches, vocabulary, names), schema)


def decode_ids(rows: DataFrame, vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with a column `text` decoded from token ids, in place of any column of that name.

    Vocabulary strings are joined by one blank, word ends shown. Null ids and ids outside the
    vocabulary are left out, no ids give an empty text, a null list a null text.
    """
    kept = _others(rows, text)
    schema = _schema(rows, kept, **{text: "string"})
    table = rows.select(*kept, F.col(f"`{ids}`").cast("array<int>").alias("_ids"))
    names = [f.name for f in schema]
    return table.mapInArrow(lambda batches: _decoded(batches, vocabulary, names, False), schema)


def round_trip(docs: DataFrame, vocabulary, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`encode_texts`, then `decode_ids` on what it made, in one pass of one worker, without the text."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (text.lower(), ids.lower(), decoded.lower())]
    schema = _schema(docs, kept, **{ids: "array<int>", decoded: "string"})
    rows = docs.select(*kept, F.col(f"`{text}`").cast("string").alias("_text"))
    names = [f.name for f in schema]

    def run(batches):
        return _decoded(_encoded(batches, vocabulary, names[:-1]), vocabulary, names, True)

    return rows.mapInArrow(run, schema)


def token_digests(rows: DataFrame, doc: str = "doc_id", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of encoded and decoded rows."""
    listed = F.concat_ws(" ", F.col(ids).cast("array<string>"))
    return rows.select(
        F.col(doc).cast("long").alias("doc_id"),
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )
