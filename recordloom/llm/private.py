"""Personal data in documents, and the terms that reveal it.

Patterns find the protected entities. The corpus then tells how strongly a term near an
entity reveals it: the share of the entity's information content that the term gives
away, PMI(entity; term) / IC(entity), is 1 when the term occurs with the entity only.
Terms above a threshold are generalised, above a higher one removed. Copies of a text are no
further evidence: the information content goes by distinct texts, and the share of a term's
documents that hold the pair is discounted by the number of its distinct texts.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scale import materialize
from .words import letter_words, slices, utf8

KINDS = ["email", "ip", "card", "phone"]  # `term` follows them
GENERALISE_AT, REMOVE_AT = 0.8, 0.95
# Fixed value: the part of one text that absolute discounting takes off the texts of a pair, so
# that a term in a single text counts a quarter; a chance neighbour in few texts weighs less.
DISCOUNT = 0.75
NEAR_WORDS, NEAR_CHARS = 8, 120
TERMS_HELD = 200_000  # terms a task counts before it passes them on

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts inside a run of digits, so only starts of runs are tried
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
_A_TO_Z = {c: c + 32 for c in range(65, 91)}


def _emails(text: str):
    """Each @ with the longest run of name characters before it that no match holds yet."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        at += 1
        if start < at - 1 and domain:
            done = at = domain.end()
            yield start, done


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all base matches that pass, in order of start, then kind."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def near_terms(text: str, spans: list[tuple[int, str, int]]) -> list[tuple[int, int, int, int]]:
    """(entity, term, start, end) of terms near each span and outside all spans; hashes for names."""
    inside = sorted((a, b) for a, _, b in spans)
    lower = text.translate(_A_TO_Z)
    found = []
    for start, kind, end in spans:
        value = lower[start:end] if kind == "email" else _NOT_DIGIT.sub(".", text[start:end])
        if kind in ("card", "phone"):
            value = value.replace(".", "")
        entity = _signed(f"{kind}:{value}".encode())
        low, high = max(0, start - NEAR_CHARS), min(len(text), end + NEAR_CHARS)
        before = [m for m in _TERM.finditer(lower, low, start) if m.start() > low or low == 0][-NEAR_WORDS:]
        after = [m for m in _TERM.finditer(lower, end, high) if m.end() < high or high == len(text)][:NEAR_WORDS]
        for m in before + after:
            term = m.group()
            if len(term) >= 3 and not term.isdigit() and not any(a < m.end() and m.start() < b for a, b in inside):
                found.append((entity, _signed(term.encode()), m.start(), m.end()))
    return found


def _signed(value: bytes) -> int:
    h = xxhash.xxh64_intdigest(value)
    return h - (1 << 64) if h >> 63 else h


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
_NEAR = pa.list_(
    pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
)


def _find(batches):
    for batch in slices(batches):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        spans = [base_spans(t) for t in texts]
        names = [",".join(f"{k}:{a}:{b}" for a, k, b in s) for s in spans]
        near = [near_terms(t, s) if s else [] for t, s in zip(texts, spans)]
        counts = [pa.array([sum(k == kind for _, k, _ in s) for s in spans], pa.int64()) for kind in KINDS]
        as_dicts = lambda rows, keys: [[dict(zip(keys, r)) for r in row] for row in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([_signed(t.encode()) for t in texts], pa.int64()),
                *counts,
                pa.array([hashlib.sha256(n.encode()).hexdigest() for n in names], pa.string()),
                pa.array(as_dicts(spans, ("start", "kind", "end")), _SPANS),
                pa.array(as_dicts(near, ("entity", "term", "start", "end")), _NEAR),
            ],
            names=["doc_id", "text_hash", *[f"n_{k}" for k in KINDS], "base_sha256", "found", "near"],
        )


_FOUND = (
    "doc_id long, text_hash long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "found array<struct<start:long,kind:string,end:long>>, "
    "near array<struct<entity:long,term:long,start:long,end:long>>"
)


def _count_terms(batches):
    """(term, documents it stands in), summed over what a task holds at a time."""
    held: dict[bytes, int] = {}

    def rows():
        keys = pa.array([_signed(w) for w in held], pa.int64())
        return pa.RecordBatch.from_arrays([keys, pa.array(list(held.values()), pa.int64())], names=["term", "n"])

    for batch in batches:
        for text in utf8(batch.column(0)):
            for w in set(letter_words(text)):
                held[w] = held.get(w, 0) + 1
            if len(held) >= TERMS_HELD:
                yield rows()
                held.clear()
    yield rows()


def find_private(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
    discount: float = DISCOUNT,
) -> DataFrame:
    """(doc_id, text_hash, n_email, n_ip, n_card, n_phone, base_sha256, all_spans) per input row.

    `all_spans` has (start, rank, kind, end, action): base spans are removed, terms (kind `term`)
    generalised or removed. A term counts near an entity if it is one of the 8 words on either
    side, within 120 characters. Of the documents with the term, those with the pair are the
    share that the term gives away, less `discount` of a text in all texts of the pair; the
    entity's information is its rarity among distinct texts. There is no least number of texts:
    with the defaults a term that occurs in the only text of its entity is generalised from
    1,024 distinct texts on. Document counts cover all whole documents. Null text is empty; rows
    that repeat are judged one by one and count one by one, except that equal texts are one
    text; a null id is carried along; an empty table gives no rows.
    """
    own = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(own.mapInArrow(_find, _FOUND), "private")
    near = rows.select("doc_id", "text_hash", F.inline("near"))
    total = rows.select("text_hash").distinct().count()
    # documents per entity and pair, first summed per text, so that copies combine early
    once = rows.select(
        "text_hash", F.explode(F.array_distinct(F.transform("near", lambda x: F.struct(x["entity"].alias("entity"), x["term"].alias("term"))))).alias("x")
    ).select("text_hash", "x.*")
    per_text = once.groupBy("entity", "term", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    pairs = per_text.groupBy("entity", "term").agg(F.sum("n").alias("n_pair"), F.count(F.lit(1)).alias("texts"))
    pairs = materialize(pairs, "pairs")
    entities = (
        rows.select("text_hash", F.explode(F.array_distinct(F.transform("near", lambda x: x["entity"]))).alias("entity"))
        .distinct()
        .groupBy("entity")
        .agg(F.count(F.lit(1)).alias("n_entity"))
    )
    terms = own.select("text").mapInArrow(_count_terms, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    information = F.log(F.lit(float(total or 1)) / F.col("n_entity"))
    share = F.col("n_pair") / F.col("n_term") * (1 - F.lit(float(discount)) / F.col("texts"))
    disclosed = (information + F.log(share)) / information
    risky = (
        pairs.join(entities, "entity")
        .join(terms, "term")
        .filter(F.col("n_entity") < total)
        .withColumn("disclosed", disclosed)
        .filter(F.col("disclosed") >= generalise_at)
        .select("entity", "term", F.when(F.col("disclosed") >= remove_at, "remove").otherwise("generalise").alias("action"))
    )
    risky = materialize(risky, "risky")
    span = F.struct("start", F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), "end", "action")
    # one span and action per place: removal wins
    places = near.join(risky, ["entity", "term"]).groupBy("doc_id", "text_hash", "start", "end").agg(F.max("action").alias("action"))
    by_doc = places.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(
        F.collect_list(span).alias("terms")
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform(
        "found",
        lambda x: F.struct(
            x["start"].alias("start"),
            (F.array_position(kinds, x["kind"]) - 1).cast("int").alias("rank"),
            x["kind"].alias("kind"),
            x["end"].alias("end"),
            F.lit("remove").alias("action"),
        ),
    )
    every = F.array_sort(F.concat(base, F.coalesce("terms", F.array().cast(_TERM_SPANS))))
    return rows.join(by_doc, same, "left").select(
        "doc_id", "text_hash", *[f"n_{k}" for k in KINDS], "base_sha256", every.alias("all_spans")
    )


_TERM_SPANS = "array<struct<start:long,rank:int,kind:string,end:long,action:string>>"


def private_spans(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): `kind:start:end`, comma-joined."""
    found = find_private(docs, **options)
    names = F.transform("all_spans", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", F.array_join(names, ",").alias("spans"))


def sanitised(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` with entities and removed terms replaced by [kind], generalised terms by [...]."""
    found = find_private(docs, doc=doc, text=text, **options).select("doc_id", "text_hash", "all_spans").distinct()
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    keyed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.sha2(body, 256).alias("__private"))
    place = docs.columns.index(text)
    hashed = docs.select(F.col(doc).cast("long").alias("__id"), F.col(text).alias("__text")).distinct()

    def hashes(batches):
        for batch in slices(batches):
            texts = [t or b"" for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    pa.array([_signed(t) for t in texts], pa.int64()),
                ],
                names=["__id", "__sha", "__hash"],
            )

    names = hashed.mapInArrow(hashes, "__id long, __sha string, __hash long").distinct()
    spans = names.join(found, F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash")))
    spans = spans.select("__id", "__sha", F.col("all_spans").alias("__spans"))
    same = F.col(doc).cast("long").eqNullSafe(F.col("__id")) & (F.col("__private") == F.col("__sha"))
    joined = keyed.join(spans, same).select(*[F.col(f"`{c}`") for c in docs.columns], "__spans")

    def replace(batches):
        for batch in slices(batches):
            out = []
            for body_, spans_ in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                parts, at = [], 0
                for s in spans_:
                    if s["start"] >= at:
                        parts += [body_[at : s["start"]], "[...]" if s["action"] == "generalise" else f"[{s['kind']}]"]
                    at = max(at, s["end"])
                out.append(body_ if body_ is None else "".join([*parts, body_[at:]]))
            columns = [pa.array(out, pa.string()) if i == place else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=list(batch.schema.names[:-1]))

    return joined.mapInArrow(replace, T.StructType(docs.schema.fields))
