"""Language identification of mixed text: script ranges, per-word scores, Viterbi with a switching penalty.

Training counts hashed byte trigrams (letters lower-cased, everything else a blank) of every training document
per language; ``buckets`` trigram classes per language bound the model, which is broadcast.  Prediction:

1. a word's script follows from its UTF-8 lead bytes; languages that never use that script in training drop
   out for the word (a script no language uses leaves the word neutral);
2. each remaining language scores the word by the log probability of its trigrams;
3. Viterbi over the words of a document with a constant penalty per language switch labels spans;
4. the document's language is the one whose spans cover most letters; the score is the share they cover.

Defined results: a null text, an empty text or one without a letter is ``und`` with score 0 and no span; ties go to the smaller
language code; rows with a null ``lang`` or text do not train; without any training row all is ``und``; further
columns pass through.  Columns named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.blocks import flat, give_back, unused

BUCKETS = 1 << 16
SWITCH_PENALTY = 8.0
_BLOCK = 1 << 20
_VITERBI_WORDS = 300_000

# Scripts by UTF-8 lead byte (fixed values of the encoding): name, first and last lead byte.
SCRIPTS = [("latin", 0x61, 0x7A), ("latin", 0xC3, 0xCD), ("greek", 0xCE, 0xCF), ("cyrillic", 0xD0, 0xD4),
           ("armenian", 0xD5, 0xD5), ("hebrew", 0xD6, 0xD7), ("arabic", 0xD8, 0xDB), ("other", 0xDC, 0xDF),
           ("indic", 0xE0, 0xE0), ("other", 0xE1, 0xE1), ("kana", 0xE3, 0xE3), ("han", 0xE4, 0xE9),
           ("hangul", 0xEA, 0xED), ("other", 0xEE, 0xF4)]
SCRIPT_NAMES = sorted({name for name, _, _ in SCRIPTS})
_SCRIPT_BIT = np.zeros(256, np.uint16)
for _name, _lo, _hi in SCRIPTS:
    _SCRIPT_BIT[_lo:_hi + 1] = 1 << SCRIPT_NAMES.index(_name)

_LETTER = np.zeros(256, bool)  # bytes that stay; others become blanks
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray      # (langs, buckets) float32, relative to the mean over languages
    scripts: np.ndarray   # (langs,) bit set of scripts


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with a leading blank and a blank after each text; offsets of the texts in it."""
    lowered = pc.utf8_lower(pc.fill_null(column, ""))
    raw, off = flat(pc.binary_join_element_wise(lowered, pa.scalar("", lowered.type), pa.scalar(" ", lowered.type)))
    data = np.empty(len(raw) + 2, np.uint8)
    data[0] = data[-1] = 32
    data[1:-1] = raw
    data[~_LETTER[data]] = 32
    return data, off + 1


def _trigrams(data: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of the trigram around each byte (entry i: bytes i-1, i, i+1); ends are not used."""
    x = data.astype(np.uint32)
    out = np.zeros(len(x), np.uint32)
    out[1:-1] = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D))
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    return (out >> np.uint32(16)) % np.uint32(buckets)


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + _BLOCK, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", buckets: int = BUCKETS) -> Model:
    """Learn from every row of ``docs`` with a language and a text.  What returns to the driver is at most
    ``buckets`` counts and one bit set per language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in _slices(batches, "text"):
            data, off = _letters(batch.column("text"))
            gram, bit = _trigrams(data, buckets), _SCRIPT_BIT[data]
            lang, code = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            size = np.diff(off)
            solid = data != 32
            for k, name in enumerate(lang):
                mine = np.zeros(len(data), bool)
                mine[off[0]:off[-1]] = np.repeat(code == k, size)
                mine &= solid
                grams[name] = grams.get(name, 0) + np.bincount(gram[mine], minlength=buckets)
                bits = bit[mine]
                scripts[name] = scripts.get(name, 0) + np.array([((bits >> b) & 1).sum() for b in range(len(SCRIPT_NAMES))])
        give_back()
        for name, c in grams.items():
            at = np.flatnonzero(c)
            seen = np.flatnonzero(scripts[name])
            yield pa.record_batch([pa.array([name] * (len(at) + len(seen))), pa.array(np.concatenate((at, -1 - seen)).astype(np.int32)),
                                   pa.array(np.concatenate((c[at], scripts[name][seen])).astype(np.int64))], ["lang", "gram", "n"])

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    counts = rows.mapInArrow(count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = counts.toPandas()
    langs = sorted(table["lang"].unique())
    logp = np.zeros((len(langs), buckets), np.float32)
    scripts = np.zeros(len(langs), np.uint16)
    for k, name in enumerate(langs):
        own = table[table["lang"] == name]
        c = np.zeros(buckets)
        grams = own[own["gram"] >= 0]
        c[grams["gram"].to_numpy()] = grams["n"].to_numpy()
        logp[k] = np.log((c + 0.5) / (c.sum() + 0.5 * buckets))
        used = own[own["gram"] < 0]
        total = max(1, used["n"].sum())
        for g, n in zip(used["gram"], used["n"], strict=True):
            if n >= 0.001 * total:  # a script makes up a thousandth of its letters at least
                scripts[k] |= np.uint16(1 << (-1 - int(g)))
    if langs:
        logp -= logp.mean(axis=0)
    return Model([str(x) for x in langs], logp, scripts)


def word_scores(data: np.ndarray, off: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores (words, langs), letters per word, words per document)."""
    solid = data != 32
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1  # data begins and ends with a blank
    start, end = edge[::2], edge[1::2]
    gram = _trigrams(data, model.logp.shape[1])
    scores = np.empty((len(start), len(model.langs)), np.float32)
    # a word's trigrams are those centred on its bytes; the blanks beside it are part of the first and last
    for k in range(len(model.langs)):
        run = np.concatenate(([0.0], np.cumsum(model.logp[k][gram], dtype=np.float64)))
        scores[:, k] = run[end] - run[start]
    bits = _SCRIPT_BIT[data]
    word_bits = np.bitwise_or.reduceat(bits, start) if len(start) else np.zeros(0, np.uint16)
    for b in np.unique(word_bits):
        allowed = (model.scripts & b) != 0 if b else np.ones(len(model.langs), bool)
        if not allowed.any():
            scores[word_bits == b] = 0.0
        elif not allowed.all():
            scores[np.ix_(word_bits == b, ~allowed)] = -100.0
    words = np.searchsorted(start, off)
    return scores, (end - start).astype(np.int64), np.diff(words)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word; documents advance together, one word per step, longest first."""
    n_lang = scores.shape[1]
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    order = np.argsort(-counts, kind="stable")
    first, counts = first[order], counts[order]
    stay = np.zeros(scores.shape, bool)      # the best path to (word, label) keeps its label
    jump = np.zeros(len(scores), np.int16)   # else it comes from the best label one word before
    longest = int(counts[0]) if len(counts) else 0
    alive = np.searchsorted(-counts, -np.arange(longest), "left")  # documents with more than t words
    value = np.zeros((0, n_lang), np.float32)
    last = np.zeros(len(counts), np.int16)
    for t in range(longest):
        n = alive[t]
        at = first[:n] + t
        if t == 0:
            value = scores[at]
        else:
            if n < len(value):
                last[n:len(value)] = value[n:].argmax(axis=1)
                value = value[:n]
            best = value.argmax(axis=1)
            switch = value[np.arange(n), best] - penalty
            keep = value >= switch[:, None]
            stay[at], jump[at] = keep, best
            value = np.where(keep, value, switch[:, None]) + scores[at]
    if longest:
        last[:len(value)] = value.argmax(axis=1)
    path = np.zeros(len(scores), np.int16)
    label = last
    for t in range(longest - 1, -1, -1):
        n = alive[t]
        at = first[:n] + t
        now = label[:n]
        path[at] = now
        if t:
            label[:n] = np.where(stay[at, now], now, jump[at])
    return path


def identify(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = SWITCH_PENALTY,
             spans: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred, score, n_spans and, on demand, spans (array of lang, first_word, n_words)."""
    new = ["lang_pred", "score", "n_spans"] + ["spans"] * spans
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    if not model.langs:
        none = docs.select(*keep).withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "n_spans": F.lit(0).cast("bigint")})
        return none.withColumn("spans", F.array().cast("array<struct<lang:string,first_word:bigint,n_words:bigint>>")) if spans else none
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema
    inner_text, inner_letter = unused("_text", keep), unused("_letter", keep)
    text = inner_text if text_col not in keep or docs.schema[text_col].dataType.simpleString() != "string" else text_col
    ddl = "lang_pred string, score double, n_spans bigint" + ", spans array<struct<lang:string,first_word:bigint,n_words:bigint>>" * spans
    schema = T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])
    span_kind = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        n_lang = len(m.langs)
        waiting: list[tuple] = []

        def finish() -> Iterator[pa.RecordBatch]:
            scores = np.concatenate([w[1] for w in waiting])
            path = viterbi(scores, np.concatenate([w[3] for w in waiting]), penalty)
            at = 0
            for batch, own, letters, counts in waiting:
                mine = path[at:at + len(own)]
                at += len(own)
                doc = np.repeat(np.arange(len(counts)), counts)
                mass = np.bincount(doc * n_lang + mine, weights=letters, minlength=len(counts) * n_lang).reshape(-1, n_lang)
                total = mass.sum(axis=1)
                best = mass.argmax(axis=1)
                told = (total > 0) & batch.column(inner_letter).to_numpy(zero_copy_only=False).astype(bool)
                begins = np.ones(len(mine), bool)
                begins[1:] = (mine[1:] != mine[:-1]) | (doc[1:] != doc[:-1])
                n_spans = np.where(told, np.bincount(doc[begins], minlength=len(counts)), 0)
                pred = [m.langs[b] if t else "und" for b, t in zip(best, told, strict=True)]
                score = np.where(told, mass.max(axis=1) / np.maximum(total, 1), 0.0)
                cols = [batch.column(c) for c in keep] + [pa.array(pred), pa.array(score), pa.array(n_spans.astype(np.int64))]
                if spans:
                    begin = np.flatnonzero(begins)
                    long = np.diff(np.concatenate((begin, [len(mine)])))
                    head = np.concatenate(([0], np.cumsum(counts)))
                    lists: list[list] = [[] for _ in counts]
                    for b, n in zip(begin, long, strict=True):
                        if told[doc[b]]:
                            lists[doc[b]].append({"lang": m.langs[mine[b]], "first_word": int(b - head[doc[b]]), "n_words": int(n)})
                    cols.append(pa.array(lists, span_kind))
                yield pa.record_batch(cols, keep + new)

        held = 0
        for batch in _slices(batches, text):
            data, off = _letters(batch.column(text))
            waiting.append((batch, *word_scores(data, off, m)))
            held += len(waiting[-1][1])
            if held >= _VITERBI_WORDS:
                yield from finish()
                waiting, held = [], 0
                give_back()
        if waiting:
            yield from finish()
        waiting.clear()
        give_back()

    has_letter: Column = F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))
    more = [has_letter.alias(inner_letter)] + [F.col(text_col).cast("string").alias(inner_text)] * (text == inner_text)
    return docs.select(*keep, *more).mapInArrow(label, schema)
