"""Language identification by prediction by partial matching.

Each language has byte context trees up to ``ORDER`` bytes deep with counts frozen after training. A
word (a run of letters, lower-cased, in UTF-8) is coded byte by byte and closed by a space, from a
context of spaces: a byte seen after the deepest known context costs ``-log2(n / (T + D))`` (``T``
bytes, ``D`` different ones seen there); otherwise the escape ``-log2(D / (T + D))`` is paid and the
context shortened. Below order 0 every byte costs 8 bits. The language with the shortest code of all
words wins (the alphabetically first of equal ones); its score is its share of ``2 ** -length`` with lengths
per letter, so that it tells how clear the choice is and not how long the text.

Training reads a bounded sample: the documents of a language whose hash falls in a share that holds about
``docs_per_lang`` of them (all of a smaller language). Training and prediction read whole texts.
"""

from __future__ import annotations

import itertools
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import hinted, lean, materialize, reading, small_batches
from panelcast.llm.lookup import Lookup

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 4
DOCS_PER_LANG = 400
UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
CHUNK, CACHED = 1_000_000, 150_000


def symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed ``context << 8 | byte`` of every coded byte, and where each word starts."""
    pad = " " * ORDER
    coded = [(pad + w + " ").encode("utf-8", "surrogatepass") for w in words]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    data = np.frombuffer(b"".join(coded), np.uint8).astype(np.int64)
    packed = data.copy()
    for back in range(1, ORDER + 1):
        packed[back:] |= data[:-back] << (8 * back)
    own = np.ones(len(data), bool)
    starts = np.cumsum(lengths) - lengths
    for i in range(ORDER):
        own[starts + i] = False
    return packed[own], starts - ORDER * np.arange(len(words))


class Model:
    """Code lengths of all languages: one row per known (context, byte) and per known context."""

    def __init__(self, langs: list[str], counts: list[dict[int, int]]):
        self.langs, self.tables = langs, []
        width = len(langs)
        if not langs:
            return
        full = [(np.fromiter(c.keys(), np.int64, len(c)), np.fromiter(c.values(), np.float64, len(c))) for c in counts]
        for order in range(ORDER + 1):
            mask = (1 << (8 * (order + 1))) - 1
            per = []
            for keys, n in full:
                k, inverse = np.unique(keys & mask, return_inverse=True)
                per.append((k, np.bincount(inverse, n, len(k))))
            keys = np.unique(np.concatenate([k for k, _ in per]))
            contexts = np.unique(keys >> 8)
            cost = self.lengths(keys, order - 1) if order else np.full((len(keys), width), 8.0)
            escape = np.zeros((len(contexts), width))
            for lang, (k, n) in enumerate(per):
                at = np.searchsorted(contexts, k >> 8)
                total, kinds = np.bincount(at, n, len(contexts)), np.bincount(at, minlength=len(contexts))
                known = kinds > 0
                escape[known, lang] = -np.log2(kinds[known] / (total + kinds)[known])
                cost[:, lang] += escape[np.searchsorted(contexts, keys >> 8), lang]
                cost[np.searchsorted(keys, k), lang] = -np.log2(n / (total + kinds)[at])
            self.tables.append((Lookup(keys), cost.astype(np.float32), Lookup(contexts), escape.astype(np.float32)))

    def lengths(self, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits of each symbol in each language."""
        if order < 0:
            return np.full((len(packed), len(self.langs)), 8.0)
        keys, cost, contexts, escape = self.tables[order]
        own = packed & ((1 << (8 * (order + 1))) - 1)
        at = keys.find(own)
        out = cost[at].astype(np.float64)
        if len(miss := np.flatnonzero(at < 0)):
            out[miss] = self.lengths(packed[miss], order - 1)
            seen = contexts.find(own[miss] >> 8)
            out[miss[seen >= 0]] += escape[seen[seen >= 0]]
        return out

    def of_words(self, words: list[str]) -> np.ndarray:
        packed, starts = symbols(words)
        return np.add.reduceat(self.lengths(packed), starts, axis=0)


class Scorer:
    """Predictions for texts, with the words met so far kept up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.bits = np.zeros((CACHED // 8, len(self.model.langs)))

    def learn(self, words: list[str]) -> None:
        n = len(self.rows)
        if n + len(words) > len(self.bits):
            self.bits = np.concatenate([self.bits, np.zeros((n + len(words), self.bits.shape[1]))])
        self.rows.update(zip(words, range(n, n + len(words)), strict=True))
        self.bits[n : n + len(words)] = self.model.of_words(words)

    def lengths(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """Bits of each text by language, and its letters."""
        words = [WORDS.findall(x.lower()) for x in texts]
        counts = [sum(map(len, part)) if any(any(map(str.isalpha, w)) for w in part) else 0 for part in words]
        flat = list(itertools.chain.from_iterable(words))
        if len(self.rows) > CACHED:
            self.clear()
        if new := list({w: 0 for w in flat if w not in self.rows}):
            self.learn(new)
        at = np.fromiter(map(self.rows.__getitem__, flat), np.int64, len(flat))
        ends = np.cumsum([len(part) for part in words])
        bits = np.zeros((len(texts), len(self.model.langs)))
        for i, (end, part) in enumerate(zip(ends, words, strict=True)):
            bits[i] = self.bits[at[end - len(part) : end]].sum(axis=0)
        return bits, counts

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not self.model.langs:
            return out
        for rows in groups(texts):
            bits, counts = self.lengths([texts[i] for i in rows])
            for i, b, n in zip(rows, bits, counts, strict=True):
                if n:
                    best = int(np.argmin(b))
                    share = 1 / np.exp2(np.maximum(b[best] - b, -1000 * n) / n).sum()
                    out[i] = self.model.langs[best], float(share)
        return out


def groups(texts: list[str | None]) -> Iterator[list[int]]:
    """Row numbers of the texts that are not null, some ``CHUNK`` characters at a time."""
    rows, size = [], 0
    for i, x in enumerate(texts):
        if x is not None:
            rows.append(i)
            size += len(x)
            if size >= CHUNK:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if words := WORDS.findall(text.lower()):
                keys, n = np.unique(symbols(words)[0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(keys), "key": keys, "n": n.astype(np.int64)})


def train(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> Model:
    """Fit on ``doc_id, text, lang``; rows without text or language are left out.

    The sample is taken where it is read, by comparing hashes with a share per language, so no task
    gathers a language. Whole texts are counted where they are read; what reaches the driver is the
    sample's distinct contexts, and no more if a row is repeated.
    """
    small_batches(labelled.sparkSession)
    known = labelled.filter("text is not null and lang is not null")
    shares = known.groupBy("lang").agg((F.lit(float(docs_per_lang)) / F.count(F.lit(1))).alias("share"))
    shares = hinted(materialize(shares, "shares").withColumnRenamed("lang", "of"))
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / F.lit(float(1 << 53))
    sample = known.join(shares, F.col("lang") == F.col("of")).filter(place < F.col("share"))
    counts = sample.select("lang", "text").mapInArrow(count_batches, "lang string, key long, n long")
    found: dict[str, dict[int, int]] = {}
    for lang, key, n in counts.groupBy("lang", "key").agg(F.sum("n").alias("n")).toLocalIterator():
        found.setdefault(lang, {})[key] = n
    langs = sorted(found)
    return Model(langs, [found[x] for x in langs])


def predictor(model: Model, others: list[str]):
    """Batches of ``others…, text`` to ``others…, lang_pred, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = scorer.predict(batch["text"].to_pylist())
            columns = {c: batch[c] for c in others}
            columns["lang_pred"] = pa.array([x for x, _ in found], pa.string())
            columns["score"] = pa.array([x for _, x in found], pa.float64())
            yield pa.RecordBatch.from_pydict(columns)

    return lean(run)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    A null text and a text without a letter give ``und`` with score 0, as does everything when no
    language was learned. Repeated rows give repeated results; other columns are not read.
    """
    small_batches(df.sparkSession)
    rows = reading(df, doc_id=doc_id, text=text)
    rows = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    return rows.mapInArrow(predictor(model, ["doc_id", "held_out"]), schema)


def learn_and_identify(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Train on the rows that are not held out and predict every row."""
    labelled = reading(df, doc_id=doc_id, text=text, lang=lang).filter(~held_out(F.col("doc_id")))
    return identify(df, train(labelled), doc_id, text)
