"""Text quality by an interpolated modified Kneser-Ney model of characters.

The model counts runs of ``ORDER`` characters in trusted text (documents padded in front, closed by an
end mark). Lower orders count distinct left neighbours; each order has its three discounts from the
numbers of runs seen once to four times; every probability is interpolated with the next lower order,
down to a uniform one over the alphabet and one unknown character. Counts, context totals and
interpolated probabilities are joins and aggregations of tables of distinct runs.

For scoring, the table is divided to shards by the character before the predicted one, so all runs
that one prediction needs are in one shard (single characters are in all). Each shard is bounded by
``SHARD_ROWS`` and broadcast; a batch of texts goes through the shards one after the other.
A document is kept when its perplexity is at most a quantile of held-out trusted documents of its
language.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Blocks, hinted, materialize, reading, shipped, small_batches
from panelcast.llm.lookup import Lookup

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 5
START, STOP = "\x02", "\x03"
SHARD_ROWS = 3_000_000
QUANTILE, FOLDS = 0.99, 5
COUNT_CHUNK, SCORE_CHUNK = 4_000_000, 1_000_000
STEP = 0x9E3779B97F4A7C15


def chunks(texts: list[str | None], size: int) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and texts that are neither null nor empty, some ``size`` characters at a time."""
    rows, part, held = [], [], 0
    for i, x in enumerate(texts):
        if x:
            rows.append(i)
            part.append(x)
            held += len(x)
            if held >= size:
                yield rows, part
                rows, part, held = [], [], 0
    if part:
        yield rows, part


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the padded texts end to end, and where each text's first prediction stands."""
    whole = "".join(START * (ORDER - 1) + x + STOP for x in texts)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + ORDER
    return points, np.cumsum(lengths) - lengths + ORDER - 1


def mixed(points: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (points + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def run_keys(points: np.ndarray) -> list[np.ndarray]:
    """For each length 0 to ``ORDER``, the hash of the run that ends at each position."""
    out, own = [np.zeros(len(points), np.uint64)], mixed(points)
    weight = np.uint64(1)
    with np.errstate(over="ignore"):
        for length in range(1, ORDER + 1):
            key = out[-1].copy()
            key[length - 1 :] += own[: len(own) - length + 1] * weight
            out.append(key)
            weight = weight * np.uint64(STEP)
    return out


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in chunks(batch["text"].to_pylist(), COUNT_CHUNK):
            points, first = characters(texts)
            keys = run_keys(points)[ORDER]
            inside = np.ones(len(points), bool)
            for i in range(ORDER - 1):
                inside[first - 1 - i] = False
            at = np.flatnonzero(inside)
            _, where, n = np.unique(keys[at], return_index=True, return_counts=True)
            runs = points[(at[where] - ORDER + 1)[:, None] + np.arange(ORDER)].astype("<u4")
            text = runs.tobytes().decode("utf-32-le", "surrogatepass")
            grams = [text[i : i + ORDER] for i in range(0, len(text), ORDER)]
            yield pa.RecordBatch.from_pydict({"gram": pa.array(grams, pa.string()), "n": pa.array(n.astype(np.int64))})


# --- model ----------------------------------------------------------------------------


def discounts(grams: DataFrame) -> tuple[float, float, float]:
    """The three discounts, from how many runs were counted once to four times."""
    once = [F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]
    n1, n2, n3, n4 = (float(x) for x in grams.agg(*once).first())
    if not (n1 and n2):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))


def estimate(counts: DataFrame) -> DataFrame:
    """``run, logp, back`` (base 2) of every seen run and context from ``gram, n`` of the top order.

    ``logp`` is null for runs that are only contexts, ``back`` for runs that are no context.
    """
    by_order = {ORDER: materialize(counts, f"grams{ORDER}")}
    for order in range(ORDER - 1, 0, -1):
        longer = by_order[order + 1]
        shorter = longer.groupBy(F.expr("substr(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        by_order[order] = materialize(shorter, f"grams{order}")
    alphabet = by_order[1].count() + 1
    lower, out = None, None
    for order in range(1, ORDER + 1):
        grams = by_order[order].withColumn("context", F.expr(f"substr(gram, 1, {order - 1})"))
        d1, d2, d3 = discounts(grams)
        taken = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        contexts = grams.groupBy("context").agg(F.sum("n").alias("total"), F.sum(taken).alias("taken"))
        contexts = materialize(contexts.select("context", "total", (F.col("taken") / F.col("total")).alias("share")), "contexts")
        met = grams.join(contexts, "context")
        if lower is None:
            below = F.lit(1.0 / alphabet)
        else:
            met = met.withColumn("rest", F.expr("substr(gram, 2)")).join(lower.select(F.col("gram").alias("rest"), F.col("p").alias("q")), "rest")
            below = F.col("q")
        p = (F.col("n") - taken) / F.col("total") + F.col("share") * below
        lower = materialize(met.select("gram", p.alias("p")), f"order{order}")
        seen = lower.select(F.col("gram").alias("run"), F.log2("p").alias("logp"), F.lit(None).cast("double").alias("back"))
        back = contexts.select(F.col("context").alias("run"), F.lit(None).cast("double").alias("logp"), F.log2("share").alias("back"))
        out = seen.union(back) if out is None else out.union(seen).union(back)
    unknown = by_order[1].limit(1).select(F.lit(None).cast("string").alias("run"), F.lit(-np.log2(alphabet)).alias("logp"), F.lit(None).cast("double").alias("back"))
    return materialize(out.union(unknown).groupBy("run").agg(F.max("logp").alias("logp"), F.max("back").alias("back")), "model")


def key_batches(shards: int):
    """``run, logp, back`` to numbers: length, hash, and the shards that need the value and the weight
    (-1 for all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [x or "" for x in batch["run"].to_pylist()]
            lengths = np.fromiter(map(len, runs), np.int64, len(runs))
            whole = "".join(START * (ORDER - len(x)) + x for x in runs)
            points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
            keys = np.choose(lengths, [k[ORDER - 1 :: ORDER] for k in run_keys(points)])
            last = shard_numbers(points[ORDER - 1 :: ORDER], shards).astype(np.int64)
            before = shard_numbers(points[ORDER - 2 :: ORDER], shards).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "length": np.where(batch["run"].is_null().to_numpy(zero_copy_only=False), -1, lengths),
                    "key": keys.view(np.int64),
                    "seen_in": np.where(lengths > 1, before, -1),
                    "back_in": np.where(lengths > 0, last, -1),
                    "logp": batch["logp"],
                    "back": batch["back"],
                }
            )

    return run


class Shard:
    """The runs of one shard as hash tables by length, from the columns of ``key_batches``."""

    def __init__(self, number: int, shards: int, table: pa.Table):
        self.number, self.shards = number, shards
        lengths, keys = (table[c].to_numpy() for c in ("length", "key"))
        values = {"seen": table["logp"].to_numpy(), "back": table["back"].to_numpy()}
        self.uniform = float(values["seen"][lengths == -1].sum())
        self.floor = float(np.nansum(values["back"][lengths == 0]))
        self.tables = {}
        for length in range(1, ORDER + 1):
            for name, held in values.items():
                mine = (lengths == length) & ~np.isnan(held)
                self.tables[name, length] = Lookup(keys[mine].view(np.uint64)), np.append(held[mine], 0.0)

    def owns(self, points: np.ndarray) -> np.ndarray:
        return shard_numbers(points, self.shards) == self.number

    def logp(self, keys: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Log probability of the characters at these positions, given those before."""
        out, todo = np.zeros(len(at)), np.arange(len(at))
        for length in range(ORDER, 0, -1):
            table, values = self.tables["seen", length]
            found = table.find(keys[length][at[todo]])
            hit = found >= 0
            out[todo[hit]] += values[found[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            if length > 1:
                table, values = self.tables["back", length - 1]
                out[todo] += values[table.find(keys[length - 1][at[todo] - 1])]  # row -1 holds 0
        out[todo] += self.floor + self.uniform
        return out


def shard_numbers(points: np.ndarray, shards: int) -> np.ndarray:
    return ((points * np.uint64(2654435761)) >> np.uint64(7)) % np.uint64(shards)


def shards_of(model: DataFrame) -> list:
    """Broadcast shards of a model; one at a time is on the driver. An empty model has none."""
    count = -(-model.count() // SHARD_ROWS)
    numbers = "length long, key long, seen_in long, back_in long, logp double, back double"
    keyed = model.select("run", "logp", "back").mapInArrow(key_batches(max(count, 1)), numbers)
    out = []
    for i in range(count):
        needed = F.col("seen_in").isin(-1, i) | F.col("back_in").isin(-1, i)
        found = keyed.filter(needed).select("length", "key", "logp", "back").toArrow()
        out.append(shipped(model.sparkSession, Shard(i, count, found)))
    return out


def train(trusted: DataFrame) -> list:
    """Shards of a model of ``text``; null and empty texts count for nothing."""
    small_batches(trusted.sparkSession)
    counts = trusted.select("text").mapInArrow(count_batches, "gram string, n long")
    return shards_of(estimate(counts.groupBy("gram").agg(F.sum("n").alias("n"))))


def score_batches(shards: list, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Blocks(shards)
        for batch in batches:
            bits: list[float | None] = [None] * len(batch)
            for rows, texts in chunks(batch["text"].to_pylist() if shards else [], SCORE_CHUNK):
                points, first = characters(texts)
                keys = run_keys(points)
                logp = np.zeros(len(points))
                inside = np.ones(len(points), bool)
                for i in range(ORDER - 1):
                    inside[first - 1 - i] = False
                at = np.flatnonzero(inside)
                for shard in held:
                    mine = at if shard.shards == 1 else at[shard.owns(points[at - 1])]
                    logp[mine] = shard.logp(keys, mine)
                lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
                for i, total, n in zip(rows, np.add.reduceat(logp, first), lengths, strict=True):
                    bits[i] = -float(total) / int(n)
            columns = {f: batch[f] for f in fields}
            columns["bits"] = pa.array(bits, pa.float64())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def classify(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    quantile: float = QUANTILE,
) -> DataFrame:
    """``doc_id, lang, trusted, perplexity, threshold, keep`` of every row.

    Trusted are the documents that ``labels`` (``doc_id, quality, toxic``) calls good and not toxic; a
    fifth of them, by a hash of the id, is held out and gives each language its threshold (a language
    without any has the threshold of all, and null where there is none). Perplexity is per character,
    the end included. Null and empty texts have a null perplexity and are not kept; without trusted
    text nothing is kept. Repeated rows give repeated results.
    """
    spark = df.sparkSession
    small_batches(spark)
    docs = reading(df, doc_id=doc_id, text=text, lang=lang)
    good = labels.filter("quality = 1 and toxic = 0 and doc_id is not null").select(labels["doc_id"]).distinct()
    good = materialize(good.withColumn("held_out", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0), "trusted")
    training = good.filter("not held_out").select("doc_id")
    shards = train(docs.join(hinted(training), "doc_id", "left_semi"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.mapInArrow(score_batches(shards, ["doc_id", "lang"]), f"doc_id {kind}, lang string, bits double")
    scored = scored.join(hinted(good), "doc_id", "left")
    scored = materialize(scored.withColumn("perplexity", F.pow(F.lit(2.0), F.col("bits"))), "scored")
    held = scored.filter("held_out and perplexity is not null")
    limits = held.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10000).alias("own"))
    overall = held.agg(F.percentile_approx("perplexity", quantile, 10000)).first()[0]
    limits = limits.withColumnRenamed("lang", "of_lang")
    out = scored.join(limits, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    return out.select(
        "doc_id",
        "lang",
        F.col("held_out").isNotNull().alias("trusted"),
        "perplexity",
        threshold.alias("threshold"),
        F.coalesce(F.col("perplexity") <= threshold, F.lit(False)).alias("keep"),
    )
