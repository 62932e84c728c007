"""Document fingerprints from closed syncmers over words (native columns only).

A text's words are hashed; a run of ``K`` words is an anchor when the smallest of its inner runs of
``S`` words is the first or the last of them. Whether a run is an anchor depends on its own words
only, so equal passages give equal anchors whatever stands around them. A fingerprint lists anchors
in text order as ``position:hash`` (word number in base 16, 32 hash bits); a text with words but without
such a run (fewer than ``K`` words, or a few more by chance) has one anchor, the hash of all its words, so
only texts without words have none. Likeness is the Jaccard similarity of two anchor sets: 1 for equal
ones, also when both are empty, and 0 when only one is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import bind, materialize, reading

K, S = 5, 2
MASK = 0xFFFFFFFF


def _least(run: Column, first: Column, offsets: range) -> Column:
    values = [F.get(run, first + o) for o in offsets]
    return F.least(*values) if len(values) > 1 else values[0]


def anchors(text: Column) -> Column:
    """``array<struct<at:int, hash:bigint>>`` of a text column (null counts as empty)."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x09-\x0D\x20]+"), lambda w: w != "")

    def of_hashes(h: Column) -> Column:
        n = F.size(h)

        def of_runs(g: Column) -> Column:
            last = K - S

            def anchor(_, i: Column) -> Column:
                edge = F.least(F.get(g, i), F.get(g, i + last))
                closed = edge <= _least(g, i, range(1, last))
                parts = [F.get(g, i), F.get(g, i + S), *(F.get(h, i + o) for o in range(2 * S, K))]
                value = F.xxhash64(*parts).bitwiseAND(F.lit(MASK))
                return F.when(closed, F.struct(i.alias("at"), value.alias("hash")))

            return F.filter(F.transform(F.slice(h, 1, n - (K - 1)), anchor), lambda x: x.isNotNull())

        inner = F.transform(
            F.slice(h, 1, F.greatest(n - (S - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + o) for o in range(1, S))),
        )
        whole = F.struct(F.lit(0).alias("at"), F.xxhash64(h).bitwiseAND(F.lit(MASK)).alias("hash"))
        runs = F.when(n >= K, bind(inner, of_runs)).otherwise(F.array().cast("array<struct<at:int,hash:bigint>>"))
        return bind(runs, lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(whole)))

    found = bind(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)
    return F.when(F.size(words) > 0, found).otherwise(F.array().cast("array<struct<at:int,hash:bigint>>"))


def as_text(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda x: F.concat(F.lower(F.hex(x["at"])), F.lit(":"), F.lpad(F.lower(F.hex(x["hash"])), 8, "0"))),
        " ",
    )


def hashes(found: Column) -> Column:
    """The distinct anchor hashes as ints, four bytes each."""
    return F.array_distinct(F.transform(found, lambda x: (x["hash"] - F.lit(1 << 31)).cast("int")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash arrays without repeats."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, anchors`` of every row, in one pass and without a shuffle."""
    rows = reading(df, doc_id=doc_id, text=text).select("doc_id", anchors(F.col("text")).alias("found"))
    return rows.select("doc_id", as_text(F.col("found")).alias("fingerprint"), hashes(F.col("found")).alias("anchors"))


def positional_matches(a: DataFrame, b: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For pairs of rows of ``a`` and ``b`` with the same id: ``doc_id, shift, n`` with the number of
    equal anchors at each distance of positions. One row per shift; anchors meet by id and hash."""
    sides = []
    for side, df in (("a", a), ("b", b)):
        rows = reading(df, doc_id=doc_id, text=text).select("doc_id", F.explode(anchors(F.col("text"))).alias("x"))
        sides.append(rows.select("doc_id", F.col("x.hash").alias("hash"), F.col("x.at").alias(side)))
    return sides[0].join(sides[1], ["doc_id", "hash"]).groupBy("doc_id", (F.col("b") - F.col("a")).alias("shift")).agg(
        F.count(F.lit(1)).alias("n")
    )


def neighbours(keys: DataFrame) -> DataFrame:
    """``key, prev_key, prev_need``: for each document its predecessor in ascending order, the last one
    being the predecessor of the first, and a quarter of the predecessor's length.

    ``keys`` holds distinct ``key, doc_id, h, n_chars``. Keys are range-partitioned and stored with their
    partition; rows look back inside a partition, and one row per partition closes the seams.
    """
    ordered = [F.col("doc_id").asc_nulls_first(), "h"]
    dealt = keys.repartitionByRange(*ordered).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "order")
    fields = F.struct("key", "n_chars")
    rows = dealt.withColumn("prev", F.lag(fields).over(Window.partitionBy("part").orderBy(*ordered)))
    lasts = dealt.groupBy("part").agg(F.max_by(fields, F.struct("doc_id", "h")).alias("last"))  # a null is least
    seams = Window.orderBy("part")
    whole = seams.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lasts = lasts.select("part", F.coalesce(F.lag("last").over(seams), F.last("last").over(whole)).alias("seam"))
    rows = rows.join(F.broadcast(lasts), "part")  # one row per partition
    prev = F.when(F.col("prev").isNull(), F.col("seam")).otherwise(F.col("prev"))
    rows = rows.select("key", prev.alias("prev"))
    need = F.floor(F.col("prev.n_chars") / 4).cast("int").alias("prev_need")
    return rows.select("key", F.col("prev.key").alias("prev_key"), need)


def against_edits(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, and compare them and the next document's.

    The edited text has the last ``floor(n_chars / 4)`` code points replaced by the first as many (or
    all) of the next document in ascending ``doc_id``; the first follows the last, and a lone
    document follows itself. Null ids stand first and null texts count as empty. Rows with the same
    id are ordered by a hash of their text; rows equal in id and text are one document whose result
    is repeated. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, next_id``.

    Texts cross one exchange, by key, which both joins read; each document then sends its predecessor
    the leading code points it needs and its own anchors.
    """
    rows = reading(df, doc_id=doc_id, text=text).withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    h = F.xxhash64("text")
    rows = rows.withColumn("key", F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex(h)))
    keys = rows.select("key", "doc_id", h.alias("h"), F.length("text").cast("long").alias("n_chars")).distinct()
    order = materialize(neighbours(keys), "neighbours")
    docs = rows.select("key", "doc_id", "text")
    sent = docs.join(order, "key").select(
        "prev_key",
        F.struct(
            F.col("doc_id").alias("next_id"),
            F.substring(F.col("text"), F.lit(1), F.col("prev_need")).alias("piece"),
            hashes(anchors(F.col("text"))).alias("next_anchors"),
        ).alias("sent"),
    )
    sent = sent.groupBy(F.col("prev_key").alias("key")).agg(F.first("sent").alias("sent"))  # of repeated rows one
    n = F.length("text")
    kept = F.substring(F.col("text"), F.lit(1), (n - F.floor(n / 4)).cast("int"))
    met = docs.join(sent, "key").select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "sent",
        F.concat(kept, F.col("sent.piece")).alias("edited"),
        anchors(F.col("text")).alias("found"),
    )
    met = met.select("*", anchors(F.col("edited")).alias("edited_found"))
    return met.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("found")).alias("fingerprint"),
        as_text(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(hashes(F.col("found")), hashes(F.col("edited_found"))).alias("near_edited"),
        likeness(hashes(F.col("found")), F.col("sent.next_anchors")).alias("near_next"),
        F.col("sent.next_id").alias("next_id"),
    )
