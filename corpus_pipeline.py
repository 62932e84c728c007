"""The corpus pipeline over ``documents``: language, near duplicates, contamination, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and reads only what the one before it kept. All but the last
return the columns of ``documents``; other columns are left behind. Empty tables pass through. No SQL
states these stages, so ``ORACLE_SQL`` is None and tests compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import decontam, jaccard, langid, packing, pii
from panelcast.llm.common import hinted, materialize, small_batches, table
from panelcast.llm.queries import personal_data_field

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without text or without a letter go. A missing ``lang`` becomes
    the predicted one."""
    docs = docs.select(COLUMNS)
    labelled = docs.filter(~langid.held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    model = langid.train(labelled)
    small_batches(spark)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    found = docs.mapInArrow(langid.predictor(model, COLUMNS), f"{schema}, lang_pred string, score double")
    found = found.filter(F.col("lang_pred") != langid.UNKNOWN) if model.langs else found.filter("text is not null")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def nodes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``node``, one number for each text of an id: the id itself for its first text (by a 64-bit
    digest), and numbers beyond all ids for further ones. Ids with several texts are the only ones that are stored."""
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    keyed = docs.select("doc_id", digest.alias("digest"))
    several = keyed.groupBy("doc_id").agg(F.min("digest").alias("first"), F.max("digest").alias("last")).filter("first <> last")
    several = materialize(several.select("doc_id", "first"), "several")
    if several.isEmpty():
        return docs.withColumn("node", F.col("doc_id").cast("long"))
    further = materialize(keyed.join(several, "doc_id").filter("digest <> first").select("doc_id", "digest").distinct(), "further")
    highest = docs.agg(F.max("doc_id")).first()[0]
    further = materialize(further.withColumn("beyond", F.monotonically_increasing_id() + F.lit(highest + 1)), "beyond")
    met = docs.withColumn("digest", digest).join(further, ["doc_id", "digest"], "left")
    return met.withColumn("node", F.coalesce("beyond", F.col("doc_id").cast("long"))).drop("digest", "beyond")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones (five-word shingles, 0.8). Several texts
    under one id are documents of their own: the first by digest has the id's place, further ones come after all
    ids. Of equal rows of one text one stays, that of the least other columns; rows with a null id stay. Null
    and empty texts are similar to nothing; an empty table stays empty."""
    docs = docs.select(COLUMNS)
    placed = nodes(docs.filter("doc_id is not null"))
    groups = materialize(jaccard.similar_groups(placed, jaccard.Rule(), doc_id="node"), "groups")
    first = groups.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("node")).agg(F.count(F.lit(1)).alias("rows"))
    first = materialize(first, "kept")
    kept = placed.join(hinted(first.filter("rows = 1").select("node")), "node", "left_semi").select(COLUMNS)
    repeated = placed.join(hinted(first.filter("rows > 1").select("node")), "node", "left_semi")
    one = repeated.groupBy("node").agg(F.min(F.struct(COLUMNS)).alias("row")).select("row.*")
    return kept.union(one).union(docs.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows."""
    others = [c for c in COLUMNS if c != "doc_id"]
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), keep=others)
    return found.filter(~decontam.is_contaminated(F.col("n_words"), F.col("n_hit"))).select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs.select(COLUMNS), personal_data_field(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order, each reading what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
