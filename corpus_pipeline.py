"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

All stages but the last return the columns of their input, whatever others it has beside doc_id, text, lang, source and
n_chars.  Each row is a document of its own, rows with a null or repeated doc_id too.  An empty table goes through as one.
A task needs memory for some 20 copies of the largest single text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from silverbrook.llm import jaccard_join, language_id, mixing, packing, substring_dedup
from silverbrook.llm.queries import tokenizer_path
from silverbrook.llm.storage import delete, let_workers_import, passing, written

#: Near duplicates of the pipeline share word 5-grams with a Jaccard index of 0.8 at least.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified go on, with that language.  Null and empty texts and those without a letter go;
    a null lang or source is no evidence.  Equal rows fare alike."""
    let_workers_import(spark)
    return language_id.accepted(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id goes on.  Null and empty texts and rows with a
    null doc_id are in no group and go on; rows that repeat a doc_id go on together."""
    let_workers_import(spark)
    classes = jaccard_join.jaccard_classes(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)
    stay = classes.where("doc_id = component_id or doc_id is null").select("doc_id").distinct()
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["doc_id"]), "left_semi")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; texts of which nothing is left go.  Null and empty texts go
    on as empty ones.  A null doc_id comes before others; a row that stands twice is one document and keeps its text."""
    let_workers_import(spark)
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = substring_dedup.remove_repeats(docs, carry=others).where("kept is null or kept <> ''").withColumn("new", F.coalesce("kept", "text"))
    made = {"doc_id": F.col("doc_id"), "text": F.col("new"), "n_chars": F.length("new").cast("long")}
    return out.select(*[made.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole repetitions, and for one document of a source a part.
    Each row goes by its own count, rows with a null or repeated doc_id too.  A null source is a source of its own; null and
    empty texts have no words that a mix could take, and go."""
    let_workers_import(spark)
    taken = mixing.mix(docs, carry=tuple(docs.columns)).where("taken > 0").select("size", "taken", "carried")
    rounds = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("taken") / F.col("size")) - 1)
    rows = taken.select("size", "taken", "carried", F.explode(rounds).alias("round"))
    left = F.least("size", F.col("taken") - F.col("round") * F.col("size"))
    whole = F.col("carried.text").cast("string")
    words = F.split(F.regexp_replace(whole, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    text = F.when(left == F.col("size"), whole).otherwise(F.array_join(F.slice(words, F.lit(1), left.cast("int")), " "))
    made = {"text": text, "n_chars": F.length(text).cast("long")}  # the documents' columns stay in their struct until here: their names may be any
    return rows.select(*[made.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens.  A null or empty text is its end token alone."""
    let_workers_import(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

#: Near-duplicate classes and token ids have no SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``.  Tables that a stage has made are deleted once its output is written, and that
    output once the next one's is."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES[:-1]):
        with passing(spark):
            docs, done = written(stage(spark, docs, sf_dir), f"stage{i}", stays=True)
        if path:
            delete(spark, path)
        path = done
    return STAGES[-1][1](spark, docs, sf_dir)
