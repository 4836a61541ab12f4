"""The corpus pipeline: documents through language ID, exact dedup, near dedup, decontamination and tokenisation.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns the columns of documents;
the last one returns the ids. Between stages documents are written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.llm import decontamination, exact_dedup, language_id, near_dedup, sentencepiece_codec
from urbanframe.llm.common import table, written

#: Near copies share this much of their five-word shingles, in percent.
SHINGLE, SIMILAR = 5, 80
#: A text that looks less like its best language than this, in shares of all learned ones, is in none of them.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those that look like no learned language; the rest get the predicted language.

    Every row is judged by its own text: repeated rows share a fate, null and empty texts go, and null ids are as any others.
    Ties between languages go to the first by name. Other columns pass through. Without labelled rows nothing can be
    learned and all rows go; an empty table stays empty.
    """
    found = language_id.identify(docs, language_id.learn(docs))
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space stays, whatever its id is.

    It is the one with the most code points, of these the one with the smallest id (null is the last), and of repeated
    rows any one. Null counts as an empty text, so one row without text stays. Other columns pass through; an empty table
    stays empty.
    """
    return exact_dedup.exact_groups(docs).filter("first").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that with the smallest id (null is the last), of repeated rows any one.

    Rows are judged by their ids and texts, so rows of one id with unlike texts all stay; of those with near ones that
    with the least digest. Texts without words are like no other and stay, repeated rows once. Other columns pass through,
    whatever their names are; an empty table stays empty. A row's fate follows from what is in it and never from its
    place, so docs may be read again in other splits.
    """
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    rows = docs.toDF(*names.values()).withColumn("digest", F.sha2(F.coalesce(names["text"], F.lit("")), 256))
    number = F.col(names["doc_id"])
    own = F.struct(number.isNull().alias("none"), number.alias("id"), F.col("digest"))
    judged = near_dedup.near_components(rows.select(own.alias("doc_id"), F.col(names["text"]).alias("text")), SHINGLE, SIMILAR)
    fates = written(judged.groupBy("doc_id").agg(F.first("kept").alias("kept"), F.count("*").alias("n")).select("doc_id.*", "kept", "n"), "fates")
    same = number.eqNullSafe(F.col("id")) & (rows["digest"] == F.col("same_digest"))
    which = lambda what: fates.filter(what).select("id", F.col("digest").alias("same_digest"))
    left = rows.join(which("NOT kept OR n > 1"), same, "left_anti")
    repeated = rows.join(which("kept AND n > 1"), same, "left_semi").dropDuplicates([names["doc_id"], "digest"])
    return left.unionByName(repeated).select(*(F.col(k).alias(c) for c, k in names.items()))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows with a passage of a benchmark item, as it is or edited.

    Every row is judged by its own text: repeated rows share a fate; null and empty texts, and rows with a null id, are
    kept if they hold no passage. Other columns pass through; an empty table stays empty, and without items all rows stay.
    """
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every row's whole text, with their number and checksum, and whether decoding and the library agree.

    Each row, repeated or with a null id, gives one row; null and empty texts have no ids. Other columns of documents than
    doc_id, lang and source are left out. An empty table stays empty.
    """
    out = sentencepiece_codec.encode_texts(docs, sentencepiece_codec.default_model())
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "ids_crc32", "round_trip", "parity")


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", decontaminated),
    ("SentencePiece", tokens),
]

#: No stage list with a learned classifier and a tokenizer is SQL; tests hold every stage and run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; between them rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k + 1}")
    return docs


QUERIES = {"pipeline": run}
