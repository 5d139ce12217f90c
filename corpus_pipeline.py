"""A corpus from raw documents to a mixture for training: language, near duplicates, benchmark, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next stage's
documents; all but the last return the columns of ``documents``. A stage works on all rows the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import containment, cross_parsing, mixing, ownership, superminhash
from tidemark.llm.queries import ship
from tidemark.llm.tables import DOCUMENT, Scratch, bounded, held_out, table, training_row

#: Share of the likelihood a predicted language has at least, as a multiple of an even share; a letter or two have less.
MIN_LANGUAGE_SHARE = 1.2
#: A given language is replaced on this share of the likelihood, in a text of so many characters.
DECIDED_SHARE, DECIDED_LENGTH = 0.99, 200
#: The model can tell a language if it reads so many of the held-out texts given as such alike.
TOLD_SHARE = 0.8

ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter; ``lang`` becomes the language that the text is in, by which the mixture is drawn.

    A missing ``lang`` is filled with the prediction, which must be a clear one. A given one is replaced where a text of
    some length is decidedly in another language, most of its pieces too, and the model can tell both: it reads most held-out
    texts given as either alike. A text that the model learned from mostly keeps its ``lang``, right or wrong. Where no row has a ``lang`` to
    learn from, all documents with letters stay, without a language.
    """
    ship(spark)
    model = cross_parsing.fit(docs.where(training_row()))
    lettered = docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).select(*DOCUMENT)
    if not model.languages:
        return lettered
    found = cross_parsing.identify(lettered, model, language="__found", score="__score")
    found = Scratch(spark, "language-stage").keep(found)
    decided = (F.col("__score") >= DECIDED_SHARE) & (F.length("text") >= DECIDED_LENGTH)
    alike = F.avg((F.col("lang") == F.col("__found")).cast("int"))
    told = found.where(held_out() & decided & F.col("lang").isin(*model.languages)).groupBy("lang").agg(alike.alias("alike"))
    told = [r["lang"] for r in told.where(F.col("alike") >= TOLD_SHARE).collect()]
    clear = F.col("__score") >= min(1.0, MIN_LANGUAGE_SHARE / len(model.languages))
    predicted = F.when(F.col("__found") != cross_parsing.UNDETERMINED, F.col("__found"))
    other = decided & (F.col("lang") != F.col("__found")) & F.col("lang").isin(*told) & F.col("__found").isin(*told)
    found = found.withColumn("__text", F.when(other, F.sha2("text", 256)))
    mostly = _mostly(found.where(other), model).withColumn("__mostly", F.lit(True))
    found = found.join(bounded(Scratch(spark, "language-pieces").keep(mostly)), "__text", "left")
    lang = F.when(F.col("lang").isNull() | F.col("__mostly"), predicted).otherwise(F.col("lang"))
    return found.where(F.col("lang").isNotNull() | clear).withColumn("lang", lang).select(*DOCUMENT)


def _mostly(found: DataFrame, model: cross_parsing.LanguageModel) -> DataFrame:
    """``__text`` of texts that are in ``__found`` for over half of their length, piece by piece.

    A text of two languages may be read as a third one that is dear for neither.
    """
    texts = found.groupBy("__text").agg(F.min("text").alias("text"), F.min("__found").alias("whole"))
    starts = F.sequence(F.lit(1), F.length("text"), F.lit(DECIDED_LENGTH))
    pieces = texts.select("__text", "whole", F.explode(F.transform(starts, lambda i: F.substring("text", i, F.lit(DECIDED_LENGTH)))).alias("piece"))
    read = cross_parsing.identify(pieces, model, text="piece", language="__found", score="__score")
    share = F.sum(F.when(F.col("__found") == F.col("whole"), F.length("piece")).otherwise(0)) / F.sum(F.length("piece"))
    return read.groupBy("__text").agg(share.alias("share")).where("share > 0.5").select("__text")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of each group with the smallest doc_id, once; documents without an id stay."""
    ship(spark)
    scratch = Scratch(spark, "dedup-stage")
    out = scratch.keep(superminhash.near_duplicates(docs).select("doc_id", "kept"))
    dropped = out.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # a doc_id whose rows differ in text is dropped only if no row of it is kept
    dropped = dropped.join(out.where("kept").select("doc_id"), "doc_id", "left_anti")
    left = docs.join(bounded(scratch.keep(dropped)), "doc_id", "left_anti")
    repeated = out.where("kept").groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    repeated = bounded(scratch.keep(repeated))
    again = left.join(repeated, "doc_id", "left_semi")
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", "source", "lang", "n_chars"))
    once = again.withColumn("__turn", turn).where("__turn = 1").drop("__turn")
    return left.join(repeated, "doc_id", "left_anti").select(*DOCUMENT).unionByName(once.select(*DOCUMENT))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item.

    Documents without an id or text contain none and stay. Rows that repeat an id contain an item together, and go or
    stay together.
    """
    hit = containment.contained(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    hit = Scratch(spark, "benchmark-stage").keep(hit)
    return docs.join(bounded(hit), "doc_id", "left_anti").select(*DOCUMENT)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut live-looking secrets out of the texts; widely copied examples stay, and so does every document.

    Null texts stay null. Rows that repeat an id and text are cut alike. A row without an id counts for no value and is cut
    at its own spans.
    """
    ship(spark)
    return ownership.redact(docs, repository="doc_id").withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*DOCUMENT)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn documents, text and all, one row per visit, with their place in the order of training.

    Each language of a source, as the first stage found it, is mixed as a source of its own. Null sources are one source, and
    so are null languages. Documents without words come along with their block. Rows without an id are placed by their
    text; repeated rows are drawn each.
    """
    return mixing.mix(docs, parts=("lang",), carry=("text", "lang", "n_chars"))


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("secret scans", secrets),
    ("mixing sources", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs, kept = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        after = scratch.keep(stage(spark, docs, sf_dir))
        if kept is not None:
            scratch.drop(kept)
        docs = kept = after
    return STAGES[-1][1](spark, docs, sf_dir)
