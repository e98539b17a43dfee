"""Corpus pipeline: language ID, near-duplicate removal, decontamination, PII surrogates, BPE tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; its result is written as Parquet and read again as the next stage's
``docs``. All but the last return the columns of ``documents``, and any further columns
of ``docs``, whatever their names. A stage decides by row, not by id: a row is known by its id and
a hash of its text, so rows that share an id, or have none, are told apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.llm import bpe, decontaminate, langid, ngram_join, pii
from corridor.llm.queries import SURROGATE_KEY, tokenizer_path
from corridor.llm.storage import fresh, materialise, small_side, table

# Share of a text's n-grams that the language model must have a weight for. Texts in a learned language have
# 0.94 or more, other scripts below 0.12, random letters about 0.55.
MIN_KNOWN = 0.7


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _marks() -> tuple[Column, Column, Column]:
    """What a row is known by: whether it has an id, the id, and a hash of the text (null texts are equal)."""
    return F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")


def _rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the row's marks as id, which order by id with nulls last."""
    none, known, text = _marks()
    return docs.select(F.struct(none.alias("none"), known.alias("id"), text.alias("at")).alias("doc_id"), "text")


def _marked(docs: DataFrame, some: DataFrame, how: str, n: int | None = None) -> DataFrame:
    """Rows of ``docs`` whose marks are (``left_semi``) or are not (``left_anti``) the struct ``row`` of ``some``.

    ``n`` is the counted number of ``some``, where it is known.
    """
    known, text = fresh(docs, "known", "at")
    _, own, hashed = _marks()
    keys = some.select(F.col("row.id").alias(known), F.col("row.at").alias(text)).distinct()
    keys = keys if n is None else small_side(keys, n)
    return docs.join(keys, own.eqNullSafe(F.col(known)) & (hashed == F.col(text)), how)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that was learned: not ``und``, and MIN_KNOWN of the n-grams have a weight."""
    name, = fresh(docs, "language")
    found = langid.with_language(docs, langid.train(docs), name=name)
    known = (F.col(f"{name}.lang_pred") != langid.UNKNOWN) & (F.col(f"{name}.known") >= MIN_KNOWN)
    return found.where(known).select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of linked rows: the one of the smallest id (a null id is the largest).

    Rows with one id and one text are copies, and one of them stays, also where the text is null or
    empty. Rows with one id and different texts are different documents. Rows without an id
    are documents of their own.
    """
    rows = _rows_of(docs)
    again = materialise(rows.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("row")), "repeated")
    n = again.count()
    if n:
        # Copies of one row: an aggregate that is combined before the shuffle, over the repeated rows only.
        known, text = fresh(docs, "known", "at")
        _, own, hashed = _marks()
        copies = _marked(docs, again, "left_semi", n).withColumns({known: own, text: hashed})
        once = copies.dropDuplicates([known, text]).select(*_columns(docs))
        docs = _marked(docs, again, "left_anti", n).unionByName(once)
    groups = ngram_join.link_components(rows).select("doc_id", "component_id")
    stays = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("row"))
    return _marked(docs, stays, "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows whose text holds a window of a benchmark item."""
    found = decontaminate.find_contamination(_rows_of(docs), table(spark, sf_dir, "benchmark"))
    return _marked(docs, found.where("n_hit > 0").select(F.col("doc_id").alias("row")), "left_anti")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates; ``n_chars``, where there is one, follows the new text."""
    new = pii.pseudonymise(docs, SURROGATE_KEY, told=tuple(fresh(docs, "n_entities", "kinds")))
    return new.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
                        for c in docs.columns])


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with the token ids of the whole text and their number."""
    return bpe.encode(docs, tokenizer_path()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("private_data", private_data), ("bpe_tokens", bpe_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs


ORACLE_SQL = None
