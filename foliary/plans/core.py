"""What happens to documents once decided: clean-up of new ones, overrides on stored ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.functions.documents import merge_overrides, only_static
from foliary.functions.text import normalize_text
from foliary.operators.fold import fold_overrides
from foliary.operators.ligatures import ArrivalLexicon, Lexicon, repair_ligatures
from foliary.operators.tables import upsert
from foliary.plans.ingest import Decisions

Preprocessor = Callable[[DataFrame], DataFrame]


def preprocess(documents: DataFrame, steps: Sequence[Preprocessor] = ()) -> DataFrame:
    """Run document frames through the steps in order."""
    return reduce(DataFrame.transform, steps, documents)


def clean_texts(
    documents: DataFrame, lexicon: Lexicon | ArrivalLexicon, id_col: str = "doc_id", seq_col: str | None = None
) -> DataFrame:
    """Repair ligatures, then normalise ``doc.extracted_text``."""
    repaired = repair_ligatures(documents, lexicon, id_col, "doc.extracted_text", seq_col)
    return repaired.withColumn(
        "doc", F.col("doc").withField("extracted_text", normalize_text(F.col("doc.extracted_text")))
    )


def core_new(
    new_documents: DataFrame, lexicon: Lexicon | ArrivalLexicon, steps: Sequence[Preprocessor] = ()
) -> DataFrame:
    """New documents ``(doc_id, doc, seq, …)`` in their stored form: cleaned, then preprocessed."""
    return preprocess(clean_texts(new_documents, lexicon, seq_col="seq"), steps)


def core_update(documents: DataFrame, folded: DataFrame) -> DataFrame:
    """Stored documents ``(doc_id, doc)`` with their folded overrides applied.

    Labels are added, source URI and genre replaced; derived annotations go when annotators are to
    run again. Documents without overrides pass unchanged.
    """
    overrides = folded.select(
        F.col("target_id").alias("doc_id"),
        F.struct("labels", "source_uri", "tenants", "genre", "run_annotators").alias("_o"),
    )
    merged = merge_overrides(F.col("doc"), F.col("_o"))
    stripped = merged.withField("annotations", only_static(F.col("doc.annotations")))
    return (
        documents.join(overrides, "doc_id", "left")
        .withColumn(
            "doc",
            F.when(F.col("_o").isNull(), F.col("doc"))
            .when(F.col("_o.run_annotators"), stripped).otherwise(merged),
        )
        .select(*documents.columns)
    )


def apply_decisions(
    decisions: Decisions, lexicon: Lexicon | ArrivalLexicon, steps: Sequence[Preprocessor] = ()
) -> DataFrame:
    """Rows of the corpus table a batch adds or replaces, in the corpus schema.

    A NEW document that receives overrides later in the batch gets them, too.
    """
    folded = fold_overrides(decisions.messages)
    rows = decisions.stored_targets
    stored = rows.select(F.col("document_id").alias("doc_id"), F.struct(*rows.columns).alias("doc"))
    fresh = core_new(decisions.new_documents.select("doc_id", "doc", "seq"), lexicon, steps).select("doc_id", "doc")
    return core_update(stored.unionByName(fresh), folded).select("doc.*")


def tenant_additions(decisions: Decisions) -> DataFrame:
    """``(tenant, doc_id)`` memberships a batch asks for, through new documents and overrides."""
    given = decisions.new_documents.select("doc_id", F.explode("overrides.tenants").alias("tenant"))
    asked = decisions.messages.select(
        F.col("target_id").alias("doc_id"), F.explode("overrides.tenants").alias("tenant")
    )
    return given.unionByName(asked).select("tenant", "doc_id").distinct()


def corpus_after(corpus: DataFrame, changed: DataFrame) -> DataFrame:
    """Whole corpus with the changed rows in place."""
    return upsert(corpus, changed.withColumn("seq", F.lit(0)))
