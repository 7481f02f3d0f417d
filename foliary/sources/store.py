"""Append-only Parquet tables that a job adds one version to per batch.

Each batch writes its rows to a folder of its own (``<table>/batch=<id>``), so repeating a batch
after a failure replaces exactly its own rows, and no folder is read while it is written. Reading
"as of" a batch leaves out that batch and later ones.

The corpus and the search parts are kept in ``BUCKETS`` folders by a hash of the document's id, next to a slim table
``versions`` that says which batches wrote a document. A lookup asks that table first, in the buckets of its
own ids only, and then reads the rows it found from their buckets and batches; versions are never ranked as whole rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from foliary.operators.annotate import OPEN_RUNS
from foliary.operators.neardup import NearDupSettings
from foliary.operators.tables import merge_parts
from foliary.schemas import CORPUS, DEAD_LETTER, STATUS, TENANT_DOCS
from foliary.session import cut
from foliary.sources.index import PIECES, StoredIndex

TABLES = {
    "corpus": CORPUS,
    "versions": "document_id STRING",
    "search_parts": f"{CORPUS}, tenants ARRAY<STRING>",
    "tenant_docs": TENANT_DOCS,
    "index_pieces": PIECES,
    "annotation_runs": "doc_id STRING, label STRING, status STRING, round INT",
    "open_runs": OPEN_RUNS,
    "lexicon": "word STRING, docs BIGINT",
    "pipeline_status": STATUS,
    "dead_letters": DEAD_LETTER,
    "notices": "topic STRING, key STRING, value STRING",
    "origins": "origin STRING",
    "rejected": "seq BIGINT, doc_id STRING, value STRING",
    "decisions": (
        "seq BIGINT, doc_id STRING, target_id STRING, outcome STRING, duplicate_of STRING, "
        "target_change STRING, operation STRING, message STRING, run_annotators BOOLEAN"
    ),
}

#: Folders per batch of the tables that are looked up by document.
BUCKETS = 64
BUCKETED = ("corpus", "versions", "search_parts")
#: A lookup that finds its rows in more batches than this reads all of them.
MOST_BATCHES = 1000


def bucket_of(document_id: str = "document_id") -> Column:
    return F.pmod(F.xxhash64(document_id), F.lit(BUCKETS)).cast("int")


class CorpusStore:
    """All tables of one corpus under ``root``, a folder every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def append(self, table: str, rows: DataFrame, batch: int) -> None:
        """Write a batch's rows; a repeated batch replaces its earlier attempt."""
        untyped = {f.name for f in rows.schema.fields if isinstance(f.dataType, NullType)}
        rows = rows.select(*[
            F.col(f.name).cast(f.dataType) if f.name in untyped else F.col(f.name) for f in self._empty(table).schema.fields
        ])
        path = f"{self._folder(table)}/batch={batch}"
        if table not in BUCKETED:
            rows.write.mode("overwrite").parquet(path)
            return
        rows = rows.withColumn("bucket", bucket_of())
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        if table == "corpus":  # by what was written, so the two agree
            written = self.spark.read.schema(f"{TABLES[table]}, bucket INT").parquet(path)
            self.append("versions", written, batch)

    def number(self, origin: str) -> int:
        """The batch number of an origin, such as a stream's checkpoint and micro-batch id.

        An origin seen before gets its number again, so its rows replace those of its first attempt; a
        new one gets the next free number, so it can never overwrite rows of another. One writer at a time.
        """
        known = self.read("origins")
        seen = known.where(F.col("origin") == origin).agg(F.min("batch")).first()[0]
        if seen is not None:
            return seen
        last = known.agg(F.max("batch")).first()[0]
        if last is None:  # a store written without origins
            found = [self.read(t).agg(F.max("batch")).first()[0] for t in TABLES if t != "origins"]
            last = max((n for n in found if n is not None), default=-1)
        self.append("origins", self.spark.createDataFrame([(origin,)], TABLES["origins"]), last + 1)
        return last + 1

    def _empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], TABLES[table])

    def read(self, table: str, before: int | None = None) -> DataFrame:
        """All rows of a table with their ``batch`` (and ``bucket``), up to but without batch ``before``."""
        try:
            keys = "batch BIGINT, bucket INT" if table in BUCKETED else "batch BIGINT"
            rows = self.spark.read.schema(f"{TABLES[table]}, {keys}").parquet(self._folder(table))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            none = self._empty(table).withColumn("batch", F.lit(None).cast("bigint"))
            return none.withColumn("bucket", F.lit(None).cast("int")) if table in BUCKETED else none
        return rows if before is None else rows.where(F.col("batch") < before)

    def corpus(self, before: int | None = None, ids: DataFrame | None = None) -> DataFrame:
        """Newest version of every stored document; with ``ids`` (document_id) of those only."""
        return StoredCorpus(self, before)(ids)

    def search_view(self, before: int | None = None, ids: DataFrame | None = None) -> DataFrame:
        """The documents with all their annotations and tenants, each field as the newest batch that set it left it."""
        parts = self.read("search_parts", before)
        if ids is not None:
            parts = asked_buckets(parts, ids).join(ids, "document_id", "left_semi")
        return merge_parts(parts.drop("bucket"), "batch")

    def stored(self, before: int | None = None) -> StoredCorpus:
        """Lookup of stored documents by id, as of a batch."""
        return StoredCorpus(self, before)

    def tenant_docs(self, before: int | None = None) -> DataFrame:
        return self.read("tenant_docs", before).drop("batch").distinct()

    def open_runs(self, before: int | None = None) -> DataFrame:
        """``(doc_id, label, round)`` to ask again, as the last batch with annotators left them.

        Every batch writes all that is open then, with one row without a document, so that an empty state counts, too.
        """
        states = self.read("open_runs", before)
        last = states.agg(F.max("batch")).first()[0]
        return states.where((F.col("batch") == F.lit(last)) & F.col("doc_id").isNotNull()).drop("batch")

    def set_open_runs(self, rows: DataFrame, batch: int) -> None:
        marker = self.spark.createDataFrame([(None, None, None)], OPEN_RUNS)
        self.append("open_runs", rows.unionByName(marker), batch)

    def shingle_index(self, before: int | None = None) -> StoredIndex:
        """The inverted index of the texts checked before a batch."""
        return StoredIndex(self, before)

    def add_to_index(self, sets: DataFrame, batch: int, settings: NearDupSettings) -> None:
        """Add a batch's checked texts (see :attr:`foliary.plans.ingest.Checked.index_rows`)."""
        self.shingle_index(batch).add(sets, batch, settings)

    def compact(self, target_root: str) -> CorpusStore:
        """Write the current state of corpus, tenants, words and index as one batch of a new store."""
        fresh = CorpusStore(self.spark, target_root)
        batch = fresh.number(f"compacted from {self.root}")
        fresh.append("corpus", self.corpus(), batch)
        fresh.append("search_parts", self.search_view(), batch)
        fresh.append("tenant_docs", self.tenant_docs(), batch)
        fresh.append("annotation_runs", self.read("annotation_runs").groupBy("doc_id", "label").agg(
            F.max_by("status", "batch").alias("status"), F.max_by("round", "batch").alias("round")), batch)
        fresh.set_open_runs(self.open_runs(), batch)
        fresh.append("lexicon", self.read("lexicon").groupBy("word").agg(F.sum("docs").alias("docs")), batch)
        index = self.shingle_index()
        for window, percent in index.laws:
            fresh.add_to_index(index.rows(), batch, NearDupSettings(window=window, threshold=percent))
        return fresh


def asked_buckets(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` in the buckets that hold the asked ids; a condition on folders, so others are not opened."""
    buckets = [r.bucket for r in ids.select(bucket_of().alias("bucket")).distinct().collect()]
    return rows.where(F.col("bucket").isin(buckets)) if len(buckets) < BUCKETS else rows


class StoredCorpus:
    """The documents of a store as of a batch: which are stored (``known``), and their newest rows (a call)."""

    def __init__(self, store: CorpusStore, before: int | None = None):
        self.store, self.before = store, before

    def known(self, ids: DataFrame | None = None) -> DataFrame:
        """``(document_id, batch, bucket)``: the batch that wrote the newest version; ``ids`` as in a call."""
        versions = self.store.read("versions", self.before)
        if ids is not None:
            versions = asked_buckets(versions, ids).join(ids, "document_id", "left_semi")
        return versions.groupBy("document_id", "bucket").agg(F.max("batch").alias("batch"))

    def __call__(self, ids: DataFrame | None = None) -> DataFrame:
        """Newest rows of the documents ``ids`` (document_id), or of all, in the corpus schema."""
        rows = self.store.read("corpus", self.before)
        places = self.known(ids)
        if ids is not None:
            places = cut(places)
            found = places.agg(F.collect_set("bucket").alias("buckets"), F.slice(
                F.collect_set("batch"), 1, MOST_BATCHES + 1).alias("batches")).first()
            rows = rows.where(F.col("bucket").isin(found.buckets))
            if len(found.batches) <= MOST_BATCHES:
                rows = rows.where(F.col("batch").isin(found.batches))
        return rows.join(places, ["document_id", "batch", "bucket"], "left_semi").drop("batch", "bucket")
