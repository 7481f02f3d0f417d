"""The workload's feed: texts are moved once, and only where a table comes in few pieces."""

from workload import feed as W


def _tables(spark, folder):
    docs = [(i, f"text {i}", "en", f"src{i % 20}", 6) for i in range(40)]
    spark.createDataFrame(docs, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars INT").write.parquet(
        f"{folder}/documents.parquet")
    labels = [(i, i % 2, int(i % 10 == 0)) for i in range(0, 40, 2)] + [(77, 1, 1)]
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")


def test_a_table_in_many_pieces_stays_where_it_is(spark):
    cores = spark.sparkContext.defaultParallelism
    many, few = spark.range(100, numPartitions=2 * cores), spark.range(100, numPartitions=1)
    assert "Exchange" not in W.spread(many)._jdf.queryExecution().executedPlan().toString()
    assert W.spread(few).rdd.getNumPartitions() >= min(2, cores)


def test_both_events_of_a_labelled_document(spark, tmp_path):
    _tables(spark, tmp_path)
    seqs = sorted(r.seq for r in W.feed(spark, str(tmp_path)).collect())
    assert seqs == [*range(40), *(W.RESEND + i for i in range(0, 40, 2))]


def test_stored_documents_are_the_toxic_ones(spark, tmp_path):
    _tables(spark, tmp_path)
    assert sorted(r.document_id for r in W.stored_corpus(spark, str(tmp_path)).collect()) == ["D0", "D10", "D20", "D30"]
    assert W.stored_texts(spark, str(tmp_path)).count() == 4 and W.stored_tenants(spark, str(tmp_path)).count() == 8
