"""Row numbers when the cluster changes between two jobs."""

import itertools

import pytest
from pyspark.sql import functions as F

from starloom.llm import decontaminate, frames, jaccard, queries, repeats, scoring

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"
PARALLELISM = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture
def restless(spark, monkeypatch):
    """After each saved table scans are split for another number of cores."""
    cores, plain = itertools.cycle([16, 4, 9]), frames.saved

    def saved(rows):
        written = plain(rows)
        spark.conf.set(PARALLELISM, next(cores))
        return written

    for module in (frames, jaccard, repeats, decontaminate):
        monkeypatch.setattr(module, "saved", saved)
    spark.conf.set(PARALLELISM, 4)
    yield
    spark.conf.unset(PARALLELISM)


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("documents") / "with blank %20")
    spark.read.parquet(DOCUMENTS).repartition(40, "doc_id").write.parquet(folder)
    return spark.read.parquet(folder)


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("stored", [True, False])
def test_jaccard(spark, documents, restless, stored):
    link = lambda rows, **how: _rows(jaccard.link(rows, **how).select("doc_id", "n_shingles", "component_id"))
    assert link(documents, stored=stored) == link(spark.read.parquet(DOCUMENTS).coalesce(1))
    kept = jaccard.without_near_copies(documents, stored=stored)
    assert _rows(kept.select("doc_id")) == sorted({(component,) for _, _, component in link(documents, stored=stored)}, key=repr)


@pytest.mark.parametrize("stored", [True, False])
def test_repeats(spark, documents, restless, stored):
    left = lambda rows, **how: _rows(repeats.remove(rows, **how).select("doc_id", "n_bytes", "n_removed", "kept"))
    assert left(documents, stored=stored) == left(spark.read.parquet(DOCUMENTS).coalesce(1))


def test_decontamination(spark, documents, restless):
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    leaked = {r.doc_id for r in decontaminate.overlaps(documents, benchmark).collect()}
    kept = {r.doc_id for r in decontaminate.without_leaks(documents, benchmark, stored=True).collect()}
    assert leaked and kept == {r.doc_id for r in documents.collect()} - leaked


@pytest.mark.parametrize("query, order", [(queries.op10_scoring, 2), (queries.op10_scoring_triples, 3)])
def test_scoring(spark, documents, monkeypatch, tmp_path, query, order):
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    expected = _rows(scoring.score(spark.read.parquet(DOCUMENTS).coalesce(1), order).select("doc_id", "n_words"))
    plain, switched = frames.saved, []

    def saved(rows):
        written = plain(rows)
        rows.sparkSession.conf.set(PARALLELISM, 16)  # the session that the query reads in
        switched.append(rows.sparkSession)
        return written

    monkeypatch.setattr(scoring, "saved", saved)
    found = query(spark, str(tmp_path))
    assert switched and all(session.conf.get(PARALLELISM) == "16" for session in switched)
    assert _rows(found.select("doc_id", "n_words")) == expected
    assert spark.conf.get(PARALLELISM, None) is None


def test_numbers_of_files(spark, documents):
    before = {r.doc_id: r.n for r in frames.numbered(documents, "n", stored=True).collect()}
    spark.conf.set(PARALLELISM, 40)
    try:
        assert before == {r.doc_id: r.n for r in frames.numbered(documents, "n", stored=True).collect()}
    finally:
        spark.conf.unset(PARALLELISM)
    assert len(set(before.values())) == documents.count()


def test_numbers_of_rows_from_no_file(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",)], "_metadata string")
    assert frames.numbered(rows, "n", stored=True).select("n").distinct().count() == 3


def test_clashing_names(spark, documents):
    taken = documents.select("doc_id", F.lit(1).alias("_metadata"), F.lit(2).alias("_file"), F.lit(3).alias("_index"),
                             F.lit(4).alias("_place"))
    found = frames.numbered(taken, "n", stored=True)
    assert found.columns == [*taken.columns, "n"]
    assert found.filter("_metadata <> 1 OR _file <> 2 OR _index <> 3 OR _place <> 4").count() == 0
    assert found.select("n").distinct().count() == documents.count()


def test_empty_files(spark, documents, tmp_path):
    documents.limit(0).write.parquet(str(tmp_path / "empty"))
    assert frames.numbered(spark.read.parquet(str(tmp_path / "empty")), "n", stored=True).collect() == []


def test_file_names_need_no_python_workers(spark, documents, capsys):
    frames.numbered(documents, "n", stored=True).explain()
    plan = capsys.readouterr().out
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan


def test_small_batches_unless_set(spark, documents):
    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.unset(name)
        frames.small_batches(documents)
        # Texts of 100 kB: 50 MB of a column are read at once, 1 MB is sent.
        assert [int(spark.conf.get(name)) for name in names] == [1 << 20, 512]
        spark.conf.set(names[1], "100")
        frames.small_batches(documents)
        assert spark.conf.get(names[1]) == "100"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)
