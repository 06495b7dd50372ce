import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from starloom.llm import queries
from starloom.llm.frames import saved

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_their_order_keep_the_columns(spark):
    names = ["language ID", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]
    assert [name for name, _ in pipeline.STAGES] == names
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in pipeline.STAGES:
        docs = saved(stage(spark, docs, FOLDER))
        counts.append(docs.count())
        if name != names[-1]:
            assert docs.columns == columns
            assert docs.filter("n_chars <> char_length(text)").count() == 0
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > counts[4]
    total = docs.agg(F.sum("length")).first()[0]
    sequences = docs.select("sequence_id").distinct().count()
    assert sequences == -(-total // 4096)


def test_planted_cases(spark):
    """Copies, a passage that repeats, and a benchmark passage go; clean texts come through as they were."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    clean = [
        (r.doc_id, r.text, r.lang) for r in pipeline.decontaminated(spark, docs, FOLDER).filter("n_chars > 600").collect()
    ]
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    passage = " ".join(clean[0][1].split()[:60])
    words = clean[1][1].split()
    words[len(words) // 2] = "changed"
    own = [" ".join(reversed(clean[i][1].split())) for i in (3, 4)]  # texts unlike any other
    planted = {
        90_001: clean[2][1], 90_002: " ".join(words), 90_003: own[0] + "\n" + passage, 90_004: own[1] + " " + item,
        90_005: "12 34 --", 90_006: None,
    }
    extra = [
        (*(i, text, "en", "s", len(text or "")), 1, "x", {"a": 1}) for i, text in planted.items()
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, `language` string, m map<string, int>"
    rows = docs.withColumns({"row": F.lit(1), "language": F.lit("x"), "m": F.create_map(F.lit("a"), F.lit(1))})
    table = saved(rows.unionByName(spark.createDataFrame(extra, schema)))
    one = saved(pipeline.language_id(spark, table, FOLDER))
    assert one.columns == table.columns
    kept = {r.doc_id for r in one.collect()}
    assert {90_005, 90_006} & kept == set() and {i for i, _, _ in clean} <= kept
    two = saved(pipeline.near_copies(spark, one, FOLDER))
    kept = {r.doc_id for r in two.collect()}
    assert {90_001, 90_002} & kept == set() and {90_003, 90_004} <= kept and two.columns == table.columns
    three = saved(pipeline.repeated_passages(spark, two, FOLDER))
    texts = {r.doc_id: r.text for r in three.collect()}
    assert passage not in (texts.get(90_003) or "") and three.columns == table.columns
    four = pipeline.decontaminated(spark, two, FOLDER)
    assert 90_004 not in {r.doc_id for r in four.collect()} and four.columns == table.columns


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = saved(stage(spark, docs, FOLDER))
        assert docs.count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    frame = {query.__name__: query for query in queries.QUERIES}[name](spark, folder)
    ours = sorted(tuple(row) for row in frame.collect())
    assert ours == sorted(connection.sql(queries.ORACLE_SQL[name]).select(*frame.columns).fetchall())


def test_a_query_for_each_operator():
    numbers = {query.__name__.split("_")[0] for query in queries.QUERIES}
    assert numbers == {f"op{number}" for number in range(1, 14)}
