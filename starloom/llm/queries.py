"""One query for each operator, over its whole table, with the settings meant for production."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    chat,
    conversations,
    decontaminate,
    jaccard,
    language,
    licenses,
    packing,
    personal,
    repeats,
    scoring,
    sharding,
    vector_codes,
    vectors,
)
from starloom.plans.sizing import steady


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every leak of a benchmark item into a document."""
    return decontaminate.overlaps(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return language.identify(documents, language.train(documents))


def op3_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove(_table(spark, folder, "documents"), stored=True).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link(_table(spark, folder, "documents"), stored=True).select("doc_id", "n_shingles", "component_id")


def op5_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, folder, "embeddings"))


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations, read back from the formatted text by its own marks and spans."""
    probe = "</s>[INST] ok [/INST]"
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema))
    formatted = chat.format_trees(chat.linear(rows)).withColumn("turns", chat.read_back(F.col("formatted")))
    said = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    learned = F.array_join(F.transform("loss_spans", lambda s: chat.unescape(
        F.col("formatted").substr((s.start + 1).cast("int"), s.length.cast("int"))
    )), "")
    return formatted.withColumn("loss", learned).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(said, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(_table(spark, folder, "documents"), 16).withColumns({
        "law": F.lit(sharding.LAW), "grown_shard": F.lit(None).cast("int"),
    })


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents, packed; the tokenizer's file is a parameter of the operator."""
    pieces = packing.tokenized(_table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packing.pack(pieces)


def _scores(spark: SparkSession, folder: str, order: int) -> DataFrame:
    scored = scoring.score(_table(steady(spark), folder, "documents"), order)
    return scored.select(
        "doc_id", "n_words", F.round("log_score", 5).alias("log_score"),
        F.round("mean_log_score", 7).alias("mean_log_score"),
    )


def op10_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder, scoring.ORDER)


def op10_scoring_triples(spark: SparkSession, folder: str) -> DataFrame:
    """The same with contexts of two words."""
    return _scores(spark, folder, 3)


def op11_personal(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every whole text; the digest is over the base spans alone."""

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    return personal.find(_table(spark, folder, "documents")).select(
        "doc_id", *(f"n_{kind}" for kind in personal.BASE_KINDS),
        F.sha2(told(F.filter("spans", lambda s: s.base)), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"),
    )


def op12_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all vectors, with the codebooks' digest on every row."""
    rows, books = vector_codes.compress(_table(spark, folder, "embeddings"))
    digits = F.transform("codes", lambda code: F.lpad(F.lower(F.hex(code)), 2, "0"))
    return vector_codes.with_label_errors(rows).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error",
        F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults, dealt by the checksum of ``conv_id:turn``; nulls are one space."""
    blank = F.lit(" ")
    deal = F.crc32(F.encode(F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    ), "UTF-8")) % 20
    text = F.coalesce("text", blank)
    rows = rows.select(
        "conv_id", "turn", F.when(deal == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(deal == 1, "").when(deal == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(deal == 0, 0).when(deal == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).drop("copy", "copies")


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations after damage; one without rows left has none."""
    rows = _table(spark, folder, "conversations")
    found, turns = conversations.repair(damaged(rows))
    every = rows.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found.drop("conv_id"), "conv", "left").join(conversations.digests(turns), "conv", "left").select(
        "conv_id", *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


QUERIES = (op1_decontamination, op2_language, op3_repeats, op4_jaccard, op5_vectors, op6_licenses, op7_chat, op8_sharding, op9_packing, op10_scoring, op10_scoring_triples, op11_personal, op12_codes, op13_repair)



def _codes_round(number: int) -> str:
    """Assignment to the entries of one round, and the entries of the next."""
    return f"""
        near{number} AS (
            SELECT vec_id, label, p, least % 64 AS entry, least // 64 AS error FROM (
                SELECT c.vec_id, c.label, c.p, min(list_sum([
                    (z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(c.x, b.x)
                ])::BIGINT * 64 + b.entry) AS least
                FROM cut c JOIN book{number} b ON b.p = c.p GROUP BY c.vec_id, c.label, c.p
            )
        ), mean{number} AS (
            SELECT p, entry, list((s - (s % n + n) % n) // n ORDER BY i) AS x FROM (
                SELECT c.p, n.entry, c.i, sum(c.one)::BIGINT AS s, count(*) AS n
                FROM (SELECT vec_id, p, unnest(x) AS one, unnest(range(1, len(x) + 1)) AS i FROM cut) c
                JOIN near{number} n ON n.vec_id = c.vec_id AND n.p = c.p GROUP BY c.p, n.entry, c.i
            ) GROUP BY p, entry
        ), book{number + 1} AS (
            SELECT b.p, b.entry, coalesce(m.x, b.x) AS x
            FROM book{number} b LEFT JOIN mean{number} m ON m.p = b.p AND m.entry = b.entry
        )"""


_CODES_SQL = f"""
    WITH kept AS (
        SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ), cut AS (
        SELECT vec_id, label, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x
        FROM (SELECT vec_id, label, v, unnest(range(16)) AS p FROM kept)
    ), seeds AS (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
    ), book0 AS (
        SELECT c.p, s.entry, c.x FROM cut c JOIN seeds s ON s.vec_id = c.vec_id WHERE s.entry < 64
    ), {_codes_round(0)}, {_codes_round(1)}, {_codes_round(2)}, whole AS (
        SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, sum(error)::BIGINT AS error
        FROM near2 GROUP BY vec_id, label
    )
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (
        SELECT sha256(string_agg(one::VARCHAR, ',' ORDER BY p, entry, i))
        FROM (SELECT p, entry, unnest(x) AS one, unnest(range(1, len(x) + 1)) AS i FROM book2)
    ) AS codebooks_sha256
    FROM whole
"""

ORACLE_SQL = {
    "op10_scoring": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), tokens AS (
            SELECT doc_id, i, words[i] AS word, CASE WHEN i > 1 THEN words[i - 1] END AS before
            FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM split)
        ), ones AS (SELECT word, count(*) AS n FROM tokens GROUP BY word),
        twos AS (SELECT before, word, count(*) AS n FROM tokens WHERE before IS NOT NULL GROUP BY before, word),
        scored AS (
            SELECT t.doc_id, ln(CASE
                WHEN t.before IS NULL THEN o.n / (SELECT count(*) FROM tokens)
                WHEN w.n >= 2 THEN w.n / c.n
                ELSE 0.4 * o.n / (SELECT count(*) FROM tokens) END) AS score
            FROM tokens t JOIN ones o ON o.word = t.word
            LEFT JOIN ones c ON c.word = t.before
            LEFT JOIN twos w ON w.before = t.before AND w.word = t.word
        )
        SELECT d.doc_id, count(s.score) AS n_words, round(coalesce(sum(s.score), 0), 5) AS log_score,
               round(sum(s.score) / count(s.score), 7) AS mean_log_score
        FROM documents d LEFT JOIN scored s ON s.doc_id = d.doc_id GROUP BY d.doc_id
    """,
    "op10_scoring_triples": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), tokens AS (
            SELECT doc_id, i, words[i] AS word, CASE WHEN i > 1 THEN words[i - 1] END AS before,
                   CASE WHEN i > 2 THEN words[i - 2] END AS first
            FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM split)
        ), ones AS (SELECT word, count(*) AS n FROM tokens GROUP BY word),
        twos AS (SELECT before, word, count(*) AS n FROM tokens WHERE before IS NOT NULL GROUP BY before, word),
        threes AS (
            SELECT first, before, word, count(*) AS n FROM tokens WHERE first IS NOT NULL GROUP BY first, before, word
        ), scored AS (
            SELECT t.doc_id, ln(CASE
                WHEN h.n >= 2 THEN h.n / d.n
                ELSE CASE WHEN t.first IS NULL THEN 1 ELSE 0.4 END * CASE
                    WHEN t.before IS NULL THEN o.n / (SELECT count(*) FROM tokens)
                    WHEN w.n >= 2 THEN w.n / c.n
                    ELSE 0.4 * o.n / (SELECT count(*) FROM tokens) END
                END) AS score
            FROM tokens t JOIN ones o ON o.word = t.word
            LEFT JOIN ones c ON c.word = t.before
            LEFT JOIN twos w ON w.before = t.before AND w.word = t.word
            LEFT JOIN twos d ON d.before = t.first AND d.word = t.before
            LEFT JOIN threes h ON h.first = t.first AND h.before = t.before AND h.word = t.word
        )
        SELECT d.doc_id, count(s.score) AS n_words, round(coalesce(sum(s.score), 0), 5) AS log_score,
               round(sum(s.score) / count(s.score), 7) AS mean_log_score
        FROM documents d LEFT JOIN scored s ON s.doc_id = d.doc_id GROUP BY d.doc_id
    """,
    "op12_codes": _CODES_SQL,
}
