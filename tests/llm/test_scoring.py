import math
import re
from collections import Counter

import pytest

from starloom.llm import scoring

SCHEMA = "doc_id long, text string, piece long, n_words int"


def _brute(texts, order):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower)) for text in texts]
    counts = Counter(
        tuple(words[i:i + n]) for words in split for n in range(1, order + 1) for i in range(len(words) - n + 1)
    )
    total = sum(map(len, split))

    def score(gram):
        if len(gram) == 1:
            return counts[gram] / total
        if counts[gram] >= scoring.LEAST_COUNT:
            return counts[gram] / counts[gram[:-1]]
        return scoring.BACKOFF * score(gram[1:])

    return [(len(w), sum(math.log(score(tuple(w[max(0, i - order + 1):i + 1]))) for i in range(len(w)))) for w in split]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_as_by_brute_force(spark, order):
    texts = [None, "", " ", "a", "A b c a b c", "a b c d", "the cat sat", "the cat ran " * 4000, "the dog", "the dog", "é É"]
    frame = spark.createDataFrame([(i % 9, text, 1, 2) for i, text in enumerate(texts)], SCHEMA).repartition(3)
    found = sorted((r.n_words, r.log_score) for r in scoring.score(frame.coalesce(1), order).collect())
    for (words, score), (expected_words, expected) in zip(found, sorted(_brute(texts, order))):
        assert words == expected_words and score == pytest.approx(expected, rel=1e-9)


def test_pieces_make_no_difference(spark, monkeypatch):
    texts = [f"common words and {i % 7} word{i} again common words" for i in range(300)]
    frame = spark.createDataFrame([(i, text, 1, 2) for i, text in enumerate(texts)], SCHEMA)
    whole = {r.doc_id: r.log_score for r in scoring.score(frame).collect()}
    monkeypatch.setattr(scoring, "PIECE", 500)
    assert {r.doc_id: r.log_score for r in scoring.score(frame).collect()} == pytest.approx(whole)


def test_null_means_and_an_empty_table(spark):
    frame = spark.createDataFrame([(None, None, 1, 2), (3, "x", 1, 2)], SCHEMA)
    rows = {r.doc_id: r for r in scoring.score(frame).collect()}
    assert rows[None].mean_log_score is None and rows[None].log_score == 0 and rows[3].mean_log_score == 0
    assert scoring.score(frame.limit(0)).count() == 0


def test_a_query_scores_by_contexts_of_two_words(tmp_path, spark):
    from starloom.llm import queries

    texts = ["a b c", "a b c", "x b d", "x b d", "x b d"]
    rows = [(i, text, 1, 2) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    named = {query.__name__: query for query in queries.QUERIES}
    found = {r.doc_id: r.log_score for r in named["op10_scoring_triples"](spark, str(tmp_path)).collect()}
    assert [found[i] for i in range(5)] == pytest.approx([score for _, score in _brute(texts, 3)], abs=1e-5)
    assert found[0] != pytest.approx(_brute(texts, 2)[0][1], abs=1e-5)
