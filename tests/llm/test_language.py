import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import language

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_forward_backward_by_enumeration():
    draw = np.random.default_rng(1)
    scores, transitions, start = draw.normal(size=(2, 4, 3)), draw.normal(size=(3, 3)), draw.normal(size=3)
    there = np.array([[True] * 4, [True, True, False, False]])
    found, expected = language._forward_backward(scores, there, transitions, start, pairs=True)
    pairs = np.zeros((3, 3))
    for chain, length in ((0, 4), (1, 2)):
        total, marginal, own = 0, np.zeros((length, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=length):
            weight = start[path[0]] + sum(scores[chain, t, path[t]] for t in range(length))
            weight = np.exp(weight + sum(transitions[a, b] for a, b in zip(path, path[1:])))
            total += weight
            for t in range(length):
                marginal[t, path[t]] += weight
            for a, b in zip(path, path[1:]):
                own[a, b] += weight
        assert np.allclose(found[chain, :length], marginal / total)
        pairs += own / total
    assert np.allclose(expected, pairs)


@pytest.mark.parametrize("seed", [1, 2])
def test_long_texts_are_one_chain(seed):
    draw = np.random.default_rng(seed)
    sizes = [1000, 0, 64, 1, 65, 128, 3, 700]
    counts = np.cumsum([0, *sizes])
    scores, transitions, start = 2 * draw.normal(size=(counts[-1], 4)), 2 * draw.normal(size=(4, 4)), draw.normal(size=4)
    layout, text = language._chains(counts)
    there = layout >= 0
    pieces = scores[np.where(there, layout, 0)]
    starts, last = language._messages(pieces, there, text, transitions, start)
    found = language._forward_backward(pieces, there, transitions, starts, last=last)
    result = np.zeros_like(scores)
    result[layout[there]] = found[there]
    for low, high in zip(counts, counts[1:]):
        if high > low:
            whole = language._forward_backward(scores[None, low:high], np.ones((1, high - low), bool), transitions, start)
            assert np.allclose(result[low:high], whole[0], atol=1e-9)


def test_labels_do_not_depend_on_the_length_of_pieces(spark, model, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    column = pa.array([*texts, " ".join(text or "" for text in texts[:20]), None, ""])
    one, counts = language.labelled(column, model)
    monkeypatch.setattr(language._chains, "__defaults__", (int(np.diff(counts).max()),))
    whole, _ = language.labelled(column, model)
    assert np.diff(counts).max() > 1000 and np.abs(one - whole).max() < 1e-3


def test_held_out_accuracy(spark, model):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = language.identify(documents, model, into="found").collect()
    held = [r for r in rows if r.found.held_out]
    assert len(held) > 100 and sum(r.found.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.found.score <= 1 for r in rows)


def test_words_of_two_languages_are_told_apart(spark, model):
    texts = {r.lang: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").filter("n_chars > 2000").collect()}
    parts = [" ".join(texts[lang].split()[:40]) for lang in ("en", "de")]
    chances, counts = language.labelled(pa.array([" ".join(parts), parts[0]]), model)
    top = np.array(model.languages)[chances.argmax(axis=1)]
    change, end = counts[2] - counts[1], counts[1]
    assert (top[:change - 2] == "en").mean() > 0.9 and (top[change + 2:end] == "de").mean() > 0.9


def test_texts_without_letters_and_odd_rows(spark, model):
    rows = [
        (1, None, "x"), (2, "", "x"), (3, "12 -- 34!", "x"), (4, "… — “”", "x"), (None, "the and of", "x"),
        (6, "the of and that " * 30_000, "x"), (6, "w" * 100_000, "x"), (7, "漢字", "x"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = language.identify(frame, model, into="score_").collect()
    assert [r.score_.lang_pred == "und" for r in found] == [True, True, True, True, False, False, False, False]
    assert [r.score_.score for r in found[:4]] == [0.0] * 4 and found[5].score_.lang_pred == "en"
    assert [r.score for r in found] == ["x"] * 8 and found[4].score_.held_out is False


def test_nothing_to_learn_from(spark, model):
    frame = spark.createDataFrame([(1, "the of", None), (2, None, "en")], "doc_id long, text string, lang string")
    taught = language.train(frame)
    assert [r.lang_pred for r in language.identify(frame, taught).collect()] == ["und", "und"]
    assert language.identify(frame.limit(0), model).count() == 0
    assert language.train(frame.limit(0)).languages == []


def test_one_language_alone(spark):
    frame = spark.createDataFrame([(i, "some words", "en") for i in range(20)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language.identify(frame, language.train(frame)).collect()} == {"en"}


def test_training_uses_neither_held_out_rows_nor_other_columns(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    held = language.held_out(F.col("doc_id"))
    spoiled = documents.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    one, two = language.train(documents), language.train(spoiled)
    assert one.languages == two.languages and np.array_equal(one.weights, two.weights)


def test_long_texts_teach(spark):
    words = {"en": "the and of that with house tree", "fr": "le et de que avec maison arbre"}
    rows = [(i, " ".join(random.Random(i).choices(words[lang].split(), k=5000)), lang) for i, lang in enumerate(["en", "fr"] * 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert min(len(text) for _, text, _ in rows) > 20_000
    found = {r.doc_id: r.lang_pred for r in language.identify(frame, language.train(frame)).collect()}
    assert found == {i: lang for i, _, lang in rows}


def test_memory_of_many_distinct_words(model, monkeypatch):
    draw = random.Random(5)
    few, many = (
        pa.array([" ".join("".join(draw.choices("abcdefgh", k=9)) for _ in range(number))]) for number in (500, 40_000)
    )

    def peak(column):
        tracemalloc.start()
        found, _ = language.labelled(column, model)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found, most

    peak(few)  # tables that stay
    found, most = peak(many)
    # The features of all words at once took 93 MB.
    assert most < 40e6
    monkeypatch.setattr(language, "WORDS_AT_ONCE", 1 << 40)
    whole, all_at_once = peak(many)
    assert all_at_once > most
    assert np.array_equal(found, whole)
