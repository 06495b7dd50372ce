import random

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import frames
from starloom.llm import text as T


def test_scratch_lies_in_the_shared_folder(spark):
    kept = frames.saved(spark.range(3))
    assert all("/llm-" in name for name in kept.inputFiles()) and kept.count() == 3
    assert frames.small(kept, 3) and not frames.small(kept, 2)


def _texts():
    draw = random.Random(5)
    words = ["a", "B", "été", "x\x00y", "word", "Word", "\u3000", "1"]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 12))) + draw.choice(["", " ", "\n"]) for _ in range(60)]
    return [*texts, None, "", " \t", "w" * 5000]



def test_words_are_those_between_ascii_white_space():
    texts = _texts()
    data, bounds = T.text_bytes(pa.array(texts))
    hashes, counts = T.word_hashes(data, bounds, T.NOT_SPACE)
    plain = [bytes(text or "", "utf-8").lower().split() for text in texts]
    assert np.diff(counts).tolist() == [len(words) for words in plain]
    by_word = {}
    for word, number in zip((word for words in plain for word in words), hashes.tolist()):
        assert by_word.setdefault(word, number) == number
    assert len(set(by_word.values())) == len(by_word)


def test_grams_of_equal_words_are_equal():
    texts = ["a b c d e f", "b c d e f g", "a b", "A B", "", None, "a b c d e"]
    data, bounds = T.text_bytes(pa.array(texts))
    grams, places = T.gram_hashes(*T.word_hashes(data, bounds, T.NOT_SPACE), 5)
    parts = [grams[a:b].tolist() for a, b in zip(places, places[1:])]
    assert [len(part) for part in parts] == [2, 2, 1, 1, 0, 0, 1]
    assert parts[0][1] == parts[1][0] and parts[2] == parts[3] and parts[6] == parts[0][:1]
    assert len({*parts[0], *parts[1], *parts[2]}) == 4


def test_slices_of_a_sliced_array_and_of_long_texts():
    batch = pa.record_batch({"text": pa.array(["x" * 10, None, "y" * 50, "", "z"] * 3)}).slice(1)
    parts = list(T.slices(iter([batch]), "text", 20))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist()
    assert len(parts) > 3
    assert T.text_bytes(batch.column("text"))[0].tobytes().startswith(b"yyy")


def test_packed_arrays_come_back():
    keys = np.sort(T.mixed(np.arange(1000, dtype=np.uint64)))
    more = np.arange(1000, dtype=np.int64) - 5
    batch = frames.packed_batches([keys, more], 7)
    assert batch.column("bucket").to_pylist() == list(range(7))
    found = frames.unpack_all(batch.column("blob").to_pylist(), ["u8", "i8"])
    assert (found[0] == keys).all() and (found[1] == more).all()
    assert frames.packed_batches([keys[:0], more[:0]], 7).num_rows == 0


@pytest.mark.parametrize("at_once", [5, 1_000_000])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, at_once):
    monkeypatch.setattr(frames, "EDGES_AT_ONCE", at_once)
    edges = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (9, 3), (3, 9)]
    rows = frames.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {i: 20 for i in range(20, 61)} | {i: 100 for i in range(100, 140)} | {3: 3, 9: 3}
    assert {row.id: row.component for row in rows} == expected
    assert frames.components(spark.createDataFrame([], "a long, b long")).count() == 0
