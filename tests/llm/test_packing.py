import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import packing
from starloom.llm.queries import tokenizer_file

pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, piece string, length string, ids string"
TEXTS = [
    None, "", "  ", "Hello WORLD's it's<|endoftext|>x é́ a b ΑΣ. 123", "I'll 'save .'s x.'s 'S ... a'.b", "x" * 300,
    "tab\tnew\x0bline \x1c z", "naïve … “quoted” ≱", "<|startoftext|> a <|ENDOFTEXT|>", "The end.The end,the END!",
]


def _encode(text):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    return [*encoder.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_ids_are_the_tokenizers(spark):
    rows = [(i, text, "p", "l", "i") for i, text in enumerate(TEXTS)]
    rows += [(100, "some words and marks, again. " * 900, "p", "l", "i"), (100, "some", "p", "l", "i"), (None, "a", "p", "l", "i")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = packing.tokenized(frame, tokenizer_file("word_bpe_49k.json"), 64, with_ids=True).collect()
    pieces = Counter()
    for doc_id, text, *_ in rows:
        ids = _encode(text)
        for number, start in enumerate(range(0, len(ids), 64)):
            part = ids[start:start + 64]
            pieces[doc_id, number, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in found) == pieces


def _check_places(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_every_piece_has_its_place(spark):
    draw = random.Random(1)
    lengths = [draw.choice([draw.randint(1, 100), 37, 63]) for _ in range(3000)]
    pieces = spark.createDataFrame([(i // 2, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    found = packing.pack(pieces, 100).collect()
    assert Counter((r.doc_id, r.length) for r in found) == Counter((i // 2, n) for i, n in enumerate(lengths))
    assert _check_places(found, 100) <= 1.01 * sum(lengths) / 100


def test_repeated_rows_and_an_empty_table(spark):
    pieces = spark.createDataFrame([(1, 40)] * 10, "doc_id long, length long")
    assert _check_places(packing.pack(pieces, 100).collect(), 100) == 5
    assert packing.pack(pieces.limit(0), 100).count() == 0


@pytest.mark.parametrize("histogram, most", [
    ({100: 3}, 3), ({60: 2, 40: 2}, 2), ({50: 3}, 2), ({70: 1, 20: 1, 10: 1}, 1), ({40: 1, 30: 1, 20: 1, 10: 1}, 1),
    ({60: 1, 20: 2}, 1), ({90: 5, 80: 3}, 8), ({25: 4}, 1), ({34: 3}, 2), ({}, 0), ({1: 250}, 3),
])
def test_exact_sums_are_found(histogram, most):
    patterns = packing.plan_sequences(histogram, 100)
    assert sum(count for _, count in patterns) == most
    used = Counter()
    for lengths, count in patterns:
        assert sum(lengths) <= 100
        for length in lengths:
            used[length] += count
    assert used == Counter(histogram)


def test_equal_rows_and_clashing_names(spark):
    rows = [(None, 37, "s", 1, 2, 3, "r", 5)] * 3000 + [(i, 1 + i % 100, "s", i, 2, 3, "r", 5) for i in range(1500)]
    pieces = spark.createDataFrame(
        rows, "doc_id long, length long, salt string, key long, rank long, many long, row string, ahead long"
    )
    found = packing.pack(pieces, 100).collect()
    assert Counter(tuple(r)[:8] for r in found) == Counter(rows)
    _check_places(found, 100)


def test_the_ranks_of_equal_rows_are_spread(spark):
    pieces = spark.createDataFrame([(1, 37)] * 4000, "doc_id long, length long")
    plan = packing.pack(pieces, 100)
    assert plan.count() == 4000
    sizes = pieces.withColumn("row", F.monotonically_increasing_id()).groupBy(
        F.pmod(F.xxhash64("row"), F.lit(4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ).count().agg(F.max("count")).first()[0]
    assert sizes < 500
