import random

import pytest

from starloom.llm import decontaminate

DOCS = "doc_id long, text string, item_id long, words int"
ITEMS = "item_id long, text string, doc_id long"


def _words(seed, count):
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefghij", k=6)) for _ in range(count)]


def _leaks(spark, texts, items):
    docs = spark.createDataFrame([(i, text, 0, 0) for i, text in enumerate(texts)], DOCS)
    bench = spark.createDataFrame([(i, text, 0) for i, text in enumerate(items)], ITEMS)
    return {(r.doc_id, r.item_id): r for r in decontaminate.overlaps(docs, bench).collect()}


def _cases():
    one, two, short = _words(1, 40), _words(2, 20), _words(3, 6)
    changed = [*one]
    for i in (4, 11, 19, 30):
        changed[i] = "other"
    texts = [
        "before " + " ".join(one) + " after", " ".join(changed).upper(), " ".join(_words(9, 300)), None, "", "a b c",
        " ".join(one[:9]) + " x", ", ".join(two) + ".", "x " + " ".join(short) + " y", " ".join(short[:5]),
        " ".join(_words(8, 5000) + one + _words(7, 30_000)), " ".join(one[5:25] + ["inserted"] + one[25:]),
        " ".join(one + two),
    ]
    return texts, [" ".join(one), " ".join(two), None, "", " ".join(short), "a b c", " ".join(one)]


EXPECTED = {
    (d, i) for d, own in {0: (0, 6), 1: (0, 6), 7: (1,), 8: (4,), 9: (4,), 10: (0, 6), 11: (0, 6), 12: (0, 1, 6)}.items() for i in own
}


def test_leaks_are_found_and_others_are_not(spark):
    found = _leaks(spark, *_cases())
    assert set(found) == EXPECTED
    assert [tuple(s) for s in found[0, 0].spans] == [(1, 41)] and found[0, 0].words == 40
    assert found[1, 0].words == 36 and found[10, 0].spans[0].first == 5000
    assert found[11, 0].words == 35 and len(found[11, 0].spans) == 2


def test_more_passes_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "WORDS_PER_PASS", 100)
    assert set(_leaks(spark, *_cases())) == EXPECTED


def test_changed_words_at_any_distance(spark):
    draw = random.Random(4)
    item = _words(5, 30)
    texts = []
    for _ in range(200):
        copy = [*item]
        for i in draw.sample(range(30), 3):
            copy[i] = "changed"
        texts.append(" ".join(_words(draw.random(), 10) + copy))
    found = _leaks(spark, texts, [" ".join(item)])
    assert len(found) >= 198  # three changed words may leave no stretch that any mask fits


@pytest.mark.parametrize("before, after, part", [("x y", "z", False), ("", "", False), ("", "z", True), ("x y", "", True), ("", "", True)])
def test_every_pattern_of_changed_words_that_makes_a_leak(spark, before, after, part):
    """Inside of a text or at its edges, where with ``part`` the text holds no more of the item than the stretch that agrees."""
    draw, texts, items, expected = random.Random(6), [], [], set()
    for size in (5, 6, 7, 8, 9, 10, 12, 40, 41):
        item = _words(size, size)
        if size < 11:
            patterns = [[number >> i & 1 for i in range(size)] for number in range(1 << size)]
        else:
            patterns = [[i % n != k for i in range(size)] for n in (3, 4, 5, 6) for k in range(n)]
            patterns += [[draw.random() < 0.8 for _ in range(size)] for _ in range(100)]
        for same in patterns:
            best = max(
                (sum(1 if x else -2 for x in same[a:b]), -b, a, sum(same[a:b])) for a in range(size) for b in range(a, size + 1)
            )
            if best[0] > 0 and best[3] >= min(decontaminate.LEAST_WORDS, decontaminate.LEAST_PART * size):
                expected.add((len(texts), len(items)))
            copy = [word if x else "changed" for word, x in zip(item, same)]
            if part and best[0] > 0:
                # At an edge of the text the item is cut off where its best stretch ends.
                copy = copy[0 if before else best[2]:len(copy) if after else -best[1]]
            texts.append(" ".join([before, *copy, after]))
        items.append(" ".join(item))
    found = set(_leaks(spark, texts, items))
    assert expected <= found and len(expected) > 400
    assert all(pair in expected for pair in found if len(items[pair[1]].split()) < 8)


def test_empty_tables(spark):
    assert _leaks(spark, [], ["a b c d e f"]) == {} and _leaks(spark, ["a b c d e f"], []) == {}


def test_whole_rows_pass_on(spark):
    texts, items = _cases()
    docs = spark.createDataFrame([(5, text, 0, 0) for text in texts] + [(None, None, None, None)], DOCS)
    bench = spark.createDataFrame([(i, text, 0) for i, text in enumerate(items)], ITEMS)
    left = decontaminate.without_leaks(docs.coalesce(1), bench)
    assert left.columns == docs.columns
    leaked = {d for d, _ in EXPECTED}
    assert sorted(r.text or "" for r in left.collect()) == sorted(
        [text or "" for i, text in enumerate(texts) if i not in leaked] + [""]
    )


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_finds_every_shared_run_of_words(spark, folder):
    import re

    from starloom.llm.queries import op1_decontamination

    def runs(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(words[i:i + 13]) for i in range(len(words) - 12)}

    items = {r.item_id: runs(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    shared = {
        (r.doc_id, i) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()
        for own in [runs(r.text)] for i, item in items.items() if own & item
    }
    assert {(r.doc_id, r.item_id) for r in op1_decontamination(spark, folder).collect()} == shared and shared
