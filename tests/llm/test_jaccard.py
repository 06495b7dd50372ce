import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import jaccard

SCHEMA = "doc_id long, text string, row int, kept string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _plain(rows):
    sets, parent = [_set(text) for _, text in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            if one and sets[j]:
                both = len(one & sets[j])
                if 100 * both >= 80 * (len(one) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(root(i), []).append(doc_id)
    smallest = {k: min((i for i in ids if i is not None), default=None) for k, ids in least.items()}
    return [(len(sets[i]), smallest[root(i)]) for i in range(len(rows))]


def _check(spark, rows):
    frame = spark.createDataFrame([(*row, 0, "k") for row in rows], SCHEMA).coalesce(1)
    found = sorted(jaccard.link(frame).collect(), key=lambda r: r.row)
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in found] == [
        (doc_id, *own) for (doc_id, _), own in zip(rows, _plain(rows))
    ]
    return found


def _corpus(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, number = [], 0
    for size in (1, 3, 4, 5, 6, 7, 8, 9, 10, 14, 20, 30, 45, 60, 90, 140, 250, 600):
        for _ in range(3):
            base = draw.choices(words, k=size)
            for changes in (0, 0, 1, 1, 2, 3, 5):
                copy = [*base]
                for _ in range(min(changes * max(1, size // 80), size)):
                    kind, at = draw.randint(0, 2), draw.randrange(len(copy))
                    if kind == 0:
                        copy[at] = draw.choice(words).upper()
                    elif kind == 1:
                        copy.insert(at, draw.choice(words))
                    elif len(copy) > 1:
                        del copy[at]
                rows.append((number, draw.choice([" ", "  ", "\n"]).join(copy)))
                number += 1
    draw.shuffle(rows)
    line = "this line stands in very many texts of the corpus and links none of them by itself "
    rows += [(number + i, line + " ".join(draw.choices(words, k=draw.randint(1, 40)))) for i in range(150)]
    return rows + [(None, None), (None, "w1 w2"), (None, "w1 w2"), (7, ""), (7, " \t"), (7, "w1 w2"), (9, "x " * 20_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_as_by_brute_force(spark, seed):
    found = _check(spark, _corpus(seed))
    by_component = {}
    for r in found:
        by_component.setdefault(r.component_id, []).append(r)
    for name, members in by_component.items():
        if name is not None:
            assert any(r.kept for r in members)


def test_families_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 5)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for number in range(150):
        copy = [*base]
        for at in draw.sample(range(120), draw.choice([1, 2, 3, 4, 6])):
            copy[at] = f"own{number}x{at}"
        rows.append((number, " ".join(copy)))
    _check(spark, rows)


def test_a_large_family_is_not_sent_once_for_each_block(spark, monkeypatch):
    """Groups of near copies that met by chance: each set is sent a few times, not to 30 blocks; all links are found."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    sent, similar = [], jaccard._similar

    def counted(texts, placed):
        sent.append(placed.count())
        return similar(texts, placed)

    monkeypatch.setattr(jaccard, "_similar", counted)
    draw = random.Random(6)
    rows = []
    for group in range(80):
        base = [f"g{group}w{i}" for i in range(100)]
        for copy in range(6):
            rows.append((len(rows), " ".join(f"{word}x{copy}" if i == draw.randrange(100) else word for i, word in enumerate(base))))
    frame = spark.createDataFrame(rows, "row long, text string").withColumn("doc_id", F.col("row"))
    lists, bounds = jaccard.sets_of(pa.array([text for _, text in rows]))
    ends = [(n, b - a, int(lists[a].view(np.int64)), int(lists[b - 1].view(np.int64))) for n, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist()))]
    signs = spark.createDataFrame(ends, "row long, n_shingles long, first long, last long")
    families = spark.range(len(rows)).withColumn("component", F.lit(0).cast("long"))
    edges = [(r.a, r.b) for r in jaccard._compared(frame, families, signs).collect()]
    assert sum(sent) < 5 * len(rows)
    label = list(range(len(rows)))
    for _ in range(len(rows)):
        before = list(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    expected = _plain(rows)
    assert [label[n] for n in range(len(rows))] == [smallest for _, smallest in expected]


def test_recurring_counts_by_leading_bits_leave_none_out(spark):
    rows = [(0, "a b c d e f g"), (1, "a b c d e f x"), (2, "p q r s t"), (3, None), (70, "a b c d e"), (2**40 + 1, "p q r s t")]
    frame = spark.createDataFrame(rows, "row long, text string")
    found = {r.row: r.recurring for r in jaccard._recurring(frame, 2**50).collect()}
    assert found == {0: 2, 1: 2, 2: 1, 70: 1, 2**40 + 1: 1}
    few_bits = {r.row: r.recurring for r in jaccard._recurring(frame, 0).collect()}
    assert all(few_bits[row] >= times for row, times in found.items())


def test_similar_sets_share_a_key():
    draw = np.random.default_rng(3)
    for size in (*range(1, 60), 100, 333, 1000, 9000):
        for _ in range(3):
            one = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
            gone = draw.integers(0, max(1, int(len(one) * 0.11)) + 1)
            two = np.unique(np.concatenate([one[gone:], draw.integers(0, 2**63, gone).astype(np.uint64)]))
            both = len(np.intersect1d(one, two))
            if gone == 0 or 100 * both < 80 * (len(one) + len(two) - both):
                continue
            common = np.sort(draw.choice(one, len(one) // 2, replace=False))
            for listed in (common, np.zeros(0, np.uint64)):
                keys, owner = jaccard.meeting_keys(
                    np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)]), listed
                )
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist()), size


def test_overlaps_are_counts():
    draw = np.random.default_rng(4)
    members = [np.unique(draw.integers(0, 300, draw.integers(1, 200)).astype(np.uint64) << np.uint64(55)) for _ in range(40)]
    found = jaccard.overlaps(members, 7)
    for i in range(7):
        for j in range(40):
            if i != j:
                assert found[i, j] == len(np.intersect1d(members[i], members[j]))


def test_one_row_of_each_group_stays(spark):
    rows = [(4, "a b c d e f"), (2, "A b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (5, None), (5, ""), (6, "x")]
    frame = spark.createDataFrame([(*row, i, "k") for i, row in enumerate(rows)], SCHEMA).coalesce(1)
    left = jaccard.without_near_copies(frame)
    assert left.columns == frame.columns
    assert sorted(r.row for r in left.collect()) == [1, 4, 5, 6]


def test_dropping_many_copies_shuffles_no_texts(spark, monkeypatch):
    """The numbers of 250 dropped rows go to the scan as bits, however few rows are broadcast."""
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 30)
    rows = [(n, f"a b c d e f{n % 50}", n, "k") for n in range(300)]
    left = jaccard.without_near_copies(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert sorted(r.row for r in left.collect()) == list(range(50))


def test_empty_table(spark):
    assert jaccard.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_common_grams_are_counted_over_all_texts(spark):
    """Of 6,000 texts 24 are the part that makes an n-gram common; 23 are too few."""
    texts = [f"own{n} words{n} of{n} this{n} text{n}" for n in range(6000)]
    for line in range(40):
        for n in range(24 if line < 20 else 23):
            texts[(line * 150 + n * 7) % 6000] += " " + " ".join(f"line{line}word{i}" for i in range(5))
    frame = spark.createDataFrame([(n, n, text) for n, text in enumerate(texts)], "row long, doc_id long, text string")
    counts = Counter(gram for text in texts for gram in _set(text))
    found = jaccard.common_grams(frame)
    assert len(found) == sum(times >= 24 for times in counts.values()) == 20
    lines = pa.array([" ".join(f"line{line}word{i}" for i in range(5)) for line in range(20)])
    assert found.tolist() == sorted(jaccard.sets_of(lines)[0].tolist())
