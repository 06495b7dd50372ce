import random

import numpy as np
import pytest

from starloom.llm import repeats

SCHEMA = "doc_id long, text string, row int, spans string, kept string"


def _plain(rows, length):
    """Removed spans by brute force, for rows in order of id and place."""
    seen, result = set(), {}
    for place in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0], i)):
        raw = (rows[place][1] or "").encode()
        gone = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - length + 1):
            piece = raw[i:i + length]
            if piece in seen:
                gone[i:i + length] = 1
            seen.add(piece)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone])))
        result[place] = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
    return result


def _check(spark, rows, length):
    frame = spark.createDataFrame([(*row, i, "s", "k") for i, row in enumerate(rows)], SCHEMA)
    found = repeats.remove(frame, into="spans_").collect()
    expected = _plain(rows, length)
    assert len(found) == len(rows)
    for r in found:
        raw = (rows[r.row][1] or "").encode()
        assert [(s.start, s.end) for s in r.spans_.spans] == expected[r.row], r.row
        assert r.spans_.n_bytes == len(raw) and r.spans_.n_removed == sum(b - a for a, b in expected[r.row])
        assert (r.text is None) == (rows[r.row][1] is None) and r.kept == "k" and r.spans == "s"
    return found


def _corpus(seed, length, alphabet="abcdefgh "):
    draw = random.Random(seed)
    passages = ["".join(draw.choices(alphabet, k=draw.randint(length // 2, 4 * length))) for _ in range(6)]
    rows = []
    for number in range(60):
        text = "".join(
            draw.choice(passages) if draw.random() < 0.4 else "".join(draw.choices(alphabet, k=draw.randint(0, 3 * length)))
            for _ in range(draw.randint(0, 5))
        )
        rows.append((draw.randint(0, 50), text))
    return rows + [(None, passages[0]), (None, passages[0]), (3, None), (4, ""), (5, passages[1]), (5, passages[1])]


def test_index_finds_repeats_as_brute_force_does(monkeypatch):
    monkeypatch.setattr(repeats, "LENGTH", 10)
    draw = random.Random(2)
    for trial in range(150):
        alphabet = "ab" if trial % 2 else "abcde\x00"
        base = ["".join(draw.choices(alphabet, k=draw.randint(0, 60))) for _ in range(3)]
        texts = [(draw.choice(base) + draw.choice(base))[draw.randint(0, 20):].encode() for _ in range(draw.randint(1, 7))]
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            continue
        index = repeats.RunLengthIndex(data, np.concatenate([[0], np.cumsum([len(text) for text in texts])]))
        seen, expected = set(), []
        for text in texts:
            for i in range(len(text) + 1):
                piece = text[i:i + 10]
                expected.append(len(piece) == 10 and piece in seen)
                if len(piece) == 10:
                    seen.add(piece)
        assert index.repeated().tolist() == expected
        assert len(index.run_start) <= index.size and len(index.sample) <= len(index.run_start) + len(texts)


def test_matching_statistics_by_brute_force(monkeypatch):
    monkeypatch.setattr(repeats, "LENGTH", 1000)
    texts = [b"banana", b"ananas", b"bandana", b"banana"]
    bounds = np.concatenate([[0], np.cumsum([len(text) for text in texts])])
    index = repeats.RunLengthIndex(np.frombuffer(b"".join(texts), np.uint8), bounds)
    before, match = index.matching_statistics()
    suffix = {}
    for number, text in enumerate(texts):
        for i in range(len(text)):
            suffix[int(bounds[number]) + number + i] = text[i:]
    order = sorted(suffix, key=lambda place: (suffix[place], place))
    for one, two in zip(order, order[1:]):
        shared = next((i for i, (a, b) in enumerate(zip(suffix[one], suffix[two])) if a != b), min(len(suffix[one]), len(suffix[two])))
        assert (before[two], match[two]) == (one, shared)


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_spans_as_by_brute_force(spark, seed):
    _check(spark, _corpus(seed, repeats.LENGTH), repeats.LENGTH)


def test_characters_of_several_bytes_and_long_runs(spark):
    rows = [(i, "é漢\U0001f600" * 40 + "x" * i) for i in range(6)] + [(9, "a" * 3000), (10, "ab" * 2000), (11, "ab" * 90)]
    for r in _check(spark, rows, repeats.LENGTH):
        assert "�" not in r.text and set(r.text) <= set(rows[r.row][1])


def test_long_texts_cut_into_parts_and_crowded_grams(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CROWDED", 3)
    monkeypatch.setattr(repeats, "CHUNK", 1500)
    passage = "".join(random.Random(7).choices("abcdefgh ", k=400))
    draw = random.Random(8)
    rows = [(i, "".join(draw.choices("abcdefgh ", k=200)) + passage + "".join(draw.choices("ab", k=9))) for i in range(40)]
    rows.append((50, "".join(draw.choices("abcdefgh ", k=4000)) + passage + "".join(draw.choices("abcdefgh ", k=4000)) + passage))
    _check(spark, rows, repeats.LENGTH)


def test_a_hot_passage_is_few_records_in_any_bucket(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CROWDED", 3)
    largest, by_bucket = [], repeats.by_bucket

    def measured(packed, work, schema):
        if "raw" in packed.columns:
            sizes = packed.selectExpr("bucket", "length(blob) + coalesce(length(raw), 0) AS size").groupBy("bucket").sum("size")
            largest.append(max(r[1] for r in sizes.collect()))
        return by_bucket(packed, work, schema)

    monkeypatch.setattr(repeats, "by_bucket", measured)
    draw = random.Random(8)
    passage = "".join(draw.choices("abcdefgh ", k=300))
    rows = [
        (i, "".join(draw.choices("abcdefgh ", k=150)) + passage + "".join(draw.choices("abcdefgh ", k=150))) for i in range(400)
    ]
    _check(spark, rows, repeats.LENGTH)
    assert len(largest) == 1 and largest[0] < 2 * 400 * repeats.LENGTH


def test_broadcasts_are_bounded_by_bytes(spark, monkeypatch):
    hints, broadcast = [], repeats.F.broadcast
    monkeypatch.setattr(repeats.F, "broadcast", lambda side: hints.append(side.columns) or broadcast(side))
    long = "".join(random.Random(3).choices("abcdefgh ", k=400))
    rows = [(i, long[i:] + "xyz"[i % 3] * 20 + long) for i in range(20)]
    _check(spark, rows, repeats.LENGTH)
    assert hints == [["row", "asked"], ["row", "spans"]]
    hints.clear()
    # Fewer rows than any limit on rows, but more bytes than this one.
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", 1000, raising=False)
    _check(spark, rows, repeats.LENGTH)
    assert hints == []


def test_empty_tables(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove(frame).count() == 0
    assert [r.n_removed for r in repeats.remove(spark.createDataFrame([(1, None)], frame.schema)).collect()] == [0]
