"""Language of words and texts by a linear-chain conditional random field.

Each word gets a score for each language from its affixes, its byte n-grams and
a lexicon; learned transitions link the languages of neighbouring words.  The
forward-backward algorithm turns both into the probability of each language at
each word, and so finds where a text changes its language.  A text's language
is the one with most probability over all its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.frames import give_back, small_batches, tidy
from starloom.llm.text import CHUNK, LETTERS, mixed, slices, span_hashes, text_bytes, words

UNKNOWN = "und"
# The classifier is fitted on so many labelled texts, drawn by hash, and on so many characters of each.
SAMPLE_TEXTS, SAMPLE_CHARACTERS = 2000, 20_000
# Chains are worked on in pieces of so many words, side by side; messages pass from piece to piece.
CHAIN = 64
FEATURE_BITS = 15
# Distinct words whose features a task holds at once.
WORDS_AT_ONCE = 4096
STEPS, CHAINS_PER_STEP, RATE, DECAY = 240, 96, 0.25, 1e-6
# A word is in a language's lexicon if the sample has it so often and mostly in that language.
LEXICON_COUNT, LEXICON_SHARE = 4, 0.7


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # feature by language
    transitions: np.ndarray  # from language by to language
    start: np.ndarray
    lexicon: np.ndarray  # sorted hashes of words
    lexicon_language: np.ndarray


def _feature(values: np.ndarray, kind: int) -> np.ndarray:
    key = values.astype(np.uint64) ^ (np.uint64(kind) << np.uint64(56))
    return (mixed(key) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _features(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray, model: Model
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of words, word after word: their numbers, their values, and where each word's begin."""
    size = end - begin
    # The bytes of all words, a zero before and after each.
    long = size + 2
    first = np.cumsum(long) - long
    place = np.arange(long.sum()) - np.repeat(first, long)
    inner = (place > 0) & (place <= np.repeat(size, long))
    letters = np.zeros(len(place), np.uint64)
    letters[inner] = data[(np.repeat(begin, long) + place - 1)[inner]]
    two, three = letters.copy(), letters.copy()
    two[:-1] |= letters[1:] << np.uint64(8) | np.uint64(1 << 40)
    three[:-1] |= letters[1:] << np.uint64(8)
    three[:-2] |= letters[2:] << np.uint64(16)
    word = np.repeat(np.arange(len(size)), long)
    at_two = place + 1 < np.repeat(long, long)
    at_three = place + 2 < np.repeat(long, long)
    scale = 1 / np.sqrt(np.maximum(size, 1))
    parts = [
        (word[at_two], _feature(two[at_two], 1), scale[word[at_two]]),
        (word[at_three], _feature(three[at_three], 2), scale[word[at_three]]),
        (np.arange(len(size)), _feature(hashes, 3), np.ones(len(size))),
        (np.arange(len(size)), _feature(np.zeros(len(size), np.uint64), 4), np.ones(len(size))),
    ]
    for length in (2, 3, 4):
        have = np.flatnonzero(size >= length)
        prefix, suffix = np.zeros(len(have), np.uint64), np.zeros(len(have), np.uint64)
        for i in range(length):
            prefix = prefix << np.uint64(8) | data[begin[have] + i]
            suffix = suffix << np.uint64(8) | data[end[have] - length + i]
        parts.append((have, _feature(prefix, 5 + length), np.ones(len(have))))
        parts.append((have, _feature(suffix, 10 + length), np.ones(len(have))))
    if len(model.lexicon):
        at = np.minimum(np.searchsorted(model.lexicon, hashes), len(model.lexicon) - 1)
        known = np.flatnonzero(model.lexicon[at] == hashes)
        parts.append((known, _feature(model.lexicon_language[at[known]], 20), np.ones(len(known))))
    owner = np.concatenate([part[0] for part in parts])
    order = np.argsort(owner, kind="stable")
    numbers = np.concatenate([part[1] for part in parts])[order]
    values = np.concatenate([part[2] for part in parts])[order].astype(np.float32)
    return numbers, values, np.searchsorted(owner[order], np.arange(len(size)))


def _scores(features: tuple[np.ndarray, np.ndarray, np.ndarray], weights: np.ndarray) -> np.ndarray:
    numbers, values, starts = features
    if not len(starts):
        return np.zeros((0, weights.shape[1]), np.float32)
    return np.add.reduceat(weights[numbers] * values[:, None], starts, axis=0)


def _chains(counts: np.ndarray, length: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """Words laid out by piece of a chain and place, -1 where a piece is shorter; the text of each piece."""
    sizes = np.diff(counts)
    number = -(-sizes // length)
    text = np.repeat(np.arange(len(sizes)), number)
    within = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    first = counts[:-1][text] + within * length
    place = first[:, None] + np.arange(length)
    return np.where(place < counts[1:][text][:, None], place, -1), text


def _forward_backward(
    scores: np.ndarray, there: np.ndarray, transitions: np.ndarray, start: np.ndarray, pairs: bool = False,
    last: np.ndarray | None = None,
):
    """Probabilities of the languages at each place of each chain, and, if asked for, of neighbouring pairs.

    ``scores`` is chain by place by language; places that are not ``there`` are last and say nothing.
    ``start`` scores the first place, for all chains or each; ``last`` is what flows back into each chain's end.
    """
    chains, length, languages = scores.shape
    here = np.exp(scores - scores.max(axis=2, keepdims=True))
    here[~there] = 1
    step = np.exp(transitions)
    ahead = np.empty_like(here)
    now = here[:, 0] * np.exp(start)
    ahead[:, 0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, length):
        now = (ahead[:, t - 1] @ step) * here[:, t]
        ahead[:, t] = now / now.sum(axis=1, keepdims=True)
    back = np.ones((chains, languages), here.dtype) if last is None else last
    expected = np.zeros((languages, languages))
    result = np.empty_like(here)
    for t in range(length - 1, -1, -1):
        now = ahead[:, t] * back
        result[:, t] = now / now.sum(axis=1, keepdims=True)
        if t:
            after = here[:, t] * back
            # Beyond the end of a chain nothing flows back.
            flow = np.where(there[:, t, None], after @ step.T, 1)
            if pairs:
                joint = ahead[:, t - 1, :, None] * step * after[:, None, :]
                joint /= joint.sum(axis=(1, 2), keepdims=True)
                expected += joint[there[:, t]].sum(axis=0)
            back = flow / flow.sum(axis=1, keepdims=True)
    return (result, expected) if pairs else result


def _messages(
    scores: np.ndarray, there: np.ndarray, text: np.ndarray, transitions: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What the pieces of a chain tell each other: the start scores of each piece, and what flows back into its end.

    Each piece is summed up as a matrix, all pieces at once; the matrices of one
    text are then passed through in order, so that nothing is lost at a cut.
    """
    count = scores.shape[2]
    step = np.exp(transitions)
    first = np.tile(np.exp(start), (len(text), 1)).astype(scores.dtype)
    last = np.ones_like(first)
    follows = np.flatnonzero(text[1:] == text[:-1])  # pieces that another one follows
    if not len(follows):
        return np.log(first), last
    of_text = np.union1d(follows, follows + 1)
    here = np.exp(scores[of_text] - scores[of_text].max(axis=2, keepdims=True))
    through = here[:, 0, None, :] * np.eye(count, dtype=scores.dtype)
    for t in range(1, scores.shape[1]):
        now = (through.reshape(-1, count) @ step).reshape(through.shape) * here[:, t, None, :]
        now /= now.sum(axis=(1, 2), keepdims=True)
        through = np.where(there[of_text, t, None, None], now, through)
    row = np.searchsorted(of_text, np.arange(len(text)))
    place = np.arange(len(text)) - np.searchsorted(text, text)
    order = follows[np.argsort(place[follows], kind="stable")]
    rounds = np.split(order, np.flatnonzero(np.diff(place[order])) + 1)
    for at in rounds:
        out = np.einsum("bi,bij->bj", first[at], through[row[at]]) @ step
        first[at + 1] = out / out.sum(axis=1, keepdims=True)
    for at in reversed(rounds):
        out = np.einsum("bij,bj->bi", through[row[at + 1]], last[at + 1]) @ step.T
        last[at] = out / out.sum(axis=1, keepdims=True)
    return np.log(np.maximum(first, np.finfo(first.dtype).tiny)), last


def fit(texts: list[str], labels: list[str], seed: int = 11) -> Model:
    """Learn from texts of one stated language each.

    To learn how languages change within a text, chains are put together from
    stretches of one to three texts.
    """
    languages = sorted(set(labels))
    count = len(languages)
    data, bounds = text_bytes(pc.utf8_lower(pa.array(texts, pa.large_string())))
    begin, end, counts = words(data, bounds, LETTERS)
    label = np.searchsorted(languages, labels)
    model = Model(
        languages, np.zeros((1 << FEATURE_BITS, count), np.float32), np.zeros((count, count)), np.zeros(count),
        np.zeros(0, np.uint64), np.zeros(0, np.int64),
    )
    if not len(begin) or count < 2:
        return model
    hashes, first, kind = np.unique(span_hashes(data, begin, end), return_index=True, return_inverse=True)
    of_word = np.repeat(label, np.diff(counts))
    seen = np.zeros((len(hashes), count))
    np.add.at(seen, (kind, of_word), 1)
    # A lexicon of the words that the sample has in one language; each second text helps to make it, so that
    # the others show the model words that it lacks.
    half = np.zeros((len(hashes), count))
    even = np.repeat(np.arange(len(texts)) % 2 == 0, np.diff(counts))
    np.add.at(half, (kind[even], of_word[even]), 1)
    listed = np.flatnonzero(
        (half.sum(axis=1) >= LEXICON_COUNT) & (half.max(axis=1) >= LEXICON_SHARE * half.sum(axis=1))
    )
    model.lexicon, model.lexicon_language = hashes[listed], half[listed].argmax(axis=1)
    # Some words at a time, as the driver holds them all.
    blocks = [
        _features(data, begin[first[low:low + 16384]], end[first[low:low + 16384]], hashes[low:low + 16384], model)
        for low in range(0, len(hashes), 16384)
    ]
    numbers = np.concatenate([block[0].astype(np.int32) for block in blocks])
    values = np.concatenate([block[1] for block in blocks])
    before = np.cumsum([0, *(len(block[0]) for block in blocks)])
    starts = np.concatenate([block[2] + at for block, at in zip(blocks, before)])
    del blocks
    widths = np.diff(np.append(starts, len(numbers)))

    draw = np.random.Generator(np.random.PCG64(seed))
    usable = np.flatnonzero(np.diff(counts) > 0)
    squares = np.full(model.weights.shape, 1e-3, np.float32)
    squares_t, squares_s = np.full((count, count), 1e-3), np.full(count, 1e-3)
    for _ in range(STEPS):
        picked = draw.choice(usable, (CHAINS_PER_STEP, 3))
        cuts = np.sort(draw.integers(0, CHAIN + 1, (CHAINS_PER_STEP, 2)), axis=1)
        cuts[draw.random(CHAINS_PER_STEP) < 0.4] = CHAIN  # these chains stay in one text
        which = (np.arange(CHAIN) >= cuts[:, :1]).astype(int) + (np.arange(CHAIN) >= cuts[:, 1:])
        text = np.take_along_axis(picked, which, axis=1)
        size = np.diff(counts)[text]
        offset = np.take_along_axis(draw.integers(0, 1 << 30, (CHAINS_PER_STEP, 3)), which, axis=1)
        word = counts[:-1][text] + (offset + np.arange(CHAIN)) % size
        truth = label[text]
        used, at = np.unique(kind[word], return_inverse=True)
        at = at.reshape(word.shape)
        places = np.concatenate([np.arange(a, a + w) for a, w in zip(starts[used], widths[used])])
        own = (numbers[places], values[places], np.cumsum(widths[used]) - widths[used])
        scores = _scores(own, model.weights)[at].astype(np.float64)
        there = np.ones(word.shape, bool)
        found, expected = _forward_backward(scores, there, model.transitions, model.start, pairs=True)
        miss = np.eye(count)[truth] - found
        per_word = np.zeros((len(used), count))
        np.add.at(per_word, at.ravel(), miss.reshape(-1, count))
        slope = np.repeat(per_word, widths[used], axis=0) * own[1][:, None]
        gradient = np.stack([
            np.bincount(own[0], slope[:, i], 1 << FEATURE_BITS) for i in range(count)
        ], axis=1) / word.size
        gradient -= DECAY * model.weights
        squares += gradient**2
        model.weights += (RATE * gradient / np.sqrt(squares)).astype(np.float32)
        observed = np.zeros((count, count))
        np.add.at(observed, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
        change = (observed - expected) / word.size
        squares_t += change**2
        model.transitions += RATE * change / np.sqrt(squares_t)
        change = miss[:, 0].mean(axis=0)
        squares_s += change**2
        model.start += RATE * change / np.sqrt(squares_s)
    return model


def labelled(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The probability of each language at each word of some texts, and the words' bounds by text."""
    data, bounds = text_bytes(pc.utf8_lower(column))
    begin, end, counts = words(data, bounds, LETTERS)
    count = len(model.languages)
    result = np.zeros((len(begin), count))
    if len(begin) and count:
        hashes, first, kind = np.unique(span_hashes(data, begin, end), return_index=True, return_inverse=True)
        parts = (slice(low, low + WORDS_AT_ONCE) for low in range(0, len(first), WORDS_AT_ONCE))
        scores = np.concatenate([
            _scores(_features(data, begin[first[part]], end[first[part]], hashes[part], model), model.weights)
            for part in parts
        ])
        layout, text = _chains(counts)
        there = layout >= 0
        at, transitions = scores[kind[np.where(there, layout, 0)]], model.transitions.astype(np.float32)
        start, last = _messages(at, there, text, transitions, model.start.astype(np.float32))
        found = _forward_backward(at, there, transitions, start, last=last)
        result[layout[there]] = found[there]
    return result, counts


def held_out(doc_id: Column) -> Column:
    """Rows kept from training, by id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def train(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang"
) -> Model:
    """Fit on a bounded sample of the rows that have a language and are not held out."""
    usable = documents.filter(
        ~held_out(F.col(id_column)) & F.col(language_column).isNotNull() & F.col(text_column).isNotNull()
        & F.col(id_column).isNotNull()
    ).select(
        F.left(text_column, F.lit(SAMPLE_CHARACTERS)).alias("text"), F.col(language_column).alias("lang"), F.xxhash64(id_column, text_column).alias("draw")
    )
    # Somewhat more than are wanted are drawn by hash, so that no task offers more than its share.
    chance = min(1.0, 1.3 * SAMPLE_TEXTS / max(1, usable.count()))
    drawn = usable.filter(F.pmod(F.xxhash64("draw"), F.lit(1 << 30)) <= int(chance * (1 << 30)))
    rows = drawn.orderBy("draw", "lang").limit(SAMPLE_TEXTS).collect()
    model = fit([row.text for row in rows], [row.lang for row in rows])
    give_back()
    return model


OWN = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("n_words", T.LongType()), T.StructField("n_switches", T.LongType()),
])


def identify(
    documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", into: str | None = None
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, n_words, n_switches`` for every row, from the whole text alone.

    ``score`` is the mean probability of the predicted language over all words,
    ``n_switches`` how often the likeliest language changes.  A null text or one
    without a letter is ``und`` with a score of 0; so is every text if nothing
    could be learned.  With ``into`` the result is ``documents`` with these
    values in one more column of that name.
    """
    schema = documents.schema if into else T.StructType([])
    # Columns go by number, so that names cannot clash.
    kept = [F.col(f"`{field.name}`").alias(f"keep_{i}") for i, field in enumerate(schema)]
    fields = [T.StructField(f"keep_{i}", field.dataType) for i, field in enumerate(schema)]
    text = f"keep_{documents.columns.index(text_column)}" if into else "text"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = np.array([*model.languages, UNKNOWN], object)
        for batch in slices(batches, text, CHUNK // 2):
            chances, counts = labelled(batch.column(text), model)
            sizes = np.diff(counts)
            total = np.zeros((len(sizes), max(1, chances.shape[1])))
            some = np.flatnonzero(sizes)
            if len(some) and chances.shape[1]:
                total[some] = np.add.reduceat(chances, counts[some], axis=0) / sizes[some, None]
            best, score = total.argmax(axis=1), np.clip(total.max(axis=1), 0, 1)
            data, bounds = text_bytes(batch.column(text))
            latin = np.concatenate([[0], np.cumsum(LETTERS[data] & (data < 0x80))])
            lettered = latin[bounds[1:]] > latin[bounds[:-1]]
            for i in np.flatnonzero(~lettered & (sizes > 0)):
                lettered[i] = any(map(str.isalpha, batch.column(text)[int(i)].as_py()))
            unknown = ~lettered | (len(model.languages) == 0)
            best[unknown], score[unknown] = len(model.languages), 0
            top = chances.argmax(axis=1) if chances.shape[1] else np.zeros(len(chances), int)
            change = np.zeros(len(top) + 1, np.int64)
            change[2:] = np.cumsum(np.diff(top) != 0) if len(top) else 0
            switches = np.where(sizes > 0, change[counts[1:]] - change[np.minimum(counts[:-1] + 1, counts[1:])], 0)
            names = [field.name for field in fields]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in names), batch.column("id"), batch.column("held"),
                    pa.array(languages[best], pa.string()), pa.array(score), pa.array(sizes), pa.array(switches),
                ],
                [*names, *OWN.names],
            )

    more = [] if into else [F.col(text_column).alias("text")]
    result = small_batches(documents).select(
        *kept, F.col(id_column).cast("long").alias("id"), held_out(F.col(id_column)).alias("held"), *more
    ).mapInArrow(tidy(predict), T.StructType([*fields, *OWN.fields]))
    if not into:
        return result
    return result.select(
        *(F.col(f"keep_{i}").alias(field.name) for i, field in enumerate(schema)), F.struct(*OWN.names).alias(into)
    )
