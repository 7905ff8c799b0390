"""Language of each word by a linear-chain conditional random field, and of each document.

Words are runs of characters other than space and 09-0D, lower-cased A-Z. Features of a word, by
hash into tables of fixed size: the word itself (lexicon), its first and last one to three bytes
(affixes), and its 2-, 3- and 4-byte n-grams with boundary marks. The emission of a language is
the mean of the weights of each kind, summed; transitions between the languages of neighbouring
words are learned with it. Training maximises the likelihood of the label sequences by gradients
from forward-backward, on a bounded sample: up to ``SAMPLE`` documents per language, each whole
text in consecutive windows of ``STRETCH`` words, whose words have the language of their document.
Windows are put in a fixed random order and joined in twos, so that a sequence may go from any
language to any other in its middle, as code-switched text does. Which languages there are is read
from all training rows.

Scoring runs forward-backward over every whole text, in lockstep over the documents of a slice,
and yields the probability of each language for each word; a document's language is the one with
the highest mean over its words with a letter, and that mean its score. ``label_words`` gives the
spans of words in one language instead.

``und`` with score 0 where the text is null or has no letter. With no labelled row everything is
``und``. Ties go to the language that is first in code point order. Rows are scored one by one,
so repeated rows agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from epochloom.llm.batches import (
    Words,
    map_slices,
    mix,
    run_index,
    run_sums,
    texts_of,
    word_hashes,
    words_of,
)
from epochloom.llm.shared import arrived, saved, shipped
from epochloom.llm.training import held_out, one_per_id, remainder

UNKNOWN = "und"
SAMPLE = 400
STRETCH = 60
#: Training sequences that go through forward-backward together.
BLOCK = 1000
#: Features that are summed at a time.
PIECE = 1 << 19
#: Features per kind.
TABLE = 1 << 16
KINDS = ("word", "affix", "gram")
STEPS = 60


@dataclass
class Batch:
    """Distinct words of some texts: features with their kinds, whether they have a letter, and
    where each word stands."""

    feature: list[np.ndarray]
    owner: list[np.ndarray]
    size: list[np.ndarray]
    letter: np.ndarray
    which: np.ndarray
    counts: np.ndarray


def _features(data: np.ndarray, words: Words, hashes: np.ndarray) -> tuple[list, list, list]:
    """Per kind: features, the word each belongs to, and features per word. Both are kept in 32 bits
    as soon as they are known, for a slice's distinct words have millions."""
    slot = lambda x: (mix(x) % np.uint64(TABLE)).astype(np.int32)
    n = len(words.starts)
    lengths = words.lengths + 2
    at = run_index(lengths)
    stream = np.full(len(at), 32, np.uint64)
    inside = (at > 0) & (at < np.repeat(lengths, lengths) - 1)
    stream[inside] = data[(np.repeat(words.starts - 1, lengths) + at)[inside]]
    owner = np.repeat(np.arange(n, dtype=np.int32), lengths)
    left = np.repeat(lengths, lengths) - at
    grams, owners, first, last = [], [], [], []
    code = stream.copy()
    for k in (2, 3, 4):
        code[: len(code) - k + 1] |= stream[k - 1 :] << np.uint64(8 * (k - 1))
        whole = np.flatnonzero(left >= k)
        value = code[whole] + (np.uint64(k) << np.uint64(40))
        grams.append(slot(value))
        owners.append(owner[whole])
        start, end = at[whole] == 0, left[whole] == k
        first.append((slot(value[start] + (np.uint64(1) << np.uint64(48))), owner[whole][start]))
        last.append((slot(value[end] + (np.uint64(2) << np.uint64(48))), owner[whole][end]))
    affix, affix_owner = (np.concatenate(x) for x in zip(*first, *last, strict=True))
    gram, gram_owner = np.concatenate(grams), np.concatenate(owners)
    word = np.arange(n, dtype=np.int32)
    return (
        [(hashes % np.uint64(TABLE)).astype(np.int32), affix, gram],
        [word, affix_owner, gram_owner],
        [np.bincount(o, minlength=n) for o in (word, affix_owner, gram_owner)],
    )


def batch_of(column: pa.Array) -> Batch:
    texts = texts_of(column).lowered()
    words = words_of(texts)
    hashes = word_hashes(texts.data, words)
    kinds, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    some = Words(words.starts[first], words.lengths[first], np.array([len(first)]))
    return Batch(
        *_features(texts.data, some, kinds), _with_letter(texts.data, some), which, words.counts
    )


def _with_letter(data: np.ndarray, words: Words) -> np.ndarray:
    body = data[np.repeat(words.starts, words.lengths) + run_index(words.lengths)]
    ends = np.r_[0, np.cumsum(words.lengths)].astype(np.int64)
    strings = pa.LargeStringArray.from_buffers(
        len(words.starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(body))
    )
    found = pc.match_substring_regex(strings, r"\p{L}")
    return found.to_numpy(zero_copy_only=False).astype(bool)


def emissions(batch: Batch, weights: np.ndarray) -> np.ndarray:
    """(distinct words, languages): sum over kinds of the mean weight."""
    n = len(batch.size[0])
    out = np.zeros((n, weights.shape[2]))
    for k in range(len(KINDS)):
        for j in range(weights.shape[2]):
            total = _summed(batch.owner[k], weights[k, :, j], batch.feature[k], n)
            out[:, j] += total / np.maximum(batch.size[k], 1)
    return out


def _summed(key: np.ndarray, values: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """The sum of values[place] by key, in pieces that need little memory."""
    out = np.zeros(n)
    for i in range(0, len(key), PIECE):
        out += np.bincount(key[i : i + PIECE], values[place[i : i + PIECE]], n)
    return out


def _ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences longest first: their order, starts, and how many have a word at each place."""
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    longest = int(counts.max(initial=0))
    active = np.searchsorted(-counts[order], -np.arange(longest), "left")
    return order, starts, active


def forward_backward(
    emission: np.ndarray, transition: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals per word, expected transition counts, and the log-partition, of all sequences.

    All sequences advance together; values are scaled to sum 1 at each place.
    """
    top = emission.max(axis=1, keepdims=True, initial=-np.inf) if len(emission) else emission
    local = np.exp(emission - top)
    step = np.exp(transition)
    order, starts, active = _ranges(counts)
    forward, scale = np.empty_like(local), np.ones(len(local))
    for t, n in enumerate(active):
        at = starts[:n] + t
        a = local[at] if t == 0 else (forward[at - 1] @ step) * local[at]
        total = a.sum(axis=1)
        forward[at], scale[at] = a / total[:, None], total
    backward = np.ones_like(local)
    expected = np.zeros_like(step)
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        after = starts[:n] + t + 1
        onward = local[after] * backward[after] / scale[after][:, None]
        backward[after - 1] = onward @ step.T
        expected += forward[after - 1].T @ onward
    return forward * backward, expected * step, float(np.log(scale).sum() + top.sum())


class LanguageModel:
    def __init__(self, languages: list[str], weights=None, transition=None):
        self.languages, self.weights, self.transition = languages, weights, transition

    def marginals(self, batch: Batch) -> np.ndarray:
        """(words, languages): the probability of each language for each word."""
        emission = emissions(batch, self.weights)[batch.which]
        return forward_backward(emission, self.transition, batch.counts)[0]

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(column)
        if self.weights is None:
            return [UNKNOWN] * n, np.zeros(n)
        batch = batch_of(column)
        letter = batch.letter[batch.which]
        marginal = np.where(letter[:, None], self.marginals(batch), 0.0)
        counted = run_sums(letter.astype(np.int64), batch.counts)
        total = np.stack([run_sums(m, batch.counts) for m in marginal.T], axis=1)
        mean = total / np.maximum(counted, 1)[:, None]
        best = mean.argmax(axis=1)
        score = np.where(counted > 0, mean[np.arange(n), best], 0.0)
        names = np.array([*self.languages], object)
        return list(np.where(counted > 0, names[best], UNKNOWN)), np.clip(score, 0, 1)

    def spans(self, column: pa.Array) -> dict[str, np.ndarray]:
        """Runs of words of one text with the same likeliest language: the text, first and last
        word from 0, the language, and the mean of its probabilities."""
        batch = batch_of(column)
        if self.weights is None:
            marginal = np.zeros((len(batch.which), 1))
        else:
            marginal = self.marginals(batch)
        best, text = marginal.argmax(axis=1), np.repeat(np.arange(len(column)), batch.counts)
        at = run_index(batch.counts)
        new = (at == 0) | (np.diff(best, prepend=-1) != 0)
        first = np.flatnonzero(new)
        lengths = np.diff(np.r_[first, len(best)])
        names = np.array(self.languages or [UNKNOWN], object)
        score = run_sums(marginal[np.arange(len(best)), best], lengths) / lengths
        return {
            "text": text[first],
            "first_word": at[first],
            "last_word": at[first] + lengths - 1,
            "lang": names[best[first]],
            "score": np.clip(score, 0, 1),
        }


def _windows(text: str) -> list[str]:
    """A whole training text in consecutive windows of words."""
    words = text.split()
    return [" ".join(words[i : i + STRETCH]) for i in range(0, max(len(words), 1), STRETCH)]


def _training_batch(texts: list[str]) -> Batch:
    """As ``batch_of`` for many texts, built piece by piece to spare the driver's memory."""
    hashes, counts, seen = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], {}
    for i in range(0, len(texts), 500):
        part = texts_of(pa.array(texts[i : i + 500], pa.string())).lowered()
        words = words_of(part)
        hashes.append(word_hashes(part.data, words))
        counts.append(words.counts)
        for key, at in zip(*(x.tolist() for x in np.unique(hashes[-1], return_index=True)), strict=True):
            if key not in seen:
                start = words.starts[at]
                seen[key] = part.data[start : start + words.lengths[at]].tobytes().decode()
    kinds = sorted(seen)  # the order in which batch_of has distinct words
    pieces = [
        batch_of(pa.array([" ".join(seen[key] for key in kinds[i : i + 10_000])]))
        for i in range(0, max(len(kinds), 1), 10_000)
    ]
    feature, owner, size = [], [], []
    for k in range(len(KINDS)):
        before = np.cumsum([0, *[len(p.letter) for p in pieces]])
        feature.append(np.concatenate([p.feature[k].astype(np.int32) for p in pieces]))
        owner.append(
            np.concatenate([(p.owner[k] + b).astype(np.int32) for p, b in zip(pieces, before)])
        )
        size.append(np.concatenate([p.size[k].astype(np.int32) for p in pieces]))
        for p in pieces:
            p.feature[k] = p.owner[k] = p.size[k] = None
    letter = np.concatenate([p.letter for p in pieces])
    which = np.searchsorted(np.array(kinds, np.uint64), np.concatenate(hashes)).astype(np.int32)
    return Batch(feature, owner, size, letter, which, np.concatenate(counts))


def fit(texts: list[str], label: np.ndarray, languages: list[str]) -> LanguageModel:
    """Adam on the conditional log-likelihood of label sequences, each of two of the texts."""
    order = np.random.default_rng(5).permutation(len(texts))
    batch = _training_batch([texts[i] for i in order])
    size = len(languages)
    per_word = np.repeat(np.asarray(label)[order], batch.counts)
    counts = np.add.reduceat(batch.counts, np.arange(0, len(order), 2)) if len(order) else batch.counts
    n, total = len(batch.size[0]), max(int(counts.sum()), 1)
    observed = np.bincount(batch.which * size + per_word, minlength=n * size)
    observed = observed.reshape(n, size).astype(np.float32)  # whole numbers, far below 2**24
    inside = run_index(counts)[1:] > 0
    moves = np.bincount((per_word[:-1] * size + per_word[1:])[inside], minlength=size * size)
    moves = moves.reshape(size, size)
    ends = np.r_[0, np.cumsum(counts)]
    blocks = [
        (counts[i : i + BLOCK], batch.which[ends[i] : ends[min(i + BLOCK, len(counts))]])
        for i in range(0, len(counts), BLOCK)
    ]
    weights, transition = np.zeros((len(KINDS), TABLE, size)), np.zeros((size, size))
    state = [np.zeros_like(x) for x in (weights, weights, transition, transition)]
    for t in range(1, STEPS + 1):
        emission, gap, expected = emissions(batch, weights), -observed.astype(float), -moves.astype(float)
        for part, which in blocks:
            marginal, turns, _ = forward_backward(emission[which], transition, part)
            gap += np.stack([np.bincount(which, m, n) for m in marginal.T], axis=1)
            expected += turns
        gap /= total
        slope = np.empty_like(weights)
        for k in range(len(KINDS)):
            share = gap / np.maximum(batch.size[k], 1)[:, None]
            for j in range(size):
                slope[k, :, j] = _summed(batch.feature[k], share[:, j], batch.owner[k], TABLE)
        slope += 1e-7 * weights
        turn = expected / total + 1e-4 * transition
        for i, (value, s) in enumerate(((weights, slope), (transition, turn))):
            m, v = state[2 * i], state[2 * i + 1]
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            value -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    return LanguageModel(languages, weights.astype(np.float32), transition)


def train(docs: DataFrame, modulus: int = 0, rest: int = 0) -> LanguageModel:
    """A model from the text and lang of all rows, less those whose crc32 remainder is ``rest``."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    if modulus:
        known = known.where(remainder(modulus) != rest)
    # the labels a corpus uses: few, whatever its size
    languages = sorted(r[0] for r in known.select("lang").distinct().toLocalIterator())
    if not languages:
        return LanguageModel([])
    # each task keeps the first of a language before the exchange, so no language meets in one task
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.select("doc_id", "lang").distinct()
    chosen = chosen.withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE).drop("n")
    rows = known.select("doc_id", "text", "lang")
    rows = one_per_id(rows.join(F.broadcast(saved(chosen)), ["doc_id", "lang"]), "lang")
    texts, label = [], []
    for row in rows.orderBy("doc_id", "lang", "text").toLocalIterator():
        for piece in _windows(row["text"] or ""):
            texts.append(piece)
            label.append(languages.index(row["lang"]))
    return fit(texts, np.array(label), languages)


def identify(
    docs: DataFrame,
    model: LanguageModel,
    modulus: int = 4,
    rest: int = 2,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, and the named columns of ``docs``."""
    shared = shipped(docs.sparkSession, model)
    fields = [docs.schema[c] for c in carried]

    def make():
        model = arrived(shared)

        def step(batch):
            names, scores = model.predict(batch.column("text"))
            out = {"held_out": batch.column("held_out"), "lang_pred": names, "score": scores}
            return out | {c: batch.column(c) for c in ("doc_id", *carried)}

        return step

    schema = ["doc_id long", "held_out boolean", "lang_pred string", "score double"]
    schema += [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    rows = docs.select(*dict.fromkeys(("doc_id", "text", *carried)), held_out(modulus, rest))
    return map_slices(rows, make, ", ".join(schema))


def label_words(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, first_word, last_word (from 0), lang, score for every span of words of one language
    in every row; nothing for texts without words."""
    shared = shipped(docs.sparkSession, model)

    def make():
        model = arrived(shared)

        def step(batch):
            found = model.spans(batch.column("text"))
            return found | {"doc_id": batch.column("doc_id").take(pa.array(found["text"]))}

        return step

    schema = "doc_id long, first_word long, last_word long, lang string, score double"
    return map_slices(docs.select("doc_id", "text"), make, schema)
