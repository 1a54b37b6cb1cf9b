"""Language of words and documents by a linear-chain conditional random field.

Each word has affix, n-gram and lexicon features; weights of features and of transitions
between languages are learned together by gradients of the log-likelihood from
forward-backward. Training sequences are made of snippets of documents in several
languages, so the transitions see switches. A text's words are labelled by
forward-backward over the whole text, block by block: transfer matrices of blocks give the
messages at their edges, so that many words are done at once and a text's cost grows with its length.
A word is a run of letters; a longer run is cut into words of ``LONGEST_WORD`` letters, each with its own vote.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_lens.llm.common import free_name, held_out, pieces, sample_by_hash
from market_lens.sources.scratch import materialize

LONGEST_WORD = 64
WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST_WORD}}}")
BUCKETS = 1 << 17
BLOCK = 64
UNKNOWN = "und"
#: Default bounds of what a model is fitted on: documents of each language, and characters of each.
DOCS_PER_LANGUAGE = 500
CHARS_PER_DOC = 3000
LEXICON = 5000
REMEMBER = 90_000


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class _Buckets(dict):
    """Buckets of feature names; n-grams repeat, so names are hashed once."""

    def __missing__(self, name: str) -> int:
        bucket = zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS
        if len(self) < REMEMBER:
            self[name] = bucket
        return bucket


_BUCKETS = _Buckets()


def features(word: str, lexicon: frozenset[str]) -> list[int]:
    """Buckets of a word's features: prefixes and suffixes up to 4, 2- and 3-grams, and the word if it is in the lexicon."""
    edged = f"^{word}$"
    names = ["bias", *[f"<{word[:k]}" for k in range(1, 5)], *[f">{word[-k:]}" for k in range(1, 5)]]
    names += [edged[k : k + 2] for k in range(len(edged) - 1)]
    names += [edged[k : k + 3] for k in range(len(edged) - 2)]
    if word in lexicon:
        names.append(f"={word}")
    return [_BUCKETS[n] for n in dict.fromkeys(names)]


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray
    switch: np.ndarray
    lexicon: frozenset[str]

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.labels)))
        for at in range(0, len(words), 1 << 12):
            buckets = [features(w, self.lexicon) for w in words[at : at + (1 << 12)]]
            starts = np.cumsum([0, *map(len, buckets)])[:-1]
            flat = np.fromiter(chain.from_iterable(buckets), np.int64)
            out[at : at + (1 << 12)] = np.add.reduceat(self.weights[flat], starts, axis=0)
        return out


def _sequences(samples: list[tuple[str, int]], rng: np.random.Generator) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different words, and sequences of ``BLOCK`` word numbers with a label each (-1 pads)."""
    ids: dict[str, int] = {}
    snippets: list[tuple[list[int], int]] = []
    for text, label in samples:
        words = [ids.setdefault(w, len(ids)) for w in words_of(text)]
        at = 0
        while at < len(words):
            size = int(rng.integers(4, BLOCK))
            snippets.append((words[at : at + size], label))
            at += size
    order = rng.permutation(len(snippets)).tolist()
    stream = [(w, label) for k in order for w in snippets[k][0] for label in [snippets[k][1]]]
    stream += [(-1, -1)] * (-len(stream) % BLOCK)
    flat = np.array(stream, np.int64).reshape(-1, BLOCK, 2)
    return list(ids), flat[:, :, 0], flat[:, :, 1]


def _posteriors(emission: np.ndarray, switch: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of words and of transitions (summed) of sequences that start from any label alike."""
    step = np.exp(switch - switch.max())
    e = np.exp(emission - emission.max(axis=2, keepdims=True))
    n, size, k = e.shape
    live = np.arange(size) < lengths[:, None]
    e[~live] = 1.0
    forward, before = np.empty_like(e), np.full((n, k), 1.0 / k)
    for t in range(size):
        before = before @ step * e[:, t]
        before /= before.sum(axis=1, keepdims=True)
        forward[:, t] = before
    after, marginal, pairs = np.ones((n, k)), np.empty_like(e), np.zeros((k, k))
    for t in range(size - 1, -1, -1):
        both = forward[:, t] * after
        marginal[:, t] = both / both.sum(axis=1, keepdims=True)
        came = forward[:, t - 1] if t else np.full((n, k), 1.0 / k)
        right = e[:, t] * after
        joint = (came @ step * right).sum(axis=1)
        on = live[:, t]
        pairs += step * ((came[on] / joint[on, None]).T @ right[on])
        after = np.where(on[:, None], right @ step.T, after)
        after /= after.sum(axis=1, keepdims=True)
    marginal[~live] = 0
    return marginal, pairs


def fit(samples: list[tuple[str, str]], rounds: int = 40, rate: float = 0.25, decay: float = 1e-4, seed: int = 7) -> Model | None:
    """A model out of texts and their languages; None if there is no word to learn from."""
    labels = sorted({lang for _, lang in samples})
    rng = np.random.default_rng(seed)
    samples = sorted(samples)
    words, ids, gold = _sequences([(t, labels.index(lang)) for t, lang in samples], rng)
    if not words:
        return None
    counts = Counter()
    flat = ids[ids >= 0]
    for i, n in zip(*np.unique(flat, return_counts=True), strict=True):
        counts[words[i]] = int(n)
    lexicon = frozenset(w for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LEXICON] if n > 2)
    buckets = [features(w, lexicon) for w in words]
    owners = np.repeat(np.arange(len(words)), [len(b) for b in buckets])
    used, column = np.unique(np.concatenate([np.array(b) for b in buckets]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in buckets])[:-1]])
    k = len(labels)
    weights, switch = np.zeros((len(used), k)), np.zeros((k, k))
    square_w, square_s = np.full_like(weights, 1e-2), np.full_like(switch, 1e-2)
    batch = max(1, -(-len(ids) // 4))
    for r in range(rounds):
        part = np.arange(r % 4, len(ids), 4) if len(ids) >= 4 else np.arange(len(ids))
        seq, want = ids[part], gold[part]
        lengths = (seq >= 0).sum(axis=1)
        table = np.add.reduceat(weights[column], starts, axis=0)
        marginal, pairs = _posteriors(table[np.maximum(seq, 0)], switch, lengths)
        live = seq >= 0
        right = np.zeros_like(marginal)
        right[live, want[live]] = 1
        diff = (right - marginal)[live]
        by_word = np.stack([np.bincount(seq[live], diff[:, j], len(words)) for j in range(k)], axis=1)
        slope = np.stack([np.bincount(column, by_word[owners, j], len(used)) for j in range(k)], axis=1)
        seen = np.zeros((k, k))
        follow = live[:, 1:]
        np.add.at(seen, (want[:, :-1][follow], want[:, 1:][follow]), 1)
        first = np.bincount(want[live[:, 0], 0], minlength=k)
        slope_s = seen + first[None, :] / k - pairs
        slope, slope_s = slope / batch - decay * weights, slope_s / batch - decay * switch
        square_w += slope**2
        square_s += slope_s**2
        weights += rate * slope / np.sqrt(square_w)
        switch += rate * slope_s / np.sqrt(square_s)
    full = np.zeros((BUCKETS, k), np.float32)
    full[used] = weights
    return Model(labels, full, switch, lexicon)


def label_shares(model: Model, emission: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text (of ``sizes`` words, one after the other in ``emission``) the sums of its words' marginals."""
    k = len(model.labels)
    step = np.exp(model.switch - model.switch.max())
    blocks = -(-sizes // BLOCK)
    n = int(blocks.sum())
    owner = np.repeat(np.arange(len(sizes)), blocks)
    ordinal = np.arange(n) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    length = np.minimum(BLOCK, np.repeat(sizes, blocks) - ordinal * BLOCK)
    start = np.repeat(np.cumsum(sizes) - sizes, blocks) + ordinal * BLOCK
    # rows by falling length: those that have a word at place t come first
    order = np.argsort(-length, kind="stable")
    have = np.array([int((length > t).sum()) for t in range(BLOCK)])
    places = np.minimum(start[order, None] + np.arange(BLOCK), max(0, len(emission) - 1))
    e = np.exp(emission - emission.max(axis=1, keepdims=True))[places]
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)

    whole = np.broadcast_to(np.eye(k), (n, k, k)).copy()  # transfer matrix of each block
    if blocks.max(initial=0) > 1:
        for t in range(BLOCK):
            m = have[t]
            whole[:m] = (whole[:m].reshape(-1, k) @ step).reshape(m, k, k) * e[:m, t, None, :]
            if t % 8 == 7:
                whole[:m] /= whole[:m].max(axis=(1, 2), keepdims=True)
    before, after = np.full((n, k), 1.0 / k), np.ones((n, k))
    by_place = np.argsort(ordinal, kind="stable")  # first blocks, then second ones, …
    ends = np.cumsum(np.bincount(ordinal)) if n else np.zeros(0, np.int64)
    later = [by_place[ends[j - 1] : ends[j]] for j in range(1, len(ends))]
    for at in later:
        here, left = rank[at], rank[at - 1]
        message = np.einsum("nk,nkl->nl", before[left], whole[left])
        before[here] = message / message.sum(axis=1, keepdims=True)
    for at in reversed(later):
        here, right = rank[at - 1], rank[at]
        message = np.einsum("nkl,nl->nk", whole[right], after[right])
        after[here] = message / message.sum(axis=1, keepdims=True)

    forward = np.empty((n, BLOCK, k))
    for t in range(BLOCK):
        m = have[t]
        before[:m] = before[:m] @ step * e[:m, t]
        before[:m] /= before[:m].sum(axis=1, keepdims=True)
        forward[:m, t] = before[:m]
    total = np.zeros((n, k))
    for t in range(BLOCK - 1, -1, -1):
        m = have[t]
        both = forward[:m, t] * after[:m]
        total[:m] += both / both.sum(axis=1, keepdims=True)
        after[:m] = (e[:m, t] * after[:m]) @ step.T
        after[:m] /= after[:m].sum(axis=1, keepdims=True)
    return np.stack([np.bincount(owner[order], total[:, j], len(sizes)) for j in range(k)], axis=1)


class Scorer:
    """Labels texts and remembers the emissions of words, in two generations: a word that is met again outlives one."""

    def __init__(self, model: Model | None):
        self.model = model
        self.ids: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.labels) if model else 1), np.float32)
        self.older = self.ids, self.table

    def _numbers(self, words: list[str]) -> np.ndarray:
        if len(self.ids) > REMEMBER:
            self.older, self.ids, self.table = (self.ids, self.table), {}, np.zeros_like(self.table)
        ids = self.ids
        missing = set(words).difference(ids)
        if missing:
            old_ids, old_table = self.older
            kept = [w for w in missing if w in old_ids]
            new = list(missing.difference(kept)) if kept else list(missing)
            while len(ids) + len(missing) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            at = len(ids)
            self.table[at : at + len(kept)] = old_table[[old_ids[w] for w in kept]]
            self.table[at + len(kept) : at + len(missing)] = self.model.emissions(new)
            for w in chain(kept, new):
                ids[w] = len(ids)
        return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The language and its share of each text; ``und`` and 0 where there is no letter or nothing was learned."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if self.model is None:
            return names, scores
        said, sizes, rows = [], [], []
        for row, text in enumerate(texts):
            words = words_of(text)
            if any(not w.isdigit() and any(map(str.isalpha, w)) for w in words):
                said += words
                sizes.append(len(words))
                rows.append(row)
        if rows:
            numbers = self._numbers(said)
            sums = label_shares(self.model, self.table[numbers].astype(np.float64), np.array(sizes))
            best = sums.argmax(axis=1)
            share = sums[np.arange(len(rows)), best] / sums.sum(axis=1)
            for row, b, s in zip(rows, best.tolist(), share.tolist(), strict=True):
                names[row], scores[row] = self.model.labels[b], min(1.0, max(0.0, s))
        return names, scores


def sample(docs: DataFrame, id: str, text: str, lang: str, most_docs: int, most_chars: int) -> list[tuple[str, str]]:
    """At most ``most_docs`` different documents of each language, and a stretch of each from a hashed place.

    A document is an id with a text: rows that repeat count once, and rows that share an id are drawn one by one.
    The drawn keys are written, so Spark knows that they are few and doesn't shuffle the texts to meet them.
    """
    usable = ~held_out(id) & F.col(lang).isNotNull() & F.col(text).isNotNull()
    key = F.xxhash64(id, text).alias("key")
    thin = docs.where(usable).select(key, F.col(lang).alias("lang")).distinct()
    chosen = materialize(sample_by_hash(thin, "lang", most_docs, "key"), "drawn")
    place = F.pmod(F.xxhash64(id), F.greatest(F.lit(1), F.char_length(text) - most_chars)).cast("int") + 1
    part = F.substring(F.col(text), place, F.lit(most_chars))
    rows = docs.where(usable).select(key, F.col(lang).alias("lang"), part.alias("part"))
    found = rows.join(chosen, ["key", "lang"], "left_semi").groupBy("key", "lang").agg(F.min("part").alias("part"))
    return [(r["part"], r["lang"]) for r in found.collect()]


def learn(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", most_docs: int = DOCS_PER_LANGUAGE, most_chars: int = CHARS_PER_DOC
) -> Model | None:
    """A model from documents of ``docs`` that are not held out and have a language: of each, at most ``most_docs``
    documents and ``most_chars`` characters of a document are drawn by hash."""
    return fit(sample(docs, id, text, lang, most_docs, most_chars))


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (names get underscores where ``docs`` has them).

    The language is the one with the largest sum of word marginals over the whole text, the
    score its share. Null texts and texts without a letter are ``und`` with score 0.
    Repeated rows each get the same result; ties go to the first language by name.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang string, score double>")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = Scorer(held.value)
        for batch in batches:
            names, shares = [], []
            for part in pieces(batch, 1 << 20):
                got = score([t or "" for t in part.to_pylist()])
                names += got[0]
                shares += got[1]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64())], ["lang", "score"])

    result = free_name(docs, "result")
    done = docs.withColumn(result, label(F.col(text)))
    names = {"lang": free_name(docs, "lang_pred"), "score": free_name(docs, "score")}
    return done.select(*docs.columns, *[F.col(result)[k].alias(v) for k, v in names.items()])


def predictions(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", most_docs: int = DOCS_PER_LANGUAGE, most_chars: int = CHARS_PER_DOC
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    Learned from the rows that are not held out, within the bounds of ``learn``; rows without an id are held out.
    """
    model = learn(docs, id, text, lang, most_docs, most_chars)
    thin = docs.select(F.col(id).alias("doc_id"), held_out(id).alias("held_out"), F.col(text).alias("text"))
    return identify(thin, model).drop("text")


def confident(docs: DataFrame, least: float = 0.4, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` in which one language has a share of ``least``; ``und`` goes."""
    done = identify(docs, learn(docs, id, text, lang), text)
    name, score = done.columns[-2:]
    return done.where((F.col(name) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
