"""Quality by co-training of two views.

One classifier sees the text's content (kinds of characters, words, repetition), the other
the page's metadata and layout (source, language, size, lines). Each learns from a bounded
sample of labelled rows. Then, round by round, each scores the whole unlabelled table, takes the rows
that it is surest of (beyond a quantile of its evidence) and hands them to the other, which learns from
a bounded draw of them. At last each view is calibrated on labelled rows kept back for it and their
calibrated evidence is combined. The result scores all documents.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_lens.llm.common import held_out, pieces, sample_by_hash
from market_lens.sources.scratch import materialize

#: Default bounds of what is fitted on: labelled rows of each class, and rows drawn of each hand-over, by hash.
LABELLED_ROWS, DRAWN_ROWS = 3000, 300
ROUNDS = 6
#: The share of the unlabelled rows that each view hands over in a round.
HANDED = 0.05
#: Steps of a view's evidence in which the surest rows are told, and its bounds.
STEP, FARTHEST = 0.05, 15.0
BINS = 8
SOURCES = 64

_LETTER, _UPPER, _DIGIT, _SPACE, _HIGH = (np.zeros(256, bool) for _ in range(5))
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_HIGH[128:] = True
_MARKS = [b for b in range(33, 127) if not (_LETTER[b] or _DIGIT[b])]
_ENDS = {ord(c) for c in ".!?\"')"}


def content(text: bytes) -> list[float]:
    """Numbers of the content view; all 0 for the empty text."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(1, len(text))
    shares = [counts[kind].sum() / n for kind in (_LETTER, _UPPER, _DIGIT, _SPACE, _HIGH)]
    marks = (counts[_MARKS] / n).tolist()
    words = text.lower().split()
    seen = Counter(words)
    k = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    top = seen.most_common(3)
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1)
    spread = [lengths.mean(), lengths.std(), lengths.max(), (lengths <= 3).mean()] if len(words) else [0.0] * 4
    # the share of different words falls with length, so it is told for a fixed stretch too
    parts = [len(set(words[i : i + 100])) / len(words[i : i + 100]) for i in range(0, len(words), 100)]
    repeats = [len(seen) / k, pairs, sum(c for _, c in top) / k, (top[0][1] / k) if top else 0.0]
    return [*map(float, shares), *marks, *map(float, spread), *repeats, min(parts, default=0.0), float(np.mean(parts)) if parts else 0.0]


def layout(text: bytes) -> list[float]:
    """Numbers of the metadata view that come from the page's lines and size."""
    lines = text.split(b"\n")
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    full = [x for x in lines if x.strip()]
    ended = sum(x.rstrip()[-1] in _ENDS for x in full) / max(1, len(full))
    capital = sum(65 <= x.lstrip()[0] < 91 or x.lstrip()[0] > 127 for x in full) / max(1, len(full))
    again = 1 - len(set(full)) / max(1, len(full))
    return [np.log1p(len(text)), np.log1p(len(lines)), sizes.mean(), sizes.max(), sizes.std(), ended, capital, again]


def _place(value: str | None) -> int:
    return SOURCES if value is None else zlib.crc32(value.encode()) % SOURCES


@dataclass
class View:
    """A linear classifier over numbers cut into quantile bins, and over one-hot places."""

    edges: list[np.ndarray]
    places: int
    weights: np.ndarray

    @classmethod
    def shape(cls, numbers: np.ndarray, places: int) -> View:
        cuts = np.linspace(0, 1, BINS + 1)[1:-1]
        edges = [np.unique(np.quantile(column, cuts)) for column in numbers.T]
        width = sum(len(e) + 1 for e in edges) + places + 1
        return cls(edges, places, np.zeros(width))

    def columns(self, numbers: np.ndarray, placed: np.ndarray) -> np.ndarray:
        """The set columns of each row: one for each number, one for each place; the last is the offset."""
        out, at = [], 0
        for k, edges in enumerate(self.edges):
            out.append(at + np.searchsorted(edges, numbers[:, k], side="left"))
            at += len(edges) + 1
        out += [at + placed[:, j] for j in range(placed.shape[1])]
        return np.stack([*out, np.full(len(numbers), len(self.weights) - 1)], axis=1)

    def fit(self, columns: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> None:
        """Newton steps of the ridge logistic likelihood."""
        x = np.zeros((len(columns), len(self.weights)), np.float32)
        np.put_along_axis(x, columns, 1.0, axis=1)
        w = np.zeros(len(self.weights))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (labels - p) - ridge * w
            curve = (x * (p * (1 - p))[:, None].astype(np.float32)).T @ x + ridge * np.eye(len(w))
            w = w + np.linalg.solve(curve, slope)
        self.weights = w

    def logits(self, columns: np.ndarray) -> np.ndarray:
        return self.weights[columns].sum(axis=1)


@dataclass
class Model:
    content: View
    layout: View
    #: (weight of the content view's evidence, of the layout view's, offset)
    combined: np.ndarray

    def score(self, inside: tuple, outside: tuple) -> np.ndarray:
        parts = self.content.logits(self.content.columns(*inside)), self.layout.logits(self.layout.columns(*outside))
        logit = self.combined[0] * np.clip(parts[0], -15, 15) + self.combined[1] * np.clip(parts[1], -15, 15) + self.combined[2]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _calibrated(parts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Platt scaling of each view, and a common weight of the scaled views: three numbers in all."""

    def platt(x: np.ndarray) -> np.ndarray:
        x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        w = np.zeros(x.shape[1])
        target = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
            w = w + np.linalg.solve(curve, x.T @ (target - p) - 0.1 * w)
        return w

    each = [platt(parts[:, [k]]) for k in range(2)]
    scaled = np.stack([parts[:, k] * max(0.0, each[k][0]) + each[k][1] for k in range(2)], axis=1)
    both = platt(scaled)
    both[:2] = np.maximum(0, both[:2])
    slope = both[:2] * [max(0.0, each[k][0]) for k in range(2)]
    return np.array([*slope, both[2] + both[0] * each[0][1] + both[1] * each[1][1]])


class LocalPool:
    """Unlabelled rows in memory."""

    def __init__(self, inside: tuple, outside: tuple):
        self.views, self.n, self.given = (inside, outside), len(inside[0]), [set(), set()]

    def surest(self, views: list[View], share: float) -> list[tuple[tuple, tuple, np.ndarray]]:
        """For each view the rows that it hands over, as both views' numbers, and its labels of them."""
        out = []
        for k, view in enumerate(views):
            free = np.array([i for i in range(self.n) if i not in self.given[k]], np.int64)
            logit = view.logits(view.columns(*(x[free] for x in self.views[k])))
            order = np.argsort(logit, kind="stable")
            good = max(1, round(HANDED * self.n * share))
            bad = max(1, round(HANDED * self.n * (1 - share)))
            picked = [i for i in order[:bad] if logit[i] < -1] + [i for i in order[-good:] if logit[i] > 1]
            self.given[k] |= set(free[picked].tolist())
            rows = free[picked]
            out.append((*(tuple(x[rows] for x in v) for v in self.views), (logit[picked] > 0).astype(float)))
        return out


class TablePool:
    """Unlabelled rows of a written table ``key, f``; every row is scored in each round."""

    def __init__(self, rows: DataFrame, drawn_rows: int):
        self.rows, self.drawn_rows, self.given = rows, drawn_rows, [set(), set()]
        self.n, self.round = rows.count(), 0

    def surest(self, views: list[View], share: float) -> list[tuple[tuple, tuple, np.ndarray]]:
        """As of a pool in memory, but with the surest rows by steps of evidence, and a draw of them by hash."""
        held = self.rows.sparkSession.sparkContext.broadcast(views)

        @F.arrow_udf("array<double>")
        def logits(rows: pa.Array) -> pa.Array:
            each = [v.logits(v.columns(*x)) for v, x in zip(held.value, _unpacked(rows.to_pylist()), strict=True)]
            return pa.array(np.clip(np.stack(each, axis=1), -FARTHEST, FARTHEST).tolist(), pa.list_(pa.float64()))

        scored = self.rows.select("key", "f", logits("f").alias("l"))
        steps = scored.select(F.posexplode("l").alias("view", "l")).groupBy("view", F.floor(F.col("l") / STEP).alias("step"))
        counts = {(r["view"], r["step"]): r["count"] for r in steps.count().collect()}  # at most 2 * 2 * FARTHEST / STEP rows
        wanted, edges = F.lit(False), {}
        self.round += 1
        places = F.pmod(F.xxhash64(F.lit(self.round), "key"), F.lit(1 << 30)) / (1 << 30)  # another draw in each round
        for k in range(2):
            mine = sorted((step, n) for (view, step), n in counts.items() if view == k)
            for side, part in ((1, share), (-1, 1 - share)):
                quota, sure, edge = max(1, round(HANDED * self.n * part)), 0, None
                for step, n in mine[::-side]:
                    if side * (step if side > 0 else step + 1) * STEP <= 1 or (edge is not None and sure + n > quota):
                        break
                    sure, edge = sure + n, step
                if edge is None:
                    continue
                edges[k, side] = edge
                place = F.floor(F.col("l")[k] / STEP)
                beyond = place >= edge if side > 0 else place <= edge
                some = max(1, round(self.drawn_rows * part))
                wanted = wanted | (beyond & (places * sure <= 2 * some))
        drawn = scored.where(wanted).groupBy("key").agg(F.min("f").alias("f"), F.min("l").alias("l"))
        rows = drawn.orderBy(places, "key").limit(8 * self.drawn_rows).collect()
        inside, outside = _unpacked([r["f"] for r in rows])
        out = []
        for k in range(2):
            evidence = np.array([r["l"][k] for r in rows])
            sure = []
            for side, part in ((1, share), (-1, 1 - share)):
                if (k, side) not in edges:
                    continue
                beyond = side * np.floor(evidence / STEP) >= side * edges[k, side]
                free = [i for i in np.flatnonzero(beyond) if rows[i]["key"] not in self.given[k]]
                best = sorted(free, key=lambda i: (-side * evidence[i], rows[i]["key"]))[: max(1, round(self.drawn_rows * part))]
                sure += best
            self.given[k] |= {rows[i]["key"] for i in sure}
            out.append((tuple(x[sure] for x in inside), tuple(x[sure] for x in outside), (evidence[sure] > 0).astype(float)))
        return out


def co_train(inside: tuple, outside: tuple, labels: np.ndarray, rounds: int = ROUNDS, pool: LocalPool | TablePool | None = None) -> Model | None:
    """``labels``: 1 or 0, or -1 for rows of a pool in memory, unless a ``pool`` is given; rows are in no order that
    matters. None without both labels."""
    if pool is None:
        rest = np.flatnonzero(labels < 0)
        pool = LocalPool(tuple(x[rest] for x in inside), tuple(x[rest] for x in outside))
    known = np.flatnonzero(labels >= 0)
    if len(np.unique(labels[known])) < 2:
        return None
    kept_back = known[::4]  # labelled rows for calibration
    learn = np.setdiff1d(known, kept_back)
    if len(np.unique(labels[learn])) < 2 or len(np.unique(labels[kept_back])) < 2:
        learn = kept_back = known
    views = [View.shape(inside[0][known], 1), View.shape(outside[0][known], 2 * (SOURCES + 1))]
    columns = [views[0].columns(*inside), views[1].columns(*outside)]
    share = labels[learn].mean()
    # each view has labels of its own: given ones, and what the other view handed over
    own = [[(c[learn], labels[learn].astype(float))] for c in columns]
    for r in range(rounds + 1):
        for view, have in zip(views, own, strict=True):
            view.fit(np.concatenate([c for c, _ in have]), np.concatenate([y for _, y in have]))
        if r == rounds or not pool.n:
            break
        for k, (in_rows, out_rows, y) in enumerate(pool.surest(views, share)):
            if len(y):
                to = 1 - k
                own[to].append((views[to].columns(*(in_rows, out_rows)[to]), y))
    parts = np.stack([np.clip(v.logits(c[kept_back]), -15, 15) for v, c in zip(views, columns, strict=True)], axis=1)
    return Model(*views, _calibrated(parts, labels[kept_back].astype(float)))


def _numbers(source: pa.Array, lang: pa.Array, texts: list[bytes]) -> tuple[tuple, tuple]:
    places = np.array([(_place(s), SOURCES + 1 + _place(g)) for s, g in zip(source.to_pylist(), lang.to_pylist(), strict=True)])
    inside = np.array([content(t) for t in texts]), np.zeros((len(texts), 1), np.int64)
    return inside, (np.array([layout(t) for t in texts]), places)


def _features(source: Column, lang: Column, text: Column) -> Column:
    @F.arrow_udf("struct<inside array<double>, outside array<double>, places array<int>>")
    def features(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("inside", pa.list_(pa.float64())), ("outside", pa.list_(pa.float64())), ("places", pa.list_(pa.int32()))])
        for sources, langs, texts in batches:
            out, at = [], 0
            for part in pieces(texts):
                some = sources.slice(at, len(part)), langs.slice(at, len(part))
                inside, outside = _numbers(*some, [t or b"" for t in part.to_pylist()])
                rows = zip(inside[0].tolist(), outside[0].tolist(), outside[1].tolist(), strict=True)
                out += [{"inside": a, "outside": b, "places": c} for a, b, c in rows]
                at += len(part)
            yield pa.array(out, kind)

    return features(source, lang, text.cast("binary"))


def _unpacked(rows: list[dict]) -> tuple[tuple, tuple]:
    """Both views' numbers of rows of ``f``."""
    inside = np.array([r["inside"] for r in rows]).reshape(len(rows), -1)
    outside = np.array([r["outside"] for r in rows]).reshape(len(rows), -1)
    places = np.array([r["places"] for r in rows], np.int64).reshape(len(rows), -1)
    return (inside, np.zeros((len(rows), 1), np.int64)), (outside, places)


def _numbered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, key, y, f`` of every row, written once: its label (-1 without one, -2 where it is held out) and both views' numbers.

    The key tells documents apart: an id with a text. Held-out rows meet no labels, so null ids make no hot key of the join.
    """
    marks = labels.where(~held_out("doc_id") & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("y"))
    thin = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), _features(F.col("source"), F.col("lang"), F.col("text")).alias("f"))
    free = thin.where(~held_out("doc_id")).join(marks, "doc_id", "left")
    free = free.select("doc_id", "key", F.coalesce("y", F.lit(-1)).cast("int").alias("y"), "f")
    return materialize(free.union(thin.where(held_out("doc_id")).select("doc_id", "key", F.lit(-2).alias("y"), "f")), "quality_numbers")


def scores(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, drawn_rows: int = DRAWN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (``doc_id, text, lang, source``).

    ``labels`` has ``doc_id, quality`` (1 or 0; others and null don't count; of several labels of a
    document the lower counts). The score is the probability of quality 1, 0.5 where the labelled
    sample lacks a class. Null is the empty text; a null source or language is a value of its own.
    Repeated rows get the same score; rows without an id are held out; other columns are ignored. A fit takes at
    most ``labelled_rows`` labelled rows of a class and ``drawn_rows`` rows of each hand-over.
    """
    rows = _numbered(docs, labels)
    drawn = materialize(sample_by_hash(rows.where("y >= 0").select("key", "y").distinct(), "y", labelled_rows, "key"), "quality_drawn")
    found = rows.join(drawn, ["key", "y"], "left_semi").groupBy("key", "y").agg(F.min("f").alias("f")).collect()
    found.sort(key=lambda r: (zlib.crc32(str(r["key"]).encode()), r["key"]))
    pool = TablePool(rows.where("y = -1").select("key", "f"), drawn_rows)
    known = np.array([r["y"] for r in found], np.int64)
    model = co_train(*_unpacked([r["f"] for r in found]), known, pool=pool) if len(found) else None
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(numbers: pa.Array) -> pa.Array:
        if held.value is None or not len(numbers):
            return pa.array([0.5] * len(numbers), pa.float64())
        return pa.array(held.value.score(*_unpacked(numbers.to_pylist())).tolist(), pa.float64())

    thin = rows.select("doc_id", held_out("doc_id").alias("held_out"), score("f").alias("score"))
    return thin.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
