"""Quality classifier by co-training of two views.

One classifier sees the content (words, word shapes, characters), the other the page's metadata
(source, language, length, layout). In each round, each labels the unlabelled documents it is surest about for
the other, good and bad ones in the proportion of the labels. Both are calibrated on labelled documents held out from training, a
combination of the calibrated views is fitted on them, and the round whose combination is best there is kept. Spark scores every document.

The fit uses a bounded sample of labelled documents (``FIT_ROWS``, chosen by a hash of their ids). The unlabelled ones are all
others: in each round Spark scores every one of them and takes the surest. Scoring covers all documents and whole texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import TABLES, free_names, releasing, small_batches, staged

#: Bound of the sample of labelled documents that the classifiers are fitted on.
FIT_ROWS = 6_000
#: One of so many labelled documents is held out for calibration.
HELD_OUT = 4
ROUNDS, PER_ROUND, SURE = 3, 300, 0.95
WORDS, SHAPES, SOURCES, LANGS = 512, 64, 64, 16
MEASURES = 10
KEEP_FROM = 0.5
_RUNS = re.compile(rb"A+|a+|0+|\x80+")
_CLASS = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 else 48 if 48 <= b <= 57 else 0x80 if b >= 128 else b for b in range(256))


class WordBuckets(dict):
    """Word -> its word bucket and its shape bucket, as one number; remembers a bounded number of them.

    The shape has one character per run of capitals, small letters, digits and other letters.
    """

    def __missing__(self, word: bytes) -> int:
        shape = _RUNS.sub(lambda m: m.group()[:1], word.translate(_CLASS))
        value = xxhash.xxh3_64_intdigest(word) % WORDS * SHAPES + xxhash.xxh3_64_intdigest(shape, 7) % SHAPES
        if len(self) < 300_000:
            self[word] = value
        return value


BUCKETS = WordBuckets()
TABLES.append(BUCKETS)


def content(text: str | None) -> np.ndarray:
    """Content features of a whole text: shares of word and shape buckets, and a few measures."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    out = np.zeros(WORDS + SHAPES + 5, np.float32)
    if n:
        codes = np.fromiter(map(BUCKETS.__getitem__, words), np.int64, n)
        out[:WORDS] = np.sqrt(np.bincount(codes // SHAPES, minlength=WORDS) / n)
        out[WORDS : WORDS + SHAPES] = np.sqrt(np.bincount(codes % SHAPES, minlength=SHAPES) / n)
        symbols = len(data) - len(data.translate(None, b"#*$%&|<>!{}[]~^=+@\\/"))
        capitals = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        digits = len(data) - len(data.translate(None, b"0123456789"))
        out[-5:] = len(set(words)) / n, min(symbols / n, 4), capitals / len(data), digits / len(data), len(data) / n / 10
    return out


def metadata(text: str | None, source: str | None, lang: str | None) -> np.ndarray:
    """Metadata features: source and language (hashed), length and layout of the page (lines, columns, menus, lists)."""
    data = (text or "").encode()
    lines = data.split(b"\n")
    n = len(lines)
    sizes = np.array([len(line) for line in lines], np.float32)
    out = np.zeros(SOURCES + LANGS + MEASURES, np.float32)
    out[xxhash.xxh3_64_intdigest(source or "") % SOURCES] = 1
    out[SOURCES + xxhash.xxh3_64_intdigest(lang or "") % LANGS] = 1
    ended = sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines)
    listed = sum(line.lstrip().startswith((b"-", b"*", b"#", b"|", b">")) for line in lines)
    out[-MEASURES:] = (
        math.log1p(len(data)) / 10, math.log1p(n) / 5, math.log1p(float(sizes.mean())) / 10, math.log1p(float(sizes.max())) / 10, float((sizes == 0).mean()),
        math.log1p(100 * (data.count(b"|") + data.count(b"\t")) / (len(data) + 1)), ended / n, listed / n, float((sizes < 30).mean()), 1 - len(set(lines)) / n,
    )
    return out


@dataclass
class Linear:
    """Logistic regression over standardised features."""

    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float | np.ndarray, steps: int = 12) -> Linear:
        """Newton's method; the penalty (for all or for each feature) keeps weights finite where classes are separable."""
        middle, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = np.column_stack([np.ones(len(x)), (x - middle) / scale]).astype(np.float64)
        w = np.zeros(z.shape[1])
        ridge = np.append(1e-6, np.broadcast_to(penalty, x.shape[1]))
        for _ in range(steps):
            p = chance(z @ w)
            step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        return cls(middle, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.weights[0] + ((x - self.middle) / self.scale) @ self.weights[1:]


def chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


@dataclass
class Model:
    """Both views, their calibration (slope, offset), and the combination of the calibrated logits."""

    views: tuple[Linear, Linear]
    calibration: tuple[tuple[float, float], tuple[float, float]]
    combination: Linear

    def calibrated(self, view: int, features: np.ndarray) -> np.ndarray:
        """Calibrated logits of one view."""
        slope, offset = self.calibration[view]
        return slope * self.views[view].logit(features) + offset

    def scores(self, features: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated chance of good quality by content, by metadata, and combined."""
        logits = [self.calibrated(k, x) for k, x in enumerate(features)]
        both = self.combination.logit(np.column_stack(logits))
        return chance(logits[0]), chance(logits[1]), chance(both)


#: Penalties: many features that each say little get a high one, so that few labels suffice for the others.
CONTENT_PENALTY = np.repeat([100.0, 2.0], [WORDS, SHAPES + 5])
METADATA_PENALTY = np.repeat([30.0, 2.0], [SOURCES + LANGS, MEASURES])


def shares(sure: tuple[int, int], most: tuple[int, int]) -> tuple[int, int]:
    """How many (bad, good) pseudo-labels a view gives: in the proportion of ``most``, as far as it is sure of both."""
    part = min(1.0, sure[0] / most[0], sure[1] / most[1])
    return round(part * most[0]), round(part * most[1])


class ArrayPool:
    """Unlabelled documents as two arrays of features."""

    def __init__(self, views: tuple[np.ndarray, np.ndarray]):
        self.views = views

    def surest(self, model: Model, most: tuple[int, int], taken: tuple[set, set]) -> list[list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """Of each view, up to ``most`` rows (label, key, content, metadata) of each class that it is surest of and has not given yet."""
        found = []
        for k in (0, 1):
            logit = model.calibrated(k, self.views[k])
            own = []
            for label, sure in ((0, -logit), (1, logit)):
                rows = [int(i) for i in np.argsort(-sure, kind="stable") if chance(sure[i]) >= SURE and int(i) not in taken[k]]
                own += [(label, i, self.views[0][i], self.views[1][i]) for i in rows[: most[label]]]
            found.append(own)
        return found


class TablePool:
    """Unlabelled documents as a written table (doc_id, key, x, m) of features; documents with equal features count once."""

    def __init__(self, features: DataFrame, labelled: DataFrame):
        self.features, self.labelled = features, labelled

    def surest(self, model: Model, most: tuple[int, int], taken: tuple[set, set]) -> list[list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """As above. Every row is scored in its task; only ids and logits of the sure ones are shuffled, and the features of those taken fetched."""
        given = [np.array(sorted(keys), np.int64) for keys in taken]

        def sure_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column("key").to_numpy()
                for k, column in enumerate(("x", "m")):
                    logit = model.calibrated(k, _matrix(batch.column(column).to_pylist(), k))
                    rows = np.flatnonzero((chance(np.abs(logit)) >= SURE) & ~np.isin(keys, given[k]))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(rows)), pa.array(keys[rows]), pa.array(np.full(len(rows), k, np.int32)), pa.array((logit[rows] > 0).astype(np.int32)), pa.array(np.abs(logit[rows]))],
                        ["doc_id", "key", "view", "label", "sure"],
                    )

        sure = self.features.mapInArrow(sure_rows, "doc_id long, key long, view int, label int, sure double")
        sure = sure.join(self.labelled, "doc_id", "left_anti").groupBy("view", "label", "key").agg(F.max("sure").alias("sure"))
        place = F.row_number().over(Window.partitionBy("view", "label").orderBy(F.desc("sure"), "key"))
        chosen = sure.withColumn("place", place).where(F.col("place") <= max(most)).collect()  # at most four times PER_ROUND rows
        chosen = [r for r in chosen if r["place"] <= most[r["label"]]]
        wanted = self.features.sparkSession.createDataFrame(pa.table({"key": pa.array(sorted({r["key"] for r in chosen}), pa.int64())}))
        rows = self.features.join(F.broadcast(wanted), "key").groupBy("key").agg(F.max(F.struct("x", "m")).alias("f")).collect()
        features = {r["key"]: (_matrix([r["f"]["x"]], 0)[0], _matrix([r["f"]["m"]], 1)[0]) for r in rows}
        chosen.sort(key=lambda r: (r["label"], r["place"]))
        return [[(r["label"], r["key"], *features[r["key"]]) for r in chosen if r["view"] == k] for k in (0, 1)]


def _fitted(views: tuple[Linear, Linear], held: tuple[np.ndarray, np.ndarray], held_y: np.ndarray) -> tuple[Model, float]:
    """The views calibrated and combined on held-out documents, and the mean log loss of the combination there."""
    calibration = []
    for view, x in zip(views, held):
        fitted = Linear.fit(view.logit(x)[:, None], held_y, penalty=1e-2)
        calibration.append((float(fitted.weights[1] / fitted.scale[0]), float(fitted.weights[0] - fitted.weights[1] * fitted.middle[0] / fitted.scale[0])))
    calibrated = np.column_stack([a * view.logit(x) + b for view, x, (a, b) in zip(views, held, calibration)])
    model = Model(views, (calibration[0], calibration[1]), Linear.fit(calibrated, held_y, penalty=1e-2))
    p = np.clip(model.scores(held)[2], 1e-12, 1 - 1e-12)
    return model, float(-np.mean(held_y * np.log(p) + (1 - held_y) * np.log(1 - p)))


def co_train(labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray] | TablePool, held: tuple[np.ndarray, np.ndarray], held_y: np.ndarray, rounds: int = ROUNDS, penalties: tuple = (CONTENT_PENALTY, METADATA_PENALTY)) -> Model:
    """The model of the round that is best on held-out documents (of equal ones, the first), as the views exchange their surest pseudo-labels.

    ``pool`` holds the unlabelled documents, as arrays or as a table. A view that is not sure of both classes gives nothing,
    as labels of one class alone would shift the other view; when neither gives anything, the rounds end.
    """
    if isinstance(pool, tuple):
        pool = ArrayPool(pool)
    share = y.mean()
    most = max(1, round(PER_ROUND * (1 - share))), max(1, round(PER_ROUND * share))
    taken: tuple[set, set] = (set(), set())  # keys that each view has given
    x, labels = [[labelled[k]] for k in (0, 1)], [[y], [y]]
    best: tuple[Model, float] | None = None
    for round_ in range(rounds + 1):
        views = tuple(Linear.fit(np.vstack(x[k]), np.concatenate(labels[k]), penalties[k]) for k in (0, 1))
        model, loss = _fitted(views, held, held_y)
        if best is None or loss < best[1]:
            best = model, loss
        if round_ == rounds:
            break
        gave = False
        for k, own in enumerate(pool.surest(model, most, taken)):
            n = shares((sum(r[0] == 0 for r in own), sum(r[0] == 1 for r in own)), most)
            own = [r for label in (0, 1) for r in [r for r in own if r[0] == label][: n[label]]]
            if min(n):
                gave = True
                taken[k].update(r[1] for r in own)
                x[1 - k].append(np.array([r[3 - k] for r in own]))
                labels[1 - k].append(np.array([r[0] for r in own], float))
        if not gave:
            break
    return best[0]


SIZES = (WORDS + SHAPES + 5, SOURCES + LANGS + MEASURES)


def _features(rows: list) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.array([content(r["text"]) for r in rows], np.float32).reshape(len(rows), SIZES[0]),
        np.array([metadata(r["text"], r["source"], r["lang"]) for r in rows], np.float32).reshape(len(rows), SIZES[1]),
    )


def _matrix(rows: list[bytes], view: int) -> np.ndarray:
    """Features as they are stored, one row each."""
    return np.frombuffer(b"".join(rows), np.float16).astype(np.float32).reshape(len(rows), SIZES[view])


@releasing
def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", 3_000_000):
        views = _features(batch.to_pylist())
        stored = [pa.array([r.tobytes() for r in v.astype(np.float16)], pa.binary()) for v in views]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *stored], ["doc_id", "x", "m"])


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, key, x, m): the features of every document in half precision, written once; ``key`` tells them apart."""
    rows = docs.select("doc_id", "text", "source", "lang").mapInArrow(_feature_batches, "doc_id long, x binary, m binary")
    return staged(rows.select("doc_id", F.xxhash64("x", "m").alias("key"), "x", "m"), "features")


def labels_of(labels: DataFrame) -> DataFrame:
    """One quality per doc_id; labels without either say nothing, of contradicting ones the lower counts."""
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS) -> Model | None:
    """The model; None if the labelled documents do not have both classes, in training and held out."""
    says = labels_of(labels)
    features = feature_table(docs)
    ids = features.where("doc_id is not null").select("doc_id").distinct()
    known = ids.join(says, "doc_id").orderBy(F.xxhash64("doc_id", F.lit(99)), "doc_id").limit(fit_rows).collect()
    if len({r["quality"] > 0 for r in known}) < 2:
        return None
    table = docs.sparkSession.createDataFrame(pa.table({"doc_id": pa.array([r["doc_id"] for r in known], pa.int64()), "quality": pa.array([int(r["quality"] > 0) for r in known], pa.int32())}))
    rows = features.join(F.broadcast(table), "doc_id").groupBy("doc_id").agg(F.max(F.struct("x", "m", "quality")).alias("f")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    views = [_matrix([r["f"][c] for r in rows], k) for k, c in enumerate(("x", "m"))]
    y = np.array([r["f"]["quality"] for r in rows], float)
    held = np.array([xxhash.xxh3_64_intdigest(str(r["doc_id"]), 5) % HELD_OUT for r in rows]) == 0
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        return None
    pool = TablePool(features, says.select("doc_id"))
    return co_train((views[0][~held], views[1][~held]), y[~held], pool, (views[0][held], views[1][held]), y[held], rounds)


SCORES = ("content_score", "metadata_score", "score")


def with_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, names: tuple[str, ...] = SCORES) -> DataFrame:
    """All columns and rows with three scores: the chance of good quality by content, by metadata, by both.

    Rows are scored by their own text, source and language; null counts as empty. Null ids and repeated rows are scored
    like others. If nothing can be learnt from the labels, all scores are 1.0. An empty table gives no rows. The scores
    are called ``names``; columns of these names are replaced.
    """
    docs = docs.drop(*names)
    own = docs.select(F.col("doc_id").cast("long"), "text", F.col("source").cast("string"), F.col("lang").cast("string"))
    model = fit(own, labels, fit_rows)

    @releasing
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 3_000_000):
            if model is None:
                found = (np.ones(batch.num_rows),) * 3
            else:
                found = model.scores(_features(batch.select(["text", "source", "lang"]).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.asarray(s, np.float64)) for s in found)], [*batch.schema.names, *names])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, *(T.StructField(c, T.DoubleType()) for c in names)]))


def kept_documents(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents whose score is ``keep_from`` or more, with their own columns."""
    names = tuple(free_names(docs, *SCORES))
    return with_scores(docs, labels, names=names).where(F.col(names[-1]) >= keep_from).drop(*names)
