"""Toxicity by class-conditional Kneser-Ney bigram models.

Two interpolated Kneser-Ney models, one for toxic and one for ordinary labelled texts: bigram
counts (a bigram counts once a text), then the class's continuation counts (different left
words), then backoff counts that both classes share. The discounts are large and the shared
counts are raised by a constant, so a rare expression that happens to stand in one class only
says little. A text's score compares its length-normalised log-likelihoods under both models, at
the bigram level and at the backoff level alone: over the whole text, its most toxic window, and
its words that speak most for toxicity. A logistic curve fitted on labelled rows that gave no
counts turns these into 0 to 1.

Words are hashed to ``WORDS`` ids and bigrams to ``PAIRS`` slots, so the model's size has a fixed
bound whatever the corpus; it is fitted on at most about ``MAX_TOXIC`` and ``MAX_ORDINARY`` labelled
rows, taken by a hash (the stated bound of the fit). Ordinary rows are kept in several times the
number of toxic ones, because rare ordinary expressions are what toxic ones are told from; the
constant of the curve is corrected by both classes' shares taken, so a bound does not move the
scale of the scores. Scoring covers whole texts and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalens.llm.common import fold, hash_share, id_text, materialize, mix64, steps

WORDS = 1 << 18
PAIRS = 1 << 22
MAX_TOXIC = 8000
MAX_ORDINARY = 64_000
DISCOUNTS = np.array([0, 1, 2, 5])  # of counts 0, 1, 2, 3 and more
RAISED = 30        # added to every shared backoff count
LOWER_SHARE = 1.0  # weight of the shared level, in units of a class's tokens
CONTEXT = 50.0    # added to the mass that discounts free for the unigram level, in counts
WINDOW = 32
TOPS = (2, 6, 12)  # the words that speak most for toxicity, by rank
PER_LEVEL = 3 + len(TOPS)
FEATURES = 2 * PER_LEVEL + 1
CUT = 0.3
START = 0  # the id of "no word yet"

_TABLE = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))
_LOWER = bytes(_TABLE[c] + 32 if 65 <= c <= 90 else _TABLE[c] for c in range(256))


class Words:
    """Word ids of texts: ASCII lower case, punctuation is white space."""

    def __init__(self, keep: int = 1 << 18):
        self.known: dict[bytes, int] = {}
        self.keep = keep

    def ids(self, text: str) -> np.ndarray:
        words = text.encode().translate(_LOWER).split()
        known = self.known
        if len(known) > self.keep:  # only a cache: ids are hashes
            known.clear()
        try:
            return np.array([known[w] for w in words], np.int64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = 1 + xxhash.xxh64_intdigest(w, 42) % (WORDS - 1)
            return np.array([known[w] for w in words], np.int64)


def slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (mix64(left.astype(np.uint64) << np.uint64(18) | right.astype(np.uint64))
            & np.uint64(PAIRS - 1)).astype(np.int64)


def discounted(n: np.ndarray) -> np.ndarray:
    return np.maximum(n - DISCOUNTS[np.minimum(n, 3)], 0)


@dataclass
class Model:
    """Tables by word id or pair slot; the first axis is the class (0 ordinary, 1 toxic)."""

    pair: np.ndarray      # float32 [2, PAIRS] discounted bigram counts
    context: np.ndarray   # float32 [2, WORDS] counts of the left word
    freed: np.ndarray     # float32 [2, WORDS] what the discounts took from them
    lower: np.ndarray     # float32 [2, WORDS] class level with the shared backoff inside
    curve: np.ndarray     # float64 [FEATURES + 1] weights of the features and the constant

    def word_scores(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log P(toxic) - log P(ordinary) of every word by the bigram models and by their backoff
        level alone; ``first`` marks each text's first word."""
        left = np.empty_like(ids)
        left[1:] = ids[:-1]
        left[first] = START
        at = slots(left, ids)
        lower = [self.lower[c][ids] for c in (0, 1)]
        level = [(self.pair[c][at] + (self.freed[c][left] + np.float32(CONTEXT)) * lower[c])
                 / (self.context[c][left] + np.float32(CONTEXT)) for c in (0, 1)]
        return np.log(level[1]) - np.log(level[0]), np.log(lower[1]) - np.log(lower[0])

    def features(self, texts: list[str], words: Words) -> np.ndarray:
        """Per text: for both levels the mean word score, its sum over sqrt(n), the most toxic
        window and the top words; and the size."""
        ids = [words.ids(t) for t in texts]
        sizes = np.array([len(x) for x in ids], np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        out = np.zeros((len(texts), FEATURES))
        if not ends[-1]:
            return out
        out[:, -1] = np.log1p(sizes)
        for level, score in enumerate(self.word_scores(np.concatenate(ids), begins[sizes > 0])):
            total = np.append(0.0, np.cumsum(score, dtype=np.float64))
            for i, (b, e) in enumerate(zip(begins.tolist(), ends.tolist())):
                n = e - b
                if not n:
                    continue
                k = min(WINDOW, n)
                sums = total[b + k:e + 1] - total[b:e - k + 1]
                top = np.zeros(TOPS[-1])
                best = score[b:e]
                if n > TOPS[-1]:
                    best = np.partition(best, n - TOPS[-1])[n - TOPS[-1]:]
                top[:len(best)] = np.sort(best)[::-1]
                whole = total[e] - total[b]
                out[i, PER_LEVEL * level:PER_LEVEL * (level + 1)] = (
                    whole / n, whole / np.sqrt(n), sums.max() / k,
                    *(top[x:y].mean() for x, y in zip((0, *TOPS), TOPS)))
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for b in steps(batches):
        toxic = np.array(b.column("toxic").to_pylist(), np.int64)
        key = [np.zeros(0, np.int64)]
        for c, t in zip(toxic, b.column("text").to_pylist()):
            x = words.ids(t)
            left = np.append(START, x[:-1])[:len(x)]
            key.append(np.unique(c << 36 | left << 18 | x))
        key, n = np.unique(np.concatenate(key), return_counts=True)
        yield pa.RecordBatch.from_pydict(
            {"toxic": key >> 36, "a": key >> 18 & (WORDS - 1), "b": key & (WORDS - 1),
             "slot": slots(key >> 18 & (WORDS - 1), key & (WORDS - 1)), "n": n})


def _dense(rows: DataFrame, key: str, value: str, size: int) -> np.ndarray:
    """[2, size] table of (toxic, key, value) rows: at most 2 * size of them by construction."""
    out = np.zeros((2, size), np.int32)
    got = rows.select("toxic", key, value).toArrow()
    out[got["toxic"].to_numpy(), got[key].to_numpy()] = got[value].to_numpy()
    return out


def fit(labelled: DataFrame) -> Model | None:
    """Model of a bounded sample of labelled rows (text, toxic 0/1, weight); None if a class has no rows.

    ``weight`` is how many labelled rows of its class a row stands for. Three quarters of the rows,
    by a hash, give counts, one quarter the curve, whose constant is moved to the classes' true shares.
    """
    picked = labelled.select("text", F.col("toxic").cast("long").alias("toxic"), "weight",
                             F.xxhash64("text").alias("h"))
    picked = picked.withColumn("curve", F.pmod(F.xxhash64("h"), F.lit(4)) == 0)
    picked = materialize(picked, "toxicity-sample")
    sizes = picked.groupBy("toxic", "curve").agg(F.count("*").alias("n"), F.max("weight").alias("w")).collect()
    n_of = {(r.toxic, r.curve): r.n for r in sizes}
    weight = {r.toxic: r.w for r in sizes}
    if not all(any(n_of.get((c, k), 0) for k in (True, False)) for c in (0, 1)):
        return None
    counting = picked.where(~F.col("curve"))
    if not all(n_of.get((c, False), 0) for c in (0, 1)):
        counting = picked
    grams = materialize(
        counting.repartition(8, "h").select("text", "toxic")
        .mapInArrow(_counts, "toxic long, a long, b long, slot long, n long")
        .groupBy("toxic", "a", "b", "slot").agg(F.sum("n").alias("n")), "toxicity-grams")
    three = F.least(F.col("n"), F.lit(3))
    off = F.least(F.col("n"), F.element_at(F.array(*(F.lit(int(x)) for x in DISCOUNTS[1:])),
                                           three.cast("int")).cast("long"))
    grams = grams.withColumn("off", off)
    # only what the discounts leave: few rows pass through the driver
    pair = _dense(grams.where(F.col("n") > F.col("off")).groupBy("toxic", "slot")
                  .agg(F.sum(F.col("n") - F.col("off")).alias("n")), "slot", "n", PAIRS)
    left = grams.groupBy("toxic", "a").agg(F.sum("n").alias("n"), F.sum("off").alias("off"))
    context, freed = _dense(left, "a", "n", WORDS), _dense(left, "a", "off", WORDS)
    cont = _dense(grams.groupBy("toxic", "b").agg(F.count("*").alias("n")), "b", "n", WORDS)
    both = _dense(grams.select(F.lit(0).cast("long").alias("toxic"), "a", "b").distinct()
                  .groupBy("toxic", "b").agg(F.count("*").alias("n")), "b", "n", WORDS)[0]
    shared = (both + RAISED) / (both.sum() + RAISED * WORDS)
    lower = np.empty((2, WORDS), np.float32)
    for c in (0, 1):
        kept, total = discounted(cont[c]), max(1, cont[c].sum())
        lower[c] = (kept + (total - kept.sum() + LOWER_SHARE * total) * shared) \
            / (total + LOWER_SHARE * total)
    small = np.float32
    model = Model(pair.astype(small), context.astype(small), freed.astype(small), lower,
                  np.zeros(FEATURES + 1))
    curve_rows = picked.where("curve") if all(n_of.get((c, True), 0) for c in (0, 1)) else picked
    model.curve = _curve(_features(curve_rows, model).toArrow())
    model.curve[-1] += np.log(weight[1] / weight[0])
    return model


def _features(rows: DataFrame, model: Model) -> DataFrame:
    ship = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"f{i}" for i in range(FEATURES)]

    def run(batches):
        words = Words()
        for b in steps(batches):
            f = ship.value.features(b.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_pydict(
                {"toxic": b.column("toxic"), **{n: f[:, i] for i, n in enumerate(names)}})

    return rows.select("text", "toxic").mapInArrow(
        run, "toxic long, " + ", ".join(f"{n} double" for n in names))


def _curve(rows: pa.Table, rounds: int = 40, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton steps on standardised features."""
    x = np.column_stack([rows[f"f{i}"].to_numpy() for i in range(FEATURES)])
    y = rows["toxic"].to_numpy().astype(float)
    mean, sd = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / sd, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + ridge * w
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), g)
    return np.append(w[:-1] / sd, w[-1] - (w[:-1] * mean / sd).sum())


def labelled_rows(docs: DataFrame, labels: DataFrame, parts: int = 4, left_out: int = 2,
                  max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY) -> DataFrame:
    """(text, toxic, weight) of labelled documents whose fold is not ``left_out``, at most about
    ``max_toxic`` and ``max_ordinary`` of them.

    Null ids or labels are left out; an id with several label rows takes the largest label. The
    weight is the class's labelled rows divided by those taken.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .where(fold(F.col("doc_id"), parts) != left_out)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share, weight = F.lit(False), F.lit(1.0)
    for c, most in ((0, max_ordinary), (1, max_toxic)):
        n = sizes.get(c, 0)
        share = share | ((F.col("toxic") == c) & hash_share(n, most, "doc_id"))
        if n > most:
            weight = F.when(F.col("toxic") == c, F.lit(n / (0.95 * most))).otherwise(weight)
    # at most about max_toxic + max_ordinary pairs of numbers: a bounded broadcast, no text is shuffled
    picked = F.broadcast(known.where(share).withColumn("weight", weight))
    return id_text(docs).join(picked, "doc_id").select("text", "toxic", "weight")


def score(docs: DataFrame, model: Model | None, name: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``name`` (0 to 1) added; null and empty texts are scored too.

    A column of that name is replaced. Without a model (no labelled rows of both classes) every
    score is 0.
    """
    ship = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema if f.name != name]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept),
                        f"{name} double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, m = Words(), ship.value
        for b in steps(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            s = m.score(m.features(texts, words)) if m else np.zeros(len(texts))
            yield b.append_column(name, pa.array(s))

    return docs.select([f.name for f in kept]).mapInArrow(run, schema)


def keep_civil(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``docs`` without the documents whose score reaches ``cut``.

    Null and empty texts are scored as empty texts; repeated rows go or stay together. Without labels
    of both classes every row stays. Any columns are passed on.
    """
    name = "_toxicity_score"
    while name in docs.columns:
        name += "_"
    return score(docs, fit(labelled_rows(docs, labels)), name).where(F.col(name) < cut).drop(name)


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; repeated rows and ties get equal scores, an
    empty table gives no rows, other columns are ignored. ``held_out`` of a null id is null."""
    model = fit(labelled_rows(docs, labels))
    return score(id_text(docs), model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= CUT).cast("int").alias("predicted"))
