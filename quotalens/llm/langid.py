"""Language identification by a byte convolutional network, trained in numpy.

Bytes are embedded, filters of widths 2, 3 and 4 run over them, their maxima over a window feed
a softmax. Training windows come from a bounded sample of labelled texts (``PER_LANG`` windows a
language, by hash of the text: the stated bound of the fit). A whole text is cut into windows of
``WINDOW`` bytes, all windows of a batch go through the network together, and a text's language
is the one with the largest sum of log-probabilities over its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalens.llm.common import flat, fold, hash_share, id_text, steps

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16       # per width
EMBED = 8
PER_LANG = 3000    # training windows a language
EPOCHS = 8
BATCH = 64
PASS = 256         # windows that go through the network together
UNKNOWN = "und"


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray    # [256, EMBED]; byte 0 pads
    filters: np.ndarray  # [max(WIDTHS) * EMBED, len(WIDTHS) * FILTERS], narrow ones padded by 0
    bias: np.ndarray
    dense: np.ndarray    # [len(WIDTHS) * FILTERS, languages]
    out: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """[windows * positions, max(WIDTHS) * EMBED] embedded neighbourhoods."""
        n, size = windows.shape
        wide = max(WIDTHS)
        padded = np.zeros((n, size + wide - 1, EMBED), np.float32)
        padded[:, :size] = self.embed[windows]
        view = np.lib.stride_tricks.as_strided(
            padded, (n, size, wide * EMBED),
            (padded.strides[0], padded.strides[1], padded.strides[2]))
        return view.reshape(n * size, wide * EMBED)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        made = self.columns(windows) @ self.filters
        return np.maximum(made.reshape(*windows.shape, -1).max(axis=1) + self.bias, 0)

    def log_probs(self, windows: np.ndarray) -> np.ndarray:
        z = np.concatenate([self.pooled(windows[i:i + PASS]) for i in range(0, len(windows), PASS)]) \
            @ self.dense + self.out
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def cut_windows(raw: np.ndarray, offs: np.ndarray, size: int = WINDOW):
    """All windows of all texts (the last one padded by byte 0) and the text of each."""
    lengths = np.diff(offs)
    counts = -(-lengths // size)
    doc = np.repeat(np.arange(len(lengths)), counts)
    starts = np.cumsum(counts) - counts
    nth = np.arange(len(doc)) - starts[doc]
    out = np.zeros((len(doc), size), np.uint8)
    pos = np.arange(len(raw)) - np.repeat(offs[:-1], lengths)
    row = np.repeat(starts, lengths) + pos // size
    out.ravel()[row * size + pos % size] = raw
    return out, doc, nth


def train(windows: np.ndarray, langs: np.ndarray, names: list[str], seed: int = 7,
          epochs: int = EPOCHS, rate: float = 4e-3) -> Network:
    """Adam on cross-entropy; the maximum passes its gradient to the position that won."""
    rng = np.random.default_rng(seed)
    f, wide = len(WIDTHS) * FILTERS, max(WIDTHS)
    small = np.float32
    mask = np.zeros((wide * EMBED, f), small)
    for k, w in enumerate(WIDTHS):
        mask[:w * EMBED, k * FILTERS:(k + 1) * FILTERS] = 1
    net = Network(names, rng.normal(0, 0.3, (256, EMBED)).astype(small),
                  (rng.normal(0, 0.25, mask.shape) * mask).astype(small), np.zeros(f, small),
                  rng.normal(0, 0.2, (f, len(names))).astype(small), np.zeros(len(names), small))
    params = ["embed", "filters", "bias", "dense", "out"]
    m1 = {p: np.zeros_like(getattr(net, p)) for p in params}
    m2 = {p: np.zeros_like(getattr(net, p)) for p in params}
    step, total = 0, epochs * -(-len(windows) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            x, y = windows[order[i:i + BATCH]], langs[order[i:i + BATCH]]
            n, size = x.shape
            cols = net.columns(x)
            conv = (cols @ net.filters).reshape(n, size, f)
            won = conv.argmax(axis=1)
            top = np.take_along_axis(conv, won[:, None], 1)[:, 0] + net.bias
            act = np.maximum(top, 0)
            z = act @ net.dense + net.out
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            back = (p @ net.dense.T) * (top > 0)  # [n, f] at position won
            grads = {"dense": act.T @ p, "out": p.sum(0), "bias": back.sum(0)}
            at = (np.arange(n)[:, None] * size + won)  # [n, f] rows of cols
            grads["filters"] = np.einsum("nfk,nf->kf", cols[at], back) * mask
            dcol = back[:, :, None] * net.filters.T[None]  # [n, f, wide * EMBED]
            bytes_at = np.zeros((n, size + wide - 1), np.int64)
            bytes_at[:, :size] = x
            touched = bytes_at[np.arange(n)[:, None, None], won[:, :, None] + np.arange(wide)]
            g = np.zeros_like(net.embed)
            flat_g = dcol.reshape(-1, EMBED)
            for e in range(EMBED):
                g[:, e] = np.bincount(touched.ravel(), weights=flat_g[:, e], minlength=256)
            g[0] = 0
            grads["embed"] = g
            step += 1
            lr = rate * (1 - step / (total + 1))
            for q in params:
                m1[q] += 0.1 * (grads[q] - m1[q])
                m2[q] += 0.001 * (grads[q] ** 2 - m2[q])
                move = lr * (m1[q] / (1 - 0.9 ** step)) / (np.sqrt(m2[q] / (1 - 0.999 ** step)) + 1e-8)
                setattr(net, q, (getattr(net, q) - move).astype(small))
            net.embed[0] = 0
    return net


def fit(docs: DataFrame, left_out: int | None = 2, parts: int = 4,
        per_lang: int = PER_LANG) -> Network | None:
    """Network of labelled texts whose fold is not ``left_out`` (None: of all).

    Rows with a null or empty lang are left out. Per language about ``per_lang`` texts, taken by a
    hash, give one window each from a place that a hash names too, so the sample that the driver
    sees is about languages x ``per_lang`` x ``WINDOW`` bytes. Without labels: None.
    """
    rows = docs.select("text", "lang", "doc_id").where(
        F.col("text").isNotNull() & (F.length(F.trim("text")) > 0)
        & F.col("lang").isNotNull() & (F.col("lang") != ""))
    if left_out is not None:
        rows = rows.where(fold(F.col("doc_id").cast("long"), parts) != left_out)
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return None
    raw, h = F.encode("text", "UTF-8"), F.xxhash64("text")
    start = F.pmod(h, F.greatest(F.lit(1), F.octet_length("text") - WINDOW + 1))
    share = F.lit(False)
    for name in names:
        share = share | ((F.col("lang") == name) & hash_share(sizes[name], per_lang, "text", "doc_id"))
    got = rows.where(share).select(
        "lang", F.substring(raw, start.cast("int") + 1, F.lit(WINDOW)).alias("w"), h.alias("h")).toArrow()
    got = got.sort_by([("lang", "ascending"), ("h", "ascending")])
    x = np.zeros((len(got), WINDOW), np.uint8)
    for i, w in enumerate(got["w"].to_pylist()):
        x[i, :len(w)] = np.frombuffer(w, np.uint8)
    y = np.array([names.index(v) for v in got["lang"].to_pylist()])
    return train(x, y, names)


def _has_letter(texts: list[str]) -> np.ndarray:
    return np.array([any(map(str.isalpha, t[:64])) or any(map(str.isalpha, t[64:])) for t in texts])


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score: ``und`` (score 0) for a null text or one without letters."""
    ship = docs.sparkSession.sparkContext.broadcast(net)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ship.value
        for b in steps(batches, max_bytes=1 << 20):
            n = b.num_rows
            letters = _has_letter(b.column("text").to_pylist())
            lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
            raw, offs = flat(b.column("text"))
            if model and letters.any():
                total = np.zeros((n, len(model.langs)))
                windows, doc, nth = cut_windows(raw, offs)
                logs = model.log_probs(windows)
                filled = np.minimum(np.diff(offs)[doc] - nth * WINDOW, WINDOW) / WINDOW
                for k in range(len(model.langs)):
                    total[:, k] = np.bincount(doc, weights=logs[:, k] * filled, minlength=n)
                weight = np.maximum(np.bincount(doc, weights=filled, minlength=n), 1e-9)
                mean = np.exp(total / np.maximum(weight, 1)[:, None])
                best = total.argmax(axis=1)
                lang = np.where(letters, np.array(model.langs, object)[best], UNKNOWN)
                score = np.where(letters, mean[np.arange(n), best] / mean.sum(axis=1), 0.0)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": b.column("doc_id"), "lang_pred": lang.tolist(), "score": score},
                schema=schema)

    return id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op5(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    out = predict(docs, fit(docs))
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
                      "lang_pred", "score")
