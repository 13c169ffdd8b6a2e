"""Language identification by a convolutional network over bytes, trained in numpy.

A text is cut into windows of ``window`` bytes, the last one zero-padded. Bytes are
embedded, filters of several widths run over the window, each filter's maximum
over the window goes through one softmax layer. A text's score per language is the
mean over all its windows, weighted by their bytes; no part of a text is skipped.

Training takes at most ``per_lang`` labelled documents of every language, chosen by a
hash of the key, and up to two windows of each; no label is left out. Prediction adds up table rows: a width-2 filter is one look-up by
byte pair, width 3 and 4 are two, so no patch matrix is built.

A null text or one without a letter is ``und`` with score 0, a table without
labels makes every text ``und``; repeated rows are scored alike, and a null key
counts as crc32 0 (never held out).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayloom.llm.common import crc_mod, documents

WIDTHS = (2, 3, 4)
_LETTER = re.compile(r"[^\W\d_]")
_ASCII = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(_ASCII.search(text) or _LETTER.search(text.decode("utf-8", "replace")))


class ByteCnn:
    """Parameters and training of the network; ``tables`` is the form used for prediction."""

    def __init__(self, langs: list[str], window: int = 256, dim: int = 8, filters: int = 16, seed: int = 1):
        g = np.random.default_rng(seed)
        self.langs, self.window, self.dim, self.filters = langs, window, dim, filters
        self.p = {"E": g.normal(0, 0.5, (256, dim)), "V": g.normal(0, 0.1, (filters * len(WIDTHS), len(langs))),
                  "c": np.zeros(len(langs))}
        for w in WIDTHS:
            self.p[f"W{w}"] = g.normal(0, 1 / np.sqrt(w * dim), (w * dim, filters))
            self.p[f"b{w}"] = np.zeros(filters)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.g = g

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients of one batch of windows; gradients pass the pooled positions only."""
        p, n = self.p, len(x)
        e = p["E"][x]
        pooled, kept = [], []
        for w in WIDTHS:
            patch = np.concatenate([e[:, i: self.window - w + 1 + i] for i in range(w)], axis=2)
            z = patch @ p[f"W{w}"] + p[f"b{w}"]
            at = z.argmax(axis=1)
            pooled.append(np.maximum(np.take_along_axis(z, at[:, None], 1)[:, 0], 0))
            kept.append((patch, at))
        h = np.concatenate(pooled, axis=1)
        o = h @ p["V"] + p["c"]
        o -= o.max(axis=1, keepdims=True)
        q = np.exp(o)
        q /= q.sum(axis=1, keepdims=True)
        loss = float(-np.log(q[np.arange(n), y] + 1e-9).mean())
        q[np.arange(n), y] -= 1
        q /= n
        d = {"V": h.T @ q, "c": q.sum(axis=0), "E": np.zeros_like(p["E"])}
        dh = (q @ p["V"].T) * (h > 0)
        rows = np.arange(n)[:, None]
        for i, w in enumerate(WIDTHS):
            patch, at = kept[i]
            dz = dh[:, i * self.filters: (i + 1) * self.filters]
            best = patch[rows, at]
            d[f"W{w}"] = np.einsum("nfk,nf->kf", best, dz)
            d[f"b{w}"] = dz.sum(axis=0)
            back = dz[:, :, None] * p[f"W{w}"].T[None]
            for j in range(w):
                np.add.at(d["E"], x[rows, at + j], back[:, :, j * self.dim: (j + 1) * self.dim])
        return loss, d

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> ByteCnn:
        """Adam over shuffled batches; same rows in the same order give the same weights."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = self.g.permutation(len(x))
            for a in range(0, len(x), batch):
                take = order[a: a + batch]
                _, d = self.step(x[take], y[take])
                t += 1
                for k, grad in d.items():
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    s[k] = 0.99 * s[k] + 0.01 * grad * grad
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
        return self

    def tables(self, seen: np.ndarray) -> dict:
        """Look-up tables over the byte values seen in training; all others share class 0."""
        kinds = np.unique(seen)
        cls = np.zeros(256, np.int32)
        cls[kinds] = np.arange(1, len(kinds) + 1)
        k = len(kinds) + 1
        emb = np.zeros((k, self.dim), np.float32)
        emb[1:] = self.p["E"][kinds]
        part = {w: [emb @ self.p[f"W{w}"][i * self.dim: (i + 1) * self.dim] for i in range(w)] for w in WIDTHS}
        pair = lambda a, b: (a[:, None] + b[None]).reshape(k * k, -1)
        first = np.concatenate([pair(part[w][0], part[w][1]) + self.p[f"b{w}"] for w in WIDTHS], axis=1)
        return {"cls": cls, "k": k, "first": np.ascontiguousarray(first), "third": part[3][2],
                "last": pair(part[4][2], part[4][3]), "V": self.p["V"], "c": self.p["c"], "langs": self.langs,
                "window": self.window, "filters": self.filters}


def windows(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts as rows, the text each belongs to, and its bytes."""
    n = np.array([max(1, -(-len(t) // size)) for t in texts], np.int64)
    start = np.cumsum(n) - n
    flat = np.zeros(int(n.sum()) * size, np.uint8)
    for t, s in zip(texts, start, strict=True):
        flat[s * size: s * size + len(t)] = np.frombuffer(t, np.uint8)
    owner = np.repeat(np.arange(len(texts)), n)
    length = np.full(len(owner), size)
    last = start + n - 1
    length[last] = np.array([len(t) for t in texts], np.int64) - (n - 1) * size
    return flat.reshape(-1, size), owner, length


def probabilities(x: np.ndarray, t: dict, chunk: int = 64) -> np.ndarray:
    """Softmax of every window, ``chunk`` windows at a time."""
    out = np.empty((len(x), len(t["langs"])), np.float32)
    f, k, n = t["filters"], t["k"], t["window"]
    for a in range(0, len(x), chunk):
        c = t["cls"][x[a: a + chunk]]
        pair = c[:, :-1] * k + c[:, 1:]
        z = np.take(t["first"], pair, axis=0)
        z[:, : n - 2, f: 2 * f] += np.take(t["third"], c[:, 2:], axis=0)
        z[:, : n - 3, 2 * f:] += np.take(t["last"], pair[:, 2:], axis=0)
        z[:, n - 2:, f: 2 * f] = -np.inf
        z[:, n - 3:, 2 * f:] = -np.inf
        o = np.maximum(z.max(axis=1), 0) @ t["V"] + t["c"]
        o = np.exp(o - o.max(axis=1, keepdims=True))
        out[a: a + chunk] = o / o.sum(axis=1, keepdims=True)
    return out


def fit(docs: DataFrame, per_lang: int = 500, window: int = 256, text: str = "text",
        lang: str = "lang", key: str = "doc_id") -> dict | None:
    """Train on a bounded hash sample of the labelled rows of ``docs``; None without labels."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = sorted((r[0], r[1]) for r in labelled.groupBy(lang).count().collect())  # a row per language
    langs = [v for v, _ in counts]
    if not langs:
        return None
    h = F.xxhash64(F.col(key), F.lit(8))
    share = F.create_map(*[F.lit(c) for v, n in counts for c in (v, min(1.0, 1.5 * per_lang / n))])[F.col(lang)]
    kept = labelled.where(F.pmod(h, F.lit(1_000_003)) / F.lit(1_000_003.0) < share)
    room = F.greatest(F.length(text) - window, F.lit(0)) + 1
    cuts = [F.expr(f"substring({text}, cast(pmod(shiftright(xxhash64({key}, {i}), 3), greatest(length({text}) - {window}, 0) + 1) + 1 as int), {window})")
            for i in (11, 12)]
    rows = kept.select(h.alias("h"), F.col(lang).alias("lang"), room.alias("room"), F.array(*cuts).alias("cuts"))
    # about 1.5 * per_lang excerpts of a language reach this window
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", "cuts"))).where(F.col("rank") <= per_lang).collect()
    rows.sort(key=lambda r: (r["h"], r["lang"], r["cuts"]))
    number, x, y = {v: i for i, v in enumerate(langs)}, [], []
    for r in rows:
        for c in r["cuts"][: 2 if r["room"] > 1 else 1]:
            x.append(c.encode()[:window])
            y.append(number[r["lang"]])
    if not x:
        return None
    x, y = windows(x, window)[0], np.array(y)
    return ByteCnn(langs, window).fit(x, y).tables(x)


def identify(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = shared.value
        langs = np.array(t["langs"], object)
        for b in batches:
            pred, score = np.full(len(b), "und", object), np.zeros(len(b))
            known = [i for i, v in enumerate(b) if v is not None and has_letter(v)]
            for part in _parts(known, b):
                x, owner, length = windows([b.iloc[i] for i in part], t["window"])
                q = probabilities(x, t) * length[:, None]
                sums = np.add.reduceat(q, np.searchsorted(owner, np.arange(len(part))), axis=0)
                sums /= sums.sum(axis=1, keepdims=True)
                best = sums.argmax(axis=1)
                pred[part], score[part] = langs[best], np.minimum(sums[np.arange(len(part)), best], 1.0)
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    return docs.withColumn("_id", predict(F.col(text).cast("binary"))).withColumns(
        {"lang_pred": F.col("_id.lang_pred"), "score": F.col("_id.score")}).drop("_id")


def _parts(rows: list[int], texts: pd.Series, most: int = 1 << 22) -> Iterator[list[int]]:
    """Rows in groups of about ``most`` bytes, to bound memory; a longer text is a group of its own."""
    part, size = [], 0
    for i in rows:
        part.append(i)
        size += len(texts.iloc[i])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def op8_byte_cnn(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held = crc_mod("doc_id", 4) == 2
    model = fit(docs.where(~held))
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")
