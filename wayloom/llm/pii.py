"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns. The field then labels the *mentions* of a
document, its words with a digit or ``@`` (all other words are outside by
definition): neighbouring mentions are joined by chain edges, and distant mentions
that repeat or resemble each other (same letters and digits, same digits, same
start of an address) by skip edges with a shared potential. Loopy sum-product
messages run over all documents of a batch at once until they settle
(``max_rounds`` at most; messages are damped). Mentions inside base spans are observed.
An unobserved run of mentions whose marginal reaches ``accept`` becomes an added
span, unless it meets a base span. Repeats are linked in order of occurrence, so
edges grow with the text, not with its square.

Weights are trained by pseudo-likelihood on the base labels of at most
``max_docs`` documents, a part of the mentions with their own features hidden, so
that context and skip edges carry weight.

A null text counts as empty (no spans, the hash of the empty string). Rows repeat
and keys may be null without effect on each other; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import documents

KINDS = ("email", "ip", "card", "phone")
_ANY = re.compile(r"[0-9@]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_RUN = re.compile(r"[^\W_]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, by kind, then start. Every scan is linear in the text."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at  # the run of name characters before the @ starts the leftmost match
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            end = m.end()
        else:
            end = at + 1
        at = text.find("@", end)
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        d = _NOT_DIGIT.sub("", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


FEATURES = 24


def _features(word: str) -> list[float]:
    d = _NOT_DIGIT.sub("", word)
    n, dots = len(d), word.count(".")
    letters = len(word) - n - sum(word.count(c) for c in ".-+()@_%")
    return [1.0, "@" in word, dots == 1, dots == 2, dots == 3, dots > 3, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 8,
            9 <= n <= 12, 13 <= n <= 19, n > 19, letters == 0, letters > 0 and n > 0, word[0] == "+",
            "(" in word or ")" in word, "-" in word, len(word) > 24, "=" in word or '"' in word,
            13 <= n <= 19 and luhn(d), word[0].isalpha()]


def _keys(word: str) -> list[str]:
    """What makes two mentions alike: letters and digits, long digit strings, the start of an address."""
    runs = _RUN.findall(word.lower())
    flat = "".join(runs)
    keys = ["w" + flat] if len(flat) >= 3 else []
    d = _NOT_DIGIT.sub("", flat)
    if len(d) >= 7:
        keys.append("d" + d)
    if len(runs) >= 2 and not flat.isdigit():
        keys.append("a" + runs[0] + "." + runs[1])
    return keys


class Graph:
    """Mentions of many documents with their features, observed labels and edges."""

    def __init__(self) -> None:
        self.x: list[list[float]] = []
        self.label: list[int] = []
        self.span: list[tuple[int, int, int]] = []  # document, start, end
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, doc: int, text: str, spans: list[Span]) -> None:
        last_of: dict[str, int] = {}
        before, spans = None, sorted((a, b, k) for k, a, b in spans)
        s = 0
        mentions = []
        for i, m in enumerate(_WORD.finditer(text)):
            if _ANY.search(m[0]):
                mentions.append((i, m))
        for i, m in mentions:
            while s < len(spans) and spans[s][1] <= m.start():
                s += 1
            inside = next((k + 1 for a, b, k in spans[s: s + 8] if a < m.end() and b > m.start()), 0)
            node = len(self.x)
            self.x.append(_features(m[0]) + [0.0, 0.0, 0.0])
            self.label.append(inside)
            self.span.append((doc, m.start(), m.end()))
            if before is not None and before[0] == i - 1:
                self.chain.append((before[1], node))
                self.x[before[1]][21] = 1.0
                self.x[node][22] = 1.0
            linked = set()
            for k in _keys(m[0]):
                j = last_of.get(k)
                if j is not None and j not in linked:
                    self.skip.append((j, node))
                    linked.add(j)
                last_of[k] = node
            self.x[node][23] = float(bool(linked))
            before = (i, node)

    def arrays(self):
        pairs = lambda e: np.array(e, np.int64).reshape(-1, 2)
        return (np.array(self.x, np.float64).reshape(-1, FEATURES), np.array(self.label, np.int64), pairs(self.chain),
                pairs(self.skip))


def train(graph: Graph, rounds: int = 300, hide: float = 0.5, seed: int = 7) -> dict:
    """Pseudo-likelihood by Adam: node weights, chain table and a symmetric skip table."""
    x, y, chain, skip = graph.arrays()
    g, k = np.random.default_rng(seed), len(KINDS) + 1
    p = {"W": np.zeros((FEATURES, k)), "T": np.zeros((k, k)), "S": np.zeros((k, k))}
    if not len(x):
        return p
    m = {n: np.zeros_like(v) for n, v in p.items()}
    s = {n: np.zeros_like(v) for n, v in p.items()}
    one = np.eye(k)
    ones = one[y]
    left, right, near = (np.zeros((len(x), k)) for _ in range(3))
    np.add.at(left, chain[:, 1], ones[chain[:, 0]])
    np.add.at(right, chain[:, 0], ones[chain[:, 1]])
    np.add.at(near, skip[:, 1], ones[skip[:, 0]])
    np.add.at(near, skip[:, 0], ones[skip[:, 1]])
    for t in range(1, rounds + 1):
        seen = x.copy()
        seen[g.random(len(x)) < hide, 1:] = 0.0  # these rest on their neighbours alone
        o = seen @ p["W"] + left @ p["T"] + right @ p["T"].T + near @ p["S"]
        q = np.exp(o - o.max(axis=1, keepdims=True))
        q = (q / q.sum(axis=1, keepdims=True) - ones) / len(x)
        d = {"W": seen.T @ q, "T": left.T @ q + q.T @ right, "S": near.T @ q}
        d["S"] = d["S"] + d["S"].T
        for n in p:
            grad = d[n] + 1e-4 * p[n]
            m[n] = 0.9 * m[n] + 0.1 * grad
            s[n] = 0.99 * s[n] + 0.01 * grad * grad
            p[n] = p[n] - 0.1 * (m[n] / (1 - 0.9**t)) / (np.sqrt(s[n] / (1 - 0.99**t)) + 1e-8)
    return p


def marginals(graph: Graph, p: dict, max_rounds: int = 100, damping: float = 0.3, tolerance: float = 1e-4) -> np.ndarray:
    """Sum-product messages over chain and skip edges together; observed labels are fixed."""
    x, y, chain, skip = graph.arrays()
    k = p["T"].shape[0]
    node = x @ p["W"]
    seen = y > 0
    node[seen] = -40.0
    node[seen, y[seen]] = 0.0
    src = np.concatenate([chain[:, 0], skip[:, 0], chain[:, 1], skip[:, 1]])
    dst = np.concatenate([chain[:, 1], skip[:, 1], chain[:, 0], skip[:, 0]])
    n, half = len(src), len(src) // 2
    back = np.concatenate([np.arange(half, n), np.arange(half)])
    chained, tables = np.zeros(n, np.int64), [np.exp(p["T"]), np.exp(p["S"]), np.exp(p["T"].T)]
    chained[: len(chain)], chained[len(chain): half], chained[half: half + len(chain)], chained[half + len(chain):] = 0, 1, 2, 1
    msg = np.zeros((n, k))
    belief = node.copy()
    for _ in range(max_rounds if n else 0):
        belief = node.copy()
        np.add.at(belief, dst, msg)
        out = belief[src] - msg[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.empty_like(msg)
        for c, table in enumerate(tables):
            new[chained == c] = out[chained == c] @ table
        new = np.log(new)
        new -= new.max(axis=1, keepdims=True)
        change = np.abs(new - msg).max()
        msg = damping * msg + (1 - damping) * new
        if change < tolerance:
            break
    belief = node.copy()
    np.add.at(belief, dst, msg)
    q = np.exp(belief - belief.max(axis=1, keepdims=True))
    return q / q.sum(axis=1, keepdims=True)


def added_spans(graph: Graph, q: np.ndarray, texts: dict[int, str], base: dict[int, list[Span]], accept: float) -> dict[int, list[Span]]:
    """Runs of accepted, unobserved mentions of one kind, trimmed of outer punctuation."""
    out: dict[int, list[Span]] = {}
    best, chained = q.argmax(axis=1), {j: i for i, j in graph.chain}
    runs: list[list[int]] = []
    for i in range(len(q)):
        if graph.label[i] == 0 and best[i] > 0 and q[i, best[i]] >= accept:
            j = chained.get(i)
            if runs and j is not None and runs[-1][-1] == j and best[j] == best[i]:
                runs[-1].append(i)
            else:
                runs.append([i])
    for r in runs:
        doc, a, b = graph.span[r[0]][0], graph.span[r[0]][1], graph.span[r[-1]][2]
        text = texts[doc]
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while b > a and not (text[b - 1].isalnum() or text[b - 1] == ")"):
            b -= 1
        if a < b and not any(s < b and e > a for _, s, e in base[doc]):
            out.setdefault(doc, []).append((int(best[r[0]]) - 1, a, b))
    return out


def find(texts: list[str | None], weights: dict, accept: float = 0.9) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text."""
    base: dict[int, list[Span]] = {}
    kept: dict[int, str] = {}
    graph = Graph()
    for i, t in enumerate(texts):
        if t and _ANY.search(t):
            base[i], kept[i] = base_spans(t), t
            graph.add(i, t, base[i])
    if not kept:
        return [([], [])] * len(texts)
    more = added_spans(graph, marginals(graph, weights), kept, base, accept) if graph.x else {}
    return [(base.get(i, []), more.get(i, [])) for i in range(len(texts))]


def fit(docs: DataFrame, max_docs: int = 2000, text: str = "text") -> dict:
    """Train on at most ``max_docs`` documents with a digit or @, the first by a hash of the text.

    Only their mentions with both neighbours leave the executors, not the texts.
    """
    @F.pandas_udf("string")
    def mentions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([_extract(t) for t in b])

    rows = docs.where(F.col(text).rlike("[0-9@]")).select(F.xxhash64(text, F.lit(3)).alias("h"), mentions(text).alias("m"))
    graph = Graph()
    for i, r in enumerate(rows.orderBy("h").limit(max_docs).collect()):
        graph.add(i, r["m"], base_spans(r["m"]))
    return train(graph)


def _extract(text: str, most: int = 4000) -> str:
    """The mentions of a text in order, each run of other words as one ``~`` (bounded training row)."""
    out, gap = [], False
    for m in _WORD.finditer(text):
        if _ANY.search(m[0]):
            out.append(m[0])
            gap = False
        elif not gap:
            out.append("~")
            gap = True
    return " ".join(out)[:most]


RESULT = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, "
          "clean string")


def tagged(docs: DataFrame, weights: dict, accept: float = 0.9, text: str = "text", rewrite: bool = False) -> DataFrame:
    """``docs`` with counts, spans and, if ``rewrite``, the text with each span replaced by its kind."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for a in range(0, len(b), 1000):
                texts = [t if isinstance(t, str) else None for t in b.iloc[a: a + 1000]]
                for t, (base, more) in zip(texts, find(texts, shared.value, accept), strict=True):
                    n = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
                    rows.append((*n, hashlib.sha256(written(base).encode()).hexdigest(), written(base + more), len(more),
                                 masked(t, base + more) if rewrite and (base or more) else None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return docs.withColumn("_pii", run(F.col(text)))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every covered stretch replaced by ``[KIND]`` of its first span."""
    out, end = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= end:
            out += [text[end:a], f"[{KINDS[k].upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def op1_skip_chain(spark, sf_dir):
    docs = documents(spark, sf_dir)
    out = tagged(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", *[f"_pii.{c.split()[0]}" for c in RESULT.split(", ")[:-1]])
