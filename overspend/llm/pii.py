"""Personal data: fixed shapes, and a skip-chain conditional random field that carries labels to repeated and similar tokens.

Four shapes (email, ip, card, phone) are always reported. The random field adds tokens that the shapes miss, such as a number written a second
time without its sign. Its nodes are the tokens of a document that hold a digit or an @; all others have the label "none" beforehand.
Chain edges join nodes that follow each other as words; skip edges join each node to the next one with the same or a similar key (its letters and
digits; for long numbers their last seven digits), however far away. Loopy belief propagation gives each node's label; tokens that a shape covers
are observed and pull on their repeats.

The unary weights are fitted by gradient descent, and both edge tables by counting, to the labels that the shapes give to a bounded sample: the ``SAMPLE``
documents with the least hash of their id and text. Everything else covers all rows and whole texts. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, functions as F

from overspend.llm.common import map_batches

Span = tuple[str, int, int]
KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
DIGIT = re.compile(r"[0-9]")
CUES = ("phone", "tel", "call", "mobile", "fax", "email", "mail", "contact", "card", "visa", "account", "ip", "host", "server")

SAMPLE = 2000
#: A label is given from this probability on.
SURE = 0.9
ROUNDS = 8


# ---- fixed shapes ------------------------------------------------------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local@domain, found from each @ so that a long word is read once."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            done = domain.end()
            out.append((start, done))
        else:
            done = at + 1
        at = text.find("@", done)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """The four shapes by kind, then start; matches that fail their check are dropped."""
    spans: list[Span] = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            spans += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return spans


# ---- the random field ----------------------------------------------------------------------------------------------------------

class Graph:
    """Nodes and edges of one document."""

    def __init__(self, text: str, base: list[Span]) -> None:
        self.spans: list[tuple[int, int]] = []
        self.features: list[np.ndarray] = []
        self.observed: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        covered = sorted((a, b, LABELS.index(k)) for k, a, b in base)
        starts = [a for a, _, _ in covered]
        last_word, before, latest = -2, "", {}
        for number, m in enumerate(TOKEN.finditer(text)):
            word = m[0]
            if "@" in word or DIGIT.search(word):
                at, node = bisect_right(starts, m.end() - 1) - 1, len(self.spans)
                label = covered[at][2] if at >= 0 and covered[at][1] > m.start() else 0
                self.spans.append(m.span())
                self.features.append(features(word, before))
                self.observed.append(label)
                if last_word == number - 1:
                    self.chain.append((node - 1, node))
                if key := likeness(word):
                    if key in latest:
                        self.skip.append((latest[key], node))
                    latest[key] = node
                last_word = number
            before = word


def likeness(word: str) -> str:
    """What repeats of a token share."""
    digits = "".join(DIGIT.findall(word))
    if len(digits) >= 7 and "@" not in word:
        return digits[-7:]
    key = re.sub(r"[^0-9a-z@.]", "", word.lower()).strip(".")
    return key if len(key) >= 5 else ""


def features(word: str, before: str) -> np.ndarray:
    digits = len(DIGIT.findall(word))
    core = word.strip(".,;:!?\"'()[]<>")
    left = before.lower().strip(".,;:!?\"'()[]<>=")
    return np.array([1, "@" in core, "@" in core and "." in core.rpartition("@")[2], word.startswith("+"), 1 <= digits <= 3, 4 <= digits <= 6,
                     7 <= digits <= 8, 9 <= digits <= 12, 13 <= digits <= 19, digits > 19, core.isdigit(), core.count(".") == 3, "(" in word,
                     "-" in core, any(c.isalpha() for c in core), left in CUES, before.startswith("+")], float)


WIDTH = 17


class Field:
    """Weights of the random field, as logarithms."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> None:
        self.unary, self.chain, self.skip = unary, chain, skip

    @classmethod
    def fit(cls, texts: Iterable[str], steps: int = 300, rate: float = 0.5, penalty: float = 1e-3) -> Field:
        rows, labels = [], []
        size = len(LABELS)
        counts = {"chain": np.ones((size, size)), "skip": np.ones((size, size)) + 4 * np.eye(size)}
        for text in texts:
            graph = Graph(text, base_spans(text))
            rows += graph.features
            labels += graph.observed
            for name in counts:
                for a, b in getattr(graph, name):
                    counts[name][graph.observed[a], graph.observed[b]] += 1
        weights = np.zeros((WIDTH, size))
        if rows:
            x, y = np.array(rows), np.eye(size)[labels]
            for _ in range(steps):
                score = x @ weights
                chance = np.exp(score - score.max(1, keepdims=True))
                chance /= chance.sum(1, keepdims=True)
                weights -= rate * (x.T @ (chance - y) / len(x) + penalty * weights)

        def relative(table: np.ndarray) -> np.ndarray:
            joint = table / table.sum()
            return np.log(joint / np.outer(joint.sum(1), joint.sum(0)))

        return cls(weights, relative(counts["chain"]), relative(counts["skip"]))

    def marginals(self, graph: Graph) -> np.ndarray:
        """Label probabilities of each node by loopy sum-product, with damping; messages of all edges are updated together."""
        node = np.array(graph.features) @ self.unary
        seen = np.array(graph.observed)
        node[seen > 0] = -30.0
        node[seen > 0, seen[seen > 0]] = 0.0
        node -= node.max(1, keepdims=True)
        edges = graph.chain + graph.skip
        if edges:
            ends = np.array(edges)
            tables = np.array([self.chain] * len(graph.chain) + [self.skip] * len(graph.skip))
            tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
            source, target = np.concatenate([ends[:, 0], ends[:, 1]]), np.concatenate([ends[:, 1], ends[:, 0]])
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            sent = np.zeros((2 * len(edges), len(LABELS)))
            for _ in range(ROUNDS):
                belief = node.copy()
                np.add.at(belief, target, sent)
                into = (belief[source] - sent[back])[:, :, None] + tables
                top = into.max(1)
                new = np.log(np.exp(into - top[:, None, :]).sum(1)) + top
                new -= new.max(1, keepdims=True)
                sent = 0.5 * sent + 0.5 * new
            np.add.at(node, target, sent)
        chance = np.exp(node - node.max(1, keepdims=True))
        return chance / chance.sum(1, keepdims=True)


def extra_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Spans of tokens that the field labels and no shape covers; punctuation around a token stays out, and neighbours of one label are one span."""
    if "@" not in text and not DIGIT.search(text):
        return []
    graph = Graph(text, base)
    if not graph.spans or all(graph.observed):
        return []
    chances = field.marginals(graph)
    out: list[Span] = []
    last = None
    for node, (start, end) in enumerate(graph.spans):
        label = int(chances[node].argmax())
        if graph.observed[node] or not label or chances[node, label] < SURE:
            last = None
            continue
        word = text[start:end]
        start, end = start + len(word) - len(word.lstrip(".,;:!?\"'([<")), end - (len(word) - len(word.rstrip(".,;:!?\"')]>")))
        if last is not None and out and out[-1][0] == LABELS[label] and (last, node) in graph.chain:
            out[-1] = out[-1][0], out[-1][1], end
        elif end > start:
            out.append((LABELS[label], start, end))
        last = node
    return out


# ---- on tables ---------------------------------------------------------------------------------------------------------------

def sample_texts(df: DataFrame, key: str = "doc_id", column: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The texts of the ``sample`` rows with the least hash of key and text; the same rows whatever the order or partitioning.

    Hashes are even, so few rows lie below a bound taken from the row count; only these are sorted. The bound rises where repeated rows leave too few below it.
    """
    rows = df.where(F.col(column).isNotNull()).select(F.xxhash64(key, column).alias("h"), F.col(column).alias("text"))
    share, total = 4 * sample, max(1, df.count())
    while share < total:
        below = rows.where(F.col("h") < F.lit((share << 64) // total - (1 << 63)))
        if below.count() >= sample:
            rows = below
            break
        share *= 8
    return rows.orderBy("h", "text").limit(sample).select("text")


def fit_field(df: DataFrame, key: str = "doc_id", column: str = "text", sample: int = SAMPLE) -> Field:
    """Fit on ``sample_texts``."""
    return Field.fit(row.text for row in sample_texts(df, key, column, sample).toLocalIterator())


def scan(df: DataFrame, field: Field, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, spans) of each row; spans as array of (kind, start, end, base), by kind, then start. A null or empty text has none."""
    def run(batches):
        for batch in batches:
            out = {"key": batch["key"], "spans": []}
            for text in batch["text"]:
                base = base_spans(text or "")
                spans = [(*s, True) for s in base] + [(*s, False) for s in extra_spans(text or "", base, field)]
                spans.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                out["spans"].append([{"kind": k, "start": a, "end": b, "base": own} for k, a, b, own in spans])
            yield out

    rows = df.select(F.col(key).alias("key"), F.col(column).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, run, f"key {kind}, spans array<struct<kind:string,start:int,end:int,base:boolean>>").withColumnRenamed("key", key)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the fixed shapes and digest columns."""
    def text_of(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    rest = [c for c in found.columns if c != "spans"]
    return found.select(*rest, *[count(kind) for kind in KINDS], F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))
