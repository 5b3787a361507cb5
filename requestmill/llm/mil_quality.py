"""Quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is encoded, a gated
attention network weighs the passages, and the weighted mean of their encodings is scored. The
weights are learned from document labels alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestmill.llm.common import sliced
from requestmill.llm.labelled import Split, sample

SPLIT = Split(4, 2)
MOST_OF_EACH, MOST_PASSAGES = 2_000, 400  # documents of either label, passages of each
PASSAGE = 64  # words
# Frequent function words of four languages.
FUNCTION_WORDS = frozenset(
    w.encode()
    for w in (
        "the of and to in is that for it with on are as was by this be at from or an "
        "der die und das den von zu mit ist des nicht ein eine im auf für sich dem als "
        "le la les de et du une est pour que dans qui sur par pas au en un "
        "el los las y con no se lo su al del por como más"
    ).split()
)
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGIT = b"0123456789"
_SIGNS = b"#*$%&|<>{}[]\\^~=_+/@"
_SHOUT = b"!"
_STOPS = b".,;:?'\"()-"
_WIDE = bytes(range(128, 256))
N_FEATURES = 17


def _passage(words: list[bytes], total: int) -> list[float]:
    n = len(words)
    if n == 0:
        return [0.0] * N_FEATURES
    text = b"".join(words)
    size = len(text)

    def share(drop: bytes) -> float:
        return (size - len(text.translate(None, drop))) / size

    signs = share(_SIGNS)
    return [
        math.log1p(n) / 4,
        math.log1p(total) / 8,
        size / n / 10,
        share(_UPPER),
        share(_DIGIT),
        signs,
        share(_SHOUT),
        share(_STOPS),
        share(_WIDE),
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        sum(map(eq, words, words[2:])) / n,
        sum(map(FUNCTION_WORDS.__contains__, words)) / n,
        words.count(b"|") / n,
        len({w[-1:] for w in words}) / n,
        min(1.0, 20 * signs),
        float(n < 12),
    ]


def passages(text: bytes | None) -> list[list[float]]:
    """Features of each passage; a text without words has one passage of zeros."""
    words = text.split() if text else []
    n = len(words)
    starts = range(0, max(1, n), PASSAGE)
    return [_passage(words[s : s + PASSAGE], n) for s in starts]


@dataclass
class Network:
    """Encoder, gated attention and output layer."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(x: np.ndarray, hidden: int = 16, gate: int = 8, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        d = x.shape[1]

        def layer(a: int, b: int) -> np.ndarray:
            return rng.normal(0, 1 / math.sqrt(a), (a, b))

        weights = {
            "E": layer(d, hidden),
            "e": np.zeros(hidden),
            "V": layer(hidden, gate),
            "v": np.zeros(gate),
            "U": layer(hidden, gate),
            "u": np.zeros(gate),
            "a": layer(gate, 1),
            "o": layer(hidden, 1),
            "b": np.zeros(1),
        }
        return Network(x.mean(axis=0), x.std(axis=0) + 0.05, weights)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """``starts``: the first passage of each bag; bags lie one after the other."""
        w = self.weights
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["E"] + w["e"])
        t, s = np.tanh(h @ w["V"] + w["v"]), 1 / (1 + np.exp(-(h @ w["U"] + w["u"])))
        score = ((t * s) @ w["a"])[:, 0]
        sizes = np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        score = np.exp(score - np.maximum.reduceat(score, starts)[bag])
        alpha = score / np.add.reduceat(score, starts)[bag]
        z = np.add.reduceat(alpha[:, None] * h, starts, axis=0)
        logit = (z @ w["o"])[:, 0] + w["b"][0]
        return {"x": x, "h": h, "t": t, "s": s, "alpha": alpha, "bag": bag, "z": z, "logit": logit}

    def gradients(self, f: dict[str, np.ndarray], starts: np.ndarray, error: np.ndarray) -> dict:
        """``error``: the loss's derivative by each bag's logit."""
        w, h, t, s, alpha, bag = self.weights, f["h"], f["t"], f["s"], f["alpha"], f["bag"]
        dz = error[:, None] * w["o"][:, 0]
        by_alpha = (dz[bag] * h).sum(axis=1)
        mean = np.add.reduceat(alpha * by_alpha, starts)[bag]
        dscore = (alpha * (by_alpha - mean))[:, None]
        dt = dscore * s * w["a"][:, 0] * (1 - t * t)
        ds = dscore * t * w["a"][:, 0] * s * (1 - s)
        dh = alpha[:, None] * dz[bag] + dt @ w["V"].T + ds @ w["U"].T
        dh = dh * (1 - h * h)
        return {
            "E": f["x"].T @ dh,
            "e": dh.sum(axis=0),
            "V": h.T @ dt,
            "v": dt.sum(axis=0),
            "U": h.T @ ds,
            "u": ds.sum(axis=0),
            "a": (t * s).T @ dscore,
            "o": (f["z"] * error[:, None]).sum(axis=0)[:, None],
            "b": np.array([error.sum()]),
        }

    def train(
        self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.02
    ) -> None:
        """Adam on the mean log loss, both labels with equal weight."""
        share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            f = self.forward(x, starts)
            p = 1 / (1 + np.exp(-np.clip(f["logit"], -30, 30)))
            for k, g in self.gradients(f, starts, (p - y) * share).items():
                g = g + 1e-4 * self.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                a, b = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                self.weights[k] -= rate * a / (np.sqrt(b) + 1e-8)

    def scores(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x, starts)["logit"], -60, 60)))


def _bags(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    found = [passages(t) for t in texts]
    starts = np.cumsum([0, *(len(f) for f in found)])[:-1].astype(np.int64)
    return np.array([p for f in found for p in f]).reshape(-1, N_FEATURES), starts


def fit(
    docs: DataFrame,
    labels: DataFrame,
    split: Split = SPLIT,
    most_of_each: int = MOST_OF_EACH,
    most_passages: int = MOST_PASSAGES,
) -> Network | float:
    """A trained network; the share of good labels where one of the labels is missing.

    The sample is at most ``most_of_each`` documents of either label, and of each at most
    ``most_passages`` passages, evenly spaced; all passages count where texts are scored. Passages'
    features, some 20 numbers for 64 words, go to the driver, not texts. The output is moved
    from equal label shares to the shares of all learnable labels of documents that are there.
    """
    chosen = sample(docs, labels, "quality", split, most_of_each)
    n1, n0 = chosen.positives, chosen.negatives
    if not (n1 and n0):
        return (n1 + 0.5) / (n1 + n0 + 1)
    rows = chosen.rows.select("y", F.col("text").cast("binary").alias("text"))
    features = _feature_batches(most_passages)
    found = rows.mapInArrow(features, "y int, x array<array<float>>").toPandas()
    bags = [np.stack([np.asarray(p, float) for p in bag]) for bag in found["x"]]
    starts = np.cumsum([0, *(len(b) for b in bags)])[:-1]
    x, y = np.concatenate(bags), found["y"].to_numpy(float)
    network = Network.fresh(x)
    network.train(x, starts, y)
    network.weights["b"] = network.weights["b"] + math.log(n1 / n0)
    return network


def _spaced(bag: list, most: int) -> list:
    """At most so many entries, the first and the last among them."""
    if len(bag) <= most:
        return bag
    return [bag[k * (len(bag) - 1) // (most - 1)] for k in range(most)]


def _feature_batches(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.float32()))
        for batch in sliced(batches):
            found = [_spaced(passages(t.as_py()), most) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["y", "x"])

    return run


def _score_batches(model: Network | float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            if isinstance(model, float):
                found = np.full(batch.num_rows, model)
            else:
                found = model.scores(*_bags([t.as_py() for t in batch.column(1)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    return run


def scores(docs: DataFrame, model: Network | float) -> DataFrame:
    """(doc_id, score), one row for each row of ``docs``; all passages of a text count.

    Null, empty and blank texts are a bag of one empty passage. Equal texts have equal scores,
    an empty table none. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_score_batches(model), "doc_id long, score double")
