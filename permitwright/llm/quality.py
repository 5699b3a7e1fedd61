"""Quality by multiple-instance learning: a document is a bag of passages, gated attention weighs them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permitwright.llm.common import byte_groups, hashed_words, passing

PASSAGE_BYTES = 1024
BIGRAMS = 48

# Byte classes by ASCII category; bytes from 0x80 on belong to letters outside ASCII.
_CLASSES = ("lower", "upper", "digit", "blank", "line end", "stop", "quote", "mark", "bar", "sign", "control", "other")


def _byte_classes() -> np.ndarray:
    table = np.full(256, 10, np.uint8)
    table[128:] = 11
    for name, chars in (
        (0, "abcdefghijklmnopqrstuvwxyz"), (1, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, "0123456789"), (3, " \t"), (4, "\r\n"),
        (5, ".,;:"), (6, "'\"()-"), (7, "!?"), (8, "|/\\_"), (9, "#$%&*+<=>@[]^`{}~"),
    ):
        table[[ord(c) for c in chars]] = name
    return table


_CLASS = _byte_classes()
_WORD_FEATURES = 6
N_FEATURES = len(_CLASSES) + BIGRAMS + _WORD_FEATURES


def passage_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A feature row per passage, and per text the number of its passages.

    A text is cut every PASSAGE_BYTES bytes; an empty one is one passage of a line end. The features are shares of byte
    classes, shares of pairs of neighbouring byte classes and letters (hashed), and word statistics: mean length,
    share of distinct words, of words equal to the one before, of words in capitals, of long ones, words per byte.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE_BYTES))
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    total = int(counts.sum())
    rows = np.zeros((total, N_FEATURES), np.float32)
    if not len(texts):
        return rows, counts
    # Every text gets a line end, which keeps its last word from the next text and belongs to its last passage.
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    inner = (np.arange(len(data)) - starts[text_of]) // PASSAGE_BYTES
    passage = first[text_of] + np.minimum(inner, counts[text_of] - 1)
    length = np.maximum(1, np.bincount(passage, minlength=total)).astype(np.float32)
    kind = _CLASS[data]
    n = len(_CLASSES)
    rows[:, :n] = np.bincount(passage * n + kind, minlength=total * n).reshape(total, n) / length[:, None]
    pair = (kind[:-1].astype(np.int64) * 37 + kind[1:] * 11 + (data[1:] & 31) * (kind[1:] < 2)) % BIGRAMS
    within = text_of[1:] == text_of[:-1]
    rows[:, n : n + BIGRAMS] = (
        np.bincount((passage[:-1] * BIGRAMS + pair)[within], minlength=total * BIGRAMS).reshape(total, BIGRAMS) / length[:, None]
    )
    begin, end, word = hashed_words(data, (kind != 3) & (kind != 4))
    if len(begin):
        at = passage[begin]
        words = np.maximum(1, np.bincount(at, minlength=total)).astype(np.float32)
        size = end - begin
        same = np.zeros(len(begin), bool)
        same[1:] = (word[1:] == word[:-1]) & (at[1:] == at[:-1])
        order = np.lexsort((word, at))
        fresh = np.ones(len(begin), bool)
        fresh[1:] = (word[order][1:] != word[order][:-1]) | (at[order][1:] != at[order][:-1])
        capital = np.add.reduceat((kind == 1).astype(np.int32), begin) * 2 > size
        count = lambda mask: np.bincount(at, weights=mask, minlength=total).astype(np.float32)
        rows[:, n + BIGRAMS :] = np.column_stack([
            count(size) / words / 10, np.bincount(at[order], weights=fresh, minlength=total) / words,
            count(same) / words, count(capital) / words, count(size > 12) / words,
            np.bincount(at, minlength=total) / length,
        ])
    return rows, counts


@dataclass(frozen=True)
class AttentionModel:
    """Encoder, gated attention and head, as plain arrays; `mean` and `scale` standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, rows: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = np.clip((rows - self.mean) / self.scale, -6, 6)
        begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * g) @ w["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), counts))
        alpha = e / np.repeat(np.add.reduceat(e, begin), counts)
        z = np.add.reduceat(alpha[:, None] * h, begin, axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "alpha": alpha, "z": z, "p": p, "begin": begin}

    def score(self, texts: list[bytes]) -> np.ndarray:
        rows, counts = passage_features(texts)
        return self.forward(rows, counts)["p"]


def _gradients(model: AttentionModel, rows: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    w, f = model.weights, model.forward(rows, counts)
    dp = (f["p"] - y) / len(y)
    dz = np.repeat(dp[:, None] * w["c"][None, :], counts, axis=0)
    dh = f["alpha"][:, None] * dz
    dalpha = (f["h"] * dz).sum(1)
    inner = np.add.reduceat(f["alpha"] * dalpha, f["begin"])
    de = f["alpha"] * (dalpha - np.repeat(inner, counts))
    dtg = de[:, None] * w["a"][None, :]
    dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
    dh = (dh + dt @ w["V"].T + dg @ w["U"].T) * (1 - f["h"] ** 2)
    return {
        "W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
        "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dp, "d": np.array(dp.sum()),
    }


def fit(rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, hidden: int = 24, attention: int = 12,
        epochs: int = 30, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> AttentionModel:
    """Train on bags of passages with document labels only: Adam on the logistic loss, fixed seed."""
    rng = np.random.default_rng(seed)
    d = rows.shape[1]
    weights = {
        "W": rng.normal(0, d**-0.5, (d, hidden)), "b": np.zeros(hidden),
        "V": rng.normal(0, hidden**-0.5, (hidden, attention)), "U": rng.normal(0, hidden**-0.5, (hidden, attention)),
        "a": rng.normal(0, 0.1, attention), "c": rng.normal(0, hidden**-0.5, hidden), "d": np.array(0.0),
    }
    mean, scale = (rows.mean(0), np.maximum(rows.std(0), 1e-3)) if len(rows) else (np.zeros(d), np.ones(d))
    model = AttentionModel(mean.astype(float), scale.astype(float), weights)
    if not len(labels):
        return model
    begin = np.concatenate(([0], np.cumsum(counts)))
    m = {k: np.zeros_like(v) for k, v in weights.items()}
    s = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            take = order[at : at + batch]
            index = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in take])
            step += 1
            for k, grad in _gradients(model, rows[index], counts[take], labels[take]).items():
                grad = grad + decay * weights[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.999 * s[k] + 0.001 * grad**2
                weights[k] = weights[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return model


def learn_quality(docs: DataFrame, labels: DataFrame, sample: int = 6_000, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality") -> AttentionModel:
    """Fit on at most `sample` labelled documents, chosen by a hash of the id; only numbers of theirs reach the driver.

    Every passage of a sample document counts. Null labels, ids and texts are left out of the sample; without any
    example the model scores by its random start, with examples of one label only it learns that label's share.
    """
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id is not null and label is not null")
        .groupBy("id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    rows = rows.join(F.broadcast(chosen), "id")  # at most `sample` rows of two numbers

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start, texts in byte_groups(list(frame["text"])):
                values, counts = passage_features(texts)
                ends = np.cumsum(counts)
                part = frame.iloc[start : start + len(texts)]
                yield pd.DataFrame({
                    "id": part["id"], "label": part["label"], "passages": counts,
                    "rows": [values[e - n : e].tobytes() for e, n in zip(ends, counts, strict=True)],
                })

    kept = rows.mapInPandas(encoded, "id long, label int, passages long, rows binary").toPandas()
    kept = kept.sort_values(["id", "passages"], kind="stable")
    values = np.frombuffer(b"".join(kept["rows"]), np.float32).reshape(-1, N_FEATURES)
    return fit(values, kept["passages"].to_numpy(np.int64), kept["label"].to_numpy(float))


def score_quality(df: DataFrame, model: AttentionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: doc_id, score (0 to 1, higher is better) and passages.

    A null text counts as empty, and an empty one is a single passage of a line end. Null ids and repeated rows are kept;
    other columns are not read, so their names cannot clash. An empty table gives no rows. A text is cut into as many
    passages as it has kilobytes, all of which are read; arrays hold a few megabytes of text at a time.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start, texts in byte_groups(list(frame["text"])):
                rows, counts = passage_features(texts)
                part = frame.iloc[start : start + len(texts)]
                yield pd.DataFrame({"doc_id": part["doc_id"], "score": model.forward(rows, counts)["p"], "passages": counts})

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, score double, passages long")


def with_quality(df: DataFrame, model: AttentionModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `df`, all columns untouched, whose text scores `threshold` or more. Null texts count as empty."""

    def good(texts: list[str | None]) -> list[bool]:
        return [bool(p >= threshold) for _, group in byte_groups(texts) for p in model.score(group)]

    return passing(df, text_col, good)
