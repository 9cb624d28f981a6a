"""A byte-level convolutional network for document quality, in numpy.

A filter sees ``WIDTH`` bytes at a time, everywhere in the text: its output is a sum of
learned values, one table of 256 for each of the places. Outputs are cut off at 0 and
max-pooled over overlapping chunks of two blocks; the chunks' mean and the maximum over
all of them go through one hidden layer into one probability. Chunks cover the whole
document, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import ragged

WIDTH, FILTERS, HIDDEN, BLOCK = 6, 16, 16, 256
FOLDS, HELD_OUT = 4, 2


def framed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts padded with zeros to whole blocks, and the first block of each (one more at the
    end). Every text stands behind as many zeros as a filter that begins before it can
    reach, so that none sees two texts."""
    sizes = np.diff(offsets)
    blocks = (sizes + WIDTH - 1 + BLOCK - 1) // BLOCK
    edges = np.concatenate(([0], np.cumsum(blocks)))
    out = np.zeros(edges[-1] * BLOCK + WIDTH, np.uint8)
    for at, a, b in zip((edges[:-1] * BLOCK + WIDTH - 1).tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        out[at : at + b - a] = data[a:b]
    return out, edges


class Network:
    """Tables of the filters and the layers behind them."""

    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
        self.weights = {
            "taps": normal(WIDTH, 256, FILTERS, by=0.3),
            "bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(2 * FILTERS, HIDDEN, by=(2 * FILTERS) ** -0.5),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, by=HIDDEN**-0.5),
            "out_bias": np.zeros(1, np.float32),
        }

    def pair_tables(self) -> list[np.ndarray]:
        """Sums of two neighbouring places for all pairs of bytes: half as many look-ups."""
        taps = self.weights["taps"]
        return [(taps[i][:, None, :] + taps[i + 1][None, :, :]).reshape(-1, FILTERS) for i in range(0, WIDTH, 2)]

    def convolved(self, frame: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Filter outputs at every place, in blocks."""
        n = len(frame) - WIDTH
        pairs = (frame[:-1].astype(np.uint16) << np.uint16(8)) | frame[1:]
        out = tables[0][pairs[:n]]
        for i, table in enumerate(tables[1:], 1):
            out += table[pairs[2 * i : 2 * i + n]]
        out += self.weights["bias"]
        return out.reshape(-1, BLOCK, FILTERS)

    def features(self, pooled: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean over chunks and maximum of every text; the chunks and each one's text."""
        doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        follows = np.append(doc[1:] == doc[:-1], False)
        alone = np.repeat(np.diff(edges) == 1, np.diff(edges))
        chunk = np.flatnonzero(follows | alone)
        right = np.where(follows[chunk], chunk + 1, chunk)
        values = np.maximum(pooled[chunk], pooled[right])
        starts = np.searchsorted(doc[chunk], np.arange(len(edges) - 1))
        count = np.diff(np.append(starts, len(chunk)))[:, None]
        mean = np.add.reduceat(values, starts, axis=0) / count
        return np.concatenate((mean, np.maximum.reduceat(values, starts, axis=0)), axis=1), chunk, right

    def logits(self, features: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum(features @ w["hidden"] + w["hidden_bias"], 0) @ w["out"] + w["out_bias"]

    def score(self, data: np.ndarray, offsets: np.ndarray, tables: list[np.ndarray], step: int = 1 << 10) -> np.ndarray:
        """Probability of label 1 of every text; long ones pass through a part at a time."""
        frame, edges = framed(data, offsets)
        pooled = np.empty((edges[-1], FILTERS), np.float32)
        for a in range(0, len(pooled), step):
            b = min(a + step, len(pooled))
            pooled[a:b] = self.convolved(frame[a * BLOCK : b * BLOCK + WIDTH], tables).max(axis=1)
        np.maximum(pooled, 0, out=pooled)
        return 1 / (1 + np.exp(-self.logits(self.features(pooled, edges)[0]).astype(np.float64)))

    def gradients(self, data: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the cross entropy. A pooled value passes its gradient to the place it came from."""
        w, n = self.weights, len(labels)
        frame, edges = framed(data, offsets)
        conv = self.convolved(frame, self.pair_tables())
        place = conv.argmax(axis=1)
        top = np.take_along_axis(conv, place[:, None], axis=1)[:, 0]
        pooled = np.maximum(top, 0)
        x, chunk, right = self.features(pooled, edges)
        z = x @ w["hidden"] + w["hidden_bias"]
        h = np.maximum(z, 0)
        p = 1 / (1 + np.exp(-(h @ w["out"] + w["out_bias"])))
        d = ((p - labels) / n).astype(np.float32)
        dz = np.outer(d, w["out"]) * (z > 0)
        dx = dz @ w["hidden"].T
        doc = np.repeat(np.arange(n), np.diff(edges))
        of = doc[chunk]
        values = np.maximum(pooled[chunk], pooled[right])
        dv = dx[of, :FILTERS] / np.bincount(of, minlength=n)[of][:, None]
        best = x[:, FILTERS:][of]
        ties = np.add.reduceat((values == best).astype(np.float32), np.searchsorted(of, np.arange(n)), axis=0)
        dv += dx[of, FILTERS:] * (values == best) / ties[of]
        dp = np.zeros_like(pooled)
        left = pooled[chunk] >= pooled[right]
        np.add.at(dp, chunk, dv * left)
        np.add.at(dp, right, dv * ~left)
        dp *= top > 0
        block, filt = np.nonzero(dp)
        g, at = dp[block, filt], block * BLOCK + place[block, filt]
        taps = np.stack(
            [np.bincount(frame[at + k].astype(np.int64) * FILTERS + filt, g, 256 * FILTERS).reshape(256, FILTERS) for k in range(WIDTH)]
        )
        return {
            "taps": taps, "bias": dp.sum(axis=0), "hidden": x.T @ dz, "hidden_bias": dz.sum(axis=0),
            "out": h.T @ d, "out_bias": d.sum(keepdims=True),
        }


def trained(
    texts: list[bytes],
    labels: np.ndarray,
    *,
    share: float = 0.5,
    epochs: int = 10,
    batch: int = 64,
    rate: float = 0.02,
    seed: int = 0,
) -> Network:
    """A network fitted with Adam; the same texts in the same order give the same network.

    Every text is shown whole and, so that short ones are known too, as a piece of up to
    200 bytes from anywhere in it. ``share`` is how much of the rows at large has label 1:
    probabilities are moved from the sample's share to that one.
    """
    net, rng = Network(seed), np.random.default_rng(seed + 1)
    pieces = []
    for t in texts:
        size = int(rng.integers(1, 200))
        at = int(rng.integers(0, max(1, len(t) - size)))
        pieces.append(t[at : at + size])
    texts, labels = [*texts, *pieces], np.concatenate((labels, labels)).astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    step, steps = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            some = order[a : a + batch]
            parts = [texts[i] for i in some]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
            step += 1
            now = rate * (1 - step / (steps + 1))
            grads = net.gradients(np.frombuffer(b"".join(parts), np.uint8), offsets, labels[some])
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                net.weights[k] = (net.weights[k] - now * move - (now * 1e-3 * net.weights[k] if k == "taps" else 0)).astype(np.float32)
    sample = float(labels.mean())
    odds = (share / (1 - share)) / (sample / (1 - sample)) if 0 < share < 1 and 0 < sample < 1 else 1.0
    net.weights["out_bias"] += np.float32(np.log(odds))
    return net


def held_out(id_col: str = "doc_id"):
    """The quarter of ids that no model learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_docs: int = 600,
    sample_bytes: int = 16 << 10,
) -> Network | float:
    """A network fitted to at most ``sample_docs`` documents of either label.

    They are those with the least hash of their id among the documents that have a label
    and are not held out. Of a text of over ``sample_bytes`` bytes a piece from anywhere in it
    is learned from, by its id, of a quarter as many characters, so at most the product of
    both is collected a label. Without rows of both labels there is nothing to tell apart: the
    result is the share of label 1, or 1 if there are no rows.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    turn = F.xxhash64(F.col(id_col).cast("string"))
    chars = sample_bytes // 4  # of at most four bytes each
    start = F.pmod(F.xxhash64(F.lit("piece"), F.col(id_col).cast("string")), F.greatest(F.length(text) - chars + 1, F.lit(1)))
    piece = F.when(F.octet_length(text) <= sample_bytes, F.col(text)).otherwise(F.substring(F.col(text), (start + 1).cast("int"), F.lit(chars)))
    texts, marks = [], []
    for value in (0, 1):
        ids = known.filter(F.col(label) == value).select(id_col).distinct()
        there = docs.select(id_col).join(ids, id_col, "left_semi").distinct().orderBy(turn, id_col).limit(sample_docs)
        rows = docs.join(F.broadcast(there), id_col, "left_semi").select(id_col, F.encode(piece, "utf-8").alias("t"))
        found = rows.filter("t is not null").orderBy(turn, id_col, "t").limit(sample_docs).collect()
        texts += [bytes(r["t"]) for r in found]
        marks += [value] * len(found)
    share = known.agg(F.avg(label)).first()[0]
    if len(set(marks)) < 2:
        return 1.0 if share is None else float(share)
    return trained(texts, np.array(marks, np.float32), share=float(share))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    threshold: float = 0.7,
    work_bytes: int = 1 << 20,
    **options,
) -> DataFrame:
    """id_col, held_out, score and predicted of every document.

    The score depends on the whole text alone. Null and empty texts are scored as empty
    ones. Rows without an id are scored too and are not held out; repeated rows give
    repeated rows. Rows of ``labels`` that name no document or have no label of 0 or 1 are
    not used; of an id labelled both ways each label counts. An empty table gives no rows;
    other columns are not read.
    """
    model = fit(docs, labels, id_col=id_col, text=text, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None if isinstance(model, float) else model.pair_tables()
        for batch in batches:
            for part in ragged.portions(batch, "text", work_bytes):
                n = part.num_rows
                score = np.full(n, model) if tables is None else model.score(*ragged.joined(part["text"]), tables)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(score)], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double").select(
        F.col("doc_id").alias(id_col),
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", threshold: float = 0.7, work_bytes: int = 1 << 20, **options) -> DataFrame:
    """The documents that the classifier doesn't reject, all columns kept.

    Scores are made beside the texts: nothing is joined, so no id has to be there or be
    the only one of its kind.
    """
    model = fit(docs, labels, id_col=id_col, text=text, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None if isinstance(model, float) else model.pair_tables()
        for batch in batches:
            for part in ragged.portions(batch, text, work_bytes):
                score = np.full(part.num_rows, model) if tables is None else model.score(*ragged.joined(part[text]), tables)
                yield part.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
