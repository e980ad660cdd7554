"""Language identification by a byte convolutional network in numpy.

Network: filters of several widths over byte embeddings, maximum over each window, and softmax. It is trained with Adam
on labelled documents chosen by hash, evenly over all labels: of each label at most ``train_docs`` divided by the number of
labels, and at least one (a documented bound). Of a text with more than ``TRAIN_WINDOWS`` windows it takes so many, spread
evenly from its first to its last. Prediction covers the whole text: it is cut into windows of ``WINDOW`` bytes (the last one padded), all windows of
a slice run as batches, and a document's score is the mean of its windows' log-probabilities weighted by their bytes.
For speed each filter is folded into tables over byte pairs, which gives the same sums.

Cases: a null text, or one with no letter, is ``und`` with score 0; ties go to the label that sorts first; rows without
label or text do not train; with no training rows at all every text is ``und``; equal texts get equal answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import begin, docs_of, pick, slices, workers_find_package

WINDOW, WIDTHS, FILTERS, DIM = 128, (2, 4, 6), 16, 8
TRAIN_DOCS, TRAIN_WINDOWS = 3000, 32
BATCH = 1024  # windows at once
LETTER = regex.compile(r"\p{L}")


class ByteCNN:
    def __init__(self, labels: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.labels = labels
        self.p = {"emb": r.normal(0, 0.3, (256, DIM))}
        for w in WIDTHS:
            self.p[f"f{w}"] = r.normal(0, (2 / (w * DIM)) ** 0.5, (w, DIM, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p["out"] = r.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(labels)))
        self.p["bias"] = np.zeros(len(labels))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 3, batch: int = 64, rate: float = 4e-3, seed: int = 7) -> None:
        """x: windows of bytes [n, WINDOW]; y: label numbers. Plain back-propagation with Adam."""
        r, m, v, step = np.random.default_rng(seed), {k: np.zeros_like(a) for k, a in self.p.items()}, {k: np.zeros_like(a) for k, a in self.p.items()}, 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(order), batch):
                k = order[i : i + batch]
                g = self._gradients(x[k], y[k])
                step += 1
                for name, a in g.items():
                    m[name] += 0.1 * (a - m[name])
                    v[name] += 0.01 * (a * a - v[name])
                    self.p[name] -= rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-6)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        e = p["emb"][x]
        pooled, kept = [], []
        for w in WIDTHS:
            t = x.shape[1] - w + 1
            cols = np.concatenate([e[:, j : j + t] for j in range(w)], axis=2)
            z = cols @ p[f"f{w}"].reshape(w * DIM, FILTERS) + p[f"b{w}"]
            at = z.argmax(1)
            pooled.append(np.take_along_axis(z, at[:, None], 1)[:, 0])
            kept.append((cols, at))
        h = np.concatenate(pooled, 1)
        a = np.maximum(h, 0)
        z = a @ p["out"] + p["bias"]
        q = np.exp(z - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        q[np.arange(n), y] -= 1
        q /= n
        g = {"out": a.T @ q, "bias": q.sum(0), "emb": np.zeros_like(p["emb"])}
        dh = (q @ p["out"].T) * (h > 0)
        for i, w in enumerate(WIDTHS):
            cols, at = kept[i]
            d = dh[:, i * FILTERS : (i + 1) * FILTERS]
            own = cols[np.arange(n)[:, None], at]  # [n, FILTERS, w * DIM]
            g[f"f{w}"] = np.einsum("nf,nfc->cf", d, own).reshape(w, DIM, FILTERS)
            g[f"b{w}"] = d.sum(0)
            back = np.einsum("nf,cf->nfc", d, p[f"f{w}"].reshape(w * DIM, FILTERS)).reshape(n, FILTERS, w, DIM)
            where = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(w)]
            np.add.at(g["emb"], where, back)
        return g

    def tables(self) -> dict[int, np.ndarray]:
        """By width, [w / 2, 65536, FILTERS]: what each byte pair adds at each even offset."""
        out = {}
        for w in WIDTHS:
            one = np.einsum("bd,wdf->wbf", self.p["emb"], self.p[f"f{w}"])
            out[w] = np.stack([(one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS) for j in range(0, w, 2)])
        return out

    def log_probabilities(self, x: np.ndarray, tables: dict[int, np.ndarray]) -> np.ndarray:
        pair = (x[:, :-1].astype(np.int32) << 8) + x[:, 1:]
        pooled = []
        for w in WIDTHS:
            t = x.shape[1] - w + 1
            z = np.take(tables[w][0], pair[:, :t], axis=0)
            for j in range(1, w // 2):
                z += np.take(tables[w][j], pair[:, 2 * j : 2 * j + t], axis=0)
            pooled.append(z.max(1) + self.p[f"b{w}"])
        z = np.maximum(np.concatenate(pooled, 1), 0) @ self.p["out"] + self.p["bias"]
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def predict(self, texts: list[bytes], tables: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Label numbers and probabilities of whole texts."""
        size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        n = np.maximum(1, -(-size // WINDOW))
        flat = np.frombuffer(b"".join(t.ljust(int(k) * WINDOW, b" ") for t, k in zip(texts, n, strict=True)), np.uint8).reshape(-1, WINDOW)
        log = np.concatenate([self.log_probabilities(flat[i : i + BATCH], tables) for i in range(0, len(flat), BATCH)])
        first = np.cumsum(n) - n
        weight = np.full(len(flat), WINDOW, np.float64)
        weight[first + n - 1] = size - (n - 1) * WINDOW
        mean = np.add.reduceat(log * weight[:, None], first) / np.maximum(1, size)[:, None]
        mean -= mean.max(1, keepdims=True)
        q = np.exp(mean)
        return q.argmax(1), q.max(1) / q.sum(1)


def train_on(labelled: list[tuple[list[bytes], str]]) -> ByteCNN | None:
    """From (windows, label) pairs."""
    labels = sorted({k for _, k in labelled})
    number = {k: i for i, k in enumerate(labels)}
    if not labelled:
        return None
    x = np.frombuffer(b"".join(bytes(w).ljust(WINDOW, b" ") for ws, _ in labelled for w in ws), np.uint8).reshape(-1, WINDOW)
    net = ByteCNN(labels)
    net.train(x, np.array([number[k] for ws, k in labelled for _ in ws]), epochs=max(3, min(20, 60_000 // len(x))))
    return net


def training_rows(rows: DataFrame, train_docs: int) -> list[tuple[list[bytes], str]]:
    """(windows, label) of the documents that train, from ``rows`` (doc_id, text, label) without nulls in text and label."""
    b = rows.select(F.col("label").cast("string").alias("label"), F.col("text").cast("binary").alias("b"), F.xxhash64("doc_id", "text").alias("_h"))
    counts = b.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("_h").alias("least")).collect()
    if not counts:
        return []
    each, top = max(1, train_docs // len(counts)), 2**63
    # twice the rows wanted lie below the bound, as their number varies; the least hash is below it in any case
    bounds = [(r.label, top - 1 if r.n <= 2 * each else max(r.least, int(-top + 4 * top * each / r.n))) for r in counts]
    near = b.join(F.broadcast(rows.sparkSession.createDataFrame(bounds, "label string, bound long")), "label").filter("_h <= bound")
    n, k = f"greatest(1, (octet_length(b) + {WINDOW - 1}) div {WINDOW})", f"least({TRAIN_WINDOWS}, n)"
    cut = near.selectExpr("label", "_h", "b", f"{n} as n").selectExpr("label", "_h", f"transform(sequence(0L, {k} - 1), i -> substring(b, cast((i * (n - 1) div greatest(1, {k} - 1)) * {WINDOW} + 1 as int), {WINDOW})) as windows")
    by = Window.partitionBy("label").orderBy("_h", "windows")
    chosen = cut.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= each).collect()
    return [(r.windows, r.label) for r in sorted(chosen, key=lambda r: (r._h, r.windows, r.label))]


def identify(docs: DataFrame, train: DataFrame, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS, keep: list[str] | None = None) -> DataFrame:
    """Per document of ``docs``: doc_id, lang_pred, score; with ``keep`` also text, the columns it names, and has_letters, which
    doesn't depend on the model. ``train`` has labelled rows."""
    workers_find_package(docs.sparkSession)
    rows = pick(train, doc_id=id_col, text=text_col, label=label_col).filter("label is not null and text is not null")
    net = train_on(training_rows(rows, train_docs))
    model = docs.sparkSession.sparkContext.broadcast(net)
    extra = keep or []
    base = pick(docs, doc_id=id_col, text=text_col, **{f"x{i}": c for i, c in enumerate(extra)}).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *[f"x{i}" for i in range(len(extra))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("langid")
        cnn = model.value
        tables = cnn.tables() if cnn else {}
        for b in slices(batches, 512, 2_000_000):
            texts = b.column(1).to_pylist()
            letters = [LETTER.search(t) is not None for t in texts]
            some = [i for i, has in enumerate(letters) if cnn and has]
            label, score = ["und"] * len(texts), [0.0] * len(texts)
            if some:
                best, p = cnn.predict([texts[i].encode() for i in some], tables)
                for i, k, q in zip(some, best.tolist(), p.tolist(), strict=True):
                    label[i], score[i] = cnn.labels[k], q
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(letters, pa.bool_())], [*b.schema.names, "lang_pred", "score", "has_letters"])

    types = "".join(f", x{i} {dict(docs.dtypes)[c]}" for i, c in enumerate(extra))
    out = base.mapInArrow(run, f"doc_id long, text string{types}, lang_pred string, score double, has_letters boolean") if extra else base.mapInArrow(_without_text(run), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", *(["text"] if extra else []), *[F.col(f"x{i}").alias(c) for i, c in enumerate(extra)], "lang_pred", "score", *(["has_letters"] if extra else []))


def _without_text(run):
    return lambda batches: (b.select(["doc_id", "lang_pred", "score"]) for b in run(batches))


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Documents that never train: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary") if isinstance(id_col, str) else id_col) % 4 == 2, F.lit(False))
