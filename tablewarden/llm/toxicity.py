"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import tempfile
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import BYTE_VALUES, U64, Rolling, flat, mixed, query, read, settled, word_hashes, word_spans
from tablewarden.llm.decontaminate import LETTERS

BITS = 16  # log2 of the rows of the embedding table
STEMS = (4, 6)  # numbers of leading bytes of a word that have embeddings of their own
BATCH_BYTES = 1 << 20
PIECE = 1 << 16  # words that training answers at once
BINS, FURTHEST = 64, 60  # raw answers are counted in bins of 1/64 between -60 and 60

# Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "de": "der die das und den von zu ist im mit nicht auf für sich des dem",
    "en": "the of and to in is that for with was this are by from be it",
    "es": "el los las de que y en un por con para una se del su no",
    "fr": "le la les des et une du dans est pour que qui sur au pas par",
}
LANGUAGES = sorted(FUNCTION_WORDS)
OTHER = len(LANGUAGES)


@dataclass
class Settings:
    """``rows`` bounds the labelled sample, half of it of each label where there are enough. Texts are whole, whatever
    their length, in the sample and in the scores."""

    rows: int = 5000
    dim: int = 16
    filters: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    steps: int = 320  # at least so many batches, in whole passes over the sample
    batch: int = 64
    rate: float = 0.01
    calibration: float = 0.2  # share of the sample that is not fitted but kept, with all rows outside of it, for the thresholds
    trust: int = 20  # toxic documents of a language at which its own threshold counts as much as the common one
    seed: int = 7


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]  # per width: (width, dim, filters)
    shifts: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(OTHER + 1))
    fitted: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # which texts of the sample were fitted


def features(texts: list[bytes | None]):
    """Table rows of each word and of its stems, the words before each text, and the language of each text."""
    data, offsets = flat([x and x.lower() for x in texts])
    starts, ends, before = word_spans(data, offsets, LETTERS)
    rolling = Rolling(BYTE_VALUES[data])
    keys = [word_hashes(data, starts, ends)]
    keys += [mixed(rolling.ranges(starts, np.minimum(ends, starts + n)) ^ U64(n)) for n in STEMS]
    votes = np.zeros((len(texts), OTHER), np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(before))
    names = np.concatenate([np.full(len(w.split()), k) for k, w in enumerate(FUNCTION_WORDS[x] for x in LANGUAGES)])
    words, edges = flat([w.encode() for x in LANGUAGES for w in FUNCTION_WORDS[x].split()])
    known = word_hashes(words, edges[:-1], edges[1:])
    order = np.argsort(known, kind="stable")
    low, high = (np.searchsorted(known[order], keys[0], side) for side in ("left", "right"))
    for k in range(int((high - low).max(initial=0))):  # a word can speak for several languages
        own = np.flatnonzero(high - low > k)
        np.add.at(votes, (doc[own], names[order[low[own] + k]]), 1)
    language = np.where(votes.max(axis=1, initial=0) > 0, votes.argmax(axis=1), OTHER)
    return np.stack([(k >> U64(64 - BITS)).astype(np.int32) for k in keys]), before, language


def cuts(text: bytes) -> list[bytes]:
    """A text in parts of about BATCH_BYTES that end between words."""
    parts, low = [], 0
    while len(text) - low > BATCH_BYTES:
        high = low + BATCH_BYTES
        while high < len(text) and LETTERS[text[high]]:
            high += 1
        parts.append(text[low:high])
        low = high
    return [*parts, text[low:]]


class Sample:
    """Table rows of the words of whole texts, in a file of the driver's temporary folder that is read piece by piece."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()
        self.starts, self.sizes = [], []
        self.words = 0

    def add(self, texts: list[bytes | None]) -> None:
        parts = [cuts(x or b"") for x in texts]
        for own in parts:
            self.starts.append(self.words)
            for part in own:
                rows, _, _ = features([part])
                self.file.write(np.ascontiguousarray(rows.T).tobytes())
                self.words += rows.shape[1]
            self.sizes.append(self.words - self.starts[-1])

    def ordered(self, order: list[int]) -> Sample:
        self.starts, self.sizes = [self.starts[i] for i in order], [self.sizes[i] for i in order]
        return self

    def read(self, text: int, low: int, high: int) -> np.ndarray:
        """Rows of the words from low to high; places after the last word are empty (the last row of the table)."""
        stems, size = 1 + len(STEMS), self.sizes[text]
        n = max(0, min(high, size) - low)
        self.file.seek((self.starts[text] + low) * stems * 4)
        rows = np.frombuffer(self.file.read(n * stems * 4), np.int32).reshape(n, stems).T
        return np.concatenate([rows, np.full((stems, high - low - n), 1 << BITS, np.int32)], axis=1)


def strongest(model: Model, sample: Sample, own: np.ndarray, most: int):
    """Per width: the largest answer of each filter in each text, and the table rows of the words that give it.

    A text longer than PIECE words is answered in pieces that overlap, so memory does not grow with its length.
    """
    found = [
        (np.full((len(own), k.shape[2]), -np.inf, np.float32), np.empty((1 + len(STEMS), len(own), k.shape[2], len(k)), np.int32))
        for k in model.filters
    ]
    group: list[tuple[int, np.ndarray]] = []

    def answer() -> None:
        rows = np.concatenate([r for _, r in group], axis=1)
        edges = np.cumsum([0, *(r.shape[1] for _, r in group)])
        x = model.table[rows[0]]
        for more in rows[1:]:
            x += model.table[more]
        for kernel, (best, places) in zip(model.filters, found, strict=True):
            width, n = len(kernel), len(x) - len(kernel) + 1
            value = x[:n] @ kernel[0]
            for j in range(1, width):
                value += x[j : j + n] @ kernel[j]
            for (k, _), low, high in zip(group, edges[:-1], edges[1:], strict=True):
                at = low + value[low : high - width + 1].argmax(axis=0)
                top = value[at, np.arange(len(at))]
                better = np.flatnonzero(top > best[k])
                best[k, better] = top[better]
                for j in range(width):
                    places[:, k, better, j] = rows[:, at[better] + j]
        group.clear()

    words = 0
    for k, text in enumerate(own.tolist()):
        windows = sample.sizes[text] + 1
        for low in range(0, windows, PIECE):
            high = min(low + PIECE, windows) + most - 1
            if group and words + high - low > PIECE:
                answer()
                words = 0
            group.append((k, sample.read(text, low, high)))
            words += high - low
    if group:
        answer()
    return found


def padded(rows: np.ndarray, before: np.ndarray, most: int):
    """Rows with ``most`` empty places (the last row of the table) after each text, and the first place of each text."""
    sizes = np.diff(before)
    begin = before[:-1] + most * np.arange(len(sizes))
    out = np.full((len(rows), rows.shape[1] + most * len(sizes)), 1 << BITS, np.int32)
    out[:, np.repeat(begin - before[:-1], sizes) + np.arange(rows.shape[1])] = rows
    return out, begin, begin + sizes


def pooled(model: Model, rows: np.ndarray, begin: np.ndarray, end: np.ndarray, most: int):
    """The largest answer of each filter in each text, by width; the last windows reach into the empty places."""
    x = model.table[rows[0]]
    for more in rows[1:]:
        x += model.table[more]
    found = []
    for kernel, shift in zip(model.filters, model.shifts, strict=True):
        width, n = len(kernel), len(x) - len(kernel) + 1
        answer = x[:n] @ kernel[0]
        for k in range(1, width):
            answer += x[k : k + n] @ kernel[k]
        answer = np.concatenate([answer, answer[:1]])
        stop = end + most - width + 1
        spans = np.stack([begin, stop], axis=1).ravel()
        found.append((answer, np.maximum.reduceat(answer, spans, axis=0)[::2] + shift))
    return x, found


def logits(model: Model, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Raw answers and languages of some texts."""
    if not texts:
        return np.empty(0), np.empty(0, np.int64)
    rows, before, language = features(texts)
    most = max(len(k) for k in model.filters)
    _, found = pooled(model, *padded(rows, before, most), most)
    hidden = np.concatenate([np.maximum(z, 0) for _, z in found], axis=1)
    return hidden @ model.weights + model.bias, language


def scores(model: Model, texts: list[bytes | None]) -> np.ndarray:
    """Probabilities whose 0.5 is the threshold of the text's language."""
    raw, language = logits(model, texts)
    return 1 / (1 + np.exp(-np.clip(raw - model.thresholds[language], -30, 30)))


def train(texts: list[bytes | None], labels: np.ndarray, share: float, s: Settings) -> Model:
    """Fit on labelled texts and set the thresholds by those of them that are not fitted."""
    sample = Sample()
    sample.add(texts)
    model = learn(sample, labels, share, s)
    if not len(model.fitted):
        return model
    check = np.setdiff1d(np.arange(len(texts)), model.fitted)
    raw, language = held_answers(model, [texts[i] for i in check], s)
    found = pd.DataFrame({"language": language, "label": labels[check], "raw": raw})
    found["bin"] = np.floor(np.clip(raw, -FURTHEST, FURTHEST) * BINS).astype(int)
    counts = found.groupby(["language", "label", "bin"]).raw.agg(n="size", low="min", high="max").reset_index()
    totals = [(k, label, part) for k in range(OTHER + 1) for label, part in ((0, 1 - share), (1, share))]
    calibrate(model, counts, pd.DataFrame(totals, columns=["language", "label", "n"]), s)
    return model


def learn(sample: Sample, labels: np.ndarray, share: float, s: Settings) -> Model:
    """Fit by Adam, without thresholds; ``share`` is the part of label 1 among all labelled documents."""
    rng = np.random.default_rng(s.seed)
    most = max(s.widths)
    table = rng.normal(0, 0.1, ((1 << BITS) + 1, s.dim)).astype(np.float32)
    table[-1] = 0
    kernels = [rng.normal(0, (2 / (w * s.dim)) ** 0.5, (w, s.dim, s.filters)).astype(np.float32) for w in s.widths]
    shifts = [np.zeros(s.filters, np.float32) for _ in s.widths]
    model = Model(table, kernels, shifts, rng.normal(0, 0.1, s.filters * len(s.widths)).astype(np.float32), 0.0)
    if len(set(labels.tolist())) < 2:  # nothing to tell apart: the share of the one label
        model.weights[:] = 0
        model.bias = 4.0 if share > 0.5 else -4.0
        return model
    order = rng.permutation(len(labels))
    held = int(len(order) * s.calibration)
    fit = order[held:]
    model.fitted = np.sort(fit)
    dense = [*kernels, *shifts, model.weights]
    first, second = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    row_first, row_second = np.zeros_like(table), np.zeros_like(table)
    step = 0
    while step < s.steps:
        rng.shuffle(fit)
        for low in range(0, len(fit), s.batch):
            step += 1
            own = fit[low : low + s.batch]
            found = strongest(model, sample, own, most)
            hidden = np.concatenate([np.maximum(z + shift, 0) for (z, _), shift in zip(found, shifts, strict=True)], axis=1)
            error = (1 / (1 + np.exp(-(hidden @ model.weights + model.bias))) - labels[own]).astype(np.float32) / len(own)
            back = np.outer(error, model.weights) * (hidden > 0)
            grads_kernel, grads_shift, at_rows, at_grads = [], [], [], []
            for k, (_, places) in enumerate(found):
                width = len(kernels[k])
                part = back[:, k * s.filters : (k + 1) * s.filters]
                grads_shift.append(part.sum(axis=0))
                grad = np.zeros_like(kernels[k])
                for j in range(width):  # only the largest window of each filter learns
                    seen = table[places[..., j]].sum(axis=0)
                    grad[j] = np.einsum("bfd,bf->df", seen, part)
                    at_rows.append(places[..., j].reshape(len(places), -1))
                    at_grads.append((part[:, :, None] * kernels[k][j].T[None]).reshape(-1, s.dim))
                grads_kernel.append(grad)
            rate = s.rate * (1 - 0.9**step) ** -1 * (1 - 0.999**step) ** 0.5
            for p, g, a, b in zip(dense, [*grads_kernel, *grads_shift, hidden.T @ error], first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (rate * a / (np.sqrt(b) + 1e-8)).astype(p.dtype)
            model.bias -= s.rate * float(error.sum())
            rows, grads = np.concatenate(at_rows, axis=1), np.concatenate(at_grads)
            touched, which = np.unique(rows.ravel(), return_inverse=True)
            total = np.zeros((len(touched), s.dim), np.float32)
            np.add.at(total, which, np.concatenate([grads] * len(rows)))
            row_first[touched] += 0.1 * (total - row_first[touched])
            row_second[touched] += 0.001 * (total * total - row_second[touched])
            table[touched] -= rate * row_first[touched] / (np.sqrt(row_second[touched]) + 1e-8)
            table[-1] = 0
    return model


def held_answers(model: Model, texts: list[bytes | None], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    parts = [logits(model, texts[low : low + s.batch]) for low in range(0, len(texts), s.batch)] or [logits(model, [])]
    raw, language = (np.concatenate(x) for x in zip(*parts, strict=True))
    return raw, language


def calibrate(model: Model, counts: pd.DataFrame, totals: pd.DataFrame, s: Settings) -> None:
    """Thresholds of the languages: the middle of the gap that gives the best F1 when labels have their true shares,
    drawn towards the threshold of all languages where a language has few toxic documents.

    ``counts`` (language, label, bin, n, low, high) are raw answers of labelled documents outside of the fit, ``totals``
    (language, label, n) all labelled documents.
    """

    def best(own: pd.DataFrame, every: pd.DataFrame) -> float | None:
        n, true = own.groupby("label").n.sum(), every.groupby("label").n.sum()
        if len(n) < 2:
            return None
        table = own.pivot_table(index="bin", columns="label", values="n", aggfunc="sum", fill_value=0).sort_index(ascending=False)
        ends = own.groupby("bin").agg(low=("low", "min"), high=("high", "max")).sort_index(ascending=False)
        hit, false = ((table[label] * (true[label] / n[label])).cumsum().to_numpy() for label in (1, 0))
        k = int(np.argmax(2 * hit / (hit + false + true[1])))
        low = float(ends.low.iloc[k])
        return (low + float(ends.high.iloc[k + 1])) / 2 if k + 1 < len(ends) else low

    everywhere = best(counts, totals)
    everywhere = 0.0 if everywhere is None else everywhere
    model.thresholds[:] = everywhere
    for k in range(OTHER):
        part = counts[counts.language == k]
        own = best(part, totals[totals.language == k])
        if own is not None:
            toxic = part.n[part.label == 1].sum()
            weight = toxic / (toxic + s.trust)
            model.thresholds[k] = weight * own + (1 - weight) * everywhere


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, s: Settings, names: tuple[str, str, str, str]) -> tuple[Model, DataFrame]:
    """Train on the driver with a bounded sample: the labelled documents with the smallest hashed ids.

    Also (id, label, fitted) of all documents that may be learned from.
    """
    id_col, text_col, label_id, label_col = (f"`{x}`" for x in names)
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(label_id).alias("label_id")).agg(
        (F.max(label_col) > 0).cast("int").alias("label")
    )
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"), may_learn.alias("may"))
    own = own.where("may").drop("may")
    # Ids and labels alone are joined and drawn; only the texts of the drawn ids, a bounded number, are fetched.
    known = own.select("id").distinct().join(marks, F.col("id") == F.col("label_id"))
    known = settled(known.select("id", "label", F.xxhash64("id").alias("draw")), "labelled")
    share = known.agg(F.avg("label")).first()[0]
    drawn = []
    for label in (0, 1):
        drawn += known.where(F.col("label") == label).orderBy("draw", "id").limit(s.rows // 2).collect()
    drawn = docs.sparkSession.createDataFrame(drawn, known.schema)
    fetched = own.join(F.broadcast(drawn), "id").groupBy("id", "label", "draw").agg(F.min("text").alias("text"))
    sample, rows = Sample(), []
    for r in fetched.toLocalIterator():  # features go to a file text by text; the driver never holds all texts
        sample.add([bytes(r.text)])
        rows.append((r.label, r.draw, r.id))
    order = sorted(range(len(rows)), key=rows.__getitem__)
    rows = [rows[i] for i in order]
    model = learn(sample.ordered(order), np.array([label for label, _, _ in rows], np.int64), share or 0.0, s)
    used = docs.sparkSession.createDataFrame([(rows[i][2],) for i in model.fitted], known.select("id").schema)
    model.fitted = np.empty(0, np.int64)
    used = F.broadcast(used.withColumn("fitted", F.lit(True)))
    return model, known.join(used, "id", "left").select("id", "label", F.coalesce("fitted", F.lit(False)).alias("fitted"))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "toxic",
    *,
    settings: Settings | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """(row, score) of every document; row has the columns in ``carry``, or all. Scores are seen from the text alone.

    ``may_learn`` marks documents whose labels may be used; at most ``settings.rows`` of them are fitted, all others set
    the thresholds.
    A document with several labels is toxic if one says so; NULL labels are left out. NULL and wordless texts have the
    score of an empty text; without both labels every score is that of the one label, and without any label low.
    The language that picks the threshold is told by function words of the text. Repeated rows are scored each.
    """
    s = settings or Settings()
    model, known = fit(docs, labels, may_learn, s, (id_col, text_col, label_id, label_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("raw double, language int")
    def answers(texts: pd.Series) -> pd.DataFrame:
        done, batch, size = [], [], 0
        for text in texts:
            batch.append(text)
            size += len(text or b"")
            if size > BATCH_BYTES:
                done.append(logits(shared.value, batch))
                batch, size = [], 0
        done.append(logits(shared.value, batch))
        raw, language = (np.concatenate(x) for x in zip(*done, strict=True))
        return pd.DataFrame({"raw": raw.astype(float), "language": language.astype(np.int32)})

    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct("*")
    seen = docs.select(
        carried.alias("row"), F.col(f"`{id_col}`").alias("id"), may_learn.alias("may"), answers(F.col(f"`{text_col}`").cast("binary")).alias("a")
    )
    seen = settled(seen.select("row", "id", "may", "a.*"), "toxicity")  # texts are answered once, for the thresholds and the scores
    near = F.greatest(F.lit(-FURTHEST), F.least(F.lit(FURTHEST), F.col("raw")))
    found = seen.where("may").select("id", "raw", "language").join(known, "id")
    found = found.groupBy("language", "label", "fitted", F.floor(near * BINS).cast("int").alias("bin"))
    found = found.agg(F.count("*").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high"))
    columns = ["language", "label", "fitted", "bin", "n", "low", "high"]
    counts = pd.DataFrame([tuple(r) for r in found.select(columns).collect()], columns=columns)
    if counts.label.nunique() == 2:
        calibrate(model, counts[~counts.fitted.astype(bool)], counts, s)
    threshold = F.get(F.array(*[F.lit(float(t)) for t in model.thresholds]), F.col("language"))
    off = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("raw") - threshold))
    return seen.select("row", (1 / (1 + F.exp(-off))).alias("score"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query("op3_toxicity")
def op3(spark, folder):
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    found = score_toxicity(docs, labels, ~held_out(F.col("doc_id")), carry=["doc_id"])
    return found.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
