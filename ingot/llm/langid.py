"""Language identification by a convolutional network over bytes.

A text is cut into windows of `WINDOW` bytes (UTF-8; the last one is filled
up).  Every byte has an embedding; filters of several widths slide over them,
the strongest answer of each filter in the window is kept (max pooling), and a
softmax over those gives the languages' probabilities.  A text's probabilities
are the mean over all its windows, weighted by the letters' bytes in each.

The network is trained in numpy, on the driver, on windows of labelled texts:
at most `TRAIN_WINDOWS` of them, with equal shares for the languages, each
taken at places spread over its whole text.  All texts count towards the
languages' frequencies; the `MAX_LANGS` most frequent languages are learnt.
Prediction runs over Arrow batches, whole texts, `CHUNK` windows at a time.

Null texts and texts without a letter are `und` with score 0; so is every text
if no language could be learnt.  A single language learnt is always predicted.
Repeated rows each get their result, other columns are passed through in
`row`, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.llm.common import col, text_bytes, whole_row

#: Bytes of a window; a multiple of every filter width.
WINDOW = 252
#: Filter widths, filters of each width, and numbers per byte.
WIDTHS = (2, 3, 4)
FILTERS = 24
DIM = 8
#: Windows of the training set, and windows that one text adds to it, at most.
TRAIN_WINDOWS = 12_000
WINDOWS_A_TEXT = 3
#: Languages that are learnt, at most.
MAX_LANGS = 200
#: Training: passes, windows of a step, step size.
EPOCHS, STEP_WINDOWS, RATE = 10, 64, 4e-3
#: Windows that go through the network at a time.
CHUNK = 128
UNKNOWN = "und"

#: Of each window the last bytes stay empty, so that no filter sees two windows.
_FILL = max(WIDTHS) - 1
_BODY = WINDOW - _FILL
_PAD = 256
_LETTER = regex.compile(r"\p{L}")
#: Bytes that belong to letters: ASCII letters and all beyond ASCII.
_LETTER_BYTE = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)] + [False])


# --- windows ----------------------------------------------------------------------------

def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, as rows of byte numbers (`_PAD` where empty)."""
    n = max(1, -(-len(data) // _BODY))
    out = np.full((n, WINDOW), _PAD, np.int16)
    body = np.full(n * _BODY, _PAD, np.int16)
    body[: len(data)] = np.frombuffer(data, np.uint8)
    out[:, :_BODY] = body.reshape(n, _BODY)
    return out


def _spread_windows(data: bytes, most: int) -> Iterator[bytes]:
    """At most `most` stretches of window length, evenly over the whole text."""
    room = max(0, len(data) - _BODY)
    for k in range(min(most, -(-len(data) // _BODY))):
        at = room * (2 * k + 1) // (2 * most) if room > most else 0
        yield data[at : at + _BODY]


# --- the network --------------------------------------------------------------------------

class Network:
    """Embedding, filters by width, and the softmax layer."""

    def __init__(self, langs: list[str], seed: int = 7):
        r, self.langs = np.random.default_rng(seed), langs
        self.p = {"embedding": r.normal(0, 0.5, (_PAD + 1, DIM)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"filter{w}"] = r.normal(0, (1 / (w * DIM)) ** 0.5, (w * DIM, FILTERS)).astype(np.float32)
            self.p[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.p["out"] = r.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.p["out_bias"] = np.zeros(len(langs), np.float32)
        self.p["embedding"][_PAD] = 0

    def _answers(self, x: np.ndarray, width: int, phase: int) -> np.ndarray:
        """Answers of the filters at the places phase, phase + width, ... of
        each window (window, place, filter); `x`: the embedded windows, one
        after the other, so that the places are rows of a matrix."""
        n = len(x) // WINDOW
        flat = np.concatenate([x.ravel()[phase * DIM :], np.zeros(phase * DIM, np.float32)]) if phase else x.ravel()
        out = (flat.reshape(-1, width * DIM) @ self.p[f"filter{width}"]).reshape(n, WINDOW // width, FILTERS)
        if phase:
            out[:, -1] = -np.inf  # that place reaches into the next window
        return out

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """Strongest answers (window, filter of all widths), rectified."""
        x = self.p["embedding"][windows.ravel()]
        found = []
        for w in WIDTHS:
            best = self._answers(x, w, 0)
            for phase in range(1, w):
                np.maximum(best, self._answers(x, w, phase), out=best)
            while best.shape[1] > 1:  # halves against each other
                half = best.shape[1] // 2
                rest = best[:, 2 * half :]
                best = np.maximum(best[:, :half], best[:, half : 2 * half])
                if rest.shape[1]:
                    np.maximum(best[:, :1], rest, out=best[:, :1])
            found.append(best[:, 0] + self.p[f"bias{w}"])
        return np.maximum(np.concatenate(found, 1), 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = self.pooled(windows) @ self.p["out"] + self.p["out_bias"]
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    # --- training ---

    def _places(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Pooled answers and, per width, the place of each filter's strongest."""
        x, places, found = self.p["embedding"][windows.ravel()], [], []
        for w in WIDTHS:
            every = np.full((len(windows), WINDOW // w, w, FILTERS), -np.inf, np.float32)
            for phase in range(w):
                every[:, :, phase] = self._answers(x, w, phase)
            every = every.reshape(len(windows), -1, FILTERS)
            places.append(every.argmax(1))
            found.append(every.max(1) + self.p[f"bias{w}"])
        return np.concatenate(found, 1), places

    def gradient(self, windows: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy."""
        found, places = self._places(windows)
        h = np.maximum(found, 0)
        z = h @ self.p["out"] + self.p["out_bias"]
        e = np.exp(z - z.max(1, keepdims=True))
        dz = e / e.sum(1, keepdims=True)
        dz[np.arange(len(y)), y] -= 1
        dz /= len(y)
        g = {"out": h.T @ dz, "out_bias": dz.sum(0), "embedding": np.zeros_like(self.p["embedding"])}
        dh = (dz @ self.p["out"].T) * (found > 0)
        for k, w in enumerate(WIDTHS):
            d = dh[:, k * FILTERS : (k + 1) * FILTERS]
            seen = windows[np.arange(len(windows))[:, None, None], places[k][:, :, None] + np.arange(w)]  # window, filter, byte
            patch = self.p["embedding"][seen].reshape(len(windows), FILTERS, w * DIM)
            g[f"filter{w}"] = np.einsum("nf,nfd->df", d, patch)
            g[f"bias{w}"] = d.sum(0)
            back = (d[:, :, None] * self.p[f"filter{w}"].T[None]).reshape(-1, DIM)
            np.add.at(g["embedding"], seen.ravel(), back)
        g["embedding"][_PAD] = 0
        return g

    def fit(self, windows: np.ndarray, y: np.ndarray, seed: int = 11) -> Network:
        """Adam over shuffled steps; the step size falls to a tenth."""
        r, t = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps = max(1, EPOCHS * -(-len(y) // STEP_WINDOWS))
        for _ in range(EPOCHS):
            order = r.permutation(len(y))
            for i in range(0, len(y), STEP_WINDOWS):
                part, t = order[i : i + STEP_WINDOWS], t + 1
                rate = RATE * (1 - 0.9 * t / steps)
                for k, g in self.gradient(windows[part], y[part]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] -= (rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
        return self

    # --- whole texts ---

    def predict(self, data: list[bytes | None]) -> tuple[list[str], list[float]]:
        """Language and score of every text; windows of all texts share chunks."""
        total, weight = np.zeros((len(data), len(self.langs))), np.zeros(len(data))
        waiting: list[tuple[int, np.ndarray]] = []
        size = 0

        def run():
            owner = np.concatenate([np.full(len(w), i) for i, w in waiting])
            rows = np.concatenate([w for _, w in waiting])
            for k in range(0, len(rows), CHUNK):
                part, who = rows[k : k + CHUNK], owner[k : k + CHUNK]
                letters = _LETTER_BYTE[part].sum(1)
                np.add.at(total, who, self.probabilities(part) * letters[:, None])
                np.add.at(weight, who, letters)
            waiting.clear()

        step = _BODY * CHUNK
        for i, d in enumerate(data):
            if not (self.langs and d and _LETTER.search(d.decode())):
                continue
            for at in range(0, len(d), step):
                waiting.append((i, windows_of(d[at : at + step])))
                size += len(waiting[-1][1])
                if size >= CHUNK:
                    run()
                    size = 0
        if waiting:
            run()
        best = total.argmax(1) if self.langs else np.zeros(len(data), int)
        langs = [self.langs[b] if w else UNKNOWN for b, w in zip(best, weight)]
        return langs, [min(1.0, float(total[i, b] / w)) if w else 0.0 for i, (b, w) in enumerate(zip(best, weight))]


# --- training set ----------------------------------------------------------------------------

def training_windows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_WINDOWS, max_langs: int = MAX_LANGS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, windows, their languages' numbers) from labelled `docs`: the
    texts of each language with the smallest hashes, as many as give it its
    share of `most` windows."""
    text, lang = col(text_col).cast("string"), col(lang_col).cast("string")
    known = docs.select(text.alias("text"), lang.alias("lang")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    n = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()}
    langs = sorted(n)
    if not langs:
        return [], np.empty((0, WINDOW), np.int16), np.empty(0, np.int64)
    share = -(-most // len(langs))
    # by hash, about half as many texts again as wanted: rows beyond them never leave their task
    grain = 1 << 30
    part = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(grain, -(-3 * share * grain // (2 * n[k])))))]), F.col("lang"))
    chosen = known.where(F.col("lang").isin(langs)).withColumn("h", F.xxhash64("text")).where(F.pmod("h", F.lit(grain)) < part)
    schema = "lang string, h long, k int, data binary"

    def cut(batches):
        for b in batches:
            rows = [(la, h, k, w) for t, la, h in zip(text_bytes(b.column(0)), b.column(1).to_pylist(), b.column(2).to_pylist()) for k, w in enumerate(_spread_windows(t, WINDOWS_A_TEXT))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.binary()))], names=["lang", "h", "k", "data"])

    # copies of a text add nothing; the first windows of all texts come before the second ones
    taken = chosen.mapInArrow(cut, schema).distinct()
    rows = taken.orderBy("k", F.xxhash64("h"), "h", "lang", "data").limit(2 * most).collect()
    at, used, x, y = {k: i for i, k in enumerate(langs)}, dict.fromkeys(langs, 0), [], []
    for r in rows:
        if used[r["lang"]] < share:
            used[r["lang"]] += 1
            x.append(windows_of(bytes(r["data"]))[:1])
            y.append(at[r["lang"]])
    return langs, np.concatenate(x) if x else np.empty((0, WINDOW), np.int16), np.array(y, np.int64)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_WINDOWS) -> Network:
    """The network, from labelled `docs`."""
    langs, x, y = training_windows(docs, text_col, lang_col, most)
    return Network(langs).fit(x, y)


# --- the operator ------------------------------------------------------------------------------

def identify(docs: DataFrame, network: Network, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`row` (the columns `keep`, all by default), `lang_pred`, `score`."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(col(text_col).cast("string").alias("text"), whole_row(docs.select(*[col(c) for c in keep])).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for b in batches:
            langs, scores = network.predict(list(text_bytes(b.column(0))))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["row", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def held_out(id_column: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training: crc32 of its id as text."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def cross_identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_WINDOWS) -> DataFrame:
    """Trains on the rows that are not held out and predicts every row:
    `doc_id`, `held_out`, `lang_pred`, `score`.  A null id is in no fold."""
    network = train(docs.where(~held_out(col(id_col)) & col(id_col).isNotNull()), text_col, lang_col, most)
    found = identify(docs, network, text_col, keep=[id_col])
    return found.select(F.col("row").getField(id_col).alias("doc_id"), held_out(F.col("row").getField(id_col)).alias("held_out"), "lang_pred", "score")
