"""Toxicity by a bidirectional gated recurrent network with attention pooling over word and character inputs.

A text is cut into words (runs of ASCII letters, digits and bytes beyond ASCII, lower case in A-Z). The input of a word is an embedding of
its hash, the mean embedding of its runs of three and four bytes, and the strongest log odds of those runs. Windows of ``WINDOW`` words begin every ``STRIDE`` words and overlap. In each, gated
units run over the words in both directions; attention weighs their states, and the weighted mean gives the window's log odds.
The score of a text is a logistic function of its largest window.

The network is trained in numpy on at most ``SAMPLE`` labelled texts of each label, those whose ids have the smallest hashes: one text of
each id, the least, of ``LONGEST`` bytes at most, and in this order as many as have ``SAMPLE_BYTES`` together. So what the driver holds is bounded however
often an id repeats and however long texts are. Training is multiple-instance
learning: an epoch trains on the window of each text that scores highest so far (first, by the log odds of its words). One column of
the word embedding begins as those log odds, shrunk for rare words (words of very few texts have no embedding); those of the
runs of bytes stay as they are.

Null, empty and blank texts, and all texts where the labels are not of both kinds, get the share of label 1 in training, 0.49
at most. Whole texts are scored. Repeated rows give a row each; a repeated label counts once, the largest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import Words, mix, schema_of, slices, words

SAMPLE = 2_500
LONGEST = 64_000
SAMPLE_BYTES = 12_000_000
WINDOW = 24
STRIDE = 8
WORD_BUCKETS = 1 << 17
CHAR_BUCKETS = 1 << 15
WORD_SIZE, CHAR_SIZE, UNITS, ATTENTION = 8, 6, 8, 8
INPUTS = WORD_SIZE + CHAR_SIZE + 1
#: Training goes over the texts this often, and more until so many updates are made.
EPOCHS = 6
UPDATES = 200
BATCH = 128
RATE = 0.01

LETTERS = np.zeros(256, bool)
LETTERS[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True

Weights = dict[str, np.ndarray]


def split(column: pa.Array) -> Words:
    return words(column, ~LETTERS)


def _grams(data: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Buckets of the runs of three bytes of each word, then of four."""
    threes = np.maximum(1, n - 2)
    sizes = threes + np.maximum(0, n - 3)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    threes = np.repeat(threes, sizes)
    more = place >= threes
    place = np.where(more, place - threes, place) + np.repeat(start, sizes)
    end = np.repeat(start + n, sizes)
    gram = more.astype(np.uint64)
    for k in range(4):
        inside = (place + k < end) & (more | (k < 3))
        gram = gram * np.uint64(257) + np.where(inside, data[np.minimum(place + k, len(data) - 1)], 0)
    return (mix(gram) & np.uint64(CHAR_BUCKETS - 1)).astype(np.int32)


class Inputs:
    """The distinct words of a batch: their buckets, and the buckets of their runs of three and four bytes, one word after another."""

    def __init__(self, w: Words):
        hashes, at, self.word = np.unique(w.hashes, return_index=True, return_inverse=True)
        self.word = self.word.astype(np.int32)
        self.bucket = (hashes & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
        a, n = w.starts[at], w.ends[at] - w.starts[at]
        self.sizes = np.maximum(1, n - 2) + np.maximum(0, n - 3)  # a short word is one run
        self.begins = np.cumsum(self.sizes) - self.sizes
        parts = [_grams(w.data, a[k : k + 50_000], n[k : k + 50_000]) for k in range(0, len(a), 50_000)]
        self.gram = np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def vectors(self, p: Weights) -> np.ndarray:
        if not len(self.bucket):
            return np.zeros((0, INPUTS), np.float32)
        return assemble(p, self.bucket, self.gram, self.sizes)


def assemble(p: Weights, bucket: np.ndarray, gram: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Inputs of words from their buckets and those of their grams, ``sizes`` of them for each word."""
    begins = np.cumsum(sizes) - sizes
    chars = np.add.reduceat(p["chars"][gram], begins, axis=0) / sizes[:, None]
    strongest = np.maximum.reduceat(p["grams"][gram], begins)
    return np.concatenate((p["words"][bucket], chars, strongest[:, None]), 1).astype(np.float32)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of words, text) of all overlapping windows."""
    n = np.diff(first)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(n)), count)
    start = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return first[text] + start, np.minimum(WINDOW, n[text] - start), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None) -> np.ndarray:
    """States [T, B, H] of gated units over projected inputs [T, B, 3H]; masked steps pass the state on."""
    steps, rows, _ = x.shape
    h = np.zeros((rows, UNITS), np.float32)
    out = np.empty((steps, rows, UNITS), np.float32)
    for t in range(steps):
        hu = h @ u
        zr = _sigmoid(x[t, :, : 2 * UNITS] + hu[:, : 2 * UNITS])
        z, r = zr[:, :UNITS], zr[:, UNITS:]
        n = np.tanh(x[t, :, 2 * UNITS :] + r * hu[:, 2 * UNITS :])
        new = np.where(mask[t, :, None], (1 - z) * n + z * h, h)
        if keep is not None:
            keep.append((h, hu, z, r, n))
        out[t] = h = new
    return out


def forward(p: Weights, left: np.ndarray, right: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Log odds of windows from inputs projected for either direction, [T, B, 3H] each."""
    trail: list[list] = [[], []]
    a = _run(left, mask, p["left_u"], trail[0] if keep is not None else None)
    b = _run(right[::-1], mask[::-1], p["right_u"], trail[1] if keep is not None else None)[::-1]
    h = np.concatenate((a, b), 2)
    u = np.tanh(h @ p["attend"])
    e = np.where(mask, u @ p["context"], -1e9)
    e = np.exp(e - e.max(0))
    weight = e / e.sum(0)
    pooled = (weight[:, :, None] * h).sum(0)
    if keep is not None:
        keep |= {"trail": trail, "h": h, "u": u, "weight": weight, "pooled": pooled}
    return pooled @ p["out"] + p["bias"][0]


def _back(d_states: np.ndarray, mask: np.ndarray, u: np.ndarray, trail: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of ``u``."""
    steps = len(trail)
    dx = np.empty((*d_states.shape[:2], 3 * UNITS), np.float32)
    du = np.zeros_like(u)
    dh = np.zeros(d_states.shape[1:], np.float32)
    for t in range(steps - 1, -1, -1):
        h, hu, z, r, n = trail[t]
        m = mask[t, :, None]
        dh = dh + d_states[t]
        d = dh * m
        dz = d * (h - n) * z * (1 - z)
        dn = d * (1 - z) * (1 - n * n)
        dr = dn * hu[:, 2 * UNITS :] * r * (1 - r)
        dx[t] = np.concatenate((dz, dr, dn), 1)
        dhu = np.concatenate((dz, dr, dn * r), 1)
        du += h.T @ dhu
        dh = dh * ~m + d * z + dhu @ u.T
    return dx, du


def gradients(p: Weights, vectors: np.ndarray, place: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[Weights, np.ndarray, np.ndarray]:
    """Gradients of the mean log loss: of the weights but the embeddings, of ``vectors``, and the log odds."""
    x = vectors[place]  # [T, B, D]
    keep: dict = {}
    odds = forward(p, x @ p["left_w"] + p["left_b"], x @ p["right_w"] + p["right_b"], mask, keep)
    d = ((_sigmoid(odds) - y) / len(y)).astype(np.float32)
    g: Weights = {"out": keep["pooled"].T @ d, "bias": np.array([d.sum()], np.float32)}
    h, u, weight = keep["h"], keep["u"], keep["weight"]
    d_pooled = d[:, None] * p["out"]
    dh = weight[:, :, None] * d_pooled
    d_weight = (h * d_pooled).sum(2)
    de = weight * (d_weight - (weight * d_weight).sum(0))
    du = de[:, :, None] * p["context"] * (1 - u * u)
    g["context"] = np.einsum("tb,tba->a", de, u)
    g["attend"] = np.einsum("tbh,tba->ha", h, du)
    dh += du @ p["attend"].T
    dx_left, g["left_u"] = _back(dh[:, :, :UNITS], mask, p["left_u"], keep["trail"][0])
    dx_right, g["right_u"] = _back(dh[::-1, :, UNITS:], mask[::-1], p["right_u"], keep["trail"][1])
    dx_right = dx_right[::-1]
    d_vectors = np.zeros_like(vectors)
    total = np.zeros_like(x)
    for side, dx in (("left", dx_left), ("right", dx_right)):
        g[f"{side}_w"] = np.einsum("tbd,tbk->dk", x, dx)
        g[f"{side}_b"] = dx.sum((0, 1))
        total += dx @ p[f"{side}_w"].T
    np.add.at(d_vectors, place[mask], total[mask])
    return g, d_vectors, odds


def fresh(rng: np.random.Generator) -> Weights:
    def some(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    size = INPUTS
    p = {f"{s}_{k}": v for s in ("left", "right") for k, v in (("w", some(size, 3 * UNITS)), ("u", some(UNITS, 3 * UNITS)), ("b", np.zeros(3 * UNITS, np.float32)))}
    p |= {"attend": some(2 * UNITS, ATTENTION), "context": some(ATTENTION), "out": some(2 * UNITS), "bias": np.zeros(1, np.float32)}
    p["words"] = (rng.standard_normal((WORD_BUCKETS, WORD_SIZE)) * 0.05).astype(np.float32)
    p["chars"] = (rng.standard_normal((CHAR_BUCKETS, CHAR_SIZE)) * 0.3).astype(np.float32)
    return p


def _places(inputs: Inputs, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words [T, B] of windows, and which steps are words."""
    step = np.arange(WINDOW)[:, None]
    mask = step < n
    return inputs.word[np.where(mask, start + step, start)], mask


def window_odds(p: Weights, inputs: Inputs, start: np.ndarray, n: np.ndarray, together: int = 4096) -> np.ndarray:
    v = inputs.vectors(p)
    left, right = v @ p["left_w"] + p["left_b"], v @ p["right_w"] + p["right_b"]
    out = np.zeros(len(start), np.float32)
    for a in range(0, len(start), together):
        place, mask = _places(inputs, start[a : a + together], n[a : a + together])
        out[a : a + together] = forward(p, left[place], right[place], mask)
    return out


def _best(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The window of largest value of each text; texts are in order."""
    order = np.lexsort((-values, text))
    return order[np.concatenate(([True], text[order][1:] != text[order][:-1]))] if len(order) else order


def train(texts: list[str], labels: np.ndarray, updates: int = UPDATES, seed: int = 7) -> Weights | None:
    w = split(pa.array(texts, pa.large_string()))
    inputs = Inputs(w)
    start, n, text = windows(w.first)
    if len(set(labels[np.unique(text)].tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    p = fresh(rng)
    # how many texts of each label hold a bucket, some texts at a time
    held = [np.zeros((2, k), np.int64) for k in (WORD_BUCKETS, CHAR_BUCKETS)]
    for a in range(0, len(texts), 100):
        first = w.first[a : a + 101]
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        pairs = np.unique(doc * len(inputs.bucket) + inputs.word[first[0] : first[-1]])
        doc, word = pairs // max(1, len(inputs.bucket)), pairs % max(1, len(inputs.bucket))
        size = inputs.sizes[word]
        place = np.repeat(inputs.begins[word] - np.cumsum(size) + size, size) + np.arange(size.sum())
        for total, owner, bucket in ((held[0], doc, inputs.bucket[word]), (held[1], np.repeat(doc, size), inputs.gram[place])):
            n_buckets = total.shape[1]
            pairs = np.unique(owner * n_buckets + bucket)
            for label in (0, 1):
                total[label] += np.bincount(pairs[labels[a + pairs // n_buckets] == label] % n_buckets, minlength=n_buckets)
    odds = _odds(*held[0], labels)
    p["words"][:, 0] = odds / 3
    common = held[0].sum(0) >= max(3, (labels == 1).sum() / 50)  # rare words are known by their runs of bytes alone
    p["words"][~common] = 0
    p["grams"] = (_odds(*held[1], labels) / 3).astype(np.float32)
    odds = np.maximum(odds[inputs.bucket], 3 * np.maximum.reduceat(p["grams"][inputs.gram], inputs.begins))
    along = np.concatenate(([0.0], np.cumsum(np.maximum(0, odds[inputs.word] - 1))))
    value = along[start + n] - along[start]
    moments = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in p.items() if k != "grams"}
    step = 0
    for _ in range(max(EPOCHS, -(-updates * BATCH // len(np.unique(text))))):
        chosen = rng.permutation(_best(value, text))
        for a in range(0, len(chosen), BATCH):
            part = chosen[a : a + BATCH]
            place, mask = _places(inputs, start[part], n[part])
            here, place = np.unique(place, return_inverse=True)
            place = place.reshape(mask.shape)
            grams = np.repeat(inputs.begins[here], inputs.sizes[here]) + np.arange(inputs.sizes[here].sum()) - np.repeat(np.cumsum(inputs.sizes[here]) - inputs.sizes[here], inputs.sizes[here])
            sizes = inputs.sizes[here]
            vectors = assemble(p, inputs.bucket[here], inputs.gram[grams], sizes)
            g, d, _ = gradients(p, vectors, place, mask, labels[text[part]].astype(np.float32))
            step += 1
            for name, x in g.items():
                _adam(p[name], x, *moments[name], step)
            for name, rows, x in (
                ("words", inputs.bucket[here], d[:, :WORD_SIZE]),
                ("chars", inputs.gram[grams], np.repeat(d[:, WORD_SIZE : WORD_SIZE + CHAR_SIZE] / sizes[:, None], sizes, axis=0)),
            ):
                which, back = np.unique(rows, return_inverse=True)
                total = np.zeros((len(which), x.shape[1]), np.float32)
                np.add.at(total, back, x)
                m, v = moments[name]
                m[which] = 0.9 * m[which] + 0.1 * total
                v[which] = 0.999 * v[which] + 0.001 * total**2
                change = RATE / 4 * m[which] / (np.sqrt(v[which]) + 1e-6)
                p[name][which] -= change * common[which, None] if name == "words" else change
        value = window_odds(p, inputs, start, n)
    best = _best(value, text)
    p["slope"] = _calibrate(value[best], labels[text[best]])
    p["base"] = np.array([min(0.49, float((labels == 1).mean()))], np.float32)
    return p


def _odds(zeros: np.ndarray, ones: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Log odds of label 1 for texts that hold a bucket, shrunk where few do."""
    odds = np.log((ones + 0.5) / (labels == 1).sum()) - np.log((zeros + 0.5) / (labels == 0).sum())
    return odds * (ones + zeros) / (ones + zeros + 1 + (labels == 1).sum() / 25)


def _adam(x: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, step: int) -> None:
    m += 0.1 * (g - m)
    v += 0.001 * (g * g - v)
    x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def _calibrate(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(constant, factor) of a logistic function of the largest window, with a weak pull toward (0, 1)."""
    x, w = np.column_stack([np.ones(len(odds)), np.clip(odds, -15, 15)]).astype(float), np.array([0.0, 1.0])
    for _ in range(30):
        q = _sigmoid(x @ w)
        w += np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.eye(2), x.T @ (y - q) - (w - [0.0, 1.0]))
    return np.array([w[0], max(w[1], 0.05)], np.float32)


def scores(column: pa.Array, p: Weights) -> np.ndarray:
    w = split(column)
    out = np.full(len(w.first) - 1, p["base"][0], float)
    start, n, text = windows(w.first)
    if len(start):
        value = window_odds(p, Inputs(w), start, n)
        begins = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
        top = np.clip(np.maximum.reduceat(value, begins), -15, 15)
        out[text[begins]] = _sigmoid(p["slope"][0] + p["slope"][1] * top.astype(float))
    return out


def _sample(documents: DataFrame, known: DataFrame, key: str, text: str, sample: int, longest: int, most: int) -> pa.Table:
    """(text, label) of the sample, in order of the hashes of ids: ``most`` bytes of each label at most."""
    order = F.xxhash64(key)
    # two samples of bounded size, so their ids may be broadcast
    chosen = known.where("__label = 1").orderBy(order, key).limit(sample).unionByName(known.where("__label = 0").orderBy(order, key).limit(sample))
    short = documents.select(key, F.col(text).alias("__text")).where(F.octet_length("__text") <= longest)
    one = short.join(F.broadcast(chosen), key).groupBy(key, "__label").agg(F.min("__text").alias("__text"))
    along = Window.partitionBy("__label").orderBy(order, key).rowsBetween(Window.unboundedPreceding, 0)  # ``sample`` rows at most
    return (
        one.withColumn("__bytes", F.sum(F.octet_length("__text")).over(along)).where(F.col("__bytes") <= most)
        .orderBy(order, key).select("__text", "__label").toArrow()
    )


def score(
    documents: DataFrame, labels: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", label: str = "toxic",
    out: str = "score", keep: list[str] | None = None, sample: int = SAMPLE, longest: int = LONGEST, most: int = SAMPLE_BYTES,
) -> DataFrame:
    """The columns ``keep`` of ``documents`` (all but the text, unless given) and the score of each whole text. ``usable``: which
    rows of ``labels`` may be learned from."""
    keep = keep if keep is not None else [c for c in documents.columns if c != text]
    keep = [c for c in keep if c != out]
    known = labels.where(usable & F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("__label"))
    got = _sample(documents, known, key, text, sample, longest, most)
    share = known.agg(F.avg("__label")).first()[0]
    y = np.array(got.column("__label").to_pylist(), int)
    p = train(got.column("__text").to_pylist(), y) if len(y) else None
    base = min(0.49, float(share or 0.0))
    if p is None:
        return documents.select(*keep).withColumn(out, F.lit(base))
    p["base"][0] = base
    model = documents.sparkSession.sparkContext.broadcast(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 3_000_000):
                found = pa.array(scores(part.column(text), model.value), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [found], [*keep, out])

    rows = documents.select(*dict.fromkeys([*keep, text]))
    return rows.mapInArrow(run, schema_of(documents, keep, f"`{out}` double"))
