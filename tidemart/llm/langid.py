"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its words' hashed subwords, followed by
a linear softmax. The model is trained here by stochastic gradient descent on a
bounded sample, and its confidence is scaled on a held-back part of that sample.

A softmax is sure of itself on texts of no language that it knows, so rejection asks
how usual a text's subwords are in the predicted language: their mean log frequency,
against that of held-back documents of its length. The limit lies between these and
texts made to be rejected: held-back documents in whose language they are not, with
their letters shuffled, and with their own language withheld.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import bound_batches, first_by_hash, give_back, held_out, ship

#: Labelled documents of each language that the model may see.
PER_LANGUAGE = 800
BUCKETS, DIMENSIONS, EPOCHS, RATE = 1 << 14, 16, 6, 0.5
#: Share of right answers in the held-back part that rejection may cost, and share of
#: the texts made to be rejected that it aims at.
REJECTED, CAUGHT = 0.002, 0.95
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_WORDS_KEPT, _GRAMS_KEPT, _AT_ONCE = 80_000, 50_000, 500


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased; none if no character is a letter."""
    words = _LETTERS.findall((text or "").lower())
    # Superscript digits and the like are matched too, but are no letters.
    return words if any(c.isalpha() for w in words for c in w) else []


class _Buckets(dict):
    def __missing__(self, gram: str) -> int:
        if len(self) >= _GRAMS_KEPT:
            self.clear()
        value = self[gram] = zlib.crc32(gram.encode("utf-8", "surrogatepass")) % BUCKETS
        return value


_bucket = _Buckets()


def _grams(word: str) -> list[str]:
    m = f"<{word}>"
    n = len(m)
    return [*word, *[m[i : i + 2] for i in range(n - 1)], *[m[i : i + 3] for i in range(n - 2)]]


def subwords(word: str) -> np.ndarray:
    """Buckets of a word's character n-grams of 1 to 3, with its ends marked."""
    return np.array([_bucket[g] for g in _grams(word)])


@dataclass
class Model:
    """Per bucket the logits it contributes; texts average them over their subwords."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    scale: float = 1.0
    threshold: float = 0.0
    # Log frequency of each bucket by language, its mean in a document, the variances
    # of that mean among long documents and by subword, and the limit of deviations.
    usual: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    limit: float = np.inf
    _known: dict[str, int] = field(default_factory=dict, repr=False)
    _rows: np.ndarray | None = field(default=None, repr=False)
    _table: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_known": {}, "_rows": None, "_table": None}

    def _learn(self, words: list[str]) -> None:
        """Sums of logits, log frequencies and subwords of new words, looked up together."""
        if self._rows is None:
            ones = np.ones((BUCKETS, 1), np.float32)
            self._table = np.concatenate([self.logits, self.usual, ones], axis=1)
        first, kept = len(self._known), self._rows
        if kept is None or first + len(words) > len(kept):
            size = max(1 << 12, 2 * (first + len(words)))
            self._rows = np.zeros((size, self._table.shape[1]), np.float32)
            self._rows[:first] = kept[:first] if first else 0
        grams = [_grams(w) for w in words]
        ends = np.cumsum([0, *map(len, grams)])
        flat = np.fromiter(map(_bucket.__getitem__, chain.from_iterable(grams)), np.int64, ends[-1])
        self._rows[first : first + len(words)] = np.add.reduceat(self._table[flat], ends[:-1])
        self._known.update(zip(words, range(first, first + len(words)), strict=True))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """The language, its probability, and whether the text is rejected.

        Texts without letters are ``und`` with probability 0 and rejected.
        """
        words = words_of(text)
        if not words or not self.languages:
            return UNKNOWN, 0.0, True
        size, known = len(self.languages), self._known
        counts = Counter(words)
        new = [w for w in counts if w not in known]
        if len(known) + len(new) > _WORDS_KEPT:
            known.clear()
            self._rows, new = None, list(counts)
        if new:
            self._learn(new)
        at = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
        times = np.fromiter(counts.values(), np.float64, len(counts))
        total = times @ self._rows[at]
        n = total[-1]
        p = softmax(self.scale * (total[:size] / n + self.bias))
        best = int(np.argmax(p))
        unusual = self.deviation(total[size:-1] / n, n)[best] > self.limit
        return self.languages[best], float(p[best]), bool(unusual or p[best] < self.threshold)

    def deviation(self, usual: np.ndarray, n) -> np.ndarray:
        """How far texts of ``n`` subwords lie below a language's documents, in their spread."""
        return (self.mean - usual) / np.sqrt(self.spread[0] + self.spread[1] / n)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(examples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """A model from ``(language, buckets, counts)`` of the sampled documents."""
    languages = sorted({e[0] for e in examples})
    number = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    embedded = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    out, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    order = rng.permutation(len(examples))
    back = order[: len(examples) // 5]
    fit = order[len(examples) // 5 :] if len(examples) > 20 else order
    steps, step = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            language, buckets, counts = examples[i]
            weights = counts / counts.sum()
            hidden = weights @ embedded[buckets]
            error = softmax(hidden @ out + bias)
            error[number[language]] -= 1
            rate = RATE * (1 - step / steps)
            back_out = out @ error
            out -= rate * np.outer(hidden, error)
            bias -= rate * 0.1 * error
            embedded[buckets] -= rate * len(buckets) ** 0.5 * np.outer(weights, back_out)
            step += 1
    model = Model(languages, (embedded @ out).astype(np.float32), bias)
    model.usual = _log_frequencies([examples[i] for i in fit], number)
    _calibrate(model, [examples[i] for i in (back if len(back) else fit)], number, rng)
    return model


def _log_frequencies(examples: list, number: dict[str, int]) -> np.ndarray:
    counts = np.full((BUCKETS, len(number)), 0.5)
    for language, buckets, n in examples:
        # A long document counts by the root of its length: it is one voice too.
        counts[buckets, number[language]] += n / n.sum() ** 0.5
    return np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32)


def _calibrate(model: Model, held: list, number: dict[str, int], rng) -> None:
    """Sets the scale that fits the held-back part best, then the limits of rejection."""
    size = len(number)
    model.mean, model.spread = np.zeros(size), np.ones((2, size))
    if not held:
        return
    logits = np.array([c @ model.logits[b] / c.sum() + model.bias for _, b, c in held])
    usual = np.array([c @ model.usual[b] / c.sum() for _, b, c in held])
    n = np.array([c.sum() for _, _, c in held], float)
    y = np.array([number[language] for language, _, _ in held])
    each = np.arange(len(y))
    scales = np.geomspace(0.1, 1000, 81)
    losses = [-np.log(softmax(s * logits)[each, y] + 1e-12).mean() for s in scales]
    model.scale = float(scales[int(np.argmin(losses))])
    p = softmax(model.scale * logits)
    right = p.argmax(axis=1) == y
    if not right.any():
        return
    model.threshold = min(float(np.quantile(p.max(axis=1)[right], REJECTED)), 0.5)
    for k in range(size):
        own = usual[y == k, k]
        if len(own):
            model.mean[k] = np.median(own)
            off, length = (own - model.mean[k]) ** 2, n[y == k]
            long = length >= np.median(length)
            model.spread[0, k] = max(np.median(off[long]), 1e-6) * 2.2
            model.spread[1, k] = max(np.median((off * length)[~long]) if (~long).any() else 0, 1e-3) * 2.2
    kept = model.deviation(usual[each, y][:, None], n[:, None])[each, y][right]
    high = float(np.quantile(kept, 1 - REJECTED))
    wrong = _made_up(model, held, logits, usual, n, y, rng)
    low = float(np.quantile(wrong, 1 - CAUGHT)) if len(wrong) else high
    model.limit = high if low <= high else (high + low) / 2


def _made_up(model: Model, held: list, logits, usual, n, y, rng) -> np.ndarray:
    """Deviations of texts of no known language.

    Withholding its own language leaves a document the best of the others. Shuffled
    letters keep their frequencies and lose their order: subwords of several letters
    are those of other documents' letters, drawn by chance.
    """
    each, out = np.arange(len(y)), []
    if len(model.languages) > 1:
        others = logits.copy()
        others[each, y] = -np.inf
        best = others.argmax(axis=1)
        out.append(model.deviation(usual[each, best][:, None], n[:, None])[each, best])
    for _, _, counts in held:
        buckets = rng.integers(0, BUCKETS, len(counts))
        best = int((counts @ model.logits[buckets] + model.bias).argmax())
        mixed = 0.3 * usual[:, best].max() + 0.7 * (counts @ model.usual[buckets, best] / counts.sum())
        out.append(model.deviation(np.full(len(model.languages), mixed), counts.sum())[best : best + 1])
    return np.concatenate(out)


def _features(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            found = []
            for text in part.column(1):
                parts = [subwords(w) for w in words_of(text.as_py())]
                ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
                found.append(np.unique(ids, return_counts=True))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.list_(pa.int32())),
                ],
                ["lang", "buckets", "counts"],
            )
    _bucket.clear()
    give_back()


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Trains on at most ``per_language`` whole documents of each language.

    The documents come first in the order of their ids' hashes, and none of them
    is held out (``common.held_out``). Rows without language, text or id are not
    learnt from; from an empty table comes a model that knows no language.
    """
    ship(docs.sparkSession)
    bound_batches(docs.sparkSession)
    named = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    ids = named.where(~held_out()).select("doc_id", "lang").distinct()
    ids = first_by_hash(ids, "lang", "doc_id", per_language)
    # At most per_language ids a language: small whatever the table.
    sample = named.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")
    found = sample.select("lang", "text").mapInArrow(
        _features, "lang string, buckets array<int>, counts array<int>"
    )
    rows = [(r.lang, np.array(r.buckets), np.array(r.counts)) for r in found.collect() if r.buckets]
    rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
    return train(rows)


def verdict(docs: DataFrame, model: Model, text: Column) -> Column:
    """``lang, score, rejected`` of a text column, from whole texts."""
    ship(docs.sparkSession)
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, rejected boolean")
    def identify(texts: pa.Array) -> pa.Array:
        found = []
        for at in range(0, len(texts), _AT_ONCE):
            found += map(shared.value.predict, texts.slice(at, _AT_ONCE).to_pylist())
        give_back()
        columns = zip(*found, strict=True) if found else ([], [], [])
        kinds = (pa.string(), pa.float64(), pa.bool_())
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.StructArray.from_arrays(arrays, ["lang", "score", "rejected"])

    return identify(text)


def identify_languages(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, rejected``.

    NULL texts and texts without letters are ``und`` with score 0 and rejected.
    Every row is judged on its own, repeated ones and those with a NULL id too;
    columns besides the two named are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    judged = rows.select("doc_id", verdict(docs, model, F.col("text")).alias("v"))
    return judged.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("v.lang").alias("lang_pred"),
        F.col("v.score").alias("score"),
        F.col("v.rejected").alias("rejected"),
    )
