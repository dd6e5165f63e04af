"""Toxicity by two class-conditional Kneser-Ney bigram models.

A toxic and an ordinary model are counted on labelled documents. Both back off to
one distribution of continuations, counted over the whole corpus: a word that
neither class has seen in enough documents counts as one rare word, with nearly the
same probability from both. A text's score is the logistic of its length-normalised
log-likelihood ratio, and of the part of it that exceeds a margin word by word: the
first also tells topics apart, the second only expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import (
    bound_batches,
    first_by_hash,
    fold_of,
    give_back,
    held_out,
    parallelism,
    ship,
    written,
)
from tidemart.llm.exact_dedup import rice_decode, rice_encode

#: Labelled documents of each class that the models may see.
PER_CLASS = 8_000
#: Words and bigrams of fewer documents of that sample are left to the backoff.
LEAST_DOCUMENTS = 5
#: Log-likelihood ratio of a word from which on it counts as an expression.
MARGIN = 2.0
DISCOUNT = 0.75
#: Labelled documents of this fold fit the logistic and not the counts.
CALIBRATION_FOLD = 3
#: A rare word backs off to its first letters, so many, before all rare words.
STEM = 5
THRESHOLD = 0.3
_WORDS = re.compile(r"[^\W_]+")
#: Words that a worker remembers, and texts that it holds as Python strings.
_KEPT, _AT_ONCE = 60_000, 500
#: Labelled texts whose words are counted together; Spark adds the counts up.
_COUNTED = 100
#: Pairs of words that a task holds before it passes them on.
_PAIRS = 1_000_000
#: Bits of a pair's hash, and bytes of text whose pairs one owner merges.
PAIR_BITS, OWNED_BYTES = 36, 4_000_000


def _stem(word: str) -> str:
    return "^" + word[:STEM]


def word_hashes(words: list[str]) -> np.ndarray:
    return np.array([_hash[w] for w in words], np.int64)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _KEPT:
            self.clear()
        data = word.encode("utf-8", "surrogatepass")
        value = self[word] = xxhash.xxh3_64_intdigest(data) >> 1
        return value


_hash = _Hashes()


def _hashed(words: list[str]) -> np.ndarray:
    of = xxhash.xxh3_64_intdigest
    return np.array([of(w.encode("utf-8", "surrogatepass")) >> 1 for w in words], np.int64)


def _places(entries: np.ndarray, words: list[str], hashes: np.ndarray) -> np.ndarray:
    """Index of each word among a model's entries, or of its stem, or their number."""

    def find(h: np.ndarray) -> np.ndarray:
        i = np.searchsorted(entries, h)
        hit = np.append(entries, -1)[i] == h
        return np.where(hit, i, len(entries))

    at = find(hashes)
    missing = np.flatnonzero(at == len(entries))
    at[missing] = find(_hashed([_stem(words[i]) for i in missing]))
    return at


@dataclass
class Model:
    """Probabilities of both classes by word, in arrays ordered by the words' hashes.

    Stems are words of their own. Index ``len(words)`` stands for every other word. ``pairs`` are ascending
    numbers ``previous * (len(words) + 1) + next``.
    """

    words: np.ndarray
    unigram: np.ndarray  # 2 x words: probability in the ordinary and the toxic class
    backoff: np.ndarray  # 2 x words: mass that a previous word leaves to the unigrams
    pairs: np.ndarray
    pair_mass: np.ndarray  # 2 x pairs
    weights: np.ndarray = field(default_factory=lambda: np.array([-3.0, 1.0, 0.0]))
    _index: dict[str, int] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_index": {}}

    def _learn(self, words: set[str]) -> None:
        """Puts the places of the words into the index."""
        new = list(words - self._index.keys())
        if len(self._index) + len(new) > _KEPT:
            self._index.clear()
            new = list(words)
        self._index.update(zip(new, _places(self.words, new, _hashed(new)).tolist(), strict=True))

    def all_features(self, texts) -> Iterator[np.ndarray]:
        """``features`` of each text; the words of some texts are looked up together."""
        for at in range(0, len(texts), 100):
            found = [_WORDS.findall((t or "").lower()) for t in texts[at : at + 100]]
            self._learn(set().union(*found))
            yield from map(self._features, found)

    def features(self, text: str | None) -> np.ndarray:
        """The mean log-likelihood ratio of a text's words, and their mean beyond the margin."""
        return next(self.all_features([text]))

    def _features(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(2)
        at = np.array([self._index[w] for w in words])
        p = self.unigram[:, at]
        p[:, 1:] *= self.backoff[:, at[:-1]]
        key = at[:-1] * (len(self.words) + 1) + at[1:]
        if len(self.pairs):
            where = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            p[:, 1:] += np.where(self.pairs[where] == key, self.pair_mass[:, where], 0)
        ratio = np.log(p[1]) - np.log(p[0])
        return np.array([ratio.mean(), np.maximum(ratio - MARGIN, 0).mean()])

    def score(self, text: str | None) -> float:
        return next(self.scores([text]))

    def scores(self, texts) -> Iterator[float]:
        for f in self.all_features(texts):
            z = self.weights[0] + f @ self.weights[1:]
            yield float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of words, stems and bigrams of labelled texts.

    Words have the previous word -1, stems -2.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, _COUNTED):
            part = batch.slice(at, _COUNTED)
            keys = []
            for i, (text, toxic) in enumerate(
                zip(part.column(0), part.column(1).to_pylist(), strict=True)
            ):
                words = _WORDS.findall((text.as_py() or "").lower())
                h, stems = word_hashes(words), word_hashes([_stem(x) for x in words])
                v = np.concatenate([np.full(len(h), -1), np.full(len(h), -2), h[:-1]])
                w = np.concatenate([h, stems, h[1:]])
                keys.append(np.stack([v, w, np.full(len(v), toxic), np.full(len(v), i)], axis=1))
            found = pd.DataFrame(np.concatenate(keys), columns=["v", "w", "toxic", "i"])
            each = found.value_counts(sort=False).reset_index(name="n")
            n = each.groupby(["v", "w", "toxic"], as_index=False).agg(n=("n", "sum"), docs=("n", "size"))
            yield pa.RecordBatch.from_pandas(n.astype("int64"), preserve_index=False)
            del keys, found, each, n
            give_back()
    _hash.clear()
    give_back()


def _continuations(words: np.ndarray, owners: int):
    """Distinct pairs of neighbouring words of the texts, as far as a task sees them.

    A pair is one number: ``PAIR_BITS`` bits of a hash of both words, above the model's
    index of the second. Each owner of a range of these numbers gets its part sorted and
    Golomb-Rice coded.
    """
    shift, starts = len(words).bit_length(), _owned(owners)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number, fresh, size = np.zeros(0, np.int64), _Numbers(), [], 0

        def merged() -> np.ndarray:
            names = list(number)
            hashes = _hashed(names)
            at = _places(words, names, hashes)
            before, after = (np.concatenate([x[k : len(x) - 1 + k] for x in fresh]) for k in (0, 1))
            key = (_pair_hashes(hashes[before], hashes[after]) << shift) | at[after]
            key = np.concatenate([held, key])
            key.sort()  # np.unique hashes, which takes far longer
            return key[np.append(True, key[1:] != key[:-1])]

        for batch in batches:
            for text in batch.column(0):
                found = _WORDS.findall((text.as_py() or "").lower())
                if len(found) < 2:
                    continue
                fresh.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
                size += len(found)
                if size >= _PAIRS // 4:
                    held, number, fresh, size = merged(), _Numbers(), [], 0
                    if len(held) >= _PAIRS:
                        yield _messages(held, starts << shift)
                        held = held[:0]
        if fresh:
            held = merged()
        yield _messages(held, starts << shift)
        give_back()

    return pairs


def _owned(owners: int) -> np.ndarray:
    """Where the owners' ranges of pair hashes start."""
    return np.array([-(-(j << PAIR_BITS) // owners) for j in range(owners)], np.int64)


def _messages(keys: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """One coded list for each owner that has any of the ascending keys."""
    cuts = np.append(np.searchsorted(keys, starts), len(keys))
    rows = []
    for owner in np.flatnonzero(np.diff(cuts)):
        part = (keys[cuts[owner] : cuts[owner + 1]] - starts[owner]).astype(np.uint64)
        rows.append((int(owner), len(part), *rice_encode(part)))
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["owner", "n", "k", "code"])


def _owner_counts(shift: int):
    """Distinct pairs of an owner's range, by the index of their second word."""

    def count(sent: pd.DataFrame) -> pd.DataFrame:
        keys = np.sort(np.concatenate([rice_decode(r.code, r.n, r.k) for r in sent.itertuples()]))
        # A range starts at a multiple of all indices, so these are the low bits still.
        keys = keys[np.append(True, keys[1:] != keys[:-1])] & np.uint64((1 << shift) - 1)
        word, n = np.unique(keys.astype(np.int64), return_counts=True)
        return pd.DataFrame({"word": word, "n": n})

    return count


def _pair_hashes(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A hash of each two words, from theirs."""
    mixed = (before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ after.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = len(self)
        return value


def continuations(texts: DataFrame, words: np.ndarray) -> np.ndarray:
    """For each of the model's words, after how many distinct words it comes in all texts.

    The last entry adds this up over every word that has no entry, a stem's over the
    words that back off to it. Counted without a bound; only the hash of a pair can
    unite two: of the pairs of a word with ``n`` predecessors about
    ``n ** 2 / 2 ** (PAIR_BITS + 1)``.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = max(parallelism(texts.sparkSession), -(-size // OWNED_BYTES))
    sent = texts.select("text").mapInArrow(
        _continuations(words, owners), "owner int, n int, k int, code binary"
    )
    owned = sent.groupBy("owner").applyInPandas(
        _owner_counts(len(words).bit_length()), "word long, n long"
    )
    seen = owned.groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    found = np.zeros(len(words) + 1, np.int64)
    found[seen.word.to_numpy(np.int64)] = seen.n.to_numpy(np.int64)
    return found


def _estimate(
    counts: pd.DataFrame, words: np.ndarray, shared: np.ndarray, tokens: np.ndarray
) -> Model:
    """Both models from the counts of words and bigrams and the shared continuations."""
    size = len(words) + 1

    def place(hashes: pd.Series) -> np.ndarray:
        i = np.searchsorted(words, hashes.to_numpy())
        i = np.minimum(i, max(0, len(words) - 1))
        known = (words[i] == hashes.to_numpy()) if len(words) else np.zeros(len(i), bool)
        return np.where(known, i, len(words))

    single, pairs = counts[counts.v < 0], counts[counts.v >= 0]
    unigram = np.zeros((2, size))
    np.add.at(unigram, (single.toxic.to_numpy(), place(single.w)), single.n.to_numpy())
    # All rare words together; stems count the words again that have an entry.
    unigram[:, -1] = np.maximum(tokens - unigram[:, :-1].sum(axis=1), 0.01 * tokens)
    totals = np.maximum(unigram.sum(axis=1, keepdims=True), 1)
    kept = np.maximum(unigram - DISCOUNT, 0)
    # What discounting leaves goes to the continuations both classes share.
    base = (kept + (unigram.sum(axis=1, keepdims=True) - kept.sum(axis=1, keepdims=True)) * shared)
    base = np.maximum(base / totals, 1e-12)
    key = place(pairs.v) * size + place(pairs.w)
    inner = (key < len(words) * size) & (key % size != len(words))
    key, number = np.unique(key[inner], return_inverse=True)
    mass = np.zeros((2, len(key)))
    np.add.at(mass, (pairs.toxic.to_numpy()[inner], number), pairs.n.to_numpy()[inner])
    left = np.maximum(mass - DISCOUNT, 0) / np.maximum(unigram[:, key // size], 1)
    backoff = np.ones((2, size))
    np.subtract.at(backoff, (slice(None), key // size), left)
    return Model(words, base, np.maximum(backoff, 1e-6), key, left)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, intercept first, by Newton's method."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(h, a.T @ (p - y) + 1e-2 * w)
    return np.append(w[0], w[1:] / scale)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = PER_CLASS,
) -> Model:
    """The two models of at most ``per_class`` labelled documents of each class.

    They come first in the order of their ids' hashes, and none is held out. The
    counts of continuations cover every text of ``docs``. Rows without id, text or
    label are not learnt from; without labelled rows every text scores alike.
    """
    spark = docs.sparkSession
    ship(spark)
    bound_batches(spark)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = labels.select(
        F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")
    ).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    chosen = (
        first_by_hash(marked.where(~held_out()).distinct(), "toxic", "doc_id", per_class)
        .select("doc_id", "toxic", (fold_of() == CALIBRATION_FOLD).alias("calibrates"))
        .dropDuplicates(["doc_id"])
    )
    # At most 2 * per_class rows of three small columns, whatever the tables.
    sample = texts.where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    # Copies would make their chance words look like expressions.
    sample = written(sample.withColumn("copy", F.xxhash64("text")), "sample")
    sample = sample.dropDuplicates(["copy", "toxic"])
    counted = sample.where("NOT calibrates").select("text", "toxic")
    counts = counted.mapInArrow(_count, "v long, w long, toxic long, n long, docs long")
    of = lambda c, column: F.sum(F.when(F.col("toxic") == c, F.col(column)).otherwise(0))
    both = counts.groupBy("v", "w").agg(
        of(0, "n").alias("n0"), of(1, "n").alias("n1"), F.sum("docs").alias("docs")
    )
    both = written(both, "counts")
    tokens = both.where("v = -1").agg(F.sum("n0"), F.sum("n1")).first()
    wide = both.where(F.col("docs") >= LEAST_DOCUMENTS).drop("docs").toPandas()
    wide = wide.sort_values(["v", "w"])
    words = np.unique(wide.loc[wide.v < 0, "w"].to_numpy(np.int64))
    shared = 0.5 + continuations(texts, words)
    narrow = pd.concat(
        [wide[["v", "w"]].assign(toxic=c, n=wide[f"n{c}"].astype("int64")) for c in (0, 1)]
    )
    model = _estimate(
        narrow[narrow.n > 0], words, shared / shared.sum(), np.array([n or 0 for n in tokens])
    )
    calibrating = sample.where("calibrates")
    rows = calibrating.select("toxic", _features(spark, model, F.col("text")).alias("f")).toPandas()
    if rows.toxic.nunique() == 2:
        model.weights = _logistic(np.stack(rows.f.to_numpy()), rows.toxic.to_numpy(float))
    return model


def _features(spark, model: Model, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series(list(shared.value.all_features(texts.tolist())))

    return features(text)


def score(docs: DataFrame, model: Model, text: Column) -> Column:
    """The score of a text column, from whole texts; NULL counts as empty."""
    ship(docs.sparkSession)
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out: list[float] = []
        for at in range(0, len(texts), _AT_ONCE):
            out += shared.value.scores(texts.slice(at, _AT_ONCE).to_pylist())
        give_back()
        return pa.array(out, pa.float64())

    return scored(text)


def score_documents(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A NULL or wordless text gets the score that no evidence gives. Every row is
    judged on its own, repeated ones and those with a NULL id too; columns besides
    the two named are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.select("doc_id", score(docs, model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
