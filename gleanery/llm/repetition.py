"""Repetition inside a single document: the share of its words that repeat earlier ones.

A logistic regression on hashed word and character n-grams scores every document in Arrow
batches. A bag of n-grams tells what a document is about and not whether it repeats
itself, so the features are, for each length of n-gram, the share of the document's
hashed n-grams that it has already had. The regression is fitted on a bounded sample of
rows that the exact count labels, calibrated on the half of the sample it was not fitted
on, and its probability is held against a fixed threshold. What passes is counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in the shortest run that counts, and the share from which a document is reported.
RUN, SHARE = 6, 0.3
#: Lengths of the n-grams of words and of characters.
WORD_GRAMS, CHAR_GRAMS = (1, 2, 3, 4, 6, 8, 12), (8, 16, 32)
#: Rows of the labelled sample, at most.
SAMPLE = 20_000
#: A document of this probability or more is counted exactly; one below it is not reported.
THRESHOLD = 0.001
#: Characters that are hashed at a time.
CHUNK = 300_000
_SIGNS = regex.compile(r"[^\p{L}\p{N}]+")


def words_of(text: str) -> list[str]:
    """Pieces between white space, lower-cased and reduced to letters and digits; empty ones dropped.

    >>> words_of("It's  12.5 -- Über!")
    ['its', '125', 'über']
    """
    low = text.lower()
    if low.isascii() and low.replace(" ", "").isalnum():
        return low.split()
    return [w for w in (p if p.isalnum() else _SIGNS.sub("", p) for p in low.split()) if w]


def repeated_words(words: list[str], run: int = RUN) -> int:
    """How many words lie in runs of ``run`` or more that already occurred, starting earlier."""
    n = len(words) - run + 1
    if n < 2 or len(set(words)) == len(words):
        return 0
    seen: set = set()
    add, total, until = seen.add, 0, 0
    for i, gram in enumerate(zip(*(words[k:] for k in range(run)))):
        if gram in seen:
            total += i + run - max(i, until)
            until = i + run
        else:
            add(gram)
    return total


def _repeats(codes: np.ndarray, owner: np.ndarray, n_docs: int, sizes: Sequence[int]) -> np.ndarray:
    """For each document and each n of ``sizes`` the share of its hashed n-grams that it has already had.

    ``codes`` are the words or characters of all documents in a row, ``owner`` the
    document of each.
    """
    have = {1: (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)}

    def hashed(size: int) -> np.ndarray:
        if size not in have:  # of two halves, which overlap if the size is odd
            half = (size + 1) // 2
            h, n = hashed(half), max(len(codes) - size + 1, 0)
            mixed = (h[:n] * np.uint64(0x9E3779B97F4A7C15)) ^ h[size - half :][:n]
            mixed *= np.uint64(0x94D049BB133111EB)
            mixed ^= mixed >> np.uint64(29)
            have[size] = mixed
        return have[size]

    out = []
    for size in sizes:
        h = hashed(size)
        n = len(h)
        inside = owner[:n] == owner[size - 1 :][:n]
        doc = owner[:n][inside]
        # The document in the upper bits, so that sorting keeps documents apart.
        keys = np.sort((doc.astype(np.uint64) << np.uint64(40)) | (h[inside] >> np.uint64(24)))
        first = np.ones(len(keys), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        distinct = np.bincount((keys[first] >> np.uint64(40)).astype(np.int64), minlength=n_docs)
        total = np.bincount(doc, minlength=n_docs)
        out.append(1 - distinct / np.maximum(total, 1) - (total == 0))
    return np.stack(out, axis=1) if out else np.zeros((n_docs, 0))


def features(docs: list[list[str]]) -> np.ndarray:
    """The features of documents given as words: one row each, all between 0 and 1.

    >>> features([["a", "b"] * 40, [str(k) for k in range(40)]])[:, 0].round(3).tolist()
    [0.975, 0.0]
    """
    texts = [" ".join(d) for d in docs]
    sizes, lengths = (np.array([len(x) for x in xs], dtype=np.int64) for xs in (docs, texts))
    out = [np.zeros((0, len(WORD_GRAMS) + len(CHAR_GRAMS)))]
    # So many characters at a time that the hashes fit a worker; a longer text goes alone.
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(np.cumsum(lengths) // CHUNK)) + 1, [len(docs)]))
    for a, b in zip(cuts, cuts[1:]):
        n = b - a
        words = [w for d in docs[a:b] for w in d]
        codes = pd.factorize(np.array(words, dtype=object))[0] if words else np.zeros(0, dtype=np.int64)
        chars = np.frombuffer("".join(texts[a:b]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        owners = (np.repeat(np.arange(n), x[a:b]) for x in (sizes, lengths))
        out.append(np.hstack([_repeats(c, o, n, grams) for c, o, grams in zip((codes, chars), owners, (WORD_GRAMS, CHAR_GRAMS))]))
    return np.vstack(out)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _regress(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Coefficients of a logistic regression, the constant last, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(60):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Classifier:
    """Calibrated probability that the share of repeated words of a document reaches SHARE."""

    weights: np.ndarray
    scale: tuple[float, float]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Classifier:
        """Fit on one half of the rows, in an order drawn once, and calibrate on the other.

        Two rows that hold by definition are added to each half, so that there is a model
        for any sample: no n-gram repeats and all do.
        """
        ends, truth = np.array([[0.0] * x.shape[1], [1.0] * x.shape[1]]), np.array([0.0, 1.0])
        order = np.random.default_rng(1).permutation(len(x))
        halves = order[0::2], order[1::2]
        one, two = (np.vstack([x[h], ends]) for h in halves)
        w = _regress(one, np.concatenate([y[halves[0]], truth]), 1e-2)
        z = two @ w[:-1] + w[-1]
        # Platt's targets keep the calibration finite where the classes part cleanly.
        y2 = np.concatenate([y[halves[1]], truth])
        high, low = y2.sum(), len(y2) - y2.sum()
        slope, shift = _regress(z[:, None], np.where(y2 > 0, (high + 1) / (high + 2), 1 / (low + 2)), 1e-6)
        return cls(w, (float(slope), float(shift)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid((x @ self.weights[:-1] + self.weights[-1]) * self.scale[0] + self.scale[1])


def labelled_sample(df: DataFrame, key: str, text: str, rows: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and exact labels of at most ``rows`` documents, chosen by a hash of their key.

    Only features and labels come to the driver: at most ``rows`` times eleven numbers.
    """
    n = df.count()
    if not n:
        return np.zeros((0, len(WORD_GRAMS) + len(CHAR_GRAMS))), np.zeros(0)
    near = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit("sample")), F.lit(1 << 32)) < int(min(1.0, 1.2 * rows / n) * (1 << 32))
    names = [f"x{k}" for k in range(len(WORD_GRAMS) + len(CHAR_GRAMS))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            docs = [words_of(t) if t else [] for t in pdf["__text"]]
            out = pd.DataFrame(features(docs), columns=names)
            out["y"] = [float(len(d) > 0 and repeated_words(d) >= SHARE * len(d)) for d in docs]
            yield out

    got = df.where(near).select(F.col(f"`{text}`").alias("__text")).mapInPandas(run, ", ".join(f"{c} double" for c in [*names, "y"])).limit(rows).toPandas()
    return got[names].to_numpy(), got.y.to_numpy()


def repetitive(df: DataFrame, key: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """key, probability, n_words, n_repeated and share of every document that repeats itself.

    These are the documents that the classifier gives ``threshold`` or more and of which
    the exact count then finds a share of SHARE or more. Null and blank texts have no words
    and are none. Whole texts are read, of any length.
    """
    shared = df.sparkSession.sparkContext.broadcast(Classifier.fit(*labelled_sample(df, key, text)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            docs = [words_of(t) if t else [] for t in pdf["__text"]]
            p = shared.value.probability(features(docs))
            rows = [k for k in np.flatnonzero(p >= threshold) if docs[k]]
            n = np.array([len(docs[k]) for k in rows], dtype=np.int64)
            r = np.array([repeated_words(docs[k]) for k in rows], dtype=np.int64)
            out = pd.DataFrame({key: pdf[key].to_numpy()[rows], "probability": p[rows], "n_words": n, "n_repeated": r, "share": r / np.maximum(n, 1)})
            yield out[out.share >= SHARE]

    kind = df.select(f"`{key}`").schema[0].dataType.simpleString()
    return df.select(f"`{key}`", F.col(f"`{text}`").alias("__text")).mapInPandas(score, f"`{key}` {kind}, probability double, n_words long, n_repeated long, share double")


def repetition(df: DataFrame, key: str, text: str, run: int = RUN) -> DataFrame:
    """key, n_words, n_repeated and share of every document, counted exactly in Arrow batches.

    Null and blank texts have no words and share 0. Whole texts are read, of any length.
    """

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words = [words_of(t) if t else [] for t in pdf["__text"]]
            n = np.array([len(w) for w in words], dtype=np.int64)
            r = np.array([repeated_words(w, run) for w in words], dtype=np.int64)
            yield pd.DataFrame({key: pdf[key], "n_words": n, "n_repeated": r, "share": r / np.maximum(n, 1)})

    kind = df.select(f"`{key}`").schema[0].dataType.simpleString()
    return df.select(f"`{key}`", F.col(f"`{text}`").alias("__text")).mapInPandas(score, f"`{key}` {kind}, n_words long, n_repeated long, share double")
