"""Quality by Bradley-Terry pairwise ranking.

A document's score is a weighted sum of its text's figures. The weights are learned
from preference pairs, a good document preferred to a poor one: the chance that it wins
is the logistic of the score difference, so the fit is a logistic loss on figure
differences. The threshold is a quantile of the sample's scores: the share of poor
documents in the sample lies below it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import add_score, labelled_sample
from .words import Words, find_words, gram_hashes, gram_starts, joined, lower_ascii, text_chunks, word_hashes

SAMPLE_ROWS = 8000
PAIRS = 40_000
CUT = 0.3

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_SIGN = np.zeros(256, bool)
_SIGN[list(b"#$%&*+/<=>@\\^_`{|}~[]")] = True
_CALL = np.zeros(256, bool)
_CALL[list(b"!")] = True


@dataclass
class QualityModel:
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def scorer(self):
        """A function from whole texts to scores from 0 to 1; the threshold is ``CUT``."""
        shift = np.log(CUT / (1 - CUT))

        def score(texts: list[bytes | None]) -> np.ndarray:
            raw = _standard(text_figures(texts), self.centre, self.spread) @ self.weights
            return 1 / (1 + np.exp(-np.clip(raw - self.threshold + shift, -30, 30)))

        return score


def text_figures(texts: list[bytes | None]) -> np.ndarray:
    """One row of figures per text: shares of letters, capitals, signs and repeats, and lengths."""
    data, at = joined(texts)
    words = find_words(data, at)
    size = np.diff(np.append(at, len(data))) - 1
    n, m = np.maximum(words.count, 1), np.maximum(size, 1)

    def share(kind: np.ndarray) -> np.ndarray:
        return np.add.reduceat(kind[data].astype(np.int64), at) / m

    letters = share(_LETTER)
    hashes = word_hashes(Words(lower_ascii(data), words.start, words.end, words.text, words.count))
    same = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    last = data[words.end - 1] if len(hashes) else data[:0]
    first = data[words.start] if len(hashes) else data[:0]
    length = (words.end - words.start).astype(float)

    def of_words(values: np.ndarray) -> np.ndarray:
        return np.bincount(words.text, values, len(texts)) / n

    mean = of_words(length)
    deviation = np.sqrt(np.maximum(of_words(length ** 2) - mean ** 2, 0))
    figures = [
        letters, share(_UPPER), share(_DIGIT), share(_SIGN), share(_CALL), share(_STOP),
        np.add.reduceat((data == 10).astype(np.int64), at) / n, mean, deviation,
        of_words(same), _distinct_share(hashes, words.text, words.count, len(texts)),
        _distinct_share(*_grams(words, hashes, 3), len(texts)),
        of_words(_SIGN[last]), of_words(_STOP[last]), of_words(_UPPER[first]),
        of_words(length <= 3), of_words(length >= 13), of_words(~_LETTER[first]),
        np.log1p(words.count), (words.count == 0).astype(float)]
    x = np.stack(figures, axis=1)
    return np.concatenate([x, np.sqrt(np.maximum(x, 0)), x > 0], axis=1)


def _grams(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = gram_starts(words, n)
    owner = words.text[starts]
    return gram_hashes(hashes, n)[starts], owner, np.bincount(owner, minlength=len(words.count))


def _distinct_share(hashes: np.ndarray, owner: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each text over all its values; 1 for none."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.where(count > 0, np.bincount(o, new, n) / np.maximum(count, 1), 1.0)


def _standard(x: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((x - centre) / spread, -4, 4)


def fit_bradley_terry(difference: np.ndarray, ridge: float = 3.0) -> np.ndarray:
    """Weights that make winners score above losers, by Newton steps on the logistic loss."""
    weights = np.zeros(difference.shape[1])
    for _ in range(30):
        lose = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
        gradient = -difference.T @ lose + ridge * weights
        curve = (difference * (lose * (1 - lose))[:, None]).T @ difference + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label: str = "quality", most: int = SAMPLE_ROWS, pairs: int = PAIRS) -> QualityModel | None:
    """The model from at most ``most`` labelled rows and ``pairs`` preference pairs.

    Pairs are drawn with a fixed seed. None without examples of both kinds.
    """
    texts, marks = labelled_sample(docs, labels, label, most, id_col, text_col)
    good, poor = np.flatnonzero(marks == 1), np.flatnonzero(marks == 0)
    if not len(good) or not len(poor):
        return None
    x = np.concatenate([text_figures(texts[p]) for p in text_chunks(texts)])
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = _standard(x, centre, spread)
    random = np.random.default_rng(7)
    winners, losers = random.choice(good, pairs), random.choice(poor, pairs)
    weights = fit_bradley_terry(z[winners] - z[losers])
    return QualityModel(centre, spread, weights, float(np.quantile(z @ weights, len(poor) / len(marks))))


def score_quality(docs: DataFrame, model: QualityModel | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` and ``out``, 0 to 1, higher for better text; ``CUT`` is the quantile threshold.

    Whole texts are scored. Null and empty texts have the figures of no words. Equal
    texts get equal scores. Without a model every score is 0. An empty table gives an
    empty table. ``out`` must be a new column name.
    """
    if model is None:
        return add_score(docs, text_col, out, lambda texts: np.zeros(len(texts)))
    return add_score(docs, text_col, out, model.scorer())
