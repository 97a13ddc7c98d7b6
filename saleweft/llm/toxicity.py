"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. Every
window of a document is compressed with the ordinary dictionary, and with the ordinary
and the toxic one together: the bytes saved say how much toxic text explains of the
window. Because the second dictionary holds the first, prose that both know saves
nothing, whatever its language.

Toxic training text is what marks toxic documents: words that far more groups of toxic
documents use than chance allows, in the order they stand. Documents with the same
least word hash count once, so a much copied document does not choose the words.

Window thresholds and the weights of a document's figures (most bytes saved, windows
over the threshold) are calibrated on rows of the sample that train neither dictionary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from .common import add_score, labelled_sample
from .words import Words, find_words, joined, lanes, lower_ascii, text_chunks, word_hashes

SAMPLE_ROWS = 8000
WINDOW_WORDS, WINDOW_STEP = 4, 3
DICTIONARY_BYTES = 8192
LEVEL = 19
_GRAM = np.uint64((1 << 40) - 1)
_CALIBRATION = 3  # every third row of the sample calibrates, the others train the dictionaries
_SAMPLE_WORDS, _SAMPLES = 16, 10  # training samples of an ordinary document, spread over its whole text


@dataclass
class ToxicityModel:
    """Two dictionaries, the window threshold, and the weights of a document's figures."""

    ordinary: bytes
    toxic: bytes
    threshold: int
    weights: np.ndarray

    def scorer(self):
        """A function from whole texts to scores from 0 to 1."""
        meters = []

        def score(texts: list[bytes | None]) -> np.ndarray:
            if not meters:
                meters.append(_Meter(self.ordinary, self.toxic))
            return _logistic(_figures(*meters[0].saved(texts), len(texts), self.threshold) @ self.weights)

        return score


class _Meter:
    """Bytes that the toxic dictionary saves on each window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.plain, self.both = _compressor(ordinary), _compressor(toxic + ordinary)
        grams, known = _grams(toxic), _grams(ordinary)
        self.grams = grams[~np.isin(grams, known)]

    def saved(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Saved bytes of the windows that can save any, and the text of each.

        A window that shares no five bytes with the toxic dictionary beyond what the
        ordinary one has as well cannot be shortened by it and counts as 0.
        """
        data, at = joined(texts)
        data = lower_ascii(data)
        words = find_words(data, at)
        n = -(-np.maximum(words.count - WINDOW_WORDS, 0) // WINDOW_STEP) + (words.count > 0)
        owner = np.repeat(np.arange(len(texts)), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        first = words.first[owner] + step * WINDOW_STEP
        last = np.minimum(first + WINDOW_WORDS, words.first[owner] + words.count[owner]) - 1
        begin, stop = np.maximum(words.start[first] - 1, 0), words.end[last] + 1
        hits = np.concatenate([[0], np.cumsum(self._marked(data))])
        open_ = hits[stop] > hits[begin]
        begin, stop, owner = begin[open_], stop[open_], owner[open_]
        saved = _sizes(self.plain, data, begin, stop) - _sizes(self.both, data, begin, stop)
        return saved, owner

    def _marked(self, data: np.ndarray) -> np.ndarray:
        """Positions from which five bytes of the toxic dictionary stand."""
        if not len(self.grams):
            return np.zeros(len(data), bool)
        values = lanes(data)[:len(data)] & _GRAM
        bits = (values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
        table = np.zeros(1 << 20, bool)
        table[(self.grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)] = True
        return table[bits]


def _grams(data: bytes) -> np.ndarray:
    values = lanes(np.frombuffer(data, np.uint8)) & _GRAM
    return np.unique(values[:max(0, len(data) - 4)])


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parts = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parts)
    return zstandard.ZstdCompressor(compression_params=parts, dict_data=dictionary)


def _sizes(compressor: zstandard.ZstdCompressor, data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Compressed length of each window."""
    raw = data.tobytes()
    return np.fromiter((len(compressor.compress(raw[a:b])) for a, b in zip(begin.tolist(), stop.tolist())),
                       np.int64, len(begin))


def _figures(saved: np.ndarray, owner: np.ndarray, n: int, threshold: int) -> np.ndarray:
    """Per text: 1, the most bytes saved, and how many windows pass the threshold."""
    most = np.zeros(n)
    np.maximum.at(most, owner, saved)
    over = np.bincount(owner, saved >= threshold, n)
    return np.stack([np.ones(n), np.minimum(most, 24) / 8, np.log1p(over)], axis=1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(figures: np.ndarray, label: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights by Newton steps; the first column is the constant and is not shrunk."""
    weights, shrink = np.zeros(figures.shape[1]), ridge * np.eye(figures.shape[1])
    shrink[0, 0] = 1e-6
    for _ in range(40):
        p = _logistic(figures @ weights)
        gradient = figures.T @ (p - label) + shrink @ weights
        curve = (figures * (p * (1 - p))[:, None]).T @ figures + shrink
        weights = weights - np.linalg.solve(curve, gradient)
    return weights


def _word_groups(texts: list[bytes]) -> tuple[dict[int, int], int]:
    """How many groups of like texts use each word, and the number of groups."""
    pairs = []
    for part in text_chunks(texts):
        data, at = joined(texts[part])
        words = find_words(lower_ascii(data), at)
        hashes = word_hashes(words)
        least = np.full(len(words.count), np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, words.text, hashes * np.uint64(0xD6E8FEB86659FD93))
        pairs.append(np.unique(np.stack([hashes, least[words.text]], axis=1), axis=0))
    every = np.unique(np.concatenate(pairs), axis=0)
    seen, count = np.unique(every[:, 0], return_counts=True)
    return dict(zip(seen.tolist(), count.tolist())), len(np.unique(every[:, 1]))


def _spelled(texts: list[bytes], wanted: set[int]) -> set[bytes]:
    """The words of some hashes."""
    out, hashes = set(), np.array(sorted(wanted), np.uint64)
    for part in text_chunks(texts):
        data, at = joined(texts[part])
        words = find_words(lower_ascii(data), at)
        for i in np.flatnonzero(np.isin(word_hashes(words), hashes)).tolist():
            out.add(words_at(words, i))
    return out


def words_at(words: Words, i: int) -> bytes:
    return words.data[words.start[i]:words.end[i]].tobytes()


def _marking_words(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    """Words of at least one in sixty toxic groups, ten deviations above their ordinary share."""
    seen, n = _word_groups(toxic)
    usual, m = _word_groups(ordinary)
    out = set()
    for word, count in seen.items():
        share = (usual.get(word, 0) + 1) / (m + 2)
        if count >= max(3, n / 60) and (count - n * share) > 10 * np.sqrt(n * share * (1 - share)):
            out.add(word)
    return _spelled(toxic, out)


def _split(text: bytes) -> list[bytes]:
    return lower_ascii(np.frombuffer(text, np.uint8)).tobytes().split()


def _trained(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train one."""
    if sum(map(len, samples)) <= size:
        return b"".join(samples)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label: str = "toxic", most: int = SAMPLE_ROWS) -> ToxicityModel | None:
    """The model from at most ``most`` labelled rows; None without examples of both kinds."""
    texts, marks = labelled_sample(docs, labels, label, most, id_col, text_col)
    taught = [(t, m) for k, (t, m) in enumerate(zip(texts, marks)) if k % _CALIBRATION]
    toxic, ordinary = (sorted({t for t, m in taught if m == kind}) for kind in (1, 0))
    if not toxic or not ordinary:
        return None
    marking = _marking_words(toxic, ordinary)
    usual = [b" ".join(w[k:k + _SAMPLE_WORDS]) + b" " for w in map(_split, ordinary)
             for k in range(0, len(w), max(_SAMPLE_WORDS, len(w) // _SAMPLES))]
    marked = [m for m in ([w for w in _split(t) if w in marking] for t in toxic) if m]
    model = ToxicityModel(_trained(usual, DICTIONARY_BYTES),
                          _trained([b" " + b" ".join(m) + b" " for m in marked], DICTIONARY_BYTES), 3, np.zeros(3))
    texts, marks = texts[::_CALIBRATION], marks[::_CALIBRATION]
    meter, best = _Meter(model.ordinary, model.toxic), -np.inf
    measured = [(meter.saved(texts[p]), p.stop - p.start) for p in text_chunks(texts)]
    for threshold in range(1, 11):
        figures = np.concatenate([_figures(saved, owner, n, threshold) for (saved, owner), n in measured])
        weights = fit_logistic(figures, marks)
        p = np.clip(_logistic(figures @ weights), 1e-9, 1 - 1e-9)
        likelihood = float(np.mean(np.where(marks == 1, np.log(p), np.log(1 - p))))
        if likelihood > best:
            best, model.threshold, model.weights = likelihood, threshold, weights
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` and ``out``, 0 to 1, higher where toxic is likelier.

    Whole texts are scored. Null and empty texts save no bytes and get the score of that.
    Equal texts get equal scores. Without a model every score is 0. An empty table
    gives an empty table. ``out`` must be a new column name.
    """
    if model is None:
        return add_score(docs, text_col, out, lambda texts: np.zeros(len(texts)))
    return add_score(docs, text_col, out, model.scorer())
