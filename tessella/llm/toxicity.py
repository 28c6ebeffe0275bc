"""Toxicity by noisy-channel deobfuscation.

A character 4-gram model is counted over all texts. Places that look disguised (digits or signs inside words, letters set
apart, letters drawn out, look-alike letters) become lattices: each character may stand for itself, for the letters it
resembles, for a gap, or for nothing. Viterbi decoding over all states under the character model restores the text, and a logistic model
over the presence of telling words and word beginnings scores it.

Labels are learnt from a bounded sample of the labelled rows (``fit_rows``, expected size, chosen by hash); the character
model covers every text. Its table is bounded by the alphabet (28**4 cells), the classifier by ``n_features``.

Defined cases: a null text is empty and gets the score of a text without telling words; a row labelled twice is toxic if
either says so, null labels are ignored; equal texts of one label count once in the fit; with no usable labels the score is
0; other columns are carried along and never read (``score`` replaces one of its own name).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, give_back, materialise, slabs

SYMBOLS = 28  # 0 gap, 1-26 letters without accents, 27 any other letter
FIT_ROWS = 20_000
N_FEATURES = 192
#: Share of toxic texts among those with a telling word, from which the word counts as a sure one.
SURE = 0.85
#: Lengths of word beginnings that may tell, besides whole words.
STEMS = (3, 5, 7)
THRESHOLD = 0.7
_ORDER_WEIGHT = 4.0

#: Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e", "£": "l"}
#: Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans({"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "ο": "o", "α": "a", "ι": "i", "υ": "u", "ν": "v", "ρ": "p", "τ": "t", "κ": "k"})
#: Letters that a mask may stand for.
MASKED = "aeiou"
#: Channel scores (natural logarithms): a sign read as a letter, a sign or digit kept as a gap; a sign, a gap, the second
#: of a double letter or one of three and more dropped.
_AS_LETTER, _AS_GAP, _DROP_SIGN, _DROP_GAP, _DROP_DOUBLE, _DROP_DRAWN = -1.5, -1.0, -2.5, -1.0, -4.0, -0.3

_signs = "0-9@$!|+€£"
_letter = "[^\\W\\d_]"
_leet = re.compile(f"{_letter}[{_signs}*]+(?={_letter})|[{_signs}](?={_letter})|(?<={_letter})[0-9]+(?!\\w)")
_apart = re.compile(f"(?<!\\w)(?:[\\w@$!][ .\\-_*]{{1,2}}){{3,}}[\\w@$!](?!\\w)")
_drawn = re.compile(f"({_letter})\\1\\1+")
_run = re.compile("(.)\\1*", re.DOTALL)
_inside = re.compile(f"[\\w@$!|+€£*]")
_hidden = re.compile("[­​-‏⁠﻿]")
_words = re.compile(f"{_letter}+")
_exotic = re.compile("[^\\x00-ɏ]")


def _symbol(c: str) -> int:
    if not c.isalpha():
        return 0
    base = unicodedata.normalize("NFD", c.lower())[0]
    return ord(base) - 96 if "a" <= base <= "z" else 27


_CODES = np.array([_symbol(chr(i)) for i in range(0x250)] + [27], np.int32)


def grams(texts: pa.Array) -> np.ndarray:
    """Counts of the 4-grams of symbols; texts are apart from each other."""
    points = np.frombuffer("".join(["\n\n\n" + x for x in pc.fill_null(texts, "").to_pylist()] + ["\n"]).encode("utf-32-le"), np.uint32)
    x = _CODES[np.minimum(points, 0x250)]
    code = ((x[:-3] * SYMBOLS + x[1:-2]) * SYMBOLS + x[2:-1]) * SYMBOLS + x[3:]
    return np.bincount(code, minlength=SYMBOLS**4)


def character_model(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Natural logarithm of the next symbol's probability, by the three before it: counts of every text, interpolated."""
    attach(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**4, np.int64)
        for batch in batches:
            for slab in slabs(batch.column(0)):
                total += grams(slab)
            del batch, slab
            give_back(None)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])

    rows = df.select(F.col(text_col)).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SYMBOLS**4)
    counts[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    counts = counts.reshape((SYMBOLS,) * 4)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for axes in ((0, 1, 2), (0, 1), (0,), ()):
        n = counts.sum(axis=axes)
        p = (n + _ORDER_WEIGHT * p) / (n.sum(axis=-1, keepdims=True) + _ORDER_WEIGHT)
    return np.log(p).astype(np.float32).ravel()


#: Longest span whose states are walked one by one; longer ones have many states and go through arrays.
SHORT = 24


class Restorer:
    """Restores disguised places of a text under a character model."""

    def __init__(self, model: np.ndarray):
        self.model = memoryview(np.ascontiguousarray(model, np.float32))
        self.table = np.ascontiguousarray(model, np.float32).reshape((SYMBOLS,) * 4)
        self.decode = lru_cache(maxsize=50_000)(self._read)

    def _options(self, c: str, before: str, drawn: bool) -> list[tuple[int, str, float]]:
        repeat = (_DROP_DRAWN if drawn else _DROP_DOUBLE) if c == before else None
        if c.isalpha():
            own = [(_symbol(c), c, 0.0)]
            return own if repeat is None else [*own, (-1, "", repeat)]
        if c in LEET or c == "*":
            out = [(_symbol(x), x, _AS_LETTER) for x in LEET.get(c, MASKED)] + [(0, c, _AS_GAP)]
            return out + [(-1, "", _DROP_SIGN if repeat is None else repeat)]
        return [(0, " ", 0.0), (-1, "", _DROP_GAP)]

    def _decode(self, span: str) -> str:
        """The likeliest reading of a span, between gaps: Viterbi over all states (the last three symbols).

        A state keeps its best path as a chain of letters, which states share, so memory follows the span's length."""
        model, live, before = self.model, {0: (0.0, None)}, ""
        wrap = SYMBOLS**3
        run = [len(m[0]) for m in _run.finditer(span) for _ in m[0]]
        for c, n in [*zip(span, run, strict=True), ("\0", 1)]:
            options = [(0, "", 0.0)] if c == "\0" else self._options(c, before, n > 2)
            after: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, path) in live.items():
                for symbol, letter, cost in options:
                    if symbol < 0:
                        to, s = state, score + cost
                    else:
                        i = state * SYMBOLS + symbol
                        to, s = i % wrap, score + cost + model[i]
                    if to not in after or after[to][0] < s:
                        after[to] = (s, path if not letter else (letter, path))
            live, before = after, c
        path, letters = max(live.values(), key=lambda x: x[0])[1], []
        while path:
            letters.append(path[0])
            path = path[1]
        return "".join(reversed(letters))

    def _read(self, span: str) -> str:
        return self._decode(span) if len(span) <= SHORT else self._decode_dense(span)

    def _decode_dense(self, span: str) -> str:
        """``_decode`` for long spans: a step is one maximum over an array of all states of the symbols that the span can have.

        Scores are kept at the beginning of blocks, and a block's choices are made again on the way back, so memory grows with the
        square root of the span's length."""
        before, kinds, steps = "", {}, []
        run = [len(m[0]) for m in _run.finditer(span) for _ in m[0]]
        for c, n in zip(span, run, strict=True):
            key = (c, c == before, n > 2)
            if key not in kinds:
                kinds[key] = self._options(c, before, n > 2)
            steps.append(key)
            before = c
        kinds["end"] = [(0, "", 0.0)]
        steps.append("end")
        alphabet = sorted({0, *(s for o in kinds.values() for s, _, _ in o if s >= 0)})
        sub = self.table[np.ix_(*[alphabet] * 4)].astype(np.float64)
        m, plans = len(alphabet), {}
        for key, options in kinds.items():
            best: dict[int, tuple[float, str]] = {}
            for symbol, letter, cost in options:
                if symbol >= 0 and (symbol not in best or best[symbol][0] < cost):
                    best[symbol] = (cost, letter)
            at = [alphabet.index(s) for s in best]
            drops = [cost for symbol, _, cost in options if symbol < 0]
            letters = dict(zip(at, [letter for _, letter in best.values()], strict=True))
            plans[key] = (np.array(at), sub[:, :, :, at] + np.array([cost for cost, _ in best.values()]), max(drops, default=None), letters)

        def step(score: np.ndarray, key) -> tuple[np.ndarray, np.ndarray]:
            at, costs, drop, _ = plans[key]
            new = np.full((m, m, m), -np.inf) if drop is None else score + drop
            back = np.full((m, m, m), 255, np.uint8)
            met = score[:, :, :, None] + costs
            first = met.argmax(axis=0)
            top = np.take_along_axis(met, first[None], axis=0)[0]
            here = new[:, :, at]
            better = top > here
            new[:, :, at] = np.where(better, top, here)
            back[:, :, at] = np.where(better, first, 255)
            return new, back

        size = math.isqrt(8 * len(steps)) + 1
        score, starts = np.full((m, m, m), -np.inf), []
        score[0, 0, 0] = 0.0
        for i, key in enumerate(steps):
            if i % size == 0:
                starts.append(score)
            score = step(score, key)[0]
        state = tuple(int(v) for v in np.unravel_index(score.argmax(), score.shape))
        out: list[str] = []
        for b in range(len(starts) - 1, -1, -1):
            score, backs, block = starts[b], [], steps[b * size : (b + 1) * size]
            for key in block:
                score, back = step(score, key)
                backs.append(back)
            for key, back in zip(reversed(block), reversed(backs), strict=True):
                code = int(back[state])
                if code != 255:
                    out.append(plans[key][3][state[2]])
                    state = (code, state[0], state[1])
        return "".join(reversed(out))

    def restore(self, text: str) -> str:
        """Lower-cased text with its disguised places read as the model reads them."""
        low = text.lower()
        if _exotic.search(low):
            low = unicodedata.normalize("NFKC", _hidden.sub("", low)).translate(LOOKALIKES).lower()
        elif "­" in low:
            low = low.replace("­", "")
        spans = []
        for found in (_leet, _drawn):
            done = -1
            for m in found.finditer(low):
                if m.start() < done:
                    continue
                a, b = m.start(), m.end()
                while a > 0 and _inside.match(low, a - 1):
                    a -= 1
                while b < len(low) and _inside.match(low, b):
                    b += 1
                done = b
                while b > m.end() and low[b - 1] in "!$|+*@":
                    b -= 1
                spans.append((a, b))
        for m in _apart.finditer(low):
            if len(set(m[0])) > 3:
                spans.append(m.span())
        if not spans:
            return low
        spans.sort()
        out, end = [], 0
        for i, (a, b) in enumerate(spans):
            a = max(a, end)
            while i + 1 < len(spans) and spans[i + 1][0] < b < spans[i + 1][1]:
                b = spans[i + 1][1]
                i += 1
            if a >= b:
                continue
            out += [low[end:a], " ", self.decode(low[a:b]) if b - a <= 256 else self._read(low[a:b]), " "]
            end = b
        return "".join(out) + low[end:]

    def words(self, text: str) -> set[str]:
        """Distinct words of the restored text."""
        return set(_words.findall(self.restore(text)))


def with_stems(words: set[str], stems: tuple[int, ...] = STEMS) -> set[str]:
    """Words, and their beginnings marked by a star."""
    return words.union(*[{w[:k] + "*" for w in words if len(w) > k} for k in stems])


class Classifier(NamedTuple):
    """Character model, telling words (or beginnings, with a star) with their weights, and the constant."""

    model: np.ndarray
    weights: dict[str, float]
    constant: float
    sure: frozenset[str] = frozenset()
    any_sure: float = 0.0

    def probability(self, telling: set[str]) -> float:
        """Of telling words that are present. One sure word moves the score by itself, whatever comes with it."""
        z = self.constant + sum(self.weights[w] for w in sorted(telling)) + (self.any_sure if telling & self.sure else 0.0)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _logistic(rows: list[tuple[list[int], int, int]], n_features: int, ridge: float = 0.1, steps: int = 25) -> np.ndarray:
    """Weights (constant last) by Newton steps on grouped rows (features present, label, count)."""
    x = np.zeros((len(rows), n_features + 1))
    for i, (present, _, _) in enumerate(rows):
        x[i, present] = 1
    x[:, -1] = 1
    y, n = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    penalty = np.full(n_features + 1, ridge)
    penalty[-1] = 1e-6
    w = np.zeros(n_features + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + penalty * w
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", usable=None, fit_rows: int = FIT_ROWS, n_features: int = N_FEATURES, min_texts: int = 5, model: np.ndarray | None = None) -> Classifier:
    """Learn from the labelled rows that ``usable`` (a condition on the id, say) allows.

    Only ids and labels of the sample are broadcast: ``fit_rows`` of them, as expected by hash."""
    attach(df.sparkSession)
    model = character_model(df, text_col) if model is None else model
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_y is not null and _id is not null")
    if usable is not None:
        marked = marked.where(usable(F.col("_id")))
    marked = marked.groupBy("_id").agg(F.max("_y").alias("_y"))
    n = marked.count()
    if n > fit_rows:
        marked = marked.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(fit_rows / n * (1 << 20)))
    sample = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")).join(F.broadcast(marked), "_id")

    def restored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restorer = Restorer(model)
        for batch in batches:
            out = pa.array([sorted(with_stems(restorer.words(x.as_py()))) for x in batch], pa.list_(pa.string()))
            del batch
            yield give_back(out)

    seen = materialise(sample.select("_y", F.xxhash64("_t").alias("_h"), F.arrow_udf(restored, "array<string>")(F.col("_t")).alias("words")).dropDuplicates(["_y", "_h"]), "fit")
    totals = seen.agg(F.count("*").alias("n"), F.sum("_y").alias("pos")).first()
    if not totals.n or not totals.pos or totals.pos == totals.n:
        return Classifier(model, {}, -50.0 if not totals.pos else 50.0)
    pos, neg = float(totals.pos), float(totals.n - totals.pos)
    by_word = seen.select("_y", F.explode("words").alias("word")).groupBy("word").agg(F.sum("_y").alias("p"), F.sum(1 - F.col("_y")).alias("q")).where(F.col("p") + F.col("q") >= min_texts)
    share = (F.col("p") + F.col("q")) / (pos + neg)
    chi = F.pow(F.col("p") - pos * share, 2) / (pos * share * (1 - share) + 1e-9) * F.signum(F.col("p") / pos - F.col("q") / neg)
    top = by_word.select("word", "p", "q", chi.alias("chi")).orderBy(F.desc("chi"), "word").limit(n_features).collect()
    at = {r.word: i for i, r in enumerate(top)}
    sure = frozenset(r.word for r in top if (r.p + 0.5) / (r.p + r.q + 1) >= SURE)
    names = F.array(*[F.lit(w) for w in at])
    grouped = seen.select("_y", F.array_sort(F.array_intersect("words", names)).alias("present")).groupBy("present", "_y").count().collect()
    any_at = len(at)
    w = _logistic([([at[x] for x in r.present] + [any_at] * bool(sure.intersection(r.present)), r._y, r["count"]) for r in grouped], len(at) + 1).tolist()
    return Classifier(model, dict(zip(at, w, strict=False)), w[-1], sure, w[any_at])


def score_column(classifier: Classifier, text_col: str = "text"):
    """Probability that a text is toxic."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restorer, telling = Restorer(classifier.model), frozenset(classifier.weights)
        stems = tuple(sorted({len(w) - 1 for w in telling if w[-1] == "*"}))
        for batch in batches:
            out = [classifier.probability(telling & with_stems(restorer.words(x.as_py() or ""), stems)) for x in batch]
            del batch
            yield give_back(pa.array(out, pa.float64()))

    return F.arrow_udf(run, "double")(F.col(text_col))


def restore_column(classifier: Classifier, text_col: str = "text"):
    """The restored text."""
    model = classifier.model

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restorer = Restorer(model)
        for batch in batches:
            out = pa.array([None if (text := x.as_py()) is None else restorer.restore(text) for x in batch], pa.string())
            del batch
            yield give_back(out)

    return F.arrow_udf(run, "string")(F.col(text_col))


def score(df: DataFrame, classifier: Classifier, text_col: str = "text", into: str = "score") -> DataFrame:
    attach(df.sparkSession)
    return df.withColumn(into, score_column(classifier, text_col))


def keep_clean(df: DataFrame, classifier: Classifier, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with their own columns."""
    attach(df.sparkSession)
    return df.where(score_column(classifier, text_col) < threshold)
