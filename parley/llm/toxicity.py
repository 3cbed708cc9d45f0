"""Operator 6: toxicity by a support vector machine on a subsequence string kernel, with Nystrom landmarks.

Kernel of two words: the weighted number of common subsequences of ``P`` = 3 letters, a subsequence
that spans n places weighing ``DECAY`` ** n, divided by the geometric mean of the words' own values. It
stays high for words with letters inserted or left out; signs inside a word are dropped before, and
runs of three or more single letters are read as one word. A word's value at a landmark is the third power of the
kernel (``POWER``; a power of a kernel is a kernel), so many remote likenesses do not add up to a near one.
Kernels below ``FLOOR`` count as 0; no other filter changes a value. On sf0.1 at 0.3, a letter inserted into one of the 20
first landmarks leaves 100 % of the forms above the floor, two letters 90 %, three 68 % (at 0.5: 94, 53 and 36 %).

Landmarks are words of ``P`` to ``LONGEST`` / 2 letters of the training documents, in ``MIN_DOCS`` toxic ones at least: of the
``CANDIDATES`` that most set toxic documents apart, each chosen to be unlike the ones before. A sentence's value at a landmark is
that of its nearest word, a document's is log(1 + the sum over its sentences); the Nystrom map (inverse square root of the
landmarks' kernel matrix, without the floor) makes these the features of a linear machine with squared hinge loss, whose margin a
logistic curve turns into the score. Words above ``LONGEST`` letters are read as overlapping parts of that length, each a word
of its own, as an insult in a run of signs or letters should not be measured against the whole run.
Labels sit on documents, so a training sentence counts through the
document it is in.

Training uses at most ``max_docs`` labelled documents (those with the smallest hash of the id); everything
is scored. Defined results: null, empty and wordless texts get the score of a document without any match;
without both classes among the training rows all scores are 0; a repeated label row of an id counts
once, toxic if any says so; all columns of the scored table are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, blocks, texts_of

P = 3
DECAY = 0.6
FLOOR = 0.3  # kernels below count as 0
POWER = 3  # of the kernel
LANDMARKS = 64
CANDIDATES = 600
MAX_DOCS = 20_000
MIN_DOCS = 3  # toxic training documents that a landmark occurs in
LONGEST = 32  # longer words are read in overlapping parts of this length
CACHE_SIZE = 200_000

_TOKEN = re.compile(r"[^\W_](?:\S*[^\W_])?").findall
_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n").split
_SPACED = re.compile(r"(?<![^\W_])(?<![^\W_]\S)[^\W\d_](?:[\W_]{1,3}[^\W\d_]){2,}(?![^\W_])")
_SIGNS = re.compile(r"[\W_]+")


def joined(text: str) -> str:
    """Lower-case text, runs of single letters joined: over the whole text, as signs and line breaks inside a run would
    end a sentence."""
    return _SPACED.sub(lambda m: _SIGNS.sub("", m[0]), text.lower())


def tokens_of(text: str) -> list[str]:
    """Lower-case words, signs inside kept; runs of single letters joined."""
    return _TOKEN(joined(text))


def plain(token: str) -> str:
    """A token without the signs inside."""
    return token if token.isalnum() else _SIGNS.sub("", token)


def words_of(text: str) -> list[str]:
    """Lower-case words without signs inside; runs of single letters joined."""
    return list(map(plain, tokens_of(text)))


def parts_of(word: str) -> list[str]:
    """A word of up to ``LONGEST`` letters, or the overlapping parts of a longer one."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i:i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def _codes(words: list[str]) -> np.ndarray:
    """Code points in rows padded with 0 (matches nothing)."""
    out = np.zeros((len(words), max(map(len, words), default=1) or 1), dtype=np.int64)
    for row, w in enumerate(words):
        out[row, :len(w)] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return out


def _same_size(words: list[str], n: int) -> np.ndarray:
    """Code points of words of ``n`` letters each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64).reshape(len(words), n)


def subsequence_kernel(s: np.ndarray, t: np.ndarray, p: int = P, decay: float = DECAY, kind=np.float64) -> np.ndarray:
    """Kernel of row i of ``s`` with row i of ``t`` (code points, 0 for padding), all rows at once."""
    n, lt = len(s), t.shape[1]
    decay = kind(decay)
    kp = [np.ones((lt + 1, n), kind)] + [np.zeros((lt + 1, n), kind) for _ in range(p - 1)]
    total = np.zeros(n, kind)
    st, tt = np.ascontiguousarray(s.T), np.ascontiguousarray(t.T)
    for x in st:
        match = ((tt == x) & (x != 0)).astype(kind)
        match *= decay * decay
        total += (match * kp[p - 1][:-1]).sum(axis=0)
        for i in range(p - 1, 0, -1):
            new = decay * kp[i]
            step = match * kp[i - 1][:-1]
            run = np.zeros(n, kind)
            for j in range(lt):
                run *= decay
                run += step[j]
                new[j + 1] += run
            kp[i] = new
    return total


class _Triples:
    """Places (i < j < k) of the subsequences of a word of ``n`` letters, and what each weighs."""

    _made: dict[int, tuple] = {}

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if n not in cls._made:
            i, j, k = (np.array(x, dtype=np.int64) for x in zip(*combinations(range(n), P)))
            cls._made[n] = i, j, k, DECAY ** (k - i + 1.0)
        return cls._made[n]


class Kernel:
    """Normalised kernel of words with a fixed list of landmarks.

    The kernel is a product of feature vectors (a number for each three letters that a word holds as a subsequence), so
    those of the landmarks are laid out once as a matrix, and a word is measured against all of them at once by
    the three letters it shares with any.
    """

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        letters = sorted(set().union(*landmarks))
        size = self._size = len(letters) + 1  # letter 0: in no landmark
        self._letter = np.zeros(max(map(ord, letters), default=0) + 2, dtype=np.int64)
        self._letter[[ord(x) for x in letters]] = np.arange(1, size)
        codes = _codes(landmarks)
        self._self = subsequence_kernel(codes, codes) if landmarks else np.zeros(0)
        entries = []
        for at, w in enumerate(landmarks):
            if len(w) >= P:
                x = self._letters(np.array([[ord(c) for c in w]], dtype=np.int64))[0]
                i, j, k, weight = _Triples.of(len(w))
                entries.append(np.column_stack([x[i] * size + x[j], x[k], np.full(len(i), at), weight]))
        entries = np.concatenate([np.zeros((0, 4)), *entries])
        pair, third, at = (entries[:, c].astype(np.int64) for c in range(3))
        known, number = np.unique(pair, return_inverse=True)
        self._pair = np.zeros(size * size, dtype=np.int64)  # two letters -> their number, 0 for none
        self._pair[known] = np.arange(1, len(known) + 1)
        three, row = np.unique((number + 1) * size + third, return_inverse=True)
        self._three = np.zeros((len(known) + 1) * size, dtype=np.int64)  # their number and a letter -> feature, 0 for none
        self._three[three] = np.arange(1, len(three) + 1)
        # by feature, its landmarks and weights: entries self._first[f] to self._first[f + 1]
        place, of = np.unique((row + 1) * len(landmarks) + at, return_inverse=True) if len(row) else (row, row)
        self._weight, self._mark = np.bincount(of, weights=entries[:, 3], minlength=len(place)), place % max(len(landmarks), 1)
        self._first = np.searchsorted(place // max(len(landmarks), 1), np.arange(len(three) + 2))

    def _letters(self, points: np.ndarray) -> np.ndarray:
        return self._letter[np.minimum(points, len(self._letter) - 1)]

    def _shared(self, words: list[str], n: int) -> np.ndarray:
        """Plain kernel of words of ``n`` letters with every landmark."""
        x = self._letters(_same_size(words, n))
        i, j, k, weight = _Triples.of(n)
        feature = self._three[self._pair[x[:, i] * self._size + x[:, j]] * self._size + x[:, k]]
        row, col = np.nonzero(feature)
        start = self._first[feature[row, col]]
        reps = self._first[feature[row, col] + 1] - start
        entry = np.repeat(start - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))
        marks = len(self.landmarks)
        held = np.bincount(np.repeat(row * marks, reps) + self._mark[entry], weights=np.repeat(weight[col], reps) * self._weight[entry],
                           minlength=len(words) * marks)
        return held.reshape(len(words), marks)

    def pairs(self, words: list[str], floor: float = FLOOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, kernel) for the pairs at or above the floor (and above 0)."""
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        by_size: dict[int, list[int]] = {}
        for at, w in enumerate(words):
            by_size.setdefault(len(w), []).append(at)
        found = [none]
        for n, ids in by_size.items() if self.landmarks else ():
            if n < P:
                continue
            # a word's own kernel is at least the sum of the squares of its weights: bounds by it lose no pair
            least = (_Triples.of(n)[3] ** 2).sum()
            step = max(1, 8_000_000 // (len(self.landmarks) * len(_Triples.of(n)[0])))  # as many words as fit in 64 MB
            for c in range(0, len(ids), step):
                some = np.array(ids[c:c + step])
                shared = self._shared([words[i] for i in some], n)
                near = np.flatnonzero(((shared >= floor * (1 - 1e-9) * np.sqrt(least * self._self)) & (shared > 0)).any(axis=1))
                if len(near):
                    at = some[near]
                    codes = _same_size([words[i] for i in at], n)
                    value = shared[near] / np.sqrt(np.maximum(subsequence_kernel(codes, codes)[:, None] * self._self, 1e-300))
                    a, b = np.nonzero((value >= floor) & (value > 0))
                    found.append((at[a], b, value[a, b]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def matrix(self, words: list[str]) -> np.ndarray:
        """The kernel of every word with every landmark, without a floor."""
        out = np.zeros((len(words), len(self.landmarks)))
        i, k, v = self.pairs(words, 0.0)
        out[i, k] = v
        return out


class Pool:
    """Landmark values of documents, with a bounded cache of the words seen."""

    def __init__(self, landmarks: list[str]):
        self.kernel = Kernel(landmarks)
        self._known: dict[str, dict[int, float] | None] = {}

    def learn(self, words: set[str]) -> None:
        if len(self._known) + len(words) > CACHE_SIZE:
            self._known.clear()
        fresh = [w for w in words if w not in self._known]
        part, owner = [], []
        for w in fresh:
            for x in parts_of(plain(w)):
                part.append(x)
                owner.append(w)
        self._known.update(dict.fromkeys(fresh))
        for i, k, v in zip(*(x.tolist() for x in self.kernel.pairs(part))):
            row = self._known[owner[i]] or {}
            row[k] = max(v ** POWER, row.get(k, 0.0))
            self._known[owner[i]] = row

    def values(self, texts: list[str]) -> np.ndarray:
        """Documents x (landmarks + 1): sums over sentences of the nearest word's kernel; number of words."""
        out = np.zeros((len(texts), len(self.kernel.landmarks) + 1))
        texts = [joined(t) for t in texts]
        # sentences end at white space, where tokens end too: those of a text are those of its sentences
        split = [_TOKEN(t) for t in texts]
        every = set().union(*split)
        if len(every.difference(self._known)):
            self.learn(every)
        get = self._known.__getitem__
        for row, words in enumerate(split):
            out[row, -1] = len(words)
            near = {w for w in set(words) if get(w)}
            if not near:
                continue
            for sentence in _SENTENCE(texts[row]):
                best: dict[int, float] = {}
                for w in near.intersection(_TOKEN(sentence)):
                    for k, v in get(w).items():
                        best[k] = max(v, best.get(k, 0.0))
                for k, v in best.items():
                    out[row, k] += v
        return out


@dataclass(frozen=True)
class Model:
    landmarks: tuple[str, ...]
    nystrom: np.ndarray  # landmarks x landmarks
    weights: np.ndarray
    bias: float
    slope: float  # of the logistic curve
    shift: float

    def features(self, values: np.ndarray) -> np.ndarray:
        k, words = np.log1p(values[:, :-1]), np.maximum(values[:, -1:], 1)
        total = values[:, :-1].sum(axis=1, keepdims=True)
        return np.hstack([k @ self.nystrom, np.log1p(total), np.log1p(100 * total / words)])

    def score(self, values: np.ndarray) -> np.ndarray:
        if not self.landmarks:
            return np.zeros(len(values))
        margin = self.features(values) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def choose_landmarks(ranked: list[tuple[str, float]], count: int = LANDMARKS) -> list[str]:
    """Greedy: the word of highest weight, weights then falling by the kernel with the chosen words."""
    words = [w for w, _ in ranked]
    weight = np.array([x for _, x in ranked])
    like = Kernel(words).matrix(words)
    chosen: list[int] = []
    while len(chosen) < min(count, len(words)) and weight.max() > 0:
        best = int(weight.argmax())
        chosen.append(best)
        weight = weight * (1 - like[:, best])
        weight[best] = 0
    return [words[i] for i in chosen]


def fit(landmarks: list[str], values: np.ndarray, toxic: np.ndarray, penalty: float = 1.0) -> Model:
    """Squared-hinge machine by Newton steps on the active rows, then the logistic curve of its margins."""
    empty = Model((), np.zeros((0, 0)), np.zeros(0), 0.0, 1.0, 0.0)
    if not landmarks or toxic.all() or not toxic.any():
        return empty
    gram = Kernel(landmarks).matrix(landmarks) ** POWER
    size, vec = np.linalg.eigh((gram + gram.T) / 2)
    size = np.maximum(size, 0.05)  # landmarks nearly alike add little
    root = vec @ np.diag(size ** -0.5) @ vec.T
    model = Model(tuple(landmarks), root, np.zeros(0), 0.0, 1.0, 0.0)
    x = model.features(values)
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.where(toxic, 1.0, -1.0)
    reg = np.eye(x.shape[1]) * penalty
    reg[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    active = np.ones(len(x), dtype=bool)
    for _ in range(50):
        w = np.linalg.solve(x[active].T @ x[active] + reg, x[active].T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    margin, ab = x @ w, np.array([1.0, 0.0])
    for _ in range(50):  # logistic curve by Newton steps
        z = np.column_stack([margin, np.ones(len(x))])
        q = 1 / (1 + np.exp(-np.clip(z @ ab, -30, 30)))
        step = np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (toxic - q) - 1e-3 * ab)
        ab = ab + step
        if np.abs(step).max() < 1e-9:
            break
    return Model(tuple(landmarks), root, w[:-1], float(w[-1]), float(ab[0]), float(ab[1]))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, max_docs: int) -> DataFrame:
    """(text, toxic) of at most ``max_docs`` labelled documents, those with the smallest hashes of the id."""
    lab = (labels.where("toxic is not null").groupBy(labels[id_col].alias("id")).agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("id"), "id").limit(max_docs))
    # at most max_docs rows of two numbers: a bounded broadcast, so no text is shuffled
    return docs.select(docs[id_col].alias("id"), "text").join(F.broadcast(lab), "id").select("text", (F.col("toxic") > 0).alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", max_docs: int = MAX_DOCS) -> Model:
    """``docs`` (id, text), ``labels`` (id, toxic)."""
    sample = training_sample(docs.withColumn("text", F.col("text").cast("string")), labels, id_col, max_docs)

    def vocabulary(batches):
        for b in blocks(batches, "text"):
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(texts_of(b), b.column("toxic").to_pylist()):
                for w in set(words_of(text)):
                    if P <= len(w) <= LONGEST // 2 and not w.isdigit():
                        counts.setdefault(w, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_pydict({"w": pa.array(list(counts), pa.string()),
                                              "clean": pa.array([c[0] for c in counts.values()], pa.int64()),
                                              "toxic": pa.array([c[1] for c in counts.values()], pa.int64())})

    sizes = sample.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in sizes}
    if not n.get(True) or not n.get(False):
        return fit([], np.zeros((0, 1)), np.zeros(0, dtype=bool))
    by_word = sample.mapInArrow(vocabulary, "w string, clean bigint, toxic bigint").groupBy("w").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= MIN_DOCS)
    share_t, share_c = F.col("toxic") / n[True], (F.col("clean") + 0.5) / (n[False] + 1)
    weight = F.col("toxic") * F.log(share_t / share_c)
    ranked = by_word.select("w", weight.alias("x")).where("x > 0").orderBy(F.desc("x"), "w").limit(CANDIDATES).collect()
    landmarks = choose_landmarks([(r["w"], r["x"]) for r in ranked])

    def measure(batches):
        pool = Pool(landmarks)
        for b in blocks(batches, "text"):
            yield pa.RecordBatch.from_pydict({"v": pa.array(pool.values(texts_of(b)).tolist(), pa.list_(pa.float64())),
                                              "toxic": b.column("toxic")})

    rows = sample.mapInArrow(measure, "v array<double>, toxic boolean").collect()  # max_docs rows at most
    rows = sorted((tuple(r["v"]), r["toxic"]) for r in rows)
    return fit(landmarks, np.array([v for v, _ in rows]), np.array([t for _, t in rows], dtype=bool))


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of every row's whole text. No shuffle."""

    def start():
        pool = Pool(list(model.landmarks))
        return lambda texts: {name: pa.array(model.score(pool.values(texts)))}

    return annotate(docs, start, f"{name} double", text_col)
