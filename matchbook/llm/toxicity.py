"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words counts the subsequences of three and four letters that both have, each weighted down by the
letters it spans and by each run of signs or blanks between them, however long, so an insult with characters put in
between still meets its plain form. Short pieces next to each other are compared as one word too.
Training words come from the sentences of labelled documents. A label holds for a document, so each toxic document is a
bag: in every round its best scoring words stand for it against the words of clean sentences (multiple-instance
training). Landmarks are the words most telling for the label and common clean words; the machine is linear
in the Nyström features of a word. As every feature is an inner product over subsequences, the trained machine
is one weight per subsequence: scoring looks these up along the text and never compares strings.
A document's score is a logistic function of its two best words, and the share of words over the margin.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchbook.llm.store import share, shared, slices

#: Labelled documents per class that the classifier is fitted on; texts up to FIT_CHARS come first, then the shortest
#: of the longer ones, of which LONG_CHARS are read.
FIT_DOCS, FIT_CHARS, LONG_CHARS = 1500, 6000, 60_000
LANDMARKS = 160
#: The weight of a subsequence for each letter it spans (at most SPAN), and for each run of other signs inside.
DECAY, SPAN, SIGNS, ORDERS = 0.7, 6, 0.9, (3, 4)
#: Letters of a piece at most, and pieces that are read as one word at most.
PIECE, PIECES = 4, 3
CUT = 0.3
#: What fit() tries on a training fold: standard errors at which a word's evidence counts half, and the penalty.
SETTINGS = ((6.0, 1e-4), (4.5, 1e-4), (3.0, 1e-4), (4.5, 1e-3))


def _codes() -> np.ndarray:
    """Letters of any accent or case as 1 to 26, look-alike signs as their letter, other letters as 27 to 31, the rest 0."""
    table = np.zeros(1 << 16, np.uint8)
    for point in range(1 << 16):
        char = chr(point)
        plain = unicodedata.normalize("NFKD", char)[0].lower()
        if "a" <= plain <= "z":
            table[point] = ord(plain) - 96
        elif char.isalpha():
            table[point] = 27 + point % 5
    for sign, letter in zip("01345$7@ß", "oieasstas", strict=True):  # fixed values
        table[ord(sign)] = ord(letter) - 96
    return table


CODES = _codes()


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The letters of all texts one after the other, and how many runs of other signs are before each.

    Then start and end among the letters, and text number, of every word. A word is a run between white space that has
    a letter; single letters in a row, as in a spaced-out word, are one word, whatever signs stand between them.
    """
    whole = " ".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(points < len(CODES), CODES[np.minimum(points, len(CODES) - 1)], 27).astype(np.int32)
    blank = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 160)
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    places = np.flatnonzero(codes)
    breaks = np.cumsum(np.diff(places, prepend=places[:1]) > 1)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    owner = np.searchsorted(begins, starts, side="right") - 1
    starts, ends = np.searchsorted(places, starts), np.searchsorted(places, ends)
    full = ends > starts
    starts, ends, owner = starts[full], ends[full], owner[full]
    if len(starts) > 1:
        single = ends - starts == 1
        goes_on = single[1:] & single[:-1] & (owner[1:] == owner[:-1])
        first, last = np.append(True, ~goes_on), np.append(~goes_on, True)
        starts, ends, owner = starts[first], ends[last], owner[first]
    return codes[places], breaks, starts, ends, owner


def decayed(breaks: np.ndarray, span: int) -> np.ndarray:
    """The weight of a subsequence that spans so many letters, by the letter it starts at."""
    last = np.minimum(np.arange(span - 1, len(breaks) + span - 1), len(breaks) - 1)
    return DECAY**span * (SIGNS ** np.arange(SPAN)).take(breaks[last] - breaks)


def inside(by_span: dict[int, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each range of letters the sum over the subsequences that start and end in it."""
    up, upto = {}, 0
    for span in sorted(by_span):
        up[span] = upto = upto + by_span[span]
    running = np.concatenate([np.zeros((1, *upto.shape[1:])), np.cumsum(upto, axis=0, dtype=np.float64)])
    total = running[np.maximum(ends - SPAN + 1, starts)] - running[starts]
    for span in range(ORDERS[0], SPAN):
        at = np.flatnonzero(ends - span >= starts)
        total[at] += up[span][ends[at] - span]
    return total


def subsequences(codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each order and span: the number, in base 32, of the subsequence that starts at each letter; 0 is past the last."""
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(SPAN, np.int32)])
    at = [padded[g : g + n] for g in range(SPAN)]
    for a in range(1, SPAN - 1):
        two = ((at[0] << 5) | at[a]) << 5
        for b in range(a + 1, SPAN):
            three = two | at[b]
            yield 3, b + 1, three
            if b + 1 < SPAN:
                three = three << 5
                for c in range(b + 1, SPAN):
                    yield 4, c + 1, three | at[c]


def word_features(word: str) -> dict[tuple[int, int], float]:
    """The subsequences of a word, or of pieces, with their weights, scaled by the length of a word of as many letters."""
    codes, breaks, *_ = joined([word])
    found: Counter = Counter()
    for order, span, numbers in subsequences(codes):
        n = max(len(codes) - span + 1, 0)
        for number, weight in zip(numbers[:n].tolist(), decayed(breaks, span)[:n].tolist(), strict=True):
            found[order, number] += weight
    norm = NORMS[min(len(codes), len(NORMS) - 1)]
    return {k: v / norm for k, v in found.items()}


def _norms(most: int = 64) -> np.ndarray:
    """The length of the feature vector of a word of n different letters: what the lookup divides by."""
    out = np.ones(most + 1)
    for n in range(1, most + 1):
        ends = [rest[-1] for order in ORDERS for rest in combinations(range(1, SPAN), order - 1)]
        total = sum((n - last) * DECAY ** (2 * (last + 1)) for last in ends if n > last)
        out[n] = max(total, DECAY ** (2 * ORDERS[0])) ** 0.5
    return out


NORMS = _norms()


@dataclass
class Machine:
    tables: dict[int, np.ndarray]  # a weight for each subsequence, by order
    bias: float
    logistic: np.ndarray

    def word_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The signed distance of every word, and the text it is in.

        A word that starts a row of short pieces has the distance of the row if that is more than that of each piece.
        """
        codes, breaks, starts, ends, owner = joined(texts)
        if not len(starts):
            return np.zeros(0), owner
        by_span: dict[int, np.ndarray] = {}
        for order, span, numbers in subsequences(codes):
            got = self.tables[order].take(numbers)
            by_span[span] = by_span[span] + got if span in by_span else got
        by_span = {span: got * decayed(breaks, span) for span, got in by_span.items()}

        def distance(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
            return inside(by_span, starts, ends) / NORMS[np.minimum(ends - starts, len(NORMS) - 1)] + self.bias

        own = distance(starts, ends)
        best, piece = own.copy(), ends - starts <= PIECE
        rows, alone = piece, own
        for k in range(1, min(PIECES, len(starts))):
            rows, alone = rows[:-1] & piece[k:] & (owner[k:] == owner[:-k]), np.maximum(alone[:-1], own[k:])
            at = np.flatnonzero(rows)
            row = distance(starts[at], ends[at + k])
            best[at] = np.where(row > alone[at], np.maximum(best[at], row), best[at])
        return best, owner

    def features(self, texts: list[str]) -> np.ndarray:
        """For each text: 1, its best and second best word, and the share of words over the margin."""
        out = np.tile([1.0, -1.0, -1.0, 0.0], (len(texts), 1))
        scores, owner = self.word_scores(texts)
        if len(scores):
            order = np.lexsort((-scores, owner))
            scores, owner = scores[order], owner[order]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            counts = np.diff(np.append(first, len(owner)))
            out[owner[first], 1] = np.clip(scores[first], -1, 2)
            more = counts > 1
            out[owner[first][more], 2] = np.clip(scores[first[more] + 1], -1, 2)
            out[owner[first], 3] = np.minimum(1.0, 20 * np.add.reduceat((scores > 0).astype(float), first) / counts)
        return out

    def features_of(self, texts: list[str]) -> np.ndarray:
        """The features of many texts, some at a time."""
        return np.vstack([self.features(texts[i : i + 50]) for i in range(0, len(texts), 50)])

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.logistic, -30, 30)))


SENTENCE = re.compile(r"[^.!?\n]+")


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by accelerated gradient steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    weight = weight / weight.sum()
    step = 1.0 / (2 * np.linalg.eigvalsh((x1 * weight[:, None]).T @ x1)[-1] + penalty)
    w = v = np.zeros(x1.shape[1])
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        grad = -2 * x1.T @ (weight * y * slack) + penalty * v
        new = v - step * grad
        v, w = new + k / (k + 3) * (new - w), new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


def fit(texts: list[str], toxic: list[int], landmarks: int = LANDMARKS, rounds: int = 4) -> Machine | None:
    """Train on whole labelled texts; None when a class is missing.

    The setting is the one that predicts a fold of every third text best from the others; the machine is then trained on all.
    """
    label = np.array(toxic)
    if not len(label) or label.min() == label.max():
        return None
    bags = [[w for c in SENTENCE.findall(t) for w in c.lower().split()] for t in texts]
    place = np.zeros(len(label), int)
    for y in (0, 1):
        place[label == y] = np.arange((label == y).sum())
    fold = place % 3 == 2
    own, best = np.flatnonzero(~fold), SETTINGS[0]
    if len(np.unique(label[fold])) == 2:
        tried = _machines([bags[i] for i in own], label[own], SETTINGS, landmarks, rounds)
        values = [m.features_of(texts) for m in tried]
        best = SETTINGS[int(np.argmin([_loss(v[fold], label[fold], _logistic(v[fold], label[fold])) for v in values]))]
    (machine,) = _machines(bags, label, (best,), landmarks, rounds)
    machine.logistic = _logistic(machine.features_of(texts), label)
    return machine


def _loss(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-6, 1 - 1e-6)
    return float(-np.mean(np.where(y == 1, np.log(p), np.log(1 - p))))


def _machines(bags: list[list[str]], label: np.ndarray, settings: tuple, landmarks: int, rounds: int) -> list[Machine]:
    """For each setting a machine without its logistic."""
    spread = [Counter(), Counter()]
    for bag, y in zip(bags, label, strict=True):
        spread[y].update(set(bag))
    n0, n1 = np.bincount(label, minlength=2).tolist()

    def tell(word: str) -> float:
        """How much more often a word is in toxic documents, in standard errors."""
        a, b = spread[1][word], spread[0][word]
        share = (a + b) / (n0 + n1)
        return (a / n1 - b / n0) / max(share * (1 - share) * (1 / n0 + 1 / n1), 1e-12) ** 0.5

    telling = {w: tell(w) for w in spread[1]}
    by_tell = sorted(telling, key=lambda w: (-telling[w], w))
    clean = sorted(spread[0], key=lambda w: (-spread[0][w], w))
    anchors = list(dict.fromkeys([*by_tell[: landmarks * 3 // 4], *clean[: landmarks // 4]]))
    vectors = [word_features(w) for w in anchors]
    keys = {k: i for i, k in enumerate(sorted({k for v in vectors for k in v}))}
    grid = np.zeros((len(anchors), len(keys)))
    for i, v in enumerate(vectors):
        for k, x in v.items():
            grid[i, keys[k]] = x
    values, axes = np.linalg.eigh(grid @ grid.T)
    keep = values > 1e-6
    project = grid.T @ (axes[:, keep] / np.sqrt(values[keep]))  # subsequence weights to Nyström features

    lookup = {n: np.full(32**n, len(keys), np.int32) for n in ORDERS}
    for (order, number), i in keys.items():
        lookup[order][number] = i
    project = np.vstack([project, np.zeros(project.shape[1])]).astype(np.float32)

    def features(words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), project.shape[1]), np.float32)
        for i in range(0, len(words), 1000):
            codes, breaks, starts, ends, owner = joined(words[i : i + 1000])
            if len(starts):
                by_span = {span: np.zeros((len(codes), project.shape[1]), np.float32) for span in range(ORDERS[0], SPAN + 1)}
                for order, span, numbers in subsequences(codes):
                    index = lookup[order][numbers]
                    there = np.flatnonzero(index < len(keys))
                    by_span[span][there] += decayed(breaks, span)[there, None].astype(np.float32) * project[index[there]]
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                starts, ends = starts[first], ends[np.append(first[1:], len(owner)) - 1]
                norms = NORMS[np.minimum(ends - starts, len(NORMS) - 1)]
                out[i + owner[first]] = inside(by_span, starts, ends) / norms[:, None]
        return out

    # Every word that is commoner in toxic documents can stand for one, with the weight of its evidence, which
    # grows smoothly with the standard errors. Of the clean words, all common ones and an even sample of the rest
    # and of rows of short pieces.
    vocabulary = [w for w in by_tell if telling[w] > 0] or by_tell[:20]
    against = [*clean[:3000], *sorted(clean[3000:], key=lambda w: hash_of(w))[:6000]]
    pieces: Counter = Counter()
    for bag, y in zip(bags, label, strict=True):
        if not y:
            pieces.update({r for k in range(2, PIECES + 1) for r in zip(*(bag[j:] for j in range(k)), strict=False) if max(map(len, r)) <= PIECE})
    rows = {" ".join(r): n for r, n in pieces.items()}
    against += sorted(rows, key=lambda r: (hash_of(r), r))[:3000]
    seen, apart = features(vocabulary), features(against)
    index = {w: i for i, w in enumerate(vocabulary)}
    of_bag = [np.array(sorted({index[w] for w in bag if w in index}), int) for bag, y in zip(bags, label, strict=True) if y]
    told = np.array([telling[w] for w in vocabulary])
    minus = np.array([spread[0][w] or rows[w] for w in against], float) ** 0.5
    out = []
    for half, penalty in settings:
        evidence = 1 / (1 + np.exp(np.clip(2 * (half - told), -30, 30)))
        current = told
        w, bias = np.zeros(project.shape[1]), 0.0
        for _ in range(rounds):
            count = np.zeros(len(vocabulary))
            for words in of_bag:
                count[words[np.argsort(-current[words], kind="stable")[:2]]] += 1
            count *= evidence
            chosen = np.flatnonzero(count)
            x = np.vstack([seen[chosen], apart])
            y = np.concatenate([np.ones(len(chosen)), -np.ones(len(against))])
            w, bias = _svm(x, y, np.concatenate([count[chosen] / count.sum(), minus / minus.sum()]), penalty=penalty)
            current = seen @ w + bias
        weights = project @ w
        tables = {n: np.zeros(32**n, np.float32) for n in ORDERS}
        for (order, code), i in keys.items():
            tables[order][code] = weights[i]
        out.append(Machine(tables, bias, np.zeros(4)))
    return out


def hash_of(word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7)


def training_sample(docs: DataFrame, labels: DataFrame, usable: Column, most: int = FIT_DOCS, chars: int = FIT_CHARS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``most`` labelled documents of each class: short texts first, by the hash of their id."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic").where(usable)
    own = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select("doc_id", "text", F.length("text").alias("size"))
    # Only the ids are ordered; the texts of the chosen ones follow.
    mixed = own.where(usable).join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.max("size").alias("size"))
    order = F.greatest("size", F.lit(chars)), F.xxhash64("doc_id"), F.col("doc_id")
    first = [mixed.where(F.col("toxic") == y).orderBy(*order).limit(most) for y in (0, 1)]
    chosen = first[0].unionByName(first[1]).select("doc_id", "toxic")
    return own.join(F.broadcast(chosen), "doc_id").select("doc_id", F.substring("text", 1, LONG_CHARS).alias("text"), "toxic")


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Machine | None:
    """A machine from labelled documents; rows with null ids, texts or labels are not used.

    The sample is bounded: ``FIT_DOCS`` documents of each class, short ones first, with ``LONG_CHARS`` characters each
    at most. Its rows are sorted on the driver, so reruns give the same machine.
    """
    usable = F.lit(True) if usable is None else usable
    rows = sorted({tuple(r) for r in training_sample(docs, labels, usable).collect()})
    return fit([r[1] for r in rows], [r[2] for r in rows])


def score(docs: DataFrame, machine: Machine | None, text_col: str = "text", column: str = "score") -> DataFrame:
    """Add the score of each whole text, 0 to 1; null and empty texts are scored like a text without words.

    Without a machine (a class without labelled rows) every score is 0. Rows that repeat each give a row, an
    empty table gives none, and a column of ``docs`` with the new name is replaced.
    """
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c != column])
    sent = share(docs.sparkSession, machine)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(sent)
        for batch in batches:
            for part in slices(batch, text_col, 1 << 17):
                texts = [t or "" for t in part.column(text_col).to_pylist()]
                scores = own.scores(texts) if own else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out(modulus: int = 4, remainder: int = 2) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) == remainder


def clean_documents(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents that score below the cut, with all their columns."""
    machine = train(docs, labels)
    return score(docs, machine, column="_toxicity").where(F.col("_toxicity") < cut).select(*[f"`{c}`" for c in docs.columns])
