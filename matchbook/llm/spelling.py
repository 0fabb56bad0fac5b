"""Spelling variants by composition of finite-state machines.

The vocabulary is a minimised acceptor; two words are near if the acceptor, composed with a transducer that makes one
edit and the acceptor again, accepts the pair. The composition is enumerated by initial states: of two words at one
edit, the shorter of m letters, either the first m // 2 or the last m // 2 letters agree, since the edit lies behind
the one or before the other. So the machine that has read a common start (or, over reversed words, a common end) is a
partition of its own: its words are brought together, made into an acceptor, and composed there. A partition with
very many words is cut into blocks that meet in pairs, each composed as two acceptors.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.store import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words of one initial state that a task composes at once.
BLOCK = 20_000
#: Entries of a task's counts before they are passed on.
COUNTS = 200_000


def noisy(doc: str, run: str, modulus: int) -> str:
    """The run, less one letter if ``modulus`` divides the checksum of its document and itself."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    return run if h % modulus else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6, least: int = 5, modulus: int | None = None) -> DataFrame:
    """(word, n): the words of whole texts with at least ``least_chars`` letters and ``least`` occurrences.

    With ``modulus``, runs are changed by ``noisy``; a document without an id is called ``null`` there.
    """

    def flushed(counts: Counter) -> pa.RecordBatch:
        words = [w for w in counts if len(w) >= least_chars]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
                # Bytes in lower case change A-Z only; other letters keep their case.
                runs = Counter(RUN.findall((text.as_py() or "").encode().lower().decode()))
                for word, n in runs.items():
                    # Shorter runs only get shorter.
                    if len(word) >= least_chars:
                        counts[noisy(doc, word, modulus) if modulus else word] += n
                if len(counts) > COUNTS:
                    yield flushed(counts)
                    counts = Counter()
        yield flushed(counts)

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("doc"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Acceptor:
    """The smallest deterministic acceptor of sorted words, built word by word: finished states are shared."""

    def __init__(self, words: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        path, last = [0], ""  # the states of the last word, not yet shared

        def settle(depth: int) -> None:
            while len(path) - 1 > depth:
                state = path.pop()
                mark = (self.final[state], *self.next[state].items())
                same = known.setdefault(mark, state)
                if same != state:
                    self.next[path[-1]][last[len(path) - 1]] = same

        for word in words:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            settle(common)
            for letter in word[common:]:
                self.next.append({})
                self.final.append(False)
                self.next[path[-1]][letter] = len(self.next) - 1
                path.append(len(self.next) - 1)
            self.final[path[-1]] = True
            last = word
        settle(0)


def _both(a: Acceptor, b: Acceptor, p: int, q: int, but: str = "") -> Iterator[str]:
    """What state ``p`` of the one and ``q`` of the other both accept, unless it begins with ``but``."""
    todo = [(p, q, "")]
    while todo:
        p, q, read = todo.pop()
        if a.final[p] and b.final[q]:
            yield read
        one, two = a.next[p], b.next[q]
        for letter in one if len(one) < len(two) else two:
            if letter in one and letter in two and (read or letter != but):
                todo.append((one[letter], two[letter], read + letter))


def composed(a: Acceptor, b: Acceptor) -> Iterator[tuple[str, str]]:
    """Every pair of a word of ``a`` and one of ``b`` that differ by exactly one edit, once.

    The edit is made where the words first differ, so a letter that is put in before equal ones is put in once.
    """
    todo = [(0, 0, "")]
    while todo:
        p, q, read = todo.pop()
        one, two = a.next[p], b.next[q]
        for x, to in one.items():
            for rest in _both(a, b, to, q, x):  # x is left out
                yield read + x + rest, read + rest
            for y, at in two.items():
                if x == y:
                    todo.append((to, at, read + x))
                else:  # replaced
                    for rest in _both(a, b, to, at):
                        yield read + x + rest, read + y + rest
        for y, at in two.items():
            for rest in _both(a, b, p, at, y):  # y is put in
                yield read + rest, read + y + rest


def _compose(rows: list[tuple[str, int, int]], m: int, i: int, j: int, back: bool) -> Iterator[tuple[str, str, int]]:
    """(word, near word, its n) of one partition, both ways, from rows (word, n, block) of blocks ``i`` and ``j``.

    Only pairs whose shorter word has ``m`` letters belong here; those with a common start are left to the forward side.
    """
    n = {word: count for word, count, _ in rows}
    if len(n) < 2:
        return
    turn = (lambda w: w[::-1]) if back else (lambda w: w)
    machines = [Acceptor(sorted({turn(w) for w, _, block in rows if block == k})) for k in dict.fromkeys((i, j))]
    half = m // 2
    for x, y in composed(machines[0], machines[-1]):
        x, y = turn(x), turn(y)
        if min(len(x), len(y)) == m and (x[:half] == y[:half]) != back:
            yield x, y, n[y]
            if i != j:
                yield y, x, n[x]


def _partitions(most_pairs: int = 50_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (key, pair); a partition's rows are at most two blocks."""
        found: list[tuple[str, str, int]] = []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64())
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "near", "near_n"])
            found.clear()
            return batch

        now, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("back", "m", "key", "i", "j", "word", "n", "block")]
            for back, m, key, i, j, word, n, block in zip(*columns, strict=True):
                if (back, m, key, i, j) != now:
                    if now:
                        for pair in _compose(rows, now[1], now[3], now[4], now[0]):
                            found.append(pair)
                            if len(found) >= most_pairs:
                                yield flushed()
                    now, rows = (back, m, key, i, j), []
                rows.append((word, n, block))
        if now:
            found.extend(_compose(rows, now[1], now[3], now[4], now[0]))
        yield flushed()

    return run


def _initial_states(words: DataFrame) -> DataFrame:
    """(back, m, key, word, n): each word where the machine has read its first half, or reversed its last half, for
    partners of its own length or longer (m letters) and for shorter ones (m - 1)."""
    sides = F.explode(F.array(F.lit(False), F.lit(True)))
    spread = words.withColumn("back", sides).withColumn("m", F.explode(F.array(F.length("word"), F.length("word") - 1)))
    half = F.floor(F.col("m") / 2).cast("int")
    read = F.when(F.col("back"), F.right("word", half)).otherwise(F.left("word", half))
    # Two starts with one hash only share a partition, they are not taken for equal.
    return spread.where(F.col("m") > 0).select("back", "m", F.xxhash64(read).alias("key"), "word", "n")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n) for every ordered pair of different words (word, n) at exactly one edit."""
    spread = _initial_states(words)
    keys = ["back", "m", "key"]
    sizes = spread.groupBy(*keys).agg(F.count("*").alias("size"))
    # A word that is alone has no partner; states with very many words go out as pairs of blocks.
    sizes = stored(sizes.where(F.col("size") > 1).withColumn("blocks", F.ceil(F.col("size") / block).cast("int")), "states")
    own = F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = spread.join(sizes, keys).withColumn("block", own).withColumn("other", other)
    dealt = dealt.select(*keys, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "word", "n", "block")
    by = [*keys, "i", "j"]
    return dealt.repartition(*by).sortWithinPartitions(*by, "word").mapInArrow(_partitions(), "word string, near string, near_n long")


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root): where (word, form) leads when followed to the end, by doubling the steps of each round.

    Forms must not run in a circle. Each round is one join; the rounds are the logarithm of the longest chain.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(further, "root", "left")
        after = stored(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = 5, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of (word, n), words distinct and not null.

    ``form`` is the near word of largest n, ties by the smallest in code-point order, if it has at least ``ratio``
    (over 1) times the word's n, else null; ``root`` follows forms to the last, and is the word itself without one.
    No words give no rows; further columns are ignored.
    """
    words = words.select("word", "n")
    near = near_words(words, block)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    sums = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    wide = F.col("best.minus") <= -ratio * F.col("n")
    known = words.join(sums, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(wide, F.col("best.near")).alias("form"), F.when(wide, -F.col("best.minus")).alias("form_n"),
    )
    known = stored(known, "forms")
    roots = rooted(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6, least: int = 5,
    ratio: int = 5, modulus: int | None = None, block: int = BLOCK,
) -> DataFrame:
    """``variants`` of the words of whole texts: runs of Latin letters, A-Z in lower case, long and common enough.

    Null and empty texts have no words; rows that repeat count each. An empty table gives no rows.
    """
    return variants(stored(word_counts(docs, id_col, text_col, least_chars, least, modulus), "words"), ratio, block)
