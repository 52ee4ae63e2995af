"""Spelling variants: words one edit apart, and the more frequent form of each.

1. Runs of letters are counted where the texts are read, in a bounded memory that is
   emptied into rows (word, n) when full; one aggregate adds them up.
2. A word is a vector of letter counts.  One replaced letter is a squared distance of two,
   one inserted or deleted letter of one, so near words are at most two apart, in
   the same or in adjacent lengths.
3. Blocks: letters are dealt into groups of about equal weight; a word lies in the block
   of its group counts, and in the block of its group counts less one letter, once
   per group that it has.  Two near words share exactly the block of what is
   left without the edited letter: there, words of one length meet one another
   (a replaced letter) and those one letter shorter (an inserted one).  The number of
   groups grows with the vocabulary, so that blocks stay short.
4. Per block, NumPy products of the count vectors (Gram matrices) give all squared
   distances; pairs at most two apart are verified letter by letter, and count only
   if the edited letter is of the group that the block leaves out, so each pair counts once.
   A block with more words than `TILE_BYTES` hold is cut into tiles, and each pair of
   tiles is its own unit of work.
5. What leaves a unit is one row per word with near words there: how many, and the best.

All letters of the alphabet here (A-Z, a-z, U+00C0 to U+00FF) are one byte in Latin-1, the
form in which words travel to the blocks.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmeter.session import drop_path, materialize

#: Letters of a tile (words times length): what one side of a product holds.
TILE_BYTES = 24_576
#: Rows of one product.
ROWS = 1_024
#: Words (and their bytes) that a task holds before it empties them into rows.
HELD, HELD_BYTES = 300_000, 16_000_000
#: Bytes of a text that are split into runs at a time.
SLICE = 2_000_000

# UTF-8 bytes of letters stay (A-Z in lower case), all others become spaces.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 128 <= c <= 191 or c == 0xC3 else 32 for c in range(256))
# Characters beyond U+007F that are no letters here.
_OTHER = re.compile(rb"[\xc2\xc4-\xff][\x80-\xbf]*")
# Letter numbers of Latin-1 bytes.
_NUMBER = np.zeros(256, np.int64)
_NUMBER[97:123] = np.arange(26)
_NUMBER[192:] = np.arange(26, 90)
ALPHABET = 90


def runs(data: bytes) -> Iterator[list[bytes]]:
    """The letter runs of a text in UTF-8, A-Z in lower case, a list for each slice of it."""
    if not data.isascii() and _OTHER.search(data):
        data = _OTHER.sub(b" ", data)
    data = data.translate(_LETTERS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class _Numbers(dict):
    """Numbers of words in the order in which they come; `new` are the latest."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Counter:
    """Counts of runs.  With `drop`, every run whose crc32 of `<id>:<run>` the number divides
    loses one letter.

    crc32 is affine: the crc of prefix and word is that of the prefix and as many zero
    bytes, xor a value of the word alone, which is kept by word.
    """

    def __init__(self, drop: int | None):
        self.drop = drop
        self.clear()

    def clear(self) -> None:
        self.numbers, self.bytes = _Numbers(), 0
        self.counts, self.crcs, self.kinds = np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.sizes: dict[int, int] = {}  # byte length -> its kind
        self.extra: dict[bytes, int] = {}

    def _learn(self) -> None:
        if len(self.numbers) > len(self.counts):
            room = max(1_024, 2 * len(self.numbers))
            self.counts, self.crcs, self.kinds = (np.concatenate((x, np.zeros(room - len(x), x.dtype)))
                                                  for x in (self.counts, self.crcs, self.kinds))
        for i, w in enumerate(self.numbers.new, len(self.numbers) - len(self.numbers.new)):
            self.crcs[i] = zlib.crc32(w) ^ zlib.crc32(bytes(len(w)))
            self.kinds[i] = self.sizes.setdefault(len(w), len(self.sizes))
            self.bytes += len(w)
        self.numbers.new = []

    def add(self, prefix: bytes, words: list[bytes]) -> None:
        if not words:
            return
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if self.numbers.new:
            self._learn()
        np.add.at(self.counts, ids, 1)
        if not self.drop:
            return
        kinds = self.kinds[ids]
        there = np.bincount(kinds, minlength=len(self.sizes))
        start = zlib.crc32(prefix)
        zeros = np.array([zlib.crc32(bytes(n), start) if there[k] else 0 for n, k in self.sizes.items()], np.uint32)
        h = zeros[kinds] ^ self.crcs[ids]
        for i in np.flatnonzero(h % np.uint32(self.drop) == 0).tolist():
            word = words[i].decode()
            k = int(h[i]) % len(word)
            short = (word[:k] + word[k + 1:]).encode()
            self.counts[ids[i]] -= 1
            self.extra[short] = self.extra.get(short, 0) + 1

    def full(self) -> bool:
        return len(self.numbers) > HELD or self.bytes > HELD_BYTES

    def rows(self, least: int) -> pa.RecordBatch:
        """(word, n) of the words with `least` letters or more, and an empty memory."""
        n = self.counts[:len(self.numbers)].tolist()
        for w, k in self.extra.items():
            if w in self.numbers:
                n[self.numbers[w]] += k
        both = [(w, k) for w, k in zip(self.numbers, n, strict=False) if k] + [(w, k) for w, k in self.extra.items() if w not in self.numbers]
        both = [(w, k) for w, k in both if len(w) - w.count(b"\xc3") >= least]
        self.clear()
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in both], pa.binary()).cast(pa.string()),
                                           pa.array([k for _, k in both], pa.int64())], names=["word", "n"])


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5,
                drop: int | None = None) -> DataFrame:
    """(word, n) of all letter runs of all whole texts; see `Counter` for `drop`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(drop)
        for b in batches:
            for key, text in zip(b.column(0), b.column(1), strict=True):
                for words in runs(text.as_py() or b""):
                    counter.add((key.as_py() or "").encode() + b":", words)
                    if counter.full():
                        yield counter.rows(least_length)
        yield counter.rows(least_length)

    found = docs.select(F.col(id_col).cast("string").alias("k"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def letter_weights(words: DataFrame) -> list[int]:
    """How often each letter of the alphabet occurs in `words` (at most 90 rows reach the driver)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALPHABET, np.int64)
        for b in batches:
            for w in b.column(0):
                total += np.bincount(_NUMBER[np.frombuffer(w.as_py(), np.uint8)], minlength=ALPHABET)
        yield pa.RecordBatch.from_arrays([pa.array(range(ALPHABET), pa.int32()), pa.array(total)], names=["letter", "n"])

    out = [0] * ALPHABET
    for r in words.select("w").mapInArrow(run, "letter int, n bigint").groupBy("letter").agg(F.sum("n").alias("n")).collect():
        out[r["letter"]] = r["n"]
    return out


def deal_letters(weights: list[int], groups: int) -> np.ndarray:
    """The group of each letter: the heaviest first, each to the lightest group."""
    group, load = np.zeros(ALPHABET, np.int64), [0] * groups
    for x in sorted(range(ALPHABET), key=lambda i: (-weights[i], i)):
        g = load.index(min(load))
        group[x] = g
        load[g] += weights[x] + 1
    return group


def block_rows(words: DataFrame, group: np.ndarray) -> DataFrame:
    """Rows (size, key, g, w, n) of words (w, n): a word in its own block (g = -1, `size` letters)
    and in those of its group counts less one letter of group g.  A key is a sum of
    random numbers, one a letter; blocks that collide are told apart by the edited letters."""
    groups = int(group.max()) + 1
    base = np.random.default_rng(13).integers(-2 ** 63, 2 ** 63, groups, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 2_000):
                part = b.slice(at, 2_000)
                ws = part.column(0).to_pylist()
                size = np.fromiter(map(len, ws), np.int64, len(ws))
                row = np.repeat(np.arange(len(ws)), size)
                counts = np.bincount(row * groups + group[_NUMBER[np.frombuffer(b"".join(ws), np.uint8)]],
                                     minlength=len(ws) * groups).reshape(-1, groups)
                key = (counts * base).sum(1)  # wraps around
                i, g = np.nonzero(counts)
                rows = np.concatenate((np.arange(len(ws)), i))
                out = pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((size, size[i] - 1)).astype(np.int32)), pa.array(np.concatenate((key, key[i] - base[g]))),
                     pa.array(np.concatenate((np.full(len(ws), -1), g)).astype(np.int32))], names=["size", "key", "g"])
                words_, n = part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*out.columns, words_, n], names=["size", "key", "g", "w", "n"])

    return words.select("w", "n").mapInArrow(run, "size int, key bigint, g int, w binary, n bigint")


def _counts(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count vectors and squared lengths of words as rows of letter numbers (exact as floats)."""
    n, size = letters.shape
    x = np.bincount((np.arange(n)[:, None] * ALPHABET + letters).ravel(), minlength=n * ALPHABET).reshape(n, ALPHABET)
    x = x.astype(np.float32 if size < 2_000 else np.float64)
    return x, (x * x).sum(1)


def _close(x: np.ndarray, xx: np.ndarray, y: np.ndarray, yy: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs at a squared distance of at most two, a block of rows at a time."""
    for at in range(0, len(x), ROWS):
        gram = x[at:at + ROWS] @ y.T
        gram *= -2
        gram += xx[at:at + ROWS, None]
        gram += yy
        i, j = np.nonzero(gram <= 2)
        for cut in range(0, len(i), 200_000):
            yield i[cut:cut + 200_000] + at, j[cut:cut + 200_000]


def near_in_block(short: np.ndarray, first: np.ndarray, second: np.ndarray, g_first: np.ndarray, g_second: np.ndarray,
                  group: np.ndarray, same: bool) -> tuple[list, list]:
    """Near pairs of one unit, as index pairs: (first, second) by a replaced letter, and
    (short, first) by an inserted one.  Words are rows of letter numbers; `first` and
    `second` are one letter longer than `short`.  `same`: both are the same rows."""
    replaced, inserted = [], []
    if len(first):
        x, xx = _counts(first)
        y, yy = (x, xx) if same else _counts(second)
        for i, j in _close(x, xx, y, yy):
            if same:
                i, j = i[i < j], j[i < j]
            a, b = first[i], second[j]
            differ = a != b
            p = differ.argmax(1)
            at = np.arange(len(i))
            ok = (differ.sum(1) == 1) & (group[a[at, p]] == g_first[i]) & (group[b[at, p]] == g_second[j])
            replaced.append((i[ok], j[ok]))
        if len(short):
            s, ss = _counts(short)
            size = short.shape[1]
            for i, j in _close(s, ss, x, xx):
                b, a = short[i], first[j]
                equal = a[:, :size] == b
                p = np.where(equal.all(1), size, equal.argmin(1))
                rest = (a[:, 1:] == b) | (np.arange(size) < p[:, None])
                ok = rest.all(1) & (group[a[np.arange(len(i)), p]] == g_first[j])
                inserted.append((i[ok], j[ok]))
    return replaced, inserted


def _unit(part: pa.Table, group: np.ndarray) -> tuple[list, ...]:
    """Rows (w, near, best_n, best) of one unit: rows of one block and one pair of tiles."""
    g, n, t = (part.column(c).to_numpy() for c in ("g", "n", "t"))
    ws = part.column("w").to_pylist()
    size = part.column("size")[0].as_py()
    low, high = part.column("i")[0].as_py(), part.column("j")[0].as_py()

    def rows(which: np.ndarray, length: int) -> np.ndarray:
        return _NUMBER[np.frombuffer(b"".join([ws[k] for k in which]), np.uint8)].reshape(len(which), length)

    own = np.flatnonzero(g < 0)
    a, b = np.flatnonzero((g >= 0) & (t == low)), np.flatnonzero((g >= 0) & (t == high))
    pairs = []
    if low == high:
        long = rows(a, size + 1)
        replaced, inserted = near_in_block(rows(own, size), long, long, g[a], g[a], group, True)
        pairs += [(a[i], a[j]) for i, j in replaced] + [(own[i], a[j]) for i, j in inserted]
    else:
        first, second = rows(a, size + 1), rows(b, size + 1)
        replaced, inserted = near_in_block(rows(own[t[own] == high], size), first, second, g[a], g[b], group, False)
        pairs += [(a[i], b[j]) for i, j in replaced] + [(own[t[own] == high][i], a[j]) for i, j in inserted]
        other = own[t[own] == low]
        _, inserted = near_in_block(rows(other, size), second, second[:0], g[b], g[b][:0], group, False)
        pairs += [(other[i], b[j]) for i, j in inserted]
    if not sum(len(i) for i, _ in pairs):
        return [], [], [], []
    x = np.concatenate([k for i, j in pairs for k in (i, j)])
    y = np.concatenate([k for i, j in pairs for k in (j, i)])
    there, place = np.unique(y, return_inverse=True)
    rank = np.empty(len(there), np.int64)
    rank[sorted(range(len(there)), key=lambda k: ws[there[k]])] = np.arange(len(there))
    order = np.lexsort((rank[place], -n[y], x))
    x, y = x[order], y[order]
    starts = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    near = np.diff(np.concatenate((starts, [len(x)])))
    return [ws[k] for k in x[starts]], near.tolist(), n[y[starts]].tolist(), [ws[k] for k in y[starts]]


def near_words(words: DataFrame, groups: int | None = None) -> DataFrame:
    """(word, n, n_near, best, best_n) of distinct `words` (word, n): the number of words
    that differ by one inserted, deleted or replaced letter, and of these the one
    with the largest n (ties: the first in code-point order); 0 and nulls where there is
    none.  Words consist of a-z and U+00C0 to U+00FF; no limit on their length or number."""
    spark = words.sparkSession
    coded = words.select(F.encode("word", "ISO-8859-1").alias("w"), "n")
    total = words.count()
    if groups is None:
        groups = min(24, max(4, round(math.log2(max(total, 2)) / 2)))
    group = deal_letters(letter_weights(coded), groups)
    keyed = block_rows(coded, group)
    # Blocks with two words or more, at least one of them without its edited letter.
    sizes = (keyed.groupBy("size", "key").agg(F.count(F.lit(1)).alias("rows"), F.max("g").alias("g")).where("rows > 1 and g >= 0")
             .select("size", "key", F.ceil(F.col("rows") * (F.col("size") + 1) / TILE_BYTES).cast("int").alias("tiles")))
    units = (keyed.join(sizes.hint("shuffle_hash"), ["size", "key"])
             .withColumn("t", F.pmod(F.xxhash64("w"), F.col("tiles")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("size", "key", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "g", "w", "n", "t"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unit = ["size", "key", "i", "j"]
    dealt = units.repartition(parts, *unit).sortWithinPartitions(*unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(parts_: list[pa.Table]) -> pa.RecordBatch:
            cols: tuple[list, ...] = ([], [], [], [])
            for p in parts_:
                for c, more in zip(cols, _unit(p, group), strict=True):
                    c += more
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                              names=["w", "near", "best_n", "best"])

        for b in batches:
            if not len(b):
                continue
            rows = pa.Table.from_batches([b])
            rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
            cols = [rows.column(c).to_numpy() for c in unit]
            cut = (np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1).tolist()
            # The last unit may go on in the next batch.
            held = rows.slice(cut[-1] if cut else 0)
            yield done([rows.slice(x, y - x) for x, y in zip([0, *cut], cut, strict=False)])
        if held is not None:
            yield done([held])

    found = (dealt.mapInArrow(run, "w binary, near bigint, best_n bigint, best binary").groupBy("w")
             .agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("b"))
             .select(F.decode("w", "ISO-8859-1").alias("word"), "n_near", F.decode("b.w", "ISO-8859-1").alias("best"),
                     (-F.col("b.n")).alias("best_n")))
    return (words.join(found, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "best", "best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the last word that following forms reaches.  Forms
    must not run in circles; each round doubles the steps followed."""
    now, path = materialize(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots",
                            with_path=True)
    paths = [path]
    while not now.where("moved").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now, path = materialize(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots", with_path=True)
        paths.append(path)
    for path in paths[:-1]:
        drop_path(forms.sparkSession, path)
    return now.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_n: int = 3,
             times: int = 2, drop: int | None = None) -> DataFrame:
    """One row per word of `docs`: word, form, root, n, n_near, form_n.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF of all whole texts, A-Z in
    lower case, with `least_length` letters or more, that occur `least_n` times or more.
    A word's form is its near word (one inserted, deleted or replaced letter) of largest n
    (ties: the first in code-point order) if that n is at least `times` times the word's own;
    else null.  The root is where following forms ends, the word itself if it has none.
    Null and empty texts have no words; repeated rows count as often as they stand; a null
    id reads as the empty text in `drop`.  An empty table gives no rows.  Other
    columns are not read.
    """
    if times < 2:
        raise ValueError("forms could run in circles")
    words = materialize(count_words(docs, id_col, text_col, least_length, drop).where(F.col("n") >= least_n), "spelling-words")
    near = materialize(near_words(words), "spelling-near")
    has = F.col("best_n") >= F.col("n") * times
    formed = near.select("word", "n", "n_near", F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"))
    ends = roots(formed.where(F.col("form").isNotNull()).select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
