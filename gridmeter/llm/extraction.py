"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is the sequence of its leaf blocks (`page_blocks`); each is article or not.
Features of a block are the elements around it, the words of their class, id and role,
and the shape of its text (length, links, punctuation, place).  A linear chain joins the
labels of neighbours.  It is fitted by gradient ascent on the log likelihood of labelled
pages, and pages are decoded by Viterbi's algorithm in tasks, page by page.

The pages it learns from are composed by `page_samples` (at most `SAMPLE`, a parameter); any
other list of (html, texts of the article's blocks) does as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmeter.llm.page_blocks import Block, read
from gridmeter.llm.page_samples import labelled_pages

SAMPLE = 1_000
MARK = "\ue000"
_WORDS = re.compile(r"[^\W\d_]+")
# Words that notices, forms, adverts and comments use of themselves.
_CUE = re.compile(r"\b(?:cookies?|consent|privacy|subscribe|newsletter|login|advertisement|sponsored|copyright|comments?|reply)\b", re.I)


def _step(n: int, borders: tuple[int, ...]) -> int:
    return sum(n >= b for b in borders)


def shapes(blocks: list[Block], title: str) -> list[tuple]:
    """What the text of each block looks like, and where it stands."""
    out, headed, last = [], False, len(blocks) - 1
    for i, b in enumerate(blocks):
        text, n = b.text, len(b.text)
        headed = headed or b.tag == "h1"
        out.append((b.tag, _step(text.count(" ") + 1 if n < 2_000 else 400, (2, 4, 9, 21, 51)),
                    _step(100 * b.linked // n, (1, 50, 90)) if b.linked else 0, text[-1] in ".!?:;\"'»”。", b.marked * 2 > n,
                    text[0] in "©(", n < 400 and _CUE.search(text) is not None,
                    3 < n < 2_000 and title.startswith(text[:60]), headed, i == 0, i == last))
    return out


def names(shape: tuple) -> set[str]:
    """Names of the features of a shape."""
    tag, size, linked, ends, marked, sign, cue, title, headed, first, last = shape
    out = {f"tag {tag}", f"size {size}", f"linked {linked}", f"tag {tag} size {size}", f"tag {tag} linked {linked}",
           "ends" if ends else "open", "headed" if headed else "before head"}
    return out | {name for name, on in (("marked", marked), ("sign", sign), ("cue", cue), ("title", title), ("first", first),
                                        ("last", last)) if on}


def features(blocks: list[Block], title: str) -> list[set[str]]:
    """Names of the features that each block has: its shape, and what lies around it."""
    return [names(s) | b.around for s, b in zip(shapes(blocks, title), blocks, strict=True)]


def _chains(pages: list[tuple[list[set[str]], list[int]]]) -> tuple:
    """Feature numbers of all blocks, padded: chains as rows, places as columns."""
    pages = sorted((p for p in pages if p[0]), key=lambda p: -len(p[0]))  # so the pages that reach a place come first
    numbers: dict[str, int] = {}
    rows = [[numbers.setdefault(f, len(numbers)) for f in sorted(block)] for fs, _ in pages for block in fs]
    size = np.array([len(r) for r in rows])
    flat = np.concatenate([np.array(r, np.int64) for r in rows])
    lens = np.array([len(fs) for fs, _ in pages])
    place = np.concatenate([np.arange(n) for n in lens])
    chain = np.repeat(np.arange(len(pages)), lens)
    labels = np.concatenate([np.array(y) for _, y in pages])
    return numbers, flat, size, chain, place, labels, lens


def fit(pages: list[tuple[list[set[str]], list[int]]], steps: int = 200, ridge: float = 1e-5) -> dict:
    """Weights of (features of each block, labels 0 or 1) by Adam on the mean log likelihood.

    `weights` has a feature's worth for label 1 against 0, `moves` the worth of going from
    a label to the next, `start` that of beginning with 1.
    """
    numbers, flat, size, chain, place, labels, lens = _chains(pages)
    n, longest = len(lens), int(lens.max())
    there = np.arange(longest)[None] < lens[:, None]
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    block = np.repeat(np.arange(len(size)), size)
    gold = np.zeros((n, longest), np.int64)
    gold[chain, place] = labels
    both = there[:, 1:]
    reach = there.sum(0)  # pages with a block at each place
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    theta = np.zeros(len(numbers) + 5)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, moves, start = theta[:-5], theta[-5:-1].reshape(2, 2), theta[-1]
        # Forward and backward sums, scaled to 1 at each place, all pages at once; past a
        # page's end nothing changes.
        odds = np.ones((n, longest))
        odds[chain, place] = np.exp(np.clip(np.add.reduceat(w[flat], first), -30, 30))
        m = np.exp(moves)
        fwd, bwd = np.zeros((2, n, longest)), np.full((2, n, longest), 0.5)
        fwd[0, :, 0], fwd[1, :, 0] = 1, np.exp(start) * odds[:, 0]
        for t in range(longest):
            k = reach[t]
            if t:
                a, b = fwd[:, :k, t - 1]
                fwd[0, :k, t], fwd[1, :k, t] = a * m[0, 0] + b * m[1, 0], (a * m[0, 1] + b * m[1, 1]) * odds[:k, t]
            fwd[:, :k, t] /= fwd[0, :k, t] + fwd[1, :k, t]
        for t in range(longest - 2, -1, -1):
            k = reach[t + 1]
            a, b = bwd[0, :k, t + 1], bwd[1, :k, t + 1] * odds[:k, t + 1]
            x, y = m[0, 0] * a + m[0, 1] * b, m[1, 0] * a + m[1, 1] * b
            bwd[0, :k, t], bwd[1, :k, t] = x / (x + y), y / (x + y)
        here = fwd[:, chain, place] * bwd[:, chain, place]
        p1 = here[1] / (here[0] + here[1])
        ahead = bwd[:, :, 1:][:, both]
        ahead[1] *= odds[:, 1:][both]
        pair = fwd[:, :, :-1][:, both][:, None] * m[:, :, None] * ahead[None]
        pair /= pair.sum((0, 1))
        grad = np.zeros_like(theta)
        grad[:-5] = np.bincount(flat, weights=(labels - p1)[block], minlength=len(numbers))
        grad[-5:-1] = (seen_moves - pair.sum(2)).ravel()
        grad[-1] = gold[:, 0].sum() - p1[place == 0].sum()
        grad = grad / len(size) - ridge * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
        theta = theta + (0.3 if step < steps * 2 // 3 else 0.03) * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-9)
    return {"weights": {f: float(theta[k]) for f, k in numbers.items()}, "moves": theta[-5:-1].reshape(2, 2).tolist(), "start": float(theta[-1])}


def train(samples: list[tuple[str, list[str]]] | None = None, sample: int = SAMPLE) -> dict:
    """The model of labelled pages: (html, texts of the article's blocks, in order), or of
    `sample` composed ones.  The order settles which of two blocks with one text is meant."""
    pages = []
    if samples is None:
        for html in labelled_pages(sample, mark=MARK):
            blocks, title = read(html)
            labels = [int(MARK in b.text) for b in blocks]
            clean = [b._replace(text=b.text.replace(MARK, "")) for b in blocks]
            pages.append((features([b for b in clean if b.text], title), [y for b, y in zip(clean, labels, strict=True) if b.text]))
        return fit(pages)
    for html, texts in samples:
        blocks, title = read(html)
        labels, at = [], 0
        for b in blocks:
            hit = b.text in texts[at:]
            at = texts.index(b.text, at) + 1 if hit else at
            labels.append(int(hit))
        pages.append((features(blocks, title), labels))
    return fit(pages)


def viterbi(emission: list[float], moves: list[list[float]], start: float) -> list[int]:
    """The likeliest labels of a chain."""
    if not emission:
        return []
    (m00, m01), (m10, m11) = moves
    v0, v1 = 0.0, start + emission[0]
    back = []
    for e in emission[1:]:
        a0, b0, a1, b1 = v0 + m00, v1 + m10, v0 + m01, v1 + m11
        back.append((b0 > a0, b1 > a1))
        v0, v1 = (b0 if b0 > a0 else a0), (b1 if b1 > a1 else a1) + e
    label = int(v1 > v0)
    out = [label]
    for pair in reversed(back):
        label = int(pair[label])
        out.append(label)
    return out[::-1]


class Reader:
    """Reads pages by a model; remembers the worth of shapes and surroundings met before."""

    def __init__(self, model: dict):
        self.model, self.shapes, self.around = model, {}, {}

    def _worth(self, memory: dict, key, found) -> float:
        worth = memory.get(key)
        if worth is None:
            if len(memory) > 50_000:
                memory.clear()
            get = self.model["weights"].get
            worth = memory[key] = sum(get(f, 0.0) for f in sorted(found(key)))
        return worth

    def main_blocks(self, page: str) -> list[str]:
        """The texts of the blocks of a page that belong to its article, in page order."""
        blocks, title = read(page, self.model["weights"])
        emission = [self._worth(self.shapes, s, names) + self._worth(self.around, b.around, iter)
                    for s, b in zip(shapes(blocks, title), blocks, strict=True)]
        labels = viterbi(emission, self.model["moves"], self.model["start"])
        return [b.text for b, y in zip(blocks, labels, strict=True) if y]


def extract(pages: DataFrame, model: dict, html_col: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the main text of each whole page: its blocks in page order, two line
    feeds between them.

    Character references are decoded; each run of white space (Unicode's, as Python's
    `split` has it) in a block is one space.  A `br` is white space.  Null and empty
    pages, and pages without an article, have the empty text.  Repeated rows give
    repeated rows, an empty table none.  A column named `out` is replaced.
    """
    pages = pages.drop(out) if out.lower() in [c.lower() for c in pages.columns] else pages

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(model)
        for htmls in batches:
            # One page at a time as a Python string.
            yield pa.array(["\n\n".join(reader.main_blocks(h.as_py() or "")) for h in htmls], pa.string())

    return pages.withColumn(out, run(F.col(html_col)))
