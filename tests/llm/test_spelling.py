"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridmeter.llm import queries, spelling
from tests.llm.conftest import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a: str, b: str) -> bool:
    """One inserted, deleted or replaced code point."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_counts(rows) -> Counter:
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 97 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            found[word] += 1
    return Counter({w: n for w, n in found.items() if len(w) >= 5 and n >= 3})


def deletions(word: str) -> set[str]:
    return {word[:i] + word[i + 1:] for i in range(len(word))} | {word}


def brute(counts) -> list[tuple]:
    """Sorted (word, form, root, n, n_near, form_n); words that share a deletion are compared."""
    shared, form, out = {}, {}, []
    for w in counts:
        for d in deletions(w):
            shared.setdefault(d, set()).add(w)
    around = {w: {v for d in deletions(w) for v in shared[d] if v != w and near(v, w)} for w in counts}
    for w in counts:
        best = min(around[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(around[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def answer(spark, tmp, df):
    found = queries.op13_spelling(spark, table(str(tmp), "documents", df))
    return sorted(map(tuple, found.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_query_equals_brute_force(spark, docs, tmp_path):
    got = answer(spark, tmp_path, docs)
    assert got == brute(brute_counts([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert any(r[1] for r in got) and any(r[2] != (r[1] or r[0]) for r in got)


def test_odd_rows(spark, odd, tmp_path):
    """Nulls, empty and very long texts, repeated rows, clashing names."""
    assert answer(spark, tmp_path, odd) == brute(brute_counts([(r["doc_id"], r["text"]) for r in odd.collect()]))


def test_empty_table(spark, empty, tmp_path):
    assert answer(spark, tmp_path, empty) == []


def test_all_pairs_in_tiles(spark, monkeypatch):
    """A block of many words over few letters, cut into tiles and short products; every pair once."""
    monkeypatch.setattr(spelling, "TILE_BYTES", 60)
    monkeypatch.setattr(spelling, "ROWS", 7)
    r = random.Random(5)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randint(4, 7))) for _ in range(260)} | {"ÿ" * 3_000, "ÿ" * 2_999 + "a", "ÿ" * 2_999})
    counts = {w: r.randint(1, 9) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(5)
    got = {x["word"]: (x["n_near"], x["best"], x["best_n"]) for x in spelling.near_words(df, groups=3).collect()}
    for w in words:
        around = [v for v in words if near(v, w) and v != w]
        best = min(around, key=lambda v: (-counts[v], v), default=None)
        assert got[w] == (len(around), best, counts.get(best)), w


@pytest.mark.parametrize("groups", [1, 4, 24])
def test_groups_do_not_change_results(spark, groups):
    words = ["abcde", "abcdf", "abcd", "bacde", "abcdef", "aabcde", "abcdé", "zzzzz", "zzzzzz", "zzzzzzz"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    got = {x["word"]: x["n_near"] for x in spelling.near_words(df, groups=groups).collect()}
    assert got == {w: sum(near(v, w) for v in words if v != w) for w in words}


def test_forms_are_followed_to_the_end(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [("x", "w7")]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {f"w{i}": "w40" for i in range(40)} | {"x": "w40"}


def test_counter_over_many_slices(monkeypatch):
    """Texts in slices, a memory that is emptied, and crc32 of prefix and word from its parts."""
    monkeypatch.setattr(spelling, "SLICE", 50)
    r = random.Random(2)
    letters = "abcXYZÀ×ÿĀΔ¿日 -1"
    texts = [(i, "".join(r.choice(letters) for _ in range(r.randint(0, 900)))) for i in range(300)]
    counter, got = spelling.Counter(97), Counter()

    def flush():
        rows = counter.rows(5)
        got.update(dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)))

    for key, text in texts:
        for words in spelling.runs(text.encode()):
            counter.add(f"{key}:".encode(), words)
        if len(counter.numbers) > 100:
            flush()
    flush()
    assert Counter({w: n for w, n in got.items() if n >= 3}) == brute_counts(texts)


def test_letters_are_dealt_evenly():
    group = spelling.deal_letters([90 - i for i in range(90)], 9)
    assert np.bincount(group).tolist() == [10] * 9
