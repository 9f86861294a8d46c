"""Repeated passages across documents: brute force on branching texts, odd rows, parts."""

import random
import re

import numpy as np
import pytest

from reviewmill.llm import debruijn
from reviewmill.llm.shingles import WordHashes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """Words, number removed and kept words of each row, from sets of whole windows."""
    late = float("inf")
    first: dict[tuple, float] = {}
    texts = [(late if i is None else i, WORDS.findall(t or "")) for i, t in rows]
    for key, words in texts:
        for at in range(len(words) - window + 1):
            run = tuple(words[at : at + window])
            first[run] = min(first.get(run, late), key)
    out = []
    for key, words in texts:
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < key:
                gone.update(range(at, at + window))
        out.append((len(words), len(gone), [w for j, w in enumerate(words) if j not in gone]))
    return out


def found(spark, rows, window):
    docs = spark.createDataFrame([(n, i, t) for n, (i, t) in enumerate(rows)],
                                 "place long, doc_id long, text string")
    made = sorted(debruijn.drop_repeated_spans(docs, window=window).collect(), key=lambda r: r["place"])
    return [(r["n_words"], r["n_removed"], WORDS.findall(r["text"] or "")) for r in made]


def branching(seed, count):
    """Texts put together from few parts, so that paths split, join, begin and end everywhere."""
    draws = random.Random(seed)
    parts = [[f"w{draws.randrange(9)}" for _ in range(draws.randrange(1, 40))] for _ in range(12)]
    rows = []
    for _ in range(count):
        words = [w for _ in range(draws.randrange(6)) for w in draws.choice(parts)]
        if words and draws.random() < 0.5:
            words[draws.randrange(len(words))] = f"x{draws.randrange(5)}"
        spaces = [draws.choice([" ", "\n", " \t ", "\r\n"]) for _ in words]
        key = None if draws.random() < 0.05 else draws.randrange(count)
        rows.append((key, "".join(a + b for a, b in zip(words, spaces))))
    return rows + rows[:10]


@pytest.mark.parametrize(("seed", "window"), [(1, 6), (2, 20), (3, 50)])
def test_matches_brute_force(spark, seed, window):
    rows = branching(seed, 120)
    expected = brute(rows, window)
    assert found(spark, rows, window) == expected
    assert sum(n for _, n, _ in expected) > 0


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    long = " ".join(f"l{i}" for i in range(30_000))
    rows = [
        (1, passage), (2, f"a {passage} b"), (None, passage), (None, passage), (3, None), (4, ""),
        (5, " \n "), (6, passage[:-1]), (7, f"{passage} x"), (1, f"other {passage}"),
        (8, f"{passage}\n{passage}"), (9, long), (10, f"new {long}"), (0, f"{passage} {passage}"),
    ]
    assert found(spark, rows, 50) == brute(rows, 50)


def test_columns_spaces_and_empty_table(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(1, passage, 5, "k"), (2, f"a\n{passage}  b", 6, None), (3, None, 7, "_id")]
    docs = spark.createDataFrame(rows, "ID long, body string, N_Words int, _th string")
    made = {r["ID"]: r for r in debruijn.drop_repeated_spans(docs, "ID", "body").collect()}
    assert made[2].asDict() == {"ID": 2, "body": "a\nb", "_th": None, "n_words": 52, "n_removed": 50}
    assert made[1]["body"] == passage and made[3]["body"] is None and made[3]["_th"] == "_id"
    assert debruijn.drop_repeated_spans(docs.limit(0), "ID", "body").count() == 0


def test_wrong_source_digest_keeps_words(spark):
    docs = spark.createDataFrame([("a b c d",)], "text string")
    cut = debruijn.cut_words(2)
    shown = docs.selectExpr("text", "array(0L) AS at", "array(1L) AS n", "array(X'00') AS d")
    assert shown.select(cut("text", "at", "n", "d").alias("c")).first()["c"].asDict() == {
        "text": "a b c d", "n": 0}


def test_equal_windows_hold_the_same_node():
    draws = random.Random(4)
    hashes = WordHashes()
    middle = [str(draws.randrange(50)).encode() for _ in range(50)]
    chosen = set()
    for _ in range(50):
        left = [str(draws.randrange(50)).encode() for _ in range(draws.randrange(40))]
        right = [str(draws.randrange(50)).encode() for _ in range(draws.randrange(40))]
        words = left + middle + right
        runs = debruijn.RunHashes(words, hashes)
        starts = np.arange(len(words) - 15)
        at, lo = debruijn.sampled_nodes(runs.of(starts, starts + 16), 35)
        ruler = at[np.searchsorted(lo, len(left), side="right") - 1]
        assert len(left) <= ruler <= len(left) + 34
        chosen.add(int(ruler) - len(left))
    assert len(chosen) == 1


def test_run_hash_depends_on_words_only():
    hashes = WordHashes()
    one = debruijn.RunHashes([b"a", b"b", b"c", b"a", b"b"], hashes)
    runs = one.of(np.array([0, 3, 1, 0]), np.array([2, 5, 3, 3]))
    assert runs[0] == runs[1] and len(set(runs.tolist())) == 3
