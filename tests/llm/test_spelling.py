"""Spelling variants: brute force over deletions, odd rows, tree parts."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SMALL

from reviewmill.llm import spelling
from reviewmill.llm.queries import QUERIES


def brute_counts(rows, noise):
    counts = Counter()
    for key, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_variants(counts, ratio=10):
    """Words that share a text with one letter less, or are it, compared letter by letter."""
    holes = defaultdict(set)
    for word in counts:
        holes[word].add(word)
        for at in range(len(word)):
            holes[word[:at] + word[at + 1 :]].add(word)
    near = defaultdict(set)
    for group in holes.values():
        for one in group:
            for two in group:
                if one != two and one_edit(one, two):
                    near[one].add(two)
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= ratio * n:
            forms[word] = best
    out = set()
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out.add((word, form, root, n, len(near[word]), counts.get(form)))
    return out


def one_edit(one, two):
    if len(one) == len(two):
        return sum(a != b for a, b in zip(one, two)) == 1
    short, long = sorted((one, two), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def as_rows(frame):
    columns = ("word", "form", "root", "n", "n_near", "form_n")
    return [tuple(row[c] for c in columns) for row in frame.collect()]


def test_query_matches_brute_force(spark):
    made = as_rows(QUERIES["op13_spelling_variants"](spark, SMALL))
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    expected = brute_variants(brute_counts(rows, 31))
    assert len(made) == len(set(made)) and set(made) == expected
    assert any(form for _, form, *_ in expected)


def small_words(seed, count):
    """Words of few letters, so that most are near others, and chains of forms occur."""
    draws = random.Random(seed)
    return {"".join(draws.choices("abé", k=draws.randrange(7, 10))): draws.choice([2, 3, 20, 200, 2000, 2000])
            for _ in range(count)}


@pytest.mark.parametrize("limits", [(32_768, 131_072, 32), (40, 60, 4), (300, 25, 8)])
def test_all_pairs_with_small_boxes_and_shares(spark, monkeypatch, limits):
    for name, value in zip(("BOX_WORDS", "MOST_WORDS", "LEAF"), limits):
        monkeypatch.setattr(spelling, name, value)
    counts = small_words(3, 1500)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    made = as_rows(spelling.spelling_variants(words))
    assert len(made) == len(counts) and set(made) == brute_variants(counts)


def test_sample_decides_nothing(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BOX_WORDS", 20)
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 60)
    counts = small_words(4, 600) | {"ööööööööööö": 2, "öööööööööö": 5000}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert set(as_rows(spelling.spelling_variants(words))) == brute_variants(counts)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "Colours COLOURS colours"), (3, "Colours COLOURS colours"),
        (None, "colours color colores colores"), (4, "coloürs×coloürs÷ " * 3), (5, "ÀÉÎÕÜÇÑ àéîõüçñ àéîõüçñ"),
        (6, "colorss " * 50 + "colorsss"), (7, "日本colours語colours1colours_colours"), (8, "x" * 3000),
        (9, "x" * 3000 + " " + "x" * 2999 + " " + "x" * 2999), (10, "kolours kolours\x00kolours"),
    ]
    docs = spark.createDataFrame([(k, t, 1, "w") for k, t in rows], "doc_id long, text string, n int, word string")
    for noise in (None, 3):
        made = as_rows(spelling.spelling_groups(docs, noise=noise))
        assert set(made) == brute_variants(brute_counts(rows, noise))
    assert spelling.spelling_groups(docs.limit(0)).count() == 0


def test_chain_leads_to_the_last_form(spark):
    words = [("aaaaaaa", 2), ("aaaaaab", 20), ("aaaaabb", 200), ("aaaabbb", 2000), ("aaabbbb", 20000)]
    frame = spark.createDataFrame(words, "word string, n long")
    assert {r["root"] for r in spelling.spelling_variants(frame).collect()} == {"aaabbbb"}
    with pytest.raises(ValueError):
        spelling.spelling_variants(frame, ratio=1)


def test_edit_check_by_columns():
    draws = random.Random(1)
    words = ["".join(draws.choices("ab", k=7)) for _ in range(60)]
    longer = ["".join(draws.choices("ab", k=8)) for _ in range(60)]
    codes = spelling.letter_counts(words)[0]
    assert spelling.one_edit(codes, codes[::-1]).tolist() == [
        one_edit(a, b) for a, b in zip(words, words[::-1])]
    assert spelling.one_edit(codes, spelling.letter_counts(longer)[0]).tolist() == [
        one_edit(a, b) for a, b in zip(words, longer)]


def test_every_box_in_reach_is_searched():
    draws = np.random.default_rng(2)
    points = draws.integers(0, 5, size=(500, spelling.LETTERS + 1)).astype(np.int8)
    tree = spelling.Boxes(points, 500 * spelling.BOX_WORDS / 20, 7)
    home = {int(i): box for index, box in tree.within(points, 0) for i in index}
    assert len(home) == 500 and len(set(home.values())) == tree.count > 10
    reached = {(int(i), box) for index, box in tree.within(points, 6) for i in index}
    apart = np.abs(points[:, None, :].astype(int) - points[None, :, :]).sum(axis=2)
    bits = spelling.as_bits(points)
    assert (np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2) == apart).all()
    for one, two in zip(*np.nonzero(apart <= 6)):
        assert (int(one), home[int(two)]) in reached
