"""Exact duplicates, near-duplicates and repeated passages against brute force."""

import hashlib
import random
import re

import pytest

from reviewmill.llm.components import components
from reviewmill.llm.exact_dedup import exact_dedup
from reviewmill.llm.line_dedup import line_dedup
from reviewmill.llm.minhash import drop_near_duplicates, near_duplicates

DOCS = "doc_id bigint, text string"
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def words_of(seed, count, base=900):
    rng = random.Random(seed)
    return [f"w{rng.randrange(base)}" for _ in range(count)]


# ---- exact -----------------------------------------------------------------------------------

EXACT = [
    (5, "a  b"), (2, "a b"), (9, "a\tb"), (1, "a b "), (7, None), (3, ""), (8, "x" * 20_000),
    (4, "x" * 20_000), (6, "x" * 19_999 + "y"), (6, "again"), (6, "again"), (None, "again"),
    (None, "alone"), (None, None),
]


@pytest.mark.parametrize("hash_all", [True, False])
def test_exact_groups_match_brute_force(spark, hash_all):
    found = exact_dedup(frame(spark, EXACT), hash_all=hash_all).collect()
    groups = {}
    for doc_id, text in EXACT:
        groups.setdefault(SPACES.sub(" ", text or ""), []).append(doc_id)
    expected = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, keep, len(ids), i == keep, digest) for i in ids]
    rows = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found]
    if not hash_all:
        assert {r[4] for r in rows} <= {e[4] for e in expected} | {None}
        rows, expected = [r[:4] for r in rows], [e[:4] for e in expected]
    assert sorted(rows, key=str) == sorted(expected, key=str)


def test_exact_on_an_empty_table_and_clashing_names(spark):
    assert exact_dedup(frame(spark, [])).count() == 0
    clash = frame(spark, [(1, "a", True, 5)], f"{DOCS}, kept boolean, group_size int")
    assert exact_dedup(clash).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


# ---- components ------------------------------------------------------------------------------

def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    links += [(200, 201), (201, 202), (202, 200), (300, 300), (41, 40)]
    roots = {r["_node"]: r["_root"] for r in components(frame(spark, links, "a int, b int")).collect()}
    assert {roots[i] for i in range(42)} == {0}
    assert {roots[100 + i] for i in range(30)} == {100}
    assert {roots[i] for i in (200, 201, 202)} == {200}
    assert components(frame(spark, [], "a int, b int")).count() == 0


# ---- near ------------------------------------------------------------------------------------

def shingles(text, size):
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_components(rows, size):
    sets = [(i, shingles(t, size)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(x)] = find(y)
    best = {}
    for x, (i, _) in enumerate(sets):
        best[find(x)] = min(best.get(find(x), 1 << 62), 1 << 61 if i is None else i)
    return {(i, t): (len(s), best[find(x)]) for x, ((i, t), (_, s)) in enumerate(zip(rows, sets))}


def near_rows():
    rng, rows, number = random.Random(1), [], 0
    for group in range(12):
        base = words_of(group, 120)
        for copy in range(rng.choice([1, 2, 9])):
            words = list(base)
            for _ in range(copy % 5):
                words[rng.randrange(len(words))] = f"new{rng.random()}"
            rows.append((number, " ".join(words)))
            number += 1
    rows += [(900, None), (901, ""), (902, " \t"), (903, "One two"), (904, "one  TWO"), (905, "one")]
    rows += [(906, rows[0][1]), (906, rows[0][1]), (907, " ".join(words_of(77, 30_000)))]
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_match_brute_force(spark, size):
    rows = near_rows()
    expected = brute_components(rows, size)
    found = near_duplicates(frame(spark, rows), words=size).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        assert (r.n_shingles, r.component_id) == expected[(r.doc_id, texts[r.doc_id])]
        assert r.kept == (r.doc_id == r.component_id)


def test_a_large_group_of_near_copies_is_cut_into_blocks(spark, monkeypatch):
    from reviewmill.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng, base, rows = random.Random(5), words_of(3, 100), []
    for number in range(60):
        words = list(base)
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = f"x{number}-{rng.random()}"
        rows.append((number, " ".join(words)))
    expected = brute_components(rows, 5)
    found = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert found == {i: root for (i, _), (_, root) in expected.items()}


def test_groups_dealt_stay_few_with_one_large_component(spark, monkeypatch):
    """A bucket of 20 blocks, all but three members in one component: each member is dealt about once."""
    from pyspark.sql import functions as F

    from reviewmill.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK", 50)
    row = F.struct(F.col("id"), F.lit(0).cast("bigint").alias("th"))
    buckets = spark.range(1000).select(F.lit(7).cast("bigint").alias("_bucket"), row.alias("_node"),
                                       F.lit(10).cast("bigint").alias("_n"))
    first = F.struct(F.lit(0).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("th"))
    roots = spark.range(997).select(row.alias("_node"), first.alias("_root"))
    dealt = minhash.dealt_members(minhash.open_members(buckets, roots)).toPandas()
    assert len(dealt) <= 1000 + 3 * 20
    assert dealt.groupby(["_i", "_j"]).size().max() <= 2 * 50 + 40
    # Every member outside meets every block, and members of the component do not meet each other.
    met = {(i, j) for i, j in zip(dealt["_i"], dealt["_j"])}
    assert met == {(-block, 0) for block in range(1, 21)} | {(0, 0)}


def test_pairs_at_the_limit_pass_the_estimates():
    """Planted pairs of similarity 0.80 to 0.82: bands and estimates lose none of them."""
    import numpy as np

    from reviewmill.llm import minhash
    from reviewmill.llm.shingles import hash_family, minima

    draws = np.random.default_rng(9)
    coarse, fine = hash_family(minhash.COARSE, minhash.SEED), hash_family(minhash.FINE, minhash.SEED + 1)
    lost = 0
    for _ in range(1500):
        common, own = 80 + draws.integers(0, 3), 20
        values = draws.integers(0, 2**64, size=common + own, dtype=np.uint64)
        cut = common + int(draws.integers(0, own + 1))
        one, two = values[:cut], np.concatenate((values[:common], values[cut:]))
        low = [minima(x, coarse).reshape(minhash.BANDS, minhash.ROWS) for x in (one, two)]
        shares = (low[0] == low[1]).all(axis=1).any()
        signs = [minima(x, fine).astype(np.uint8) for x in (one, two)]
        alike = (signs[0] == signs[1]).mean() >= minhash.FINE_AT_LEAST * (1 - 1 / 256) + 1 / 256
        lost += not (shares and alike)
    assert lost == 0


def test_dropping_near_duplicates_keeps_columns_and_rows_without_text(spark):
    rows = [(1, "a b c d e f", 1), (2, "a b c d e f", 2), (3, None, 3), (None, "q", 4)]
    docs = frame(spark, rows, f"{DOCS}, kept int")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], *rows[2:]], key=str)
    assert drop_near_duplicates(docs.where("doc_id > 9")).count() == 0


# ---- lines -----------------------------------------------------------------------------------

def brute_lines(rows, min_words=50):
    """Removed line places by document: every run that also stands earlier, from all pairs of lines."""
    texts = [(i, [(k, tuple(line.encode().split())) for k, line in enumerate((t or "").split("\n"))])
             for i, t in sorted(rows, key=lambda r: r[0])]
    texts = [(i, [line for line in lines if line[1]]) for i, lines in texts]
    places = [(d, k) for d, (_, lines) in enumerate(texts) for k in range(len(lines))]
    by_line = {}
    out = {doc: set() for doc, _ in texts}
    for d, k in places:
        doc, lines = texts[d]
        for e, m in by_line.get(lines[k][1], []):
            source, n, words = texts[e][1], 0, 0
            while k + n < len(lines) and m + n < len(source) and lines[k + n][1] == source[m + n][1]:
                words += len(lines[k + n][1])
                n += 1
            if words >= min_words:
                out[doc] |= set(range(lines[k][0], lines[k + n - 1][0] + 1))
        by_line.setdefault(lines[k][1], []).append((d, k))
    return out


def line_rows():
    rng = random.Random(11)
    pool = [" ".join(words_of(1000 + k, rng.randrange(1, 30))) for k in range(40)]
    passage = "\n".join(pool[:6])
    rows = []
    for number in range(40):
        own = [" ".join(words_of(5000 + 50 * number + k, rng.randrange(1, 25))) for k in range(8)]
        if number % 3 == 0:
            own.insert(rng.randrange(8), passage)
        if number % 4 == 0:
            own.insert(rng.randrange(8), pool[rng.randrange(40)])
        if number % 5 == 0:
            own += ["", "  ", passage, own[0], passage]
        rows.append((number, "\n".join(own)))
    rows += [(50, rows[3][1]), (51, None), (52, ""), (53, "\n\n"), (54, "z\n" * 300)]
    return rows


def test_line_dedup_matches_brute_force(spark):
    rows = line_rows()
    gone = brute_lines(rows)
    assert sum(map(len, gone.values())) > 100
    for r in line_dedup(frame(spark, rows)).collect():
        text = dict(rows)[r.doc_id]
        lines = (text or "").split("\n")
        left = "\n".join(line for k, line in enumerate(lines) if k not in gone.get(r.doc_id, ()))
        assert r.text == (None if text is None else left)
        assert r.removed_lines == len(gone.get(r.doc_id, ()))


def test_a_run_is_found_whoever_holds_its_windows_first(spark):
    one, two = " ".join(words_of(1, 50)), "three more words"
    rows = [(1, one), (2, f"{one}\n{two}"), (3, f"{one}\n\n{two}\nend"), (4, f"start\n{two}\n{one}")]
    found = {r.doc_id: r.text for r in line_dedup(frame(spark, rows)).collect()}
    assert found == {1: one, 2: two, 3: "end", 4: f"start\n{two}"}


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_of_texts_from_few_lines(spark, seed):
    """Runs overlap, repeat within a text, and meet at lines with many and with few words."""
    rng = random.Random(seed)
    pool = [" ".join(words_of(100 * seed + k, rng.choice([2, 5, 11, 26, 55, 60]))) for k in range(9)]
    rows = [(i, "\n".join(rng.choice([*pool, ""]) for _ in range(rng.randrange(14)))) for i in range(40)]
    gone = brute_lines(rows)
    for r in line_dedup(frame(spark, rows)).collect():
        lines = dict(rows)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for k, x in enumerate(lines) if k not in gone[r.doc_id])


def test_fewer_fingerprints_than_lines():
    from reviewmill.llm.line_dedup import fingerprints, worded_lines

    text = "\n".join(" ".join(words_of(k, 12)) for k in range(3000))
    places, hashes, counts = worded_lines(text)
    found = fingerprints(hashes, counts, 50)
    assert len(found) < 0.45 * len(counts)
    covered = {line for runs in found.values() for a, z in runs for line in range(a, z + 1)}
    assert covered == set(range(len(counts)))


def test_line_dedup_of_repeated_rows_null_ids_and_clashing_names(spark):
    long = " ".join(words_of(1, 60))
    rows = [(1, long, 7), (1, long, 8), (2, long, 9), (None, long + "\nmore", 10)]
    found = line_dedup(frame(spark, rows, f"{DOCS}, n_lines int")).collect()
    assert sorted((str(r.doc_id), r.text, r.n_lines) for r in found) == [
        ("1", long, 1), ("1", long, 1), ("2", "", 1), ("None", "more", 2),
    ]
    assert line_dedup(frame(spark, [])).count() == 0


def test_every_line_stays_somewhere(spark):
    rows = line_rows()
    every = {line for _, t in rows for line in (t or "").split("\n") if line.strip()}
    left = {line for r in line_dedup(frame(spark, rows)).collect() for line in (r.text or "").split("\n")}
    assert every <= left
