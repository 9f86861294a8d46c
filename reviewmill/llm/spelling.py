"""Spelling variants: k-d trees over letter counts, box-pruned range search, letter order verified.

Words are points whose coordinates count their letters. One edit changes the counts by at most two in
all: exactly one for an inserted or deleted letter, two for a replaced one (or none within the last
coordinate, which counts all letters beyond a to z). So near words lie within that L1 distance, either
among the words of one length or between a length and the next.

The upper part of each length's tree is laid out on a bounded sample of the words and cuts the space
into boxes, so that Spark can deal all words to boxes; a word also visits, as a query, each box that
is within its distance. In a box a finer tree with tight bounds around its points prunes the search
again, and only for what remains the letters are compared in order. Words with the same counts are
one point.

A count from 0 to 4 is written as so many bits in a row of four, so a point takes two machine words,
and distances, also those to the bounds of a box, are numbers of bits that differ. A larger count is
taken for 4, which brings no points further apart.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import slices, table, text_of
from reviewmill.llm.shingles import mixed
from reviewmill.session import written

MIN_CHARS, MIN_COUNT = 7, 2
# A form has to occur this many times as often as the word.
RATIO = 10
# An occurrence is altered if this divides the checksum of document and word.
NOISE = 31
# The trees are laid out on about this many words; how many are searched is not bounded.
SAMPLE_WORDS = 100_000
# Words that a box should hold, and the number at which it is dealt out by hash.
BOX_WORDS, MOST_WORDS = 32_768, 131_072
LEAF = 48
LETTERS, MOST_LETTERS = 26, 4
# Fixed value: runs of these bytes are words, in UTF-8 after lower-casing A to Z.
RUNS = rb"(?:[a-z]|\xC3[\x80-\xBF])+"
# Words of a task that are counted before they leave it.
TASK_WORDS = 200_000
PAIR_BLOCK = 1 << 18


def word_counts(docs: DataFrame, id_col: str, text_col: str, noise: int | None) -> DataFrame:
    """Words with the number of their occurrences in all texts, short ones left out."""

    def count(batches):
        runs = re.compile(RUNS)

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "n"],
            )

        seen: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            for part in slices(batch):
                keys = part.column("_key").to_pylist()
                for key, text in zip(keys, part.column("_text").cast(pa.binary()).to_pylist()):
                    start = zlib.crc32(f"{key}:".encode())
                    for word, n in Counter(runs.findall(text.lower())).items():
                        # A word has no more letters than bytes, and altering makes it shorter.
                        if len(word) < MIN_CHARS:
                            continue
                        if noise and not (check := zlib.crc32(word, start)) % noise:
                            letters = word.decode()
                            at = check % len(letters)
                            word = (letters[:at] + letters[at + 1 :]).encode()
                        seen[word] += n
                if len(seen) > TASK_WORDS:
                    yield flush()
                    seen.clear()
        yield flush()

    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_key"), text_of(text_col).alias("_text")
    )
    counted = keyed.mapInArrow(count, "word string, n long")
    return counted.where(F.length("word") >= MIN_CHARS).groupBy("word").agg(F.sum("n").alias("n"))


def letter_counts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words of one length, and how often each has a to z and other letters."""
    codes = np.array(words).view(np.uint32).reshape(len(words), -1)
    place = codes - np.uint32(ord("a"))
    place[place >= LETTERS] = LETTERS
    cell = np.arange(len(words))[:, None] * (LETTERS + 1) + place
    counts = np.bincount(cell.ravel(), minlength=len(words) * (LETTERS + 1))
    counts = np.minimum(counts, MOST_LETTERS).astype(np.int8).reshape(len(words), LETTERS + 1)
    return codes.astype(np.uint8) if codes.size and codes.max() < 256 else codes, counts


def as_bits(counts: np.ndarray) -> np.ndarray:
    """Two machine words per row, in which each count has as many of its four bits set."""
    bits = np.zeros((len(counts), 128), dtype=np.uint8)
    for level in range(MOST_LETTERS):
        bits[:, level : MOST_LETTERS * (LETTERS + 1) : MOST_LETTERS] = counts > level
    return np.packbits(bits, axis=1).view(np.uint64)


def best_cut(points: np.ndarray) -> tuple[int, int] | None:
    """Coordinate and value that halve the points best: the lower half is at most the value."""
    below = np.stack([(points <= value).sum(axis=0) for value in range(MOST_LETTERS)])
    share = np.minimum(below, len(points) - below)
    value, place = np.unravel_index(int(share.argmax()), share.shape)
    return (int(place), int(value)) if share[value, place] else None


class Boxes:
    """The upper tree of one length: cuts, and the boxes between them, numbered from ``first``."""

    def __init__(self, points: np.ndarray, words: float, first: int):
        self.first, self.count, self.nodes = first, 0, []
        self.root = self._lay(points, words)

    def _lay(self, points: np.ndarray, words: float) -> int:
        """``words`` is how many of all words the sampled points stand for."""
        cut = best_cut(points) if words > BOX_WORDS and len(points) > 1 else None
        if cut is None:
            self.nodes.append((-1, self.first + self.count, 0, 0))
            self.count += 1
            return len(self.nodes) - 1
        low = points[:, cut[0]] <= cut[1]
        share = low.mean()
        left = self._lay(points[low], words * share)
        right = self._lay(points[~low], words * (1 - share))
        self.nodes.append((*cut, left, right))
        return len(self.nodes) - 1

    def within(self, points: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, int]]:
        """Indices of the points that lie within the L1 distance ``reach`` of a box, per box.

        The distance to a box adds up, over the coordinates, how far its bounds are away; cutting
        one coordinate twice replaces that coordinate's part.
        """
        def down(node: int, index: np.ndarray, away: np.ndarray, parts: dict[int, np.ndarray]):
            place, value, left, right = self.nodes[node]
            if place < 0:
                yield index, value
                return
            at = points[index, place].astype(np.int32)
            before = parts.get(place, np.zeros(len(index), dtype=np.int32))
            for child, gap in ((left, at - value), (right, value + 1 - at)):
                part = np.maximum(before, gap)
                total = away - before + part
                near = total <= reach
                if near.any():
                    inner = {p: v[near] for p, v in parts.items()}
                    inner[place] = part[near]
                    yield from down(child, index[near], total[near], inner)

        if len(points):
            yield from down(self.root, np.arange(len(points)), np.zeros(len(points), np.int32), {})


def lay_boxes(words: DataFrame) -> dict[int, Boxes]:
    """The upper trees by length, from a share of the words that their hashes choose."""
    lengths = words.groupBy(F.length("word").alias("length")).count()
    totals = {row["length"]: row["count"] for row in lengths.collect()}
    share = min(1.0, SAMPLE_WORDS / max(sum(totals.values()), 1))
    chosen = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 32)) < int(share * (1 << 32)))
    sample: dict[int, list[str]] = defaultdict(list)
    for row in chosen.select("word").collect():
        sample[len(row["word"])].append(row["word"])
    boxes, first = {}, 0
    for length in sorted(totals):
        points = (letter_counts(sample[length])[1] if sample[length]
                  else np.zeros((0, LETTERS + 1), dtype=np.int8))
        boxes[length] = Boxes(points, totals[length], first)
        first += boxes[length].count
    return boxes


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for size in np.unique(sizes):
        yield int(size), np.nonzero(sizes == size)[0]


def dealt(words: DataFrame, boxes: dict[int, Boxes]) -> DataFrame:
    """Each word in its own box, as a point, and in all boxes that it has to search, as a query.

    Words with the same letter counts have the same ``sign``.
    """
    shared = words.sparkSession.sparkContext.broadcast(boxes)

    def deal(batches):
        for batch in batches:
            for part in slices(batch, 4096):
                words, trees = part.column("word").to_pylist(), shared.value
                rows, home, query = [], [], []
                sign = np.zeros(len(words), dtype=np.uint64)
                for size, index in by_length(words):
                    points = letter_counts([words[i] for i in index])[1]
                    bits = as_bits(points)
                    sign[index] = mixed(bits[:, 0] + mixed(bits[:, 1]))
                    for length, reach, asks in ((size, 0, False), (size, 2, True), (size + 1, 1, True)):
                        if length in trees:
                            for near, box in trees[length].within(points, reach):
                                rows.append(index[near])
                                home.append(np.full(len(near), box))
                                query.append(np.full(len(near), asks))
                if rows:
                    rows = np.concatenate(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(home), pa.int32()), pa.array(np.concatenate(query)),
                         pa.array(sign[rows].view(np.int64)),
                         part.column("word").take(pa.array(rows)), part.column("n").take(pa.array(rows))],
                        names=["box", "asks", "sign", "word", "n"],
                    )

    return words.mapInArrow(deal, "box int, asks boolean, sign long, word string, n long")


def split_full_boxes(rows: DataFrame) -> DataFrame:
    """Deal the points of a box that could not be cut small enough to several shares by hash.

    Each query of such a box visits all its shares.
    """
    shares = F.ceil(F.count("*") / MOST_WORDS).cast("int")
    full = rows.where("NOT asks").groupBy("box").agg(shares.alias("_shares")).where("_shares > 1")
    # One row per tree box at most, and these are as many as the sample allows.
    joined = rows.join(F.broadcast(full), "box", "left").withColumn("_shares", F.coalesce("_shares", F.lit(1)))
    own = F.array(F.pmod(F.hash("word"), F.col("_shares")))
    every = F.sequence(F.lit(0), F.col("_shares") - 1)
    return joined.select("box", F.explode(F.when(F.col("asks"), every).otherwise(own)).alias("share"),
                         "asks", "sign", "word", "n")


class Classes:
    """Words of one length by their letter counts: distinct points, and the words of each."""

    def __init__(self, words: list[str]):
        self.codes, counts = letter_counts(words)
        bits = as_bits(counts)
        order = np.lexsort((bits[:, 1], bits[:, 0]))
        new = np.append(True, (bits[order[1:]] != bits[order[:-1]]).any(axis=1))
        starts = np.nonzero(new)[0]
        self.members, self.starts = order, starts
        self.sizes = np.diff(np.append(starts, len(order)))
        self.counts, self.bits = counts[order[starts]], bits[order[starts]]

    def words_of(self, classes: np.ndarray, within: np.ndarray) -> np.ndarray:
        """The words of the classes, one for each place within them."""
        return self.members[self.starts[classes] + within]


class Points(Classes):
    """The finer tree of one box: leaves of few points, with tight bounds at every node."""

    def __init__(self, words: list[str], n: np.ndarray):
        super().__init__(words)
        self.words, self.n = np.array(words, dtype=object), n
        self.nodes: list[tuple] = []
        self.root = self._grow(np.arange(len(self.bits)))

    def _grow(self, index: np.ndarray) -> int:
        cut = best_cut(self.counts[index]) if len(index) > LEAF else None
        inside = self.bits[index]
        # As bits, the smallest and the largest count are what all have and what any has.
        low, high = np.bitwise_and.reduce(inside), np.bitwise_or.reduce(inside)
        if cut is None:
            self.nodes.append((low, high, index, -1, -1))
        else:
            below = self.counts[index, cut[0]] <= cut[1]
            left, right = self._grow(index[below]), self._grow(index[~below])
            self.nodes.append((low, high, None, left, right))
        return len(self.nodes) - 1

    def search(self, queries: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of pairs of a query and a point that are at most ``reach`` apart."""
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            node, index = todo.pop()
            low, high, inside, left, right = self.nodes[node]
            asked = queries[index]
            away = np.bitwise_count((low & ~asked) | (asked & ~high)).sum(axis=1, dtype=np.uint8)
            index = index[away <= reach]
            if not len(index):
                continue
            if inside is None:
                todo += [(left, index), (right, index)]
                continue
            points = self.bits[inside]
            step = max(1, PAIR_BLOCK // len(inside))
            for start in range(0, len(index), step):
                some = index[start : start + step]
                apart = np.bitwise_count(queries[some, :1] ^ points[:, 0])
                apart += np.bitwise_count(queries[some, 1:] ^ points[:, 1])
                one, two = np.nonzero(apart <= reach)
                yield some[one], inside[two]


def word_pairs(
    queries: Classes, points: Classes, one: np.ndarray, two: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a word of each class ``one`` and a word of the class ``two`` beside it, in blocks."""
    many = queries.sizes[one] * points.sizes[two]
    upto = np.cumsum(many)
    start = 0
    while start < len(one):
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + PAIR_BLOCK, side="right")))
        sizes = many[start:end]
        pair = np.repeat(np.arange(start, end), sizes)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        width = points.sizes[two[pair]]
        yield (queries.words_of(one[pair], within // width),
               points.words_of(two[pair], within % width))
        start = end


def one_edit(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by exactly one edit; the right ones may be longer by one."""
    size = left.shape[1]
    if right.shape[1] == size:
        return (left != right).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(left == right[:, :size], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((left == right[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + back >= size


class Tally:
    """Of each word of a list: how many near words, and the most frequent of them."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.count = np.zeros(len(words), dtype=np.int64)
        self.best_n = np.zeros(len(words), dtype=np.int64)
        self.best = np.full(len(words), "", dtype=object)

    def add(self, index: np.ndarray, others: np.ndarray, counts: np.ndarray) -> None:
        np.add.at(self.count, index, 1)
        better = counts >= self.best_n[index]
        for at, other, n in zip(index[better].tolist(), others[better].tolist(), counts[better].tolist()):
            if n > self.best_n[at] or (n == self.best_n[at] and other < self.best[at]):
                self.best_n[at], self.best[at] = n, other

    def rows(self) -> pa.RecordBatch:
        found = np.nonzero(self.count)[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.words[found].tolist(), pa.string()), pa.array(self.count[found]),
             pa.array(self.best_n[found]), pa.array(self.best[found].tolist(), pa.string())],
            names=["word", "n_near", "form_n", "form"],
        )


def search_boxes(rows: DataFrame) -> DataFrame:
    """Near words found in each box, for its queries and for its points.

    A pair is found once: in the box of the longer word, or of the one that comes later. A box's
    points come first and are held, at most ``MOST_WORDS``; its queries pass by in batches.
    """

    def search(batches):
        key, words, counts, points, totals = None, [], [], None, None

        def close():
            if totals is not None:
                yield totals.rows()

        for batch in batches:
            box = np.stack([batch.column(c).to_numpy() for c in ("box", "share")], axis=1)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.nonzero((np.diff(box, axis=0) != 0).any(axis=1) | (np.diff(asks) != 0))[0] + 1
            for start, end in zip([0, *edges], [*edges, batch.num_rows]):
                part = batch.slice(start, end - start)
                if not part.num_rows:
                    continue
                here = tuple(box[start])
                if here != key:
                    yield from close()
                    key, words, counts, points, totals = here, [], [], None, None
                if not asks[start]:
                    words += part.column("word").to_pylist()
                    counts += part.column("n").to_pylist()
                    continue
                if not words:
                    continue
                if points is None:
                    points = Points(words, np.array(counts, dtype=np.int64))
                    totals = Tally(points.words)
                yield from ask(points, totals, part)
        yield from close()

    def ask(points: Points, totals: Tally, part: pa.RecordBatch):
        asked = part.column("word").to_pylist()
        n = part.column("n").to_numpy()
        for size, index in by_length(asked):
            words = np.array([asked[i] for i in index], dtype=object)
            counts = n[index]
            queries = Classes(words.tolist())
            same = size == points.codes.shape[1]
            mine = Tally(words)
            for pairs in points.search(queries.bits, 2 if same else 1):
                for one, two in word_pairs(queries, points, *pairs):
                    near = one_edit(queries.codes[one], points.codes[two])
                    one, two = one[near], two[near]
                    if same:
                        first = words[one] < points.words[two]
                        one, two = one[first], two[first]
                    mine.add(one, points.words[two], points.n[two])
                    totals.add(two, words[one], counts[one])
            yield mine.rows()

    sorted_rows = rows.repartition("box", "share").sortWithinPartitions("box", "share", "asks", "sign")
    return sorted_rows.mapInArrow(search, "word string, n_near long, form_n long, form string")


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Near words, form and root of each word in a table of distinct words (``word``, ``n``).

    Two words are near if one inserted, deleted or replaced code point makes them equal. ``n_near``
    counts the near words. ``form`` is the one with the largest ``n`` (of equal ones the smallest in
    code-point order) if that is at least ``ratio`` times the word's, ``form_n`` its ``n``; else
    both are null. ``root`` is where the forms lead in the end, the word itself if it has none. Each
    form is ``ratio`` times as frequent as the one before it, so chains are short; ``ratio`` must be
    2 or more. All pairs are found, whatever is sampled. An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("the ratio must be 2 or more")
    words = words.select("word", F.col("n").cast("long").alias("n"))
    rows = split_full_boxes(written(dealt(words, lay_boxes(words)), "spelling-boxes"))
    found = (
        search_boxes(rows).groupBy("word")
        .agg(F.sum("n_near").alias("n_near"),
             F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("_best"))
        .select("word", "n_near", (-F.col("_best.less")).alias("_form_n"),
                F.col("_best.form").alias("_form"))
    )
    fits = F.col("_form_n") >= F.col("n") * ratio
    near = written(
        words.join(found, "word", "left").select(
            "word", F.when(fits, F.col("_form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, F.col("_form_n")).alias("form_n"),
        ),
        "spelling-near",
    )
    roots = final_forms(near.where("form IS NOT NULL").select("word", "form"))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def final_forms(steps: DataFrame) -> DataFrame:
    """Where each word's forms end (``word``, ``root``), doubling the steps until none leads on."""
    reached = written(steps.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = written(reached.join(on, "root", "left").select("word", "root", "_next"), "spelling-roots")
        if not joined.where("_next IS NOT NULL").take(1):
            return reached
        reached = joined.select("word", F.coalesce("_next", "root").alias("root"))


def spelling_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int | None = None,
    min_count: int = MIN_COUNT, ratio: int = RATIO,
) -> DataFrame:
    """``spelling_variants`` of the words of all texts with ``min_count`` occurrences or more.

    Words are maximal runs of a to z and U+00C0 to U+00FF, after A to Z became lower case, of seven
    code points or more. With ``noise``, an occurrence loses a letter if the number divides its
    checksum, which plants misspellings to be found again; a null id counts as an empty one there.
    Null texts have no words, and a repeated row counts each time. No column of the input is
    returned, so names cannot clash.
    """
    counts = word_counts(docs, id_col, text_col, noise).where(F.col("n") >= min_count)
    return spelling_variants(written(counts, "spelling-words"), ratio)


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"), noise=NOISE)


# The checksum is put together from half bytes; near words share a text with one letter less.
ORACLE = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-z\x{C0}-\x{FF}]+')) AS w
  FROM documents
), steps AS (
  SELECT list_transform(range(16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda c, z:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), coded AS (
  SELECT w, k, upper(hex(doc_id || ':' || w)) AS x
  FROM (SELECT doc_id, w, count(*) AS k FROM runs WHERE length(w) >= 7 GROUP BY doc_id, w)
), halves AS (
  SELECT w, k, list_transform(range(strlen(x)), lambda i:
           strpos('0123456789ABCDEF', x[i + 1 + CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END]) - 1) AS b
  FROM coded
), checked AS (
  SELECT w, k, xor(list_reduce(b, lambda c, h: xor(c >> 4, t[xor(c & 15, h) + 1]), 4294967295),
                   4294967295) AS h
  FROM halves, steps
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2)
                   ELSE w END AS word
    FROM checked)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS hole
  FROM words, unnest(generate_series(1, length(word))) AS t(i)
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS m
  FROM holes a JOIN holes b ON a.hole = b.hole AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, h.word, h.n FROM words w JOIN holes h ON w.word = h.hole
  UNION SELECT h.word, w.word, w.n FROM words w JOIN holes h ON w.word = h.hole
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other
  FROM pairs GROUP BY word
), near AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM near
  UNION ALL SELECT c.word, p.form FROM chain c JOIN near p ON c.root = p.word WHERE p.form IS NOT NULL
), ends AS (
  SELECT c.word, c.root FROM chain c JOIN near p ON c.root = p.word WHERE p.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM near JOIN ends USING (word)
"""

QUERIES = {"op13_spelling_variants": op13_spelling_variants}
ORACLES = {"op13_spelling_variants": ORACLE}
