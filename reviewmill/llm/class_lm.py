"""Language-model scores from Brown classes: exchange clustering and class-based n-grams.

A text's probability is the product, over its tokens, of the probability of the token's class after
the class of the token before it, and of the token within its class. Classes of the most frequent
words come from exchange clustering: a word moves to the class that raises the likelihood of all
pairs of classes of successive frequent words most, one word after the other. Then each of the others,
however rare, takes one such step by the nearest classes on both sides of it, the rarest last. A word that was never trained on has a last class, whose transitions are estimated by those of
words that occur once.

Frequent means a share of all tokens, so there is a fixed number of such words at most, whatever
the corpus. Their counts and classes are what tasks and driver hold. Counts and classes of all other
words stay in tables and are joined. Texts are taken apart once, into hashes of their tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import number_rows, numbers_in, row_key, slices, table, text_of
from reviewmill.llm.shingles import WordHashes, words_of
from reviewmill.session import written

# Shares of all training tokens: at most 50,000 words are clustered, at most a million are held by
# tasks. The others have their classes and counts in a table.
CLUSTERED_SHARE, HELD_SHARE = 2e-5, 1e-6
# And as many occurrences at least, so that a small corpus has rare words too.
CLUSTERED_LEAST, HELD_LEAST = 20, 5
CLASSES, ROUNDS = 64, 5
# The class of unseen words, and the context at the start of a text.
UNSEEN, START = CLASSES, CLASSES + 1
# Weight of the overall class frequencies in the class probabilities after a context.
SMOOTHING = 20.0
FOLDS, HELD_OUT = 7, 2
COUNTED_TOKENS = 1_000_000
# No word is empty, so the empty one can stand for the end of a text.
END_WORD = b""
END = int(np.uint64(xxhash.xxh3_64_intdigest(END_WORD)).astype(np.int64))
# Pairs of the classes on both sides of a word, and the step between small numbers in one large one.
SIDES = (START + 1) * (UNSEEN + 1)
STEP = 128


def held_out(id_col: str):
    """Whether a document is left out of training; one without an id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def token_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row with a number (``_row``, odd if held out) and the hashes of its tokens, the end last.

    The hashes of a row are one binary value, so that Spark need not handle each of them.
    """

    def take_apart(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, 256):
                every, ends = [], [0]
                for text in part.column("_text").to_pylist():
                    every += words_of(text)
                    every.append(END_WORD)
                    ends.append(len(every))
                values = np.fromiter(map(hashes.__getitem__, every), np.uint64, count=len(every))
                tokens = number_rows(values, np.array(ends))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("_row", "_id", "held_out")] + [tokens],
                    names=["_row", "_id", "held_out", "tokens"],
                )

    out = held_out(id_col)
    texts = docs.select(
        (F.monotonically_increasing_id() * 2 + out.cast("bigint")).alias("_row"),
        row_key(id_col, text_col)[0], out.alias("held_out"), text_of(text_col).alias("_text"),
    )
    rows = texts.mapInArrow(take_apart, "_row bigint, _id bigint, held_out boolean, tokens binary")
    return written(rows, "lm-tokens", compression="zstd")


def tokens_in(batches):
    """Slices of rows with all their tokens in order, and the place of each row's first one."""
    for batch in batches:
        for part in slices(batch, 256):
            yield part, *numbers_in(part.column("tokens"))


def whole_groups(batches, key: str):
    """Sorted rows in batches such that rows with the same key are in the same batch."""
    kept = []
    for batch in batches:
        if batch.num_rows:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut or (kept and kept[-1].column(key)[0].as_py() != keys[0]):
                yield from pa.Table.from_batches([*kept, batch.slice(0, cut)]).combine_chunks().to_batches()
                kept = []
            kept.append(batch.slice(cut))
    if kept:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()


def group_starts(keys: np.ndarray) -> np.ndarray:
    return np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]


def places_of(tokens: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of each token among sorted hashes, or -1."""
    at = np.minimum(np.searchsorted(hashes, tokens), len(hashes) - 1)
    return np.where(hashes[at] == tokens, at, -1)


def before(tokens: np.ndarray, values: np.ndarray, start: int) -> np.ndarray:
    """For each token the value of the token before it, or ``start`` behind the end of a text."""
    shifted = np.concatenate([[start], values[:-1]])
    shifted[1:][tokens[:-1] == END] = start
    return shifted


def word_counts(tokens: DataFrame) -> DataFrame:
    """How often each token occurs (``hash``, ``n``), summed within tasks before the shuffle."""

    def count(batches):
        keys, held = [], 0

        def flushed():
            distinct, n = np.unique(np.concatenate(keys), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(distinct), pa.array(n)], names=["hash", "n"]
            )

        for _, own, _ in tokens_in(batches):
            # A copy, so that the whole batch need not be held.
            keys.append(own.copy())
            held += len(own)
            if held > COUNTED_TOKENS:
                yield flushed()
                keys, held = [], 0
        if keys:
            yield flushed()

    partial = tokens.select("tokens").mapInArrow(count, "hash bigint, n bigint")
    return written(partial.groupBy("hash").agg(F.sum("n").alias("n")), "lm-counts")


def pair_counts(tokens: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Pairs of a word and the one before it (``before``, ``word``, ``n``), by places in ``hashes``.

    Other words in between are passed over; ``before`` is the place behind the last at the start of
    a text.
    """
    sent = tokens.sparkSession.sparkContext.broadcast(hashes)
    width = len(hashes)

    def count(batches):
        keys, held = [], 0

        def flushed():
            distinct, n = np.unique(np.concatenate(keys), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(distinct), pa.array(n)], names=["pair", "n"]
            )

        for _, own, _ in tokens_in(batches):
            place = places_of(own, sent.value)
            own, place = own[place >= 0], place[place >= 0]
            keys.append(before(own, place, width) * width + place)
            held += len(own)
            if held > COUNTED_TOKENS:
                yield flushed()
                keys, held = [], 0
        if keys:
            yield flushed()

    partial = tokens.select("tokens").mapInArrow(count, "pair bigint, n bigint")
    sums = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    parts = sums.select(
        F.expr(f"pair div {width}").alias("before"), (F.col("pair") % width).alias("word"), "n"
    )
    return written(parts, "lm-pairs")


def xlogx(values: np.ndarray) -> np.ndarray:
    return values * np.log(np.maximum(values, 1.0))


def gains(matrix: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How much the likelihood of all class pairs grows if a word joins each class.

    ``matrix`` counts pairs (context class, class); ``before`` and ``after`` count the classes next
    to the word. Contexts have one class more than words, for the start of a text.
    """
    classes = matrix.shape[1]
    columns = (xlogx(matrix + before[:, None]) - xlogx(matrix)).sum(axis=0)
    rows = matrix[:classes]
    lines = (xlogx(rows + after[None, :]) - xlogx(rows)).sum(axis=1)
    as_word, as_context = matrix.sum(axis=0), rows.sum(axis=1)
    return (
        columns + lines
        - (xlogx(as_word + before.sum()) - xlogx(as_word))
        - (xlogx(as_context + after.sum()) - xlogx(as_context))
    )


def with_classes(pairs: DataFrame, classes: np.ndarray) -> DataFrame:
    """Pairs of words with the classes of both; there are at most 1 / ``CLUSTERED_SHARE`` words."""
    rows = [(w, int(c)) for w, c in enumerate(classes)] + [(len(classes), START)]
    of = F.broadcast(pairs.sparkSession.createDataFrame(rows, "word bigint, class int"))
    before = of.select(F.col("word").alias("before"), F.col("class").alias("context"))
    return pairs.join(of, "word").join(before, "before")


def neighbours(pairs: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each clustered word the counts of the classes before it and after it.

    Two dense arrays of ``len(classes)`` rows, so their size is bounded like the number of words.
    """
    classed = with_classes(pairs, classes)
    sums = (
        classed.select("word", F.lit(0).alias("side"), F.col("context").alias("other"), "n")
        .union(classed.select("before", F.lit(1), "class", "n")
               .where(F.col("before") < len(classes)))
        .groupBy("word", "side", "other").agg(F.sum("n").alias("n"))
        .toPandas()
    )
    before = np.zeros((len(classes), START + 1))
    after = np.zeros((len(classes), UNSEEN + 1))
    for side, out in ((0, before), (1, after)):
        own = sums[sums["side"] == side]
        out[own["word"].to_numpy(), own["other"].to_numpy()] = own["n"].to_numpy()
    return before, after


def likelihood(matrix: np.ndarray) -> float:
    """The part of the training likelihood that depends on the classes."""
    classes = matrix.shape[1]
    return float(
        xlogx(matrix).sum() - xlogx(matrix.sum(axis=0)).sum()
        - xlogx(matrix[:classes].sum(axis=1)).sum()
    )


def clustered(pairs: DataFrame, classes: np.ndarray, order: np.ndarray) -> tuple:
    """Exchange clustering: the best classes found, and their matrix of class pairs.

    In each round the executors sum every word's neighbouring classes from the pair table. Then the
    words move one after the other, each seeing the matrix that the moves before it have left.
    """
    shape = (START + 1, UNSEEN + 1)
    best, best_matrix, best_value = classes, np.zeros(shape), -np.inf
    for turn in range(ROUNDS + 1):
        before, after = neighbours(pairs, classes)
        matrix = np.zeros(shape)
        np.add.at(matrix.T, classes, before)
        value = likelihood(matrix)
        if value > best_value:
            best, best_matrix, best_value = classes.copy(), matrix.copy(), value
        if turn == ROUNDS:
            break
        classes = classes.copy()
        for word in order:
            own = classes[word]
            matrix[:, own] = np.maximum(matrix[:, own] - before[word], 0)
            matrix[own] = np.maximum(matrix[own] - after[word], 0)
            own = int(gains(matrix, before[word], after[word])[:CLASSES].argmax())
            classes[word] = own
            matrix[:, own] += before[word]
            matrix[own] += after[word]
    return best, best_matrix


def neighbour_counts(tokens: DataFrame, words: tuple, rest: bool) -> DataFrame:
    """Between which classes words without one stand, and how often (``hash``, ``near``).

    These are the words in ``words`` with class -1, or with ``rest`` those that are not in it.
    ``near`` is ``SIDES`` times the count, plus the number of a pair: the classes of the nearest words
    before and after that have one. Counts are those of a task, not summed over tasks.
    """
    sent = tokens.sparkSession.sparkContext.broadcast(words)

    def count(batches):
        found, beside, held = [], [], 0

        def flushed():
            own, place = np.unique(np.concatenate(found), return_inverse=True)
            distinct, n = np.unique(place * SIDES + np.concatenate(beside), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(own[distinct // SIDES]), pa.array(n * SIDES + distinct % SIDES)],
                names=["hash", "near"],
            )

        for _, own, _ in tokens_in(batches):
            place, known = held_classes(own, sent.value)
            # The last token is an end, which has a class.
            at = np.nonzero((place < 0) if rest else (place >= 0) & (known < 0))[0]
            classed = np.nonzero(known >= 0)[0]
            ahead = np.append(before(own[classed], known[classed], START), START)
            after = np.searchsorted(classed, at)
            found.append(own[at])
            beside.append(ahead[after] * (UNSEEN + 1) + known[classed[after]])
            held += len(at)
            if held > COUNTED_TOKENS:
                yield flushed()
                found, beside, held = [], [], 0
        if found:
            yield flushed()

    return tokens.select("tokens").mapInArrow(count, "hash bigint, near bigint")


def chances(matrix: np.ndarray) -> np.ndarray:
    """For each pair of classes on both sides of a word and each class, the logarithm of its chance.

    This is how the likelihood of all class pairs changes, for each time the word stands there, while
    many words join the class at once.
    """
    sides = [
        np.log((table + 1.0) / (table.sum(axis=0) + len(table)))[:, :CLASSES]
        for table in (matrix, matrix[: UNSEEN + 1].T)
    ]
    return (sides[0][:, None] + sides[1][None]).reshape(-1, CLASSES)


def assigned(near: DataFrame, matrix: np.ndarray) -> DataFrame:
    """The class and count of each word (``hash``, ``class``, ``n``) by the classes beside it."""
    sent = near.sparkSession.sparkContext.broadcast(chances(matrix))

    def choose(batches):
        for batch in whole_groups(batches, "hash"):
            hashes, near = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            starts, n = group_starts(hashes), near // SIDES
            best = np.empty(len(starts), np.int64)
            for low in range(0, len(starts), 4096):
                own = starts[low : low + 4096]
                end = starts[low + 4096] if low + 4096 < len(starts) else len(near)
                values = sent.value[near[own[0] : end] % SIDES] * n[own[0] : end, None]
                best[low : low + 4096] = np.add.reduceat(values, own - own[0], axis=0).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[starts]), pa.array(best.astype(np.int32)),
                 pa.array(np.add.reduceat(n, starts))],
                names=["hash", "class", "n"],
            )

    grouped = near.repartition("hash").sortWithinPartitions("hash")
    return written(grouped.mapInArrow(choose, "hash bigint, class int, n bigint"), "lm-classes")


def sorted_words(hashes: np.ndarray, counts: np.ndarray, classes: np.ndarray) -> tuple:
    """The words that tasks hold, by hash; they include the end of a text."""
    order = np.argsort(hashes)
    return hashes[order], counts[order], classes[order]


def held_classes(tokens: np.ndarray, words: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The place and the class of each token, -1 for words that tasks do not hold."""
    hashes, _, classes = words
    place = places_of(tokens, hashes)
    return place, np.where(place >= 0, classes[place], -1)


def rare_words(tokens: DataFrame, words: tuple, rest: DataFrame) -> DataFrame:
    """Per row the words that tasks do not hold, in order (``rare``), as ``rare_in`` reads them.

    A word of no training text has count 0. Neighbours that tasks hold are known where the word is
    found; a neighbour that is rare too is the one beside it in the row's list.
    """
    sent = tokens.sparkSession.sparkContext.broadcast(words)

    def find(batches):
        for part, own, starts in tokens_in(batches):
            classes = held_classes(own, sent.value)[1]
            # The last token is an end and never rare.
            at = np.nonzero(classes < 0)[0]
            row = np.searchsorted(starts, at, side="right") - 1
            beside = (before(own, classes, START)[at] + 1) * STEP + classes[at + 1] + 1
            yield pa.RecordBatch.from_arrays(
                [part.column("_row").take(pa.array(row)), pa.array(own[at]),
                 pa.array((at - starts[row]) * STEP**2 + beside)],
                names=["_row", "hash", "at"],
            )

    def listed(batches):
        for batch in whole_groups(batches, "_row"):
            row, at, word = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            starts, own = group_starts(row), word % STEP
            ahead, after = at // STEP % STEP - 1, at % STEP
            near = ahead < 0
            ahead[near] = own[np.nonzero(near)[0] - 1]
            items = (((word // STEP * 2 + near) * STEP + ahead) * STEP + own) * STEP + after
            rare = number_rows(items, np.append(starts, len(row)))
            yield pa.RecordBatch.from_arrays([pa.array(row[starts]), rare], names=["_row", "rare"])

    found = tokens.select("_row", "tokens").mapInArrow(find, "_row bigint, hash bigint, at bigint")
    known = rest.select("hash", (F.col("n") * STEP + F.col("class")).alias("word"))
    joined = found.join(known, "hash", "left").select(
        "_row", "at", F.coalesce("word", F.lit(UNSEEN)).cast("bigint").alias("word")
    )
    sorted_rows = joined.repartition("_row").sortWithinPartitions("_row", "at")
    return written(sorted_rows.mapInArrow(listed, "_row bigint, rare binary"), "lm-rare")


def rare_in(batches):
    """Slices of rows with all their rare words, and the place of each row's first one.

    Of each word the class before it and its own, the class after it (-1 if that word is rare too), its
    count, and whether the word before it is rare.
    """
    for batch in batches:
        for part in slices(batch, 256):
            items, starts = numbers_in(part.column("rare"))
            rest, after = np.divmod(items, STEP)
            rest, own = np.divmod(rest, STEP)
            rest, ahead = np.divmod(rest, STEP)
            yield part, ahead, own, after - 1, rest // 2, rest % 2 == 1, starts


def pair_sums(ahead: np.ndarray, own: np.ndarray) -> np.ndarray:
    width = UNSEEN + 1
    return np.bincount(ahead * width + own, minlength=(START + 1) * width)


def matrix_of(pairs: DataFrame) -> np.ndarray:
    """The matrix of summed class pairs (``pair``, ``n``)."""
    sums = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    matrix = np.zeros((START + 1, UNSEEN + 1))
    matrix.flat[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    return matrix


def summed(sums: np.ndarray) -> pa.RecordBatch:
    keys = np.nonzero(sums)[0]
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums[keys])], names=["pair", "n"])


def held_pairs(tokens: DataFrame, words: tuple) -> np.ndarray:
    """How often each class follows each context, where tasks hold both words."""
    sent = tokens.sparkSession.sparkContext.broadcast(words)

    def count(batches):
        sums = pair_sums(np.empty(0, np.int64), np.empty(0, np.int64))
        for _, own, _ in tokens_in(batches):
            classes = held_classes(own, sent.value)[1]
            ahead = before(own, classes, START)
            both = (classes >= 0) & (ahead >= 0)
            sums += pair_sums(ahead[both], classes[both])
        yield summed(sums)

    return matrix_of(tokens.select("tokens").mapInArrow(count, "pair bigint, n bigint"))


def rare_pairs(rare: DataFrame) -> np.ndarray:
    """How often classes follow contexts in training where one of the two words is rare.

    Words that occur once count as unseen ones as well.
    """

    def count(batches):
        sums = pair_sums(np.empty(0, np.int64), np.empty(0, np.int64))
        for _, ahead, own, after, n, near, _ in rare_in(batches):
            once, followed = n == 1, after >= 0
            once_near = near & np.concatenate([[False], once[:-1]])
            unseen = np.full(len(own), UNSEEN)
            for left, right, which in (
                (ahead, own, slice(None)), (own, after, followed),
                (ahead, unseen, once), (unseen, own, once_near),
                (unseen, after, once & followed), (unseen, unseen, once & once_near),
            ):
                sums += pair_sums(left[which], right[which])
        yield summed(sums)

    return matrix_of(rare.where("_row % 2 = 0").mapInArrow(count, "pair bigint, n bigint"))


class Model:
    """The words that tasks hold, the class probabilities, and the sizes of the classes."""

    def __init__(self, words: tuple, matrix: np.ndarray, sizes: np.ndarray, once: int):
        self.words, self.sizes = words, np.maximum(sizes, 1)
        overall = (matrix.sum(axis=0) + 1) / (matrix.sum() + matrix.shape[1])
        totals = matrix.sum(axis=1, keepdims=True)
        self.log_class = np.log10((matrix + SMOOTHING * overall) / (totals + SMOOTHING))
        _, counts, classes = words
        self.log_word = np.log10(np.maximum(counts, 1) / self.sizes[classes])
        self.log_base = np.log10(counts + 1.0)
        # A text's new words are about as many as those that occur once in training.
        self.log_unseen = -np.log10(once + 1.0)


def trained(tokens: DataFrame, counts: DataFrame, all_tokens: int) -> tuple[Model, DataFrame]:
    """The model of the training rows in ``tokens``, and all rows' rare words."""
    training = tokens.where("NOT held_out")
    held = (
        counts.where((F.col("n") >= max(HELD_SHARE * all_tokens, HELD_LEAST)) & (F.col("hash") != END))
        .toPandas()
    )
    top = held["n"] >= max(CLUSTERED_SHARE * all_tokens, CLUSTERED_LEAST)
    frequent, more = held[top], held[~top]
    hashes = np.append(frequent["hash"].to_numpy(dtype=np.int64), END)
    ends = counts.where(F.col("hash") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n = np.append(frequent["n"].to_numpy(dtype=np.int64), ends)[np.argsort(hashes)]
    hashes = np.sort(hashes)
    # The most frequent words start in classes of their own, the others follow in turn.
    classes = np.empty(len(hashes), dtype=np.int64)
    order = np.lexsort((hashes, -n))
    classes[order] = np.arange(len(hashes)) % CLASSES
    classes, matrix = clustered(pair_counts(training, hashes), classes, order)

    # The words that tasks hold choose first, all rarer ones when they are contexts as well.
    often = np.append(hashes, more["hash"].to_numpy(dtype=np.int64))
    times = np.append(n, more["n"].to_numpy(dtype=np.int64))
    known = np.append(classes, np.full(len(more), -1))
    own = sorted_words(often, times, known)
    chosen = assigned(neighbour_counts(training, own, False), matrix).toPandas()
    own[2][places_of(chosen["hash"].to_numpy(dtype=np.int64), own[0])] = chosen["class"].to_numpy()
    matrix = held_pairs(training, own)
    rest = assigned(neighbour_counts(training, own, True), matrix)

    sizes = np.bincount(own[2], own[1], minlength=CLASSES)
    once = 0
    for row in rest.groupBy("class").agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once")
    ).collect():
        sizes[row["class"]] += row["n"]
        once += row["once"]
    rare = rare_words(tokens, own, rest)
    return Model(own, matrix + rare_pairs(rare), sizes, once), rare


def held_scores(tokens: DataFrame, model: Model) -> DataFrame:
    """Per row what the words that tasks hold contribute, and the transitions between them."""
    sent = tokens.sparkSession.sparkContext.broadcast(vars(model))

    def score(batches):
        known = Model.__new__(Model)
        known.__dict__.update(sent.value)
        for part, own, starts in tokens_in(batches):
            place, classes = held_classes(own, known.words)
            ahead = before(own, classes, START)
            held, both = place >= 0, (classes >= 0) & (ahead >= 0)
            base = np.where(held, known.log_base[place], 0.0)
            score = np.where(held, known.log_word[place], 0.0)
            score += np.where(both, known.log_class[ahead, classes], 0.0)
            seen = held & (known.words[1][place] > 0)
            lengths = np.diff(starts, append=len(own))
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in ("_row", "_id", "held_out")]
                + [pa.array(lengths), pa.array(np.add.reduceat(seen, starts, dtype=np.int64)),
                   pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(score, starts))],
                names=["_row", "_id", "held_out", "n_tokens", "_often", "_base", "_score"],
            )

    return tokens.mapInArrow(
        score,
        "_row bigint, _id bigint, held_out boolean, n_tokens bigint, _often bigint, "
        "_base double, _score double",
    )


def rare_scores(rare: DataFrame, model: Model) -> DataFrame:
    """Per row what its rare words contribute, with the transitions to and from them."""
    sent = rare.sparkSession.sparkContext.broadcast(vars(model))

    def score(batches):
        known = Model.__new__(Model)
        known.__dict__.update(sent.value)
        for part, ahead, own, after, n, _, starts in rare_in(batches):
            sizes = np.append(known.sizes, 1)
            score = np.where(n > 0, np.log10(np.maximum(n, 1) / sizes[own]), known.log_unseen)
            score += known.log_class[ahead, own]
            score += np.where(after >= 0, known.log_class[own, after], 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column("_row"), pa.array(np.add.reduceat(n > 0, starts, dtype=np.int64)),
                 pa.array(np.add.reduceat(np.log10(n + 1.0), starts)),
                 pa.array(np.add.reduceat(score, starts))],
                names=["_row", "_seen", "_logs", "_more"],
            )

    return rare.mapInArrow(score, "_row bigint, _seen bigint, _logs double, _more double")


def class_lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Class model and unigram scores (log10 probabilities) of every row's whole text.

    The model is trained on the rows that are not held out (``held_out``: crc32 of the id modulo 7
    is 2). A text's tokens are its words, with A-Z in lower case, and one end. Null and empty texts
    have the end only. A row without an id is trained on and scored; repeated rows train as often as
    they occur and get the same scores. With an empty table the result is empty; if every row is held
    out, all words are unseen. The result has no other column of the input.
    """
    tokens = token_rows(docs, id_col, text_col)
    counts = word_counts(tokens.where("NOT held_out"))
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    model, rare = trained(tokens, counts, total)
    floor = float(np.log10(total + types + 1))
    none = F.lit(0)
    return held_scores(tokens, model).join(rare_scores(rare, model), "_row", "left").select(
        F.nullif(F.col("_id"), F.lit(9223372036854775807)).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("_often") + F.coalesce("_seen", none)).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor))
        .alias("base_score"),
        (F.col("_score") + F.coalesce("_more", F.lit(0.0))).alias("score"),
    )


def op9_class_lm(spark, sf_dir: str) -> DataFrame:
    return class_lm_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op9_class_lm": op9_class_lm}
ORACLES: dict[str, str] = {}
