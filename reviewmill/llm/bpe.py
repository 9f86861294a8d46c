"""Byte-level BPE: encoding and decoding whole texts with a given vocabulary.

A word's parts and the ranks of its neighbouring pairs lie in one contiguous row. The row is scanned
for its smallest rank, that boundary is deleted, and the ranks on both sides are looked up again,
until no pair has a rank. The words of a batch that were not seen before are merged side by side,
a row each. Words of more than ``SHORT_BYTES`` bytes use a heap, because scanning them would take
quadratic time; their result is the same.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import slices, table, text_of, without

SHORT_BYTES = 64
# Distinct words kept with their ids; beyond that a task starts anew.
CACHE_WORDS = 250_000
BATCH_CHARS = 2_000_000
NO_RANK = np.iinfo(np.int32).max
PAIR = 1 << 20

# How this kind of vocabulary cuts a text into words.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Letters and digits that Unicode 16 added, first and last of each range. Code points
# that are newer than that count as neither.
UNICODE_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
    (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5FA),
]
# Cutting before every space is the same as matching words unless a space has white space on both
# sides: then the run of white space is one word.
WIDE_SPACE = re.compile(r"\s \s|\s \Z")
ADDED = ["n_tokens", "tokens"]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files of this kind.

    Printable bytes stand for themselves, the others take the code points from 256 on in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces ``flat[start : start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return flat[np.arange(len(shift)) + shift]


class Vocabulary:
    """Merges, ids and bytes of a vocabulary file, as arrays that can be sent to tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        letters = byte_letters()
        ids = stored["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        spelled = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
        spelled |= {i: token.encode() for token, i in self.special.items()}
        size = max(spelled) + 1
        lengths = np.array([len(spelled.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.length = lengths
        self.start = np.cumsum(lengths) - lengths
        self.spelling = np.frombuffer(
            b"".join(spelled.get(i, b"") for i in range(size)), dtype=np.uint8
        )
        self.byte_id = np.zeros(256, dtype=np.int32)
        for letter, byte in letters.items():
            self.byte_id[byte] = ids[letter]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                  for m in stored["model"]["merges"]]
        pairs = np.array([ids[a] * PAIR + ids[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(pairs)
        self.pairs, self.rank = pairs[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int32)

    @classmethod
    def of(cls, arrays: dict) -> Vocabulary:
        """The vocabulary with these attributes; what is broadcast is plain arrays."""
        made = cls.__new__(cls)
        made.__dict__.update(arrays)
        return made

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; ``NO_RANK`` where no merge joins them."""
        wanted = left.astype(np.int64) * PAIR + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where((self.pairs[at] == wanted) & (right >= 0), self.rank[at], NO_RANK)


def merge_short(vocabulary: Vocabulary, words: list[bytes]) -> list[np.ndarray]:
    """Ids of words of at most about the same length, all merged at the same time."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    width = int(lengths.max())
    parts = np.full((len(words), width + 1), -1, dtype=np.int32)
    inside = np.arange(width + 1)[None, :] < lengths[:, None]
    parts[inside] = vocabulary.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
    ranks = vocabulary.ranks(parts[:, :-1], parts[:, 1:])
    done: list[np.ndarray] = [None] * len(words)
    open_ = np.arange(len(words))
    columns = np.arange(width + 1)
    while len(open_):
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(open_)), at]
        over = best == NO_RANK
        if over.any():
            for row, place in zip(np.nonzero(over)[0], open_[over]):
                done[place] = parts[row, : lengths[row]].copy()
            going = ~over
            open_, parts, ranks, lengths = open_[going], parts[going], ranks[going], lengths[going]
            at, best = at[going], best[going]
            if not len(open_):
                break
        rows = np.arange(len(open_))
        # The part after the boundary goes, and everything behind it moves up by one place.
        moved = np.minimum(columns[None, :] + (columns[None, :] > at[:, None]), width)
        parts = np.take_along_axis(parts, moved, axis=1)
        ranks = np.take_along_axis(ranks, np.minimum(moved[:, :-1], width - 1), axis=1)
        ranks[:, -1] = NO_RANK
        parts[rows, at] = vocabulary.merged[best]
        lengths = lengths - 1
        ranks[rows, at] = vocabulary.ranks(parts[rows, at], parts[rows, at + 1])
        before = np.maximum(at - 1, 0)
        fresh = vocabulary.ranks(parts[rows, before], parts[rows, before + 1])
        ranks[rows, before] = np.where(at > 0, fresh, ranks[rows, before])
    return done


def merge_long(vocabulary: Vocabulary, word: bytes) -> np.ndarray:
    """The same merges by a heap of pairs over a linked list of parts."""
    ids = vocabulary.byte_id[np.frombuffer(word, dtype=np.uint8)].tolist()
    after = list(range(1, len(ids))) + [-1]
    before = [-1, *range(len(ids) - 1)]
    known = {int(p): int(r) for p, r in zip(vocabulary.pairs, vocabulary.rank)}
    heap: list[tuple[int, int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] >= 0:
            pair = ids[at], ids[after[at]]
            rank = known.get(pair[0] * PAIR + pair[1])
            if rank is not None:
                heapq.heappush(heap, (rank, at, *pair))

    for at in range(len(ids)):
        offer(at)
    while heap:
        rank, at, left, right = heapq.heappop(heap)
        following = after[at]
        if ids[at] != left or following < 0 or ids[following] != right:
            continue
        ids[at], ids[following] = int(vocabulary.merged[rank]), -1
        after[at] = after[following]
        if after[at] >= 0:
            before[after[at]] = at
        offer(before[at])
        offer(at)
    return np.array([i for i in ids if i >= 0], dtype=np.int32)


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> list[np.ndarray]:
    """Ids of each word, short ones in groups of similar length."""
    out: list[np.ndarray] = [None] * len(words)
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    start = 0
    while start < len(order) and len(words[order[start]]) <= SHORT_BYTES:
        longest = min(max(4, len(words[order[start]]) + 2), SHORT_BYTES)
        stop = start
        while stop < len(order) and stop - start < 8192 and len(words[order[stop]]) <= longest:
            stop += 1
        group = order[start:stop]
        for k, ids in zip(group, merge_short(vocabulary, [words[k] for k in group])):
            out[k] = ids
        start = stop
    for k in order[start:]:
        out[k] = merge_long(vocabulary, words[k])
    return out


def newer(letter: str) -> bool:
    """Whether a code point got its meaning after Unicode 16."""
    if unicodedata.category(letter) != "Cn":
        return False
    return not any(low <= ord(letter) <= high for low, high in UNICODE_16)


def words_in(text: str) -> list[str]:
    if text.isascii():
        return WORDS.findall(text)
    late = {letter for letter in set(text) if not letter.isascii() and newer(letter)}
    if not late:
        return WORDS.findall(text)
    plain = text.translate({ord(letter): "\x01" for letter in late})
    return [text[m.start() : m.end()] for m in WORDS.finditer(plain)]


class Index(dict):
    """Number of each stretch of text between two spaces, given when it is first seen."""

    def __missing__(self, stretch: str) -> int:
        number = self[stretch] = len(self)
        return number


class Encoder:
    """Encodes batches of texts and remembers the ids of the stretches it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.forget()

    def forget(self) -> None:
        self.index = Index()
        self.flat = np.empty(0, dtype=np.int32)
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)

    def stretches(self, text: str) -> list[str]:
        """Parts of the text whose words do not depend on what stands around them."""
        if self.special and self.special.search(text):
            out, start = [], 0
            for found in self.special.finditer(text):
                out += self._plain(text[start : found.start()])
                out.append(found.group())
                start = found.end()
            return out + self._plain(text[start:])
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if "\0" in text or WIDE_SPACE.search(text):
            return words_in(text)
        return text.replace(" ", "\0 ").split("\0")

    def learn(self, new: list[str]) -> None:
        """Add the ids of stretches that were not seen before."""
        number: dict[str, int] = {}
        counts, places = [], []
        for stretch in new:
            if stretch in self.vocabulary.special:
                words = [stretch]
            else:
                words = words_in(stretch)
            counts.append(len(words))
            places += [number.setdefault(word, len(number)) for word in words]
        special = self.vocabulary.special
        spelled = [word.encode("utf-8", "surrogatepass") for word in number]
        ids = merge_words(self.vocabulary, spelled) if spelled else []
        for word, k in number.items():
            if word in special:
                ids[k] = np.array([special[word]], dtype=np.int32)
        lengths = np.array([len(i) for i in ids], dtype=np.int64)
        flat = np.concatenate(ids) if len(ids) else np.empty(0, dtype=np.int32)
        starts = np.cumsum(lengths) - lengths
        at = np.array(places, dtype=np.int64)
        made = ragged(flat, starts[at], lengths[at])
        # Ids per stretch: the lengths of its words summed up.
        upto = np.concatenate([[0], np.cumsum(lengths[at])])
        bounds = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64))])
        sizes = upto[bounds[1:]] - upto[bounds[:-1]]
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.flat = np.concatenate([self.flat, made.astype(np.int32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text's ids end."""
        if len(self.index) > CACHE_WORDS:
            self.forget()
        known = len(self.index)
        look = self.index.__getitem__
        numbers = []
        for text in texts:
            stretches = self.stretches(text)
            numbers.append(np.fromiter(map(look, stretches), np.int64, count=len(stretches)))
        if len(self.index) > known:
            new = list(self.index)[known:] if known else list(self.index)
            self.learn(new)
        every = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
        lengths = self.lengths[every]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ends = upto[np.cumsum([len(n) for n in numbers])] if numbers else np.empty(0, np.int64)
        return ragged(self.flat, self.starts[every], lengths), ends


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of ids; bytes that are not UTF-8 become replacement characters."""
    lengths = vocabulary.length[ids]
    raw = ragged(vocabulary.spelling, vocabulary.start[ids], lengths)
    return raw.tobytes().decode("utf-8", "replace")


def text_groups(texts: list[str | None]) -> Iterator[list[str]]:
    """Groups of neighbouring texts with a bounded number of characters, or one long text."""
    group, chars = [], 0
    for text in texts:
        group.append(text or "")
        chars += len(group[-1])
        if chars >= BATCH_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def _replaced(schema, added: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
                     if f.name not in added)


def bpe_encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """Add ``n_tokens`` and ``tokens``, the ids as little-endian unsigned 32-bit integers.

    Null and empty texts have no tokens. Strings of special tokens become their ids. Columns of the
    added names are replaced, all others stay. Repeated rows stay repeated. An empty table gives an
    empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))
    rows = without(docs, ADDED)

    def encode(batches):
        encoder = Encoder(Vocabulary.of(sent.value))
        for batch in (part for whole in batches for part in slices(whole)):
            tokens, counts = [], []
            for group in text_groups(batch.column(text_col).to_pylist()):
                ids, ends = encoder.encode(group)
                start = 0
                for end in ends.tolist():
                    tokens.append(ids[start:end].astype("<u4").tobytes())
                    counts.append(end - start)
                    start = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), pa.array(tokens, pa.binary())],
                names=[*batch.schema.names, *ADDED],
            )

    return rows.mapInArrow(encode, f"{_replaced(rows.schema, ADDED)}, n_tokens bigint, tokens binary")


def bpe_decode(
    rows: DataFrame, vocabulary: Vocabulary, out_col: str = "decoded_text"
) -> DataFrame:
    """Add the text of the ids in ``tokens``; null where there are no ids but null."""
    sent = rows.sparkSession.sparkContext.broadcast(vars(vocabulary))
    rest = without(rows, [out_col])

    def spell(batches):
        known = Vocabulary.of(sent.value)
        for batch in (part for whole in batches for part in slices(whole)):
            texts = [
                None if t is None else decode(known, np.frombuffer(t, dtype="<u4"))
                for t in batch.column("tokens").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())],
                names=[*batch.schema.names, out_col],
            )

    return rest.mapInArrow(spell, f"{_replaced(rest.schema, [out_col])}, {out_col} string")


def token_lengths(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """The number of tokens of each text and nothing else."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))

    def count(batches):
        encoder = Encoder(Vocabulary.of(sent.value))
        for batch in (part for whole in batches for part in slices(whole)):
            counts = []
            for group in text_groups(batch.column(0).to_pylist()):
                ends = encoder.encode(group)[1]
                counts += np.diff(ends, prepend=0).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], names=["n_tokens"])

    return docs.select(text_of(text_col).alias("_text")).mapInArrow(count, "n_tokens bigint")


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    vocabulary = default_vocabulary()
    encoded = bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    return bpe_decode(encoded.drop("text"), vocabulary).select(
        "doc_id", "n_tokens",
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"),
    )


QUERIES = {"op2_bpe": op2_bpe}
ORACLES: dict[str, str] = {}
