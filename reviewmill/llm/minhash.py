"""Near-duplicates by MinHash: universal hash minima, banding, verification, components.

Equal sets of shingles become one representative first, so exact copies never form pairs. In each
bucket of a band every member is compared with one leader only: the member whose buckets are fullest,
which among many edited copies of a text is the one nearest to all of them. What these links leave
apart is compared block by block: the members outside a bucket's largest component meet each other and
that component, finer signatures are compared inside the tasks, and only pairs that look similar
enough leave them. Every link is confirmed on the full sets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import mark_place, marks, packed, row_key, slices, table, text_of
from reviewmill.llm.components import components
from reviewmill.llm.shingles import WordHashes, hash_family, minima, shingle_set
from reviewmill.session import written

SHINGLE_WORDS = 5
PERCENT = 80
BANDS, ROWS = 32, 4
SEED = 7
# A pair of similarity 0.8 shares a band with a chance of 1 - 5e-8. The estimates have standard
# deviations of 0.035 and 0.018 there; the margins are four and four and a half of them, so the fine
# one misses a pair of 0.8 with a chance of 8e-6, and the coarse one decides nothing for good.
COARSE, FINE = 128, 512
COARSE_AT_LEAST, FINE_AT_LEAST = 0.66, 0.72
BLOCK = 256
RESULT = ["n_shingles", "component_id", "kept"]


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Key, set size, digest of the set, band keys and one byte of each minimum per row."""

    def sign(batches):
        hashes, family = WordHashes(), hash_family(BANDS * ROWS, SEED)
        import xxhash

        for batch in batches:
            for part in slices(batch):
                sizes, digests, bands, bytes_ = [], [], [], []
                for text in part.column("_text").to_pylist():
                    shingles = shingle_set(text, words, hashes)
                    sizes.append(len(shingles))
                    digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    low = minima(shingles, family)
                    bands.append([
                        xxhash.xxh3_64_intdigest(low[ROWS * b : ROWS * b + ROWS].tobytes(), b)
                        - (1 << 63)
                        for b in range(BANDS)
                    ] if len(shingles) else [])
                    bytes_.append(low.astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_th"), pa.array(sizes, pa.int64()),
                     pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(bytes_, pa.binary())],
                    names=["_id", "_th", "_n", "_set", "_bands", "_sig"],
                )

    texts = docs.select(*row_key(id_col, text_col), text_of(text_col).alias("_text"))
    schema = "_id bigint, _th bigint, _n bigint, _set binary, _bands array<bigint>, _sig binary"
    return written(texts.mapInArrow(sign, schema), "minhash-signatures")


def node(prefix: str = "") -> Column:
    return F.struct(F.col(f"{prefix}_id").alias("id"), F.col(f"{prefix}_th").alias("th"))


def size_fits(a: str, b: str) -> Column:
    """Sets whose sizes differ by more than a fifth cannot be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def alike(a: str, b: str, at_least: float) -> Column:
    """Whether the byte signatures agree often enough; bytes of unlike minima agree by chance."""

    @F.pandas_udf("boolean")
    def agree(left: pd.Series, right: pd.Series) -> pd.Series:
        if not len(left):
            return pd.Series([], dtype=bool)
        one = np.frombuffer(b"".join(left), dtype=np.uint8).reshape(len(left), -1)
        two = np.frombuffer(b"".join(right), dtype=np.uint8).reshape(len(left), -1)
        same = (one == two).mean(axis=1)
        return pd.Series((same - 1 / 256) / (1 - 1 / 256) >= at_least)

    return agree(a, b)


def of_wanted_texts(
    docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, make, column: str, kind: str
) -> DataFrame:
    """``make()(text)`` for the rows that are among ``nodes``, once per node.

    No text is shuffled to find the rows: a bitmap of fixed size tells where to look. A bit set by
    chance lets a needless row through, which the join with the nodes drops.
    """
    shared = docs.sparkSession.sparkContext.broadcast(marks(nodes))
    types = {"string": pa.string(), "binary": pa.binary()}

    def pick(batches):
        bits, made = shared.value, make()
        for batch in batches:
            at = batch.column("_at").to_numpy()
            batch = batch.filter(pa.array((bits[at >> 6] >> (at & 63)) & 1 == 1))
            for part in slices(batch):
                values = [made(text) for text in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_th"), pa.array(values, types[kind])],
                    names=["_id", "_th", column],
                )

    texts = docs.select(*row_key(id_col, text_col), text_of(text_col).alias("_text")).select(
        "_id", "_th", mark_place().alias("_at"), "_text"
    )
    found = texts.mapInArrow(pick, f"_id bigint, _th bigint, {column} {kind}")
    only = found.join(nodes, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"])
    return only.select(node().alias("_node"), column)


def confirmed(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    pairs = written(pairs, "minhash-pairs")
    nodes = pairs.select("a.*").union(pairs.select("b.*")).distinct().toDF("_id", "_th")
    nodes = written(nodes, "minhash-nodes")
    texts = of_wanted_texts(
        docs, nodes, id_col, text_col, lambda: lambda text: text, "_text", "string"
    )
    left = texts.select(F.col("_node").alias("a"), F.col("_text").alias("_one"))
    right = texts.select(F.col("_node").alias("b"), F.col("_text").alias("_two"))

    def similar(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, 128):
                links = []
                for one, two in zip(part.column("_one").to_pylist(), part.column("_two").to_pylist()):
                    x, y = shingle_set(one, words, hashes), shingle_set(two, words, hashes)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    links.append(100 * common >= PERCENT * (len(x) + len(y) - common))
                yield part.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    node_type = "struct<id:bigint,th:bigint>"
    return written(
        pairs.join(left, "a").join(right, "b").select("a", "b", "_one", "_two")
        .mapInArrow(similar, f"a {node_type}, b {node_type}"),
        "minhash-links",
    )


def shared_buckets(standing: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one of the representatives.

    ``_fill`` adds up the sizes of all buckets that a member is in.
    """
    buckets = standing.select("_node", "_n", F.explode("_bands").alias("_bucket"))
    several = buckets.groupBy("_bucket").agg(F.count("*").alias("_members")).where("_members > 1")
    several = written(several, "minhash-several")
    shared = written(buckets.join(several, "_bucket"), "minhash-shared")
    fill = shared.groupBy("_node").agg(F.sum("_members").alias("_fill"))
    return written(shared.drop("_members").join(fill, "_node"), "minhash-buckets")


def leader_pairs(buckets: DataFrame, sigs: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's leader, if sizes and signatures allow."""
    leaders = written(
        buckets.groupBy("_bucket").agg(F.max(F.struct("_fill", "_node", "_n")).alias("_first")),
        "minhash-leaders",
    )
    pairs = (
        buckets.join(leaders, "_bucket")
        .where(F.col("_node") != F.col("_first._node"))
        .where(size_fits("_n", "_first._n"))
        .select(F.least("_first._node", "_node").alias("a"), F.greatest("_first._node", "_node").alias("b"))
        .distinct()
    )
    one = sigs.select(F.col("_node").alias("a"), F.col("_sig").alias("_one"))
    two = sigs.select(F.col("_node").alias("b"), F.col("_sig").alias("_two"))
    signed = pairs.join(one, "a").join(two, "b")
    return signed.where(alike("_one", "_two", COARSE_AT_LEAST)).select("a", "b")


def open_members(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components so far, with their blocks.

    ``_rest`` and ``_big`` are the numbers of blocks outside and in the largest component, ``_in_big``
    tells where a member belongs.
    """
    labelled = written(
        buckets.join(roots, "_node", "left").withColumn("_root", F.coalesce("_root", "_node")),
        "minhash-labelled",
    )
    parts = labelled.groupBy("_bucket", "_root").agg(F.count("*").alias("_size"))
    split = (
        parts.groupBy("_bucket")
        .agg(F.max(F.struct("_size", "_root")).alias("_most"), F.sum("_size").alias("_members"),
             F.count("*").alias("_parts"))
        .where("_parts > 1")
        .select(
            "_bucket", F.col("_most._root").alias("_most"),
            F.ceil((F.col("_members") - F.col("_most._size")) / BLOCK).cast("int").alias("_rest"),
            F.ceil(F.col("_most._size") / BLOCK).cast("int").alias("_big"),
        )
    )
    members = labelled.join(written(split, "minhash-split"), "_bucket")
    in_big = F.col("_root") == F.col("_most")
    own = F.pmod(F.xxhash64("_node"), F.when(in_big, F.col("_big")).otherwise(F.col("_rest")))
    return written(
        members.select("_bucket", "_node", "_root", "_n", "_rest", "_big", in_big.alias("_in_big"),
                       own.cast("int").alias("_block")),
        "minhash-members",
    )


def dealt_members(members: DataFrame) -> DataFrame:
    """Each member once for every group of two blocks (``_i``, ``_j``) that it takes part in.

    Blocks of the largest component have numbers from -1 downwards. They meet the blocks outside it
    and not each other, so as long as few members are outside, each goes into few groups.
    """
    rest = F.sequence(F.lit(0), F.col("_rest") - 1)
    big = F.transform(F.sequence(F.lit(1), F.col("_big")), lambda block: -block)
    others = F.when(F.col("_in_big"), rest).otherwise(F.concat(rest, big))
    block = F.when(F.col("_in_big"), -1 - F.col("_block")).otherwise(F.col("_block"))
    return (
        members.withColumn("_block", block)
        .withColumn("_other", F.explode(others))
        .withColumn("_i", F.least("_block", "_other"))
        .withColumn("_j", F.greatest("_block", "_other"))
        .drop("_other", "_rest", "_big", "_in_big")
    )


def block_pairs(
    docs: DataFrame, buckets: DataFrame, bands: DataFrame, roots: DataFrame, id_col: str,
    text_col: str, words: int,
) -> DataFrame:
    """Similar-looking pairs of a bucket that are in different components so far.

    A bucket with many members is dealt into blocks, and two blocks meet in a group of their own,
    which holds about 2 * ``BLOCK`` members whatever the bucket's size.
    """
    members = open_members(buckets, roots)
    nodes = members.select("_node").distinct().select(F.col("_node.id").alias("_id"),
                                                      F.col("_node.th").alias("_th"))
    nodes = written(nodes, "minhash-open")

    def fine_signature():
        hashes, family = WordHashes(), hash_family(FINE, SEED + 1)
        return lambda text: (
            minima(shingle_set(text, words, hashes), family).astype(np.uint8).tobytes()
        )

    fine = of_wanted_texts(docs, nodes, id_col, text_col, fine_signature, "_fine", "binary")
    fine = written(fine.join(bands, "_node"), "minhash-fine")
    dealt = dealt_members(members.join(fine, "_node"))

    def compare(group: pa.Table) -> pa.Table:
        signs = np.frombuffer(b"".join(group.column("_fine").to_pylist()), dtype=np.uint8)
        signs = signs.reshape(group.num_rows, -1)
        sizes = group.column("_n").to_numpy()
        block = group.column("_block").to_numpy()
        nodes = group.column("_node").combine_chunks()
        roots = group.column("_root").combine_chunks()
        root = np.unique(
            np.rec.fromarrays([roots.field("id").to_numpy(), roots.field("th").to_numpy()]),
            return_inverse=True,
        )[1]
        bands = group.column("_bands").combine_chunks().flatten().to_numpy()
        bands = bands.reshape(group.num_rows, -1)
        bucket = group.column("_bucket")[0].as_py()
        within = group.column("_i")[0] == group.column("_j")[0]
        least = FINE_AT_LEAST * (1 - 1 / 256) + 1 / 256
        left, right = [], []
        for row in range(group.num_rows - 1):
            rest = slice(row + 1, None)
            able = (root[rest] != root[row]) & (
                100 * np.minimum(sizes[rest], sizes[row])
                >= PERCENT * np.maximum(sizes[rest], sizes[row])
            )
            if not within:
                able &= block[rest] != block[row]
            other = np.nonzero(able)[0] + row + 1
            if len(other):
                other = other[(signs[other] == signs[row]).mean(axis=1) >= least]
                # A pair that shares several buckets leaves the first of them only.
                first = (bands[other] == bands[row]).argmax(axis=1)
                other = other[bands[other, first] == bucket]
                left += [row] * len(other)
                right += other.tolist()
        return pa.table({"a": nodes.take(pa.array(left, pa.int64())),
                         "b": nodes.take(pa.array(right, pa.int64()))})

    node_type = "struct<id:bigint,th:bigint>"
    found = dealt.groupBy("_bucket", "_i", "_j").applyInArrow(
        compare, f"a {node_type}, b {node_type}"
    )
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """Key, id, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    A document's set holds its distinct runs of ``words`` words, a shorter text is one run; only A-Z
    change to lower case. Sets are linked if their similarity is 0.8 or more, and a component takes
    the smallest id in it; that document stays. Null or blank texts have no set and are linked with
    nothing. Rows without an id come last, and their component id is null if all of the component
    lack one; repeated rows have the same result. An empty table gives an empty result.
    """
    sigs = signatures(docs, id_col, text_col, words)
    full = sigs.where("_n > 0")
    first = written(
        full.groupBy("_set").agg(F.min(node()).alias("_node")), "minhash-classes"
    )
    standing = written(
        full.join(first, "_set").where(node() == F.col("_node"))
        .select("_node", "_n", "_bands", "_sig"),
        "minhash-representatives",
    )
    buckets = shared_buckets(standing)
    links = confirmed(docs, leader_pairs(buckets, standing.select("_node", "_sig")),
                      id_col, text_col, words)
    roots = written(components(links), "minhash-roots")
    bands = standing.select("_node", "_bands")
    looked_at = block_pairs(docs, buckets, bands, roots, id_col, text_col, words)
    more = confirmed(docs, looked_at, id_col, text_col, words)
    final = components(
        roots.select(F.col("_node").alias("a"), F.col("_root").alias("b")).union(more)
    )
    classes = first.join(written(final, "minhash-final"), "_node", "left").select(
        "_set", F.coalesce("_root", "_node").alias("_root")
    )
    joined = sigs.join(written(classes, "minhash-final-classes"), "_set", "left")
    root = F.when(F.col("_n") > 0, F.col("_root")).otherwise(node())
    return joined.select(
        "_id", "_th",
        F.nullif(F.col("_id"), F.lit(9223372036854775807)).alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        F.nullif(root["id"], F.lit(9223372036854775807)).alias("component_id"),
        (root == node()).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the documents that stay, with all their columns."""
    kept = near_duplicates(docs, id_col, text_col).where("kept").select("_id", "_th").distinct()
    rows = packed(docs, id_col, text_col).join(kept, ["_id", "_th"], "left_semi")
    return rows.select("_row.*")


def op5_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4).drop("_id", "_th")


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
  FROM words, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sizes
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), roots AS (
  SELECT x AS doc_id, min(y) AS root FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id,
       d.doc_id = coalesce(root, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN roots USING (doc_id)
"""

QUERIES = {"op5_near_duplicates": op5_near_duplicates}
ORACLES = {"op5_near_duplicates": ORACLE}
