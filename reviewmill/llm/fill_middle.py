"""Fill-in-the-middle: documents cut at two lines and rearranged by rotating blocks in place.

A text is cut into a prefix, a middle and a suffix. The sentinels go into the bytes of the text,
``<P>prefix<M>middle<S>suffix``, and one rotation puts the middle last: of the blocks from ``<M>`` on
for the form psm, of the whole for spm. A rotation reverses both blocks and then the pair of them, so
no second copy of the text is put together. The inverse finds the sentinels, rotates back and takes
them out again.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import slices, table, text_of, without

SEED = 7
# Percent of texts that are rearranged, and percent of these in the form suffix first.
FIM_PERCENT, SPM_PERCENT = 100, 50
# The sentinels.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
ADDED = ["n_units", "form", "prefix_chars", "middle_chars", "fim_text"]


def unit_ends(text: bytes) -> list[int]:
    """End of each line, with the line break that ends it."""
    ends, at = [], text.find(b"\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find(b"\n", at + 1)
    if len(text) > (ends[-1] if ends else 0):
        ends.append(len(text))
    return ends


def turn(buffer: bytearray, start: int, end: int) -> None:
    """Reverse the bytes from start to end."""
    buffer[start:end] = buffer[start:end][::-1]


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange the neighbouring blocks ``start:cut`` and ``cut:end`` by three reversals."""
    turn(buffer, start, cut)
    turn(buffer, cut, end)
    turn(buffer, start, end)


def rearrange(text: bytes, first: int, second: int, form: str) -> bytes:
    """The text in the given form, cut at the offsets ``first`` and ``second``."""
    if form == "plain":
        return text
    buffer = bytearray(text)
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return bytes(buffer)


def restore(output: bytes, form: str) -> bytes:
    """The text that ``rearrange`` was given, from its result and form alone.

    The texts hold no sentinel, and no sentinel ends as another begins, so the first match of each
    is the one that was put in.
    """
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "psm":
        suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
        # The blocks are suffix, middle; turning them again needs the length of the second one.
        rotate(buffer, suffix, middle, len(buffer))
    else:
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    for sentinel in SENTINELS:
        at = buffer.index(sentinel)
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


def code_points(text: bytes | bytearray) -> int:
    return len(text.decode("utf-8", "surrogatepass"))


def texts_of(column: pa.Array) -> list[bytes]:
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def fill_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
    fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """Add the rearranged text and how it was made to every row.

    ``n_units`` counts the lines, ``form`` is plain, psm or spm, ``prefix_chars`` and
    ``middle_chars`` are code points (null if plain), ``fim_text`` is the result; they replace
    columns of these names. Cuts and form follow from the sha256 of seed and id, so they repeat. A
    null or empty text and one that holds a sentinel stay plain; a null text counts as empty. Rows
    without an id are drawn as one with an empty id. Repeated rows have equal results. An empty
    table gives an empty result. A text is held whole in one task, rows are independent.
    """
    rows = without(docs, ADDED)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digest = F.sha2(key, 256)
    draws = [F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") for at in (1, 9, 17, 25)]

    @F.arrow_udf(
        "n_units bigint, form string, prefix_chars bigint, middle_chars bigint, fim_text string"
    )
    def arrange(text: pa.Array, d1: pa.Array, d2: pa.Array, d3: pa.Array, d4: pa.Array) -> pa.Array:
        made = []
        for raw, *drawn in zip(texts_of(text), *(d.to_pylist() for d in (d1, d2, d3, d4))):
            ends = [0, *unit_ends(raw)]
            low, high = sorted(draw % len(ends) for draw in drawn[:2])
            first, second = ends[low], ends[high]
            if not raw or any(s in raw for s in SENTINELS) or drawn[2] % 100 >= fim_percent:
                form, prefix, middle = "plain", None, None
            else:
                form = "spm" if drawn[3] % 100 < spm_percent else "psm"
                prefix, middle = code_points(raw[:first]), code_points(raw[first:second])
            made.append((len(ends) - 1, form, prefix, middle, rearrange(raw, first, second, form)))
        counts, forms, prefixes, middles, results = zip(*made) if made else ((),) * 5
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(forms, pa.string()),
             pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()),
             pa.array(results, pa.binary()).cast(pa.string())],
            names=ADDED,
        )

    made = rows.withColumn("_made", arrange(text_of(text_col), *draws))
    return made.select(*[F.col(f"`{c}`") for c in rows.columns], "_made.*")


def unfill_middle(
    rows: DataFrame, fim_col: str = "fim_text", form_col: str = "form", to: str = "restored_text"
) -> DataFrame:
    """Add the text that ``fill_middle`` was given, from its result and form; null for a null one.

    The column replaces one of its name. Only results of ``fill_middle`` can be turned back.
    """

    @F.arrow_udf("string")
    def back(output: pa.Array, form: pa.Array) -> pa.Array:
        outputs = output.cast(pa.binary()).to_pylist()
        found = [None if raw is None else restore(raw, kind)
                 for raw, kind in zip(outputs, form.to_pylist())]
        return pa.array(found, pa.binary()).cast(pa.string())

    return without(rows, [to]).withColumn(to, back(F.col(fim_col), F.col(form_col)))


def op12_fill_middle(spark, sf_dir: str) -> DataFrame:
    made = unfill_middle(fill_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return made.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2("restored_text", 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS x,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
  FROM documents
), h AS (
  SELECT doc_id, t, u, len(u) AS n,
         ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
         ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid,
         array_to_string(u[b + 1:n], '') AS suf
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

QUERIES = {"op12_fill_middle": op12_fill_middle}
ORACLES = {"op12_fill_middle": ORACLE}
