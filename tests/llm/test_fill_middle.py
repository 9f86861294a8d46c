"""Fill-in-middle: cuts, rotations, exact return, odd rows."""

import hashlib
import random
import re

import pytest

from reviewmill.llm import fill_middle as fim


def plain_form(doc_id, text):
    """Units, form, prefix, middle and output, put together by slicing."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[at : at + 8], 16) for at in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return len(units), "plain", None, None, text
    if h4 % 100 < 50:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts():
    draws = random.Random(5)
    parts = ["a", "é", "\n", "\n\n", "<", "<P", "S>", "M>", "日本", "\r\n", " ", "\U0001F600", "<<", ">"]
    made = ["".join(draws.choices(parts, k=draws.randrange(12))) for _ in range(300)]
    return [None, "", "\n", "x", "<P>", "a<S>b\n", "<M>\n" * 3, "<S", *made, "línea\n" * 30_000]


def test_matches_slicing_and_returns_every_text(spark):
    rows = [(i, text, "own") for i, text in enumerate(odd_texts())]
    rows += [(None, "no id\nat all", "own"), (3, "x", "own"), (3, "x", "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string")
    made = fim.unfill_middle(fim.fill_middle(docs)).collect()
    assert len(made) == len(rows)
    for row in made:
        text = row["text"] or ""
        assert row["restored_text"] == text
        got = tuple(row[c] for c in ("n_units", "form", "prefix_chars", "middle_chars", "fim_text"))
        assert got == plain_form(row["doc_id"], text)
    assert {row["form"] for row in made} == {"plain", "psm", "spm"}


def test_shares_of_forms_and_columns_kept(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('a\nb\nc', id) AS text", "1 AS Fim_Text")
    made = fim.fill_middle(docs, fim_percent=40, spm_percent=25)
    assert made.columns == ["doc_id", "text", *fim.ADDED]
    count = {row["form"]: row["count"] for row in made.groupBy("form").count().collect()}
    assert abs(count["plain"] / 4000 - 0.6) < 0.04
    assert abs(count["spm"] / (4000 - count["plain"]) - 0.25) < 0.04


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.unfill_middle(fim.fill_middle(docs)).count() == 0


@pytest.mark.parametrize("cut", range(7))
def test_rotation_undoes_itself(cut):
    buffer = bytearray(b"012345")
    fim.rotate(buffer, 0, cut, 6)
    assert bytes(buffer) == b"012345"[cut:] + b"012345"[:cut]
    fim.rotate(buffer, 0, 6 - cut, 6)
    assert bytes(buffer) == b"012345"
