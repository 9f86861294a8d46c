"""The whole pipeline against a brute-force version, and its registration."""

import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
from conftest import SMALL
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from llm.test_dedup import brute_components, brute_lines
from llm.test_text import brute_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WHITE = " \t\n\x0b\x0c\r"


def brute_rules(docs):
    """Documents that pass, without lines in more than 20 texts and a share of a source's texts."""
    hosts, lines = {}, {}
    for d in docs:
        hosts.setdefault(d["source"], set()).add(d["text"])
        for line in set(d["text"].split("\n")):
            norm = line.strip(WHITE).lower()
            if norm:
                lines.setdefault((d["source"], norm), set()).add(d["text"])
    often = {k for k, t in lines.items() if len(t) > 20 and len(t) > 0.08 * len(hosts[k[0]])}
    for d in docs:
        n_words, *_, repeated = brute_quality(d["text"])
        if n_words < 50 or 100 * repeated > 50 * n_words:
            continue
        rows = d["text"].split("\n")
        frequent = [(d["source"], r.strip(WHITE).lower()) in often for r in rows]
        gone = sum(len(r.split()) for r, f in zip(rows, frequent) if f)
        if gone <= 0.7 * n_words:
            yield d | {"text": "\n".join(r for r, f in zip(rows, frequent) if not f)}


def brute_mix(docs):
    size = Counter()
    for d in docs:
        size[d["source"]] += len(d["text"])
    total, roots = sum(size.values()), sum(math.sqrt(n) for n in size.values())
    for d in docs:
        n = size[d["source"]]
        rate = math.sqrt(n) / roots * total / n if n else 1.0
        draws = max(1, math.ceil(rate / 64))
        count = 0
        for draw in range(1, draws + 1):
            digest = hashlib.md5(f"17:{d['doc_id']}:{draw}".encode()).hexdigest()[:13]
            u, k = (int(digest, 16) + 0.5) / 2**52, 0
            p = upto = math.exp(-rate / draws)
            while upto <= u:
                k += 1
                p *= rate / draws / k
                upto += p
            count += k
        yield from [d] * count


def test_pipeline_matches_brute_force(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    docs = sorted(brute_rules(docs), key=lambda d: d["doc_id"])
    gone = brute_lines([(d["doc_id"], d["text"]) for d in docs])
    for d in docs:
        rows = d["text"].split("\n")
        d["text"] = "\n".join(r for k, r in enumerate(rows) if k not in gone.get(d["doc_id"], ()))
    roots = brute_components([(d["doc_id"], d["text"]) for d in docs], 5)
    kept = []
    for d in docs:
        size, root = roots[(d["doc_id"], d["text"])]
        if not size or root == d["doc_id"]:
            kept.append(d)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for d in brute_mix(kept):
        ids = library.encode(d["text"], add_special_tokens=False).ids
        expected.append((d["doc_id"], d["text"], d["lang"], d["source"], len(d["text"]), len(ids),
                         np.array(ids, "<u4").tobytes(), True))
    found = corpus_pipeline.run(spark, SMALL)
    assert found.columns == [*COLUMNS, "n_tokens", "tokens", "decodes"]
    assert Counter(tuple(map(bytes_or_value, r)) for r in found.collect()) == Counter(expected)


def bytes_or_value(value):
    return bytes(value) if isinstance(value, bytearray) else value


def test_stages_keep_the_columns_and_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == COLUMNS and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == 0


def test_registered_queries():
    queries = __spark_entry__.queries()
    numbered = {int(name[2:].split("_")[0]) for name in queries if name.startswith("op")}
    assert numbered == set(range(1, 14)) and queries["pipeline"] is corpus_pipeline.run
