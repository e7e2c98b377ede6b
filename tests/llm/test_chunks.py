"""Chunk boundaries and shared passages, against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from coppice.llm import chunks

SETTINGS = chunks.ChunkSettings()
GEAR = chunks.gear_table(SETTINGS.gear_seed)


def parts(data):
    ends = chunks.boundaries(data, GEAR, SETTINGS)
    assert ends[-1] == len(data) and max(np.diff([0, *ends])) <= SETTINGS.max_bytes
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def slow_cuts(data):
    """Ends of windows without a mark, one window at a time; for hashes that differ."""
    hashes = [sum(int(GEAR[data[i - k]]) << k for k in range(min(16, i + 1))) & 0xFFFF for i in range(len(data))]
    raw = [i for i, h in enumerate(hashes) if h >> (16 - SETTINGS.bits) == 0]
    gaps = zip(raw, [-SETTINGS.min_bytes, *raw], strict=False)
    marks = {i for i, before in gaps if i - before >= SETTINGS.min_bytes}
    cuts = set(marks)
    for start in range(len(data) - SETTINGS.max_bytes + 1):
        window = range(start, start + SETTINGS.max_bytes)
        if marks.isdisjoint(window):
            cuts.add(min(window, key=lambda i: (hashes[i], -i)))
    return sorted({c + 1 for c in cuts} | {len(data)})


def test_cuts_are_the_smallest_hashes_of_windows_without_a_mark():
    rng = random.Random(1)
    for size in (1, 63, 64, 65, 200, 1500):
        data = bytes(rng.choices(range(97, 123), k=size))
        assert chunks.boundaries(data, GEAR, SETTINGS) == slow_cuts(data)


@pytest.mark.parametrize("period", [b" ", b"ab", b"foo bar ", b"one word and another one, "])
def test_periodic_text_is_cut_alike_wherever_it_begins(period):
    inside = parts(period * 400)
    moved = parts(b"something before, of another length" + period * 300 + b"and after")
    assert len(inside) <= len(period * 400) / SETTINGS.min_bytes + 16  # hashes of the first bytes differ
    shared = set(inside) & set(moved)
    assert sum(len(p) for p in moved if p in shared) > 0.8 * len(period * 300)


def test_every_shared_window_of_words_is_found(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    seen = defaultdict(set)
    for doc_id, text in documents.collect():
        words = (text or "").split()
        for i in range(len(words) - 50):
            seen[xxhash.xxh3_128_digest(" ".join(words[i : i + 51]).encode())].add(doc_id)
    wanted = {d for ids in seen.values() if len(ids) > 1 for d in ids}
    found = {r["doc_id"] for r in chunks.repeated_passages(documents).select("doc_id").distinct().collect()}
    assert len(wanted) > 100 and wanted <= found


def test_spans_of_passages_occur_in_the_first_document(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in documents.collect()}
    got = chunks.repeated_passages(documents).filter(F.col("first_doc_id") < F.col("doc_id")).collect()
    assert got
    for r in got:  # it has at least one chunk of the passage
        span = texts[r["doc_id"]][r["start"] : r["end"]]
        assert any(p in texts[r["first_doc_id"]] for p in parts_of(texts[r["doc_id"]], r["start"], r["end"]))
        assert len(span) == r["end"] - r["start"] >= SETTINGS.min_passage


def parts_of(data, start, end):
    ends = chunks.boundaries(data, GEAR, SETTINGS)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False) if start <= a and b <= end]
